"""Connected components by alternating star contraction, written round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.session import scratch_path


def _written(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hook(arcs: DataFrame, larger_only: bool) -> DataFrame:
    """Every neighbour of a node, or every larger one, is tied to the node's smallest neighbour.

    The smallest neighbours are folded in the input tasks and written, so that the
    join starts from two shuffles and the arcs of a star's centre can be split.
    """
    least = arcs.groupBy("u").agg(F.min("v").alias("w")).withColumn("w", F.least("u", "w"))
    least = _written(least.select(F.col("u").alias("_u"), "w"), "least")
    tied = arcs.join(least, F.col("u") == F.col("_u"))
    if larger_only:
        tied = tied.where(F.col("v") > F.col("u"))
    else:
        tied = tied.unionAll(least.select(F.col("_u").alias("u"), F.col("_u").alias("v"), "_u", "w"))
    return tied.select(F.col("v").alias("u"), F.col("w").alias("v")).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it can reach, for every node of ``edges`` (u, v).

    Large-star and small-star rounds alternate until the arcs stay the same; each
    round is written to the shared scratch storage, so lineage stays short. Nodes
    without an edge to another node do not appear.
    """
    arcs = _written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "arcs")
    seen = None
    while True:
        state = arcs.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == seen or state[0] == 0:
            return arcs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        both = arcs.unionAll(arcs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _written(_hook(both, larger_only=True), "large-star")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        arcs = _written(_hook(down, larger_only=False), "small-star")
