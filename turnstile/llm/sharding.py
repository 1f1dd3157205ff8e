"""Shards of near equal size by longest-processing-time scheduling.

Groups that must stay together are sorted by size and go, largest first, to the
least loaded shard through a heap. A group of at least ``1 / ALONE`` of a shard's fair
load goes to the heap alone, and there are at most ``ALONE`` times the shards of them
at any input size; so 16 equal groups always come to 16 shards. Smaller groups of like
size (the same power of two) that fall into the same hash slot travel as one bundle,
at most 64 classes times ``SLOTS``; these level the shards after the large ones. A
table all of whose groups are alone is scheduled exactly.

Defined results: NULL text has no bytes and CRC 0; NULL texts form one group of
their own. A group larger than a fair share fills its shard beyond it, as it must
stay together. Repeated rows get a slot each. An empty table gives no rows. Columns
kept beside the result come back as they are, except those named as a column of it.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from turnstile.llm.texts import whole
from turnstile.session import scratch_path

SLOTS = 512  # bundles per size class
ALONE = 1024  # a group of at least this part of a shard's fair load is no part of a bundle
BLOCK_ROWS = 100_000  # rows that are numbered in one task


def longest_first(items: list[tuple], shards: int) -> dict:
    """Shard of each (size, key): the largest first, each to the least loaded shard.

    Ties go by key and by shard number, so that reruns agree.
    """
    loads = [(0, shard) for shard in range(shards)]
    placed = {}
    for size, key in sorted(items, key=lambda item: (-item[0], item[1])):
        load, shard = heapq.heappop(loads)
        placed[key] = shard
        heapq.heappush(loads, (load + size, shard))
    return placed


def group_shards(rows: DataFrame, shards: int) -> DataFrame:
    """Shard of each group of ``rows`` (group, size): columns group and shard.

    Groups are summed in the input tasks first, so a hot group is one row per task.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "groups")
    rows.groupBy("group").agg(F.sum("size").alias("total")).write.parquet(path)
    groups = spark.read.parquet(path)
    load = groups.agg(F.sum("total")).first()[0] or 0
    alone = F.col("total") * (shards * ALONE) >= load
    slot = F.pmod(F.xxhash64(F.lit("bundle"), "group"), F.lit(SLOTS))
    groups = groups.select(
        "group",
        "total",
        F.when(alone, -1).otherwise(F.length(F.bin(F.col("total")))).alias("class"),
        F.when(alone, F.col("group")).otherwise(slot).alias("slot"),
    )
    bundles = groups.groupBy("class", "slot").agg(F.sum("total").alias("total"))
    items = [(b["total"], (b["class"], b["slot"])) for b in bundles.collect()]  # at most shards * ALONE + 64 * SLOTS
    placed = [(c, s, shard) for (c, s), shard in longest_first(items, shards).items()]
    table = spark.createDataFrame(placed, "class int, slot long, shard int")
    return groups.join(F.broadcast(table), ["class", "slot"]).select("group", "shard")


def numbered(placed: DataFrame, order: list[str]) -> DataFrame:
    """``placed`` with a gapless ``slot`` from 0 within each shard.

    Rows are dealt into hash blocks, counted, and numbered within their block from
    the block's first number; no task sees a whole shard. ``placed`` is read twice.
    """
    rows = placed.count()
    blocks = max(1024, rows // BLOCK_ROWS)
    dealt = placed.withColumn("block", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    counts = dealt.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "block").orderBy(*order)
    return (
        dealt.join(first, ["shard", "block"])
        .withColumn("slot", F.col("first") + F.row_number().over(inside) - 1)
        .drop("first", "block")
    )


def shard_documents(docs: DataFrame, shards: int = 16, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of every document, then its size, text_crc32, shard and slot; equal texts share a shard."""
    spark = docs.sparkSession
    text = whole(F.col("text"))
    made = {
        "size": (F.octet_length(text) + 1).cast("long"),
        "text_crc32": F.crc32(text.cast("binary")),
        "group": F.xxhash64(F.col("text").isNull(), text),
    }
    kept = F.struct(F.col("doc_id").alias("doc_id"), *(F.col(f"`{c}`") for c in keep or [] if c != "doc_id"))
    rows = docs.select(kept.alias("row"), *(c.alias(n) for n, c in made.items()))
    path = scratch_path(spark, "sizes")
    rows.select("group", "size").write.parquet(path)
    sizes = spark.read.parquet(path)
    path = scratch_path(spark, "group-shards")
    group_shards(sizes, shards).write.parquet(path)
    path_placed = scratch_path(spark, "placed")
    rows.join(spark.read.parquet(path), "group").write.parquet(path_placed)
    told = ["size", "text_crc32", "shard", "slot"]
    names = [c for c in keep or ["doc_id"] if c not in told]
    placed = numbered(spark.read.parquet(path_placed), ["row.doc_id", "group", "size"])
    return placed.select(*(F.col(f"row.`{c}`") for c in names), *told)


def sharded(docs: DataFrame) -> DataFrame:
    """The documents by the law ``bytes``: shard sizes near equal."""
    return shard_documents(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
