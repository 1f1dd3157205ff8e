"""SimHash fingerprints, their links within a Hamming radius, and groups of near-duplicates.

Fingerprints are computed by DataFrame expressions: each shingle's hash adds to one
counter per bit, two counters to a long, summed per document in the input task.

Links are searched in BK-trees. A fingerprint is cut into ``radius + chosen`` blocks;
two within the radius differ in at most ``radius`` of them, so they agree in some
``chosen`` of them whole. The distinct fingerprints that agree in such a choice form
a shard with a tree of its own, and no link is lost. ``chosen`` follows from the
number of fingerprints: one block of 16 bits for few, two blocks (25 bits) from some
10^8, three (32 bits) from 10^11 on, so that a shard of evenly spread fingerprints
stays about one tree at any size. The trees go to their queries by a shuffle and
not by a broadcast, for together they hold every fingerprint. A shard beyond
``TREE_ROWS`` is split into several trees, and each part of it is searched in each
tree: no task gets more than two parts, and no candidate is left out.

Within a shard only links that connect something are returned, fewer than two per
fingerprint, so a group of copies never turns into all its pairs.

Defined results: NULL and empty texts have fingerprint zero, which is linked as any
other. Repeated rows get equal results, one row each; of the documents that stay
each group has one row, so of repeated rows one. A NULL doc_id never names a
component that has another document. Columns beside the named ones are not read. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.bk_trees import spanning_links
from turnstile.llm.components import components
from turnstile.llm.texts import lower_ascii, unused, whole, words
from turnstile.session import scratch_path

BITS = 64
MOST_CHOSEN = 4  # blocks that make a key; 35 keys of 36 bits at radius 3
TREE_ROWS = 2048
BATCH_ROWS = 40_000  # rows of whole shards that one call to the trees gets

PAIR = (1 << 32) | 1  # the lowest bit of each half of a long


def _written(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shingle_hash(size: int) -> Column:
    """XXH64, seed 42, of the ``size`` words from i on; of all words where there are fewer."""
    text = F.concat_ws(" ", *(F.get("words", F.col("i") + j) for j in range(size)))
    return F.when(F.col("i").isNotNull(), F.xxhash64(text))


def fingerprints(docs: DataFrame, keep: list[Column], shingle: int = 3) -> DataFrame:
    """``keep`` columns and ``f0``: a bit is 1 if set in over half the hashes of the shingles."""
    row = F.monotonically_increasing_id().alias("_row")
    rows = docs.select(row, *keep, words(lower_ascii(whole(F.col("text")))).alias("words"))
    names = [c for c in rows.columns if c not in ("_row", "words")]
    last = F.greatest(F.size("words") - shingle, F.lit(0))
    steps = F.when(F.size("words") > 0, F.sequence(F.lit(0), last))
    hashes = rows.select("_row", *names, "words", F.explode_outer(steps).alias("i")).select(
        "_row", *names, shingle_hash(shingle).alias("h")
    )
    sums = [F.sum(F.shiftrightunsigned("h", bit).bitwiseAND(F.lit(PAIR))).alias(f"s{bit}") for bit in range(32)]
    counted = hashes.groupBy("_row", *names).agg(F.count("h").alias("n"), *sums)
    total = F.lit(0).cast("long")
    for bit in range(BITS):
        count = F.shiftrightunsigned(f"s{bit % 32}", 32 * (bit // 32)).bitwiseAND(F.lit(0xFFFFFFFF))
        one = F.lit(signed(1 << bit)).cast("long")
        total = total.bitwiseOR(F.when(count * 2 > F.col("n"), one).otherwise(F.lit(0).cast("long")))
    return counted.select(*names, total.alias("f0"))


def signed(bits: int) -> int:
    """64 bits as a signed number."""
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def hexadecimal(column: str) -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def block_masks(radius: int, chosen: int) -> list[int]:
    """The bits of every choice of ``chosen`` out of ``radius + chosen`` blocks: two prints within the radius agree on one."""
    blocks = radius + chosen
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]
    return [sum(choice) for choice in combinations(masks, chosen)]


def chosen_blocks(prints: int, radius: int) -> int:
    """The fewest blocks whose bits spread evenly spread prints over shards of one tree."""
    for chosen in range(1, MOST_CHOSEN):
        if prints >> (BITS * chosen // (radius + chosen)) <= TREE_ROWS:
            return chosen
    return MOST_CHOSEN


def _linker(radius: int):
    """The function that links the rows of whole shards of a partition, sorted by shard."""
    shard_of = ["band", "key", "a", "b"]

    def linked(frame: pd.DataFrame) -> pd.DataFrame:
        prints = frame["f0"].to_numpy().view(np.uint64)[:, None]
        shard = frame.groupby(shard_of, sort=False).ngroup().to_numpy()
        one, other, far = spanning_links(prints, shard, frame["in_tree"].to_numpy(), radius)
        return pd.DataFrame(
            {"u": prints[one, 0].view(np.int64), "v": prints[other, 0].view(np.int64), "distance": far.astype(np.int32)}
        )

    def over(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        for frame in frames:
            waiting.append(frame)
            if sum(map(len, waiting)) < BATCH_ROWS:
                continue
            rows = pd.concat(waiting, ignore_index=True)
            key = rows[shard_of].to_numpy()
            ends = np.flatnonzero((key[1:] != key[:-1]).any(axis=1))
            cut = int(ends[-1]) + 1 if len(ends) else 0  # the last shard may go on
            if cut:
                yield linked(rows.iloc[:cut])
            waiting = [rows.iloc[cut:]]
        if waiting and sum(map(len, waiting)):
            yield linked(pd.concat(waiting, ignore_index=True))

    return over


def links(prints: DataFrame, radius: int, chosen: int) -> DataFrame:
    """Links between distinct ``prints`` (f0) that connect all that the radius connects: u, v, distance."""
    keys = [
        F.struct(F.lit(band).alias("band"), F.col("f0").bitwiseAND(F.lit(signed(mask)).cast("long")).alias("key"))
        for band, mask in enumerate(block_masks(radius, chosen))
    ]
    banded = prints.select("f0", F.explode(F.array(*keys)).alias("at")).select("f0", "at.band", "at.key")
    shards = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shards = _written(shards.select("band", "key", F.ceil(F.col("n") / TREE_ROWS).cast("int").alias("parts")), "shards")
    part = F.pmod(F.xxhash64(F.lit("part"), "f0"), F.col("parts")).cast("int")
    dealt = (
        banded.join(shards, ["band", "key"])
        .withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "band",
            "key",
            F.least("part", "other").alias("a"),
            F.greatest("part", "other").alias("b"),
            (F.col("part") <= F.col("other")).alias("in_tree"),
            "f0",
        )
    )
    shuffled = dealt.repartition("band", "key", "a", "b").sortWithinPartitions("band", "key", "a", "b")
    return shuffled.mapInPandas(_linker(radius), "u long, v long, distance int")


def components_of(nodes: DataFrame, radius: int, chosen: int | None = None) -> DataFrame:
    """``nodes`` (distinct f0 and other columns, written) with ``root``, the same for all that links connect."""
    edges = _written(links(nodes.select("f0"), radius, chosen or chosen_blocks(nodes.count(), radius)).select("u", "v"), "links")
    rooted = nodes.join(components(edges), F.col("f0") == F.col("node"), "left")
    return _written(rooted.select(*nodes.columns, F.coalesce("root", "f0").alias("root")), "rooted")


def linked_documents(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint and the smallest doc_id it is linked to through any chain."""
    rows = _written(fingerprints(docs, [F.col("doc_id")], shingle), "fingerprints")
    nodes = _written(rows.groupBy("f0").agg(F.min("doc_id").alias("doc_id")), "nodes")
    rooted = components_of(nodes, radius)
    least = _written(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "components")
    named = _written(rooted.join(least, "root").select("f0", "component_id"), "named")
    return rows.join(named, "f0").select("doc_id", hexadecimal("f0").alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """The documents without near-duplicates: of each component one row stays, all columns as they are.

    The row with the smallest doc_id stays, a NULL doc_id last; of several with one
    doc_id that of the smaller text hash, of rows that repeat both any one. The
    documents are written once with a number for each row, which names the row that stays.
    """
    number = unused("_number", docs.columns)
    copy = _written(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    place = F.struct(
        F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("text"), F.col(number).alias("number")
    )
    prints = fingerprints(copy, [place.alias("place")], shingle)
    nodes = _written(prints.groupBy("f0").agg(F.min("place").alias("place")), "nodes")
    stays = components_of(nodes, radius).groupBy("root").agg(F.min("place").alias("place"))
    stays = _written(stays.select(F.col("place.number").alias(number)), "stays")
    return copy.join(stays, number, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
