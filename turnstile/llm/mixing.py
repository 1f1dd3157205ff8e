"""Sources mixed to target weights with nested hash thresholds.

Each document has a hash of its own, so "all documents of a source with a hash up
to x" is a fair sample, and a larger budget contains the smaller one's. Sizes are
summed by source and hash bucket; the bucket in which the running sum crosses the
budget is the boundary, and only its rows are summed again by finer buckets, down
to single hashes. A final filter by threshold takes the documents: nothing is
sorted but histograms of at most 4096 rows per source.

Defined results: NULL text has size 0; NULL is a source of its own, after all
others. Documents of one source with one doc_id share a hash and go together;
documents without a doc_id are told apart by their text, and only repeated rows of
them go together. A source without words has target 0. An empty table gives no rows.
Of the one document at the boundary, the side nearer to the target is taken. In the
mix all columns of the documents come back as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from turnstile.llm.texts import whole, word_count
from turnstile.session import scratch_path

LEVELS = (3, 6, 32)  # hex digits of the hash: 4096 buckets, each refined by 4096, then single hashes
WEIGHTS = (3, 1, 2)


def document_hash(doc_id: Column, text: Column) -> Column:
    """32 hex digits that depend on doc_id alone, or on the text where there is none."""
    nameless = F.concat(F.lit("text "), F.md5(whole(text).cast("binary")))
    return F.md5(F.coalesce(doc_id.cast("string"), nameless).cast("binary"))


def water_levels(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Target of each row of (source, source_size).

    A target is the source's weight times one common level, cut at ``most`` times
    its size; the level is the one at which all targets add up to ``share`` of all
    sizes. Sources are one row each, numbered and summed in one small window.
    """
    every = Window.partitionBy()
    place = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    pick = F.array(*(F.lit(w) for w in weights))
    ranked = (
        sizes.withColumn("place", F.row_number().over(place))
        .withColumn("weight", F.get(pick, ((F.col("place") - 1) % len(weights)).cast("int")))
        .withColumn("cap", most * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("left", share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.col("left") / F.col("open"))
    )
    # the first source, by ratio, that its cap does not cut sets the level for all after it
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level"))).over(every)["level"]
    return ranked.withColumn("all_level", level).select(
        "source", "source_size", F.least("cap", F.col("all_level") * F.col("weight")).alias("target")
    )


def thresholds(rows: DataFrame, needs: DataFrame) -> DataFrame:
    """The largest hash to take for each source: (source, threshold).

    ``rows`` has source, hash and size; ``needs`` has source and need, in size units.
    """
    spark = rows.sparkSession
    boundary = needs.select("source", "need", F.lit("").alias("prefix"), F.lit(0).cast("long").alias("sum_before"))
    for digits in LEVELS:
        inside = F.substring("hash", 1, digits)
        done = LEVELS[max(0, LEVELS.index(digits) - 1)] if digits != LEVELS[0] else 0
        kept = rows.withColumn("prefix", F.substring("hash", 1, done))
        if done:
            wanted = boundary.select(F.col("source").alias("_source"), F.col("prefix").alias("_prefix"))
            kept = kept.join(
                wanted, F.col("source").eqNullSafe(F.col("_source")) & (F.col("prefix") == F.col("_prefix")), "left_semi"
            )
        histogram = kept.groupBy("source", inside.alias("bucket")).agg(F.sum("size").alias("in_bucket"))
        known = boundary.select(F.col("source").alias("_source"), "need", "prefix", "sum_before")
        running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        summed = histogram.join(known, F.col("source").eqNullSafe(F.col("_source"))).select(
            "source",
            "need",
            "prefix",
            "bucket",
            "in_bucket",
            (F.col("sum_before") + F.coalesce(F.sum("in_bucket").over(running), F.lit(0))).alias("sum_before"),
        )
        if digits != LEVELS[-1]:
            crossing = summed.where(F.col("sum_before") + F.col("in_bucket") > F.col("need"))
            first = crossing.groupBy("source").agg(F.min(F.struct("bucket", "need", "sum_before")).alias("at"))
            path = scratch_path(spark, "boundary")
            first.select(
                "source", F.col("at.need").alias("need"), F.col("at.bucket").alias("prefix"), "at.sum_before"
            ).write.parquet(path)
            boundary = spark.read.parquet(path)
    taken = F.when(F.col("sum_before") + F.col("in_bucket") / 2 <= F.col("need"), F.col("bucket"))
    found = summed.groupBy("source").agg(F.coalesce(F.max(taken), F.min("prefix")).alias("threshold"))
    path = scratch_path(spark, "thresholds")
    found.write.parquet(path)
    return spark.read.parquet(path)


def mix_plan(docs: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source: source_size, target, whole ``times`` for every document, ``threshold`` for once more."""
    spark = docs.sparkSession
    path = scratch_path(spark, "word-counts")
    docs.select("source", document_hash(F.col("doc_id"), F.col("text")).alias("hash"), word_count(F.col("text")).alias("size")).write.parquet(path)
    rows = spark.read.parquet(path)
    path = scratch_path(spark, "targets")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    times = F.when(F.col("source_size") == 0, 0).otherwise(F.floor(F.col("target") / F.col("source_size"))).cast("long")
    water_levels(sizes, share=share, most=most).withColumn("times", times).withColumn(
        "need", F.col("target") - F.col("times") * F.col("source_size")
    ).write.parquet(path)
    targets = spark.read.parquet(path)
    limits = thresholds(rows, targets).select(F.col("source").alias("_limited"), "threshold")
    path = scratch_path(spark, "plan")
    full = F.col("times") >= most
    targets.join(limits, F.col("source").eqNullSafe(F.col("_limited")), "left").select(
        F.col("source").alias("_source"),
        F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"),
        F.col("times").alias("_times"),
        # a source never crossed gives all once more, a full one none
        F.when(full, "").otherwise(F.coalesce("threshold", F.lit("g"))).alias("_threshold"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def planned(docs: DataFrame, **limits: float) -> DataFrame:
    """Each document as ``row``, the plan of its source (``_source`` ..) and ``_taken``, how often it is in the mix."""
    once_more = (document_hash(F.col("row.doc_id"), F.col("row.text")) <= F.col("_threshold")).cast("long")
    plan = mix_plan(docs, **limits)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return rows.join(plan, F.col("row.source").eqNullSafe(F.col("_source"))).withColumn("_taken", F.col("_times") + once_more)


def mixed(docs: DataFrame, **limits: float) -> DataFrame:
    """Every document with the words that the mix takes of it, repeats counted."""
    size = word_count(F.col("row.text"))
    return planned(docs.select("doc_id", "source", "text"), **limits).select(
        "row.doc_id",
        "row.source",
        size.alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (size * F.col("_taken")).alias("taken"),
    )


def mixture(docs: DataFrame, **limits: float) -> DataFrame:
    """The mix itself: each document as often as it is taken, all columns as they are."""
    rows = planned(docs, **limits).where("_taken > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "_taken"))).select("row.*")
