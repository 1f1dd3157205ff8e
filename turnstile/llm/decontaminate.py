"""Benchmark passages in documents, found by winnowing.

Every run of ``GRAM`` words has a hash; of each ``PICK`` hashes in a row the
smallest (of equal ones the last) is a fingerprint. Two texts that share
``GRAM + PICK - 1`` words in a row share the whole row of hashes, hence its
fingerprint, so no window of that many words is missed. Fingerprints of documents
and items are joined, and each hit is extended: all windows around it are compared
word by word. Items shorter than a window are one window and are looked up whole.

All steps are DataFrame operations. Documents travel as rows of one fingerprint
with its few surrounding word hashes, never as whole texts, and only where a
fingerprint is picked (about two in seven words). Whether the items' side is
broadcast is left to the planner: it is written first, so its size is known.

Defined results: NULL and empty texts have no words and are clean. An item
without an id makes hits but is not counted. Repeated rows are judged alike, one
row each. Without items every document is clean. Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.llm.texts import NO_WORD, lower_ascii, unused, whole
from turnstile.session import scratch_path

GRAM = 5
PICK = 6
WINDOW = GRAM + PICK - 1


def _word_hashes(text: Column) -> Column:
    """A 64-bit hash for each word, in order."""
    parts = F.split(lower_ascii(whole(text)), NO_WORD)
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))


def _starts(rows: DataFrame, length: int) -> DataFrame:
    """A row for each t at which ``length`` words begin."""
    last = F.size("hashes") - length
    return rows.where(last >= 0).withColumn("t", F.explode(F.sequence(F.lit(0), last)))


def fingerprints(rows: DataFrame) -> DataFrame:
    """The picked grams of each row with ``hashes``: hash ``mark`` and word position ``at``.

    A pick is given where it first appears: at the text's first row of hashes, where
    the hash that enters the row is the new smallest, or where the one that left it was.
    """
    names = [c for c in rows.columns if c != "hashes"]
    gram = lambda i: F.xxhash64(*(F.get("hashes", i + j) for j in range(GRAM)))
    grams = F.transform(F.sequence(F.lit(0), F.size("hashes") - GRAM), gram).alias("grams")
    hashed = rows.where(F.size("hashes") >= WINDOW).select(*names, "hashes", grams)
    wide = hashed.withColumn("t", F.explode(F.sequence(F.lit(0), F.size("grams") - PICK)))
    here = [F.get("grams", F.col("t") + j) for j in range(PICK)]
    left = F.get("grams", F.col("t") - 1)
    inner = F.least(*here[:-1])  # in this row and in the one before
    new = (F.col("t") == 0) | (here[-1] <= inner) | (left < inner)
    marked = wide.where(new).select(*names, "hashes", "grams", "t", F.least(*here).alias("mark"))
    step = F.coalesce(*(F.when(here[j] == F.col("mark"), j) for j in reversed(range(PICK))))
    return marked.select(*names, "hashes", "mark", (F.col("t") + step).alias("at"))


def _around(rows: DataFrame) -> DataFrame:
    """Fingerprints with the word hashes from which every window over them can be cut: ``near``, ``lead`` before ``at``."""
    names = [c for c in rows.columns if c != "hashes"]
    lead = F.least(F.col("at"), F.lit(PICK - 1))
    near = F.slice("hashes", F.col("at") - lead + 1, lead + F.lit(WINDOW))
    return rows.select(*names, lead.alias("lead"), near.alias("near"))


def _windows_over(rows: DataFrame) -> DataFrame:
    """Each window that contains the fingerprint: its start ``step`` words before it, its word hashes."""
    step = F.explode(F.sequence(F.lit(0), "lead")).alias("step")
    cut = F.slice("near", F.col("lead") - F.col("step") + 1, WINDOW)
    names = [c for c in rows.columns if c not in ("near", "lead")]
    return rows.select(*names, "near", "lead", step).select(*names, "step", cut.alias("window")).where(F.size("window") == WINDOW)


def item_windows(items: DataFrame) -> DataFrame:
    """Every window of every item once: item_id, ``window`` (its word hashes) and its key."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), _word_hashes(F.col("text")).alias("hashes"))
    full = _starts(rows, WINDOW).select("item_id", F.slice("hashes", F.col("t") + 1, WINDOW).alias("window"))
    short = rows.where((F.size("hashes") > 0) & (F.size("hashes") < WINDOW)).select("item_id", F.col("hashes").alias("window"))
    return full.unionAll(short).distinct().withColumn("key", F.xxhash64("window"))


def _long_hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Windows of full length in documents: identity columns, ``start``, ``length``, ``key``."""
    spark = docs.sparkSession
    # a window is a text of its own with one row of hashes: one fingerprint
    marked = fingerprints(windows.where(F.size("window") == WINDOW).select("key", "window", F.col("window").alias("hashes")))
    path = scratch_path(spark, "item-fingerprints")
    marked.select("mark", F.col("at").alias("step"), "window", "key").distinct().write.parquet(path)
    theirs = spark.read.parquet(path)
    marks = theirs.select("mark").distinct()
    path = scratch_path(spark, "marks")
    marks.write.parquet(path)
    ours = _around(fingerprints(docs)).join(spark.read.parquet(path), "mark", "left_semi")
    found = _windows_over(ours).join(theirs, ["mark", "step", "window"])
    names = [c for c in docs.columns if c != "hashes"]
    return found.select(*names, (F.col("at") - F.col("step")).alias("start"), F.lit(WINDOW).alias("length"), "key")


def _short_hits(docs: DataFrame, windows: DataFrame, length: int) -> DataFrame:
    """The same for items of fewer words than a window: every run of that many words is looked up."""
    names = [c for c in docs.columns if c != "hashes"]
    theirs = windows.where(F.size("window") == length).select("window", "key").distinct()
    runs = _starts(docs, length).select(*names, F.col("t").alias("start"), F.slice("hashes", F.col("t") + 1, length).alias("window"))
    return runs.join(theirs, "window").select(*names, "start", F.lit(length).alias("length"), "key")


def _covered(spans: Column) -> Column:
    """Words inside any of the spans (start, length)."""
    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))

    def add(state: Column, span: Column) -> Column:
        end = span["start"] + span["length"]
        fresh = F.greatest(end - F.greatest(span["start"], state["end"]), F.lit(0))
        return F.struct((state["total"] + fresh).alias("total"), F.greatest(end, state["end"]).alias("end"))

    return F.aggregate(F.array_sort(spans), zero, add)["total"]


def text_key() -> Column:
    """What identifies a text: hits belong to texts, however many documents repeat one."""
    return F.md5(whole(F.col("text")).cast("binary"))


def hit_texts(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The texts that hold a window of an item: text_md5, n_hit words inside windows, the sorted item_ids."""
    spark = docs.sparkSession
    path = scratch_path(spark, "item-windows")
    item_windows(items).write.parquet(path)
    windows = spark.read.parquet(path)
    lengths = [r[0] for r in windows.select(F.size("window").alias("n")).distinct().collect()]  # at most WINDOW

    rows = docs.select(text_key().alias("text_md5"), _word_hashes(F.col("text")).alias("hashes"))
    hits = _long_hits(rows, windows)
    for length in sorted(n for n in lengths if n < WINDOW):
        hits = hits.unionAll(_short_hits(rows, windows, length))
    path = scratch_path(spark, "hits")
    hits.groupBy("text_md5").agg(
        F.collect_set(F.struct("start", "length")).alias("spans"), F.collect_set("key").alias("keys")
    ).select("text_md5", _covered(F.col("spans")).cast("long").alias("n_hit"), "keys").write.parquet(path)
    found = spark.read.parquet(path)

    named = windows.where("item_id is not null").select("key", "item_id")
    ids = (
        found.select("text_md5", F.explode("keys").alias("key"))
        .join(named, "key")
        .groupBy("text_md5")
        .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )
    path = scratch_path(spark, "judged-texts")
    found.select("text_md5", "n_hit").join(ids, "text_md5", "left").write.parquet(path)
    return spark.read.parquet(path)


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: its words, those inside any window of an item, and the items that hit it."""
    counted = docs.select(
        "doc_id", text_key().alias("text_md5"), F.size(_word_hashes(F.col("text"))).cast("long").alias("n_words")
    )
    ids_of = F.coalesce("item_ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return counted.join(hit_texts(docs, items), "text_md5", "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids_of, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def without_passages(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without a window of an item, all columns as they are."""
    hit = unused("text_md5", docs.columns)
    found = hit_texts(docs, items).select(F.col("text_md5").alias(hit))
    return docs.join(found, text_key() == F.col(hit), "left_anti")
