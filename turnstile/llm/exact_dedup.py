"""Exact duplicates by a persistent index of text digests.

The index is a table bucketed and sorted by digest. A batch is folded to one row
per digest, joined against the index by a sort-merge anti-join that leaves the
index unshuffled, and what is new or better is appended. Every step is a
DataFrame operation; the digests of a hot text fold in each input task.

Defined results: a NULL text counts as empty, and all texts without a visible
character are equal. Rows that agree in digest, length and doc_id are the same
document and are kept or dropped together; a NULL doc_id comes after all others.
An empty batch leaves the index as it is. Columns other than the two named ones
are never read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.texts import SPACE, whole
from turnstile.session import scratch_path

DIGEST = "text_sha256"


def digest(text: Column) -> Column:
    """SHA-256 of the text without white space, in lower-case hex."""
    return F.sha2(F.regexp_replace(whole(text), SPACE, "").cast("binary"), 256)


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, its digest and the code points of its original text."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        digest(F.col(text)).alias(DIGEST),
        F.length(whole(F.col(text))).cast("long").alias("points"),
    )


def _order(points: str, doc_id: str) -> Column:
    """The smaller, the better: most code points, then smallest doc_id."""
    return F.struct((-F.col(points)).alias("short"), F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("keep_id"))


class DigestIndex:
    """The best document of every digest seen so far, in a bucketed, sorted table.

    ``buckets`` fixes the layout for the life of the table: choose it so that one
    bucket of the final index fits a task. Appends add files to the buckets.
    """

    def __init__(self, spark: SparkSession, table: str, path: str, buckets: int):
        self.spark, self.table, self.path, self.buckets = spark, table, path, buckets

    @classmethod
    def fresh(cls, spark: SparkSession, buckets: int | None = None) -> DigestIndex:
        """An index of its own on the shared scratch storage."""
        name = f"digest_index_{uuid.uuid4().hex}"
        return cls(spark, name, scratch_path(spark, name), buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))

    def _known(self) -> DataFrame | None:
        return self.spark.table(self.table) if self.spark.catalog.tableExists(self.table) else None

    def append(self, batch: DataFrame) -> None:
        """Add a batch of ``digests`` rows: those of new digests, and those better than the known ones."""
        best = batch.groupBy(DIGEST).agg(F.min(_order("points", "doc_id")).alias("best"))
        known = self._known()
        if known is not None:
            theirs = known.select(F.col(DIGEST).alias("_digest"), F.col("best").alias("_best"))
            same = (F.col(DIGEST) == F.col("_digest")) & (F.col("_best") <= F.col("best"))
            best = best.hint("merge").join(theirs.hint("merge"), same, "left_anti")
        (
            best.repartition(self.buckets, DIGEST)
            .write.mode("append")
            .format("parquet")
            .option("path", self.path)
            .bucketBy(self.buckets, DIGEST)
            .sortBy(DIGEST)
            .saveAsTable(self.table)
        )

    def best(self) -> DataFrame:
        """One row per digest: its best document over all batches."""
        known = self._known()
        if known is None:
            raise ValueError(f"nothing was appended to {self.table}")
        return known.groupBy(DIGEST).agg(F.min("best").alias("best"))

    def drop(self) -> None:
        """Forget the table; its files stay with the other scratch folders."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def resolve(rows: DataFrame, index: DigestIndex) -> DataFrame:
    """Each row of ``digests`` with the document that stays for it and the size of its group.

    The sizes and the index meet by digest, one row each; that table is written, so
    that the join of all rows starts from two shuffles and a hot digest can be split.
    """
    spark = rows.sparkSession
    sizes = rows.groupBy(DIGEST).agg(F.count(F.lit(1)).alias("group_size"))
    path = scratch_path(spark, "digest-groups")
    sizes.join(index.best(), DIGEST).write.parquet(path)
    groups = spark.read.parquet(path)
    stays = F.col("doc_id").eqNullSafe(F.col("best.keep_id")) & (F.col("points") == -F.col("best.short"))
    return rows.join(groups, DIGEST).select(
        "doc_id", F.col("best.keep_id").alias("keep_id"), "group_size", stays.alias("kept"), DIGEST
    )


def exact_duplicates(docs: DataFrame, batches: int = 2) -> DataFrame:
    """All documents through a fresh index, in batches as they would arrive."""
    spark = docs.sparkSession
    path = scratch_path(spark, "digests")
    arrival = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    digests(docs).withColumn("arrival", arrival).write.parquet(path)
    rows = spark.read.parquet(path)
    index = DigestIndex.fresh(spark)
    for number in range(batches):
        index.append(rows.where(F.col("arrival") == number))
    return resolve(rows, index)
