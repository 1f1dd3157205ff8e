from __future__ import annotations

import pytest

TEXTS = [
    (1, "The cat sat on the mat and looked at the moon over the hill for a long time.", "en", "a"),
    (2, "the cat sat  on the mat\nand looked at the moon over the hill for a long time.", "en", "a"),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, " \t\n", "en", "b"),
    (6, "le chat est sur la table et regarde la lune", "fr", "b"),
    (6, "le chat est sur la table et regarde la lune", "fr", "b"),
    (7, "a", "en", "c"),
    (8, "word " * 30_000, "en", "c"),
    (None, "no number at all", "en", "c"),
    (9, "ÉÀ ñandú ÜBER straße 你好 🎉", None, "d"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns with names that operators use inside."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(TEXTS, "doc_id long, text string, lang string, source string")
    clashing = ("n_chars", "size", "hash", "words", "score", "shard", "slot", "group", "key", "f0", "times", "word", "name")
    return docs.withColumns({c: F.lit(7) for c in clashing}).repartition(3, "doc_id")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 0, 1), (None, 1, 1), (4, None, None), (8, 0, 0)], "doc_id long, quality int, toxic int")
