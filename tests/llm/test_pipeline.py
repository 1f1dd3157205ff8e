"""The stages one after the other, on rows that are odd and on the smallest tables."""

from __future__ import annotations

import compare
import pytest

import corpus_pipeline
from turnstile.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_stages_hand_on_the_columns_of_documents(spark, odd, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items = spark.createDataFrame([(1, "le chat est sur la table et regarde la lune")], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{name}"
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "sharding":
            assert docs.columns == odd.columns
        if name == "decontamination":
            assert docs.where("doc_id = 6").count() == 0
    assert {"shard", "slot", "text"} <= set(docs.columns)


def test_the_run(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.count() > 50 and got.where("shard not between 0 and 15").count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, name):
    con = compare.open_tables(FOLDER)
    assert compare.differences(queries.QUERIES[name](spark, FOLDER), con, queries.SQL[name]) == []


def test_all_dealt_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
