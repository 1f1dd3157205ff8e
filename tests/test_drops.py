"""Order drops stay small: what is shuffled, what is written, and what meets the list of bad files."""

from __future__ import annotations

import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from turnstile.sources.files import list_files
from turnstile.sources.json_files import stage_order_drops
from turnstile.sources.staging import stage
from turnstile.suite import drops, standins
from turnstile.suite.catalogue import CATALOGUE
from turnstile.suite.standins import Inputs

N_LINES = 6000


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    home = str(tmp_path_factory.mktemp("lines"))
    number = F.col("id")
    spark.range(N_LINES).coalesce(2).select(
        F.when(number % 11 > 0, number * 7 % 3001).alias("l_orderkey"),
        (number * 13).alias("l_partkey"),
        F.when(number % 17 > 0, number * 5 % 1009).alias("l_suppkey"),
        F.when(number % 13 > 0, number % 7 + 1).cast("int").alias("l_linenumber"),
        (number % 50 * 1.0).alias("l_quantity"),
        (number % 997 * 1.25).alias("l_extendedprice"),
        F.when(number % 19 > 0, number % 11 / 100).alias("l_discount"),
        (number % 9 / 100).alias("l_tax"),
        F.when(number % 23 > 0, F.element_at(F.split(F.lit("A,N,R"), ","), (number % 3 + 1).cast("int"))).alias("l_returnflag"),
        F.when(number % 2 == 0, "F").otherwise("O").alias("l_linestatus"),
        F.date_add(F.lit("1997-01-15").cast("date"), (number % 1000).cast("int")).cast("timestamp").alias("l_shipdate"),
    ).write.parquet(f"{home}/lineitem.parquet")
    return home


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("written", [drops._order_drops, drops._cut_order_drops, drops._monthly_order_drops])
def test_drops_are_written_compressed(spark, folder, written):
    path = written(Inputs(spark, folder))
    home = Path(path.removeprefix("file:").split("/year=")[0].split("/month=")[0])
    files = [f for f in home.rglob("part-*") if f.stat().st_size]
    text = sum(len(gzip.decompress(f.read_bytes())) if f.suffix == ".gz" else f.stat().st_size for f in files)
    assert text > 250 * N_LINES  # all of it
    assert sum(f.stat().st_size for f in files) < text / 3


@pytest.mark.parametrize("written", [drops._order_drops, drops._cut_order_drops, drops._monthly_order_drops])
def test_every_ticket_is_in_a_drop(spark, folder, written):
    staged = stage_order_drops(spark, written(Inputs(spark, folder)), one_document_per_file=False)
    cut = F.year("l_shipdate") == drops.CUT_YEAR if written is not drops._order_drops else F.lit(False)
    assert staged.totals["n_tickets"] == Inputs(spark, folder).table("lineitem").filter(~cut).count()


def test_only_given_columns_are_shuffled(spark, folder):
    monthly = Inputs(spark, folder).order_documents("yyyyMM", "month", lambda short: short.repartition("month"))
    for plan in (_plan(Inputs(spark, folder).order_documents()), _plan(monthly)):
        sent = plan.split("Exchange", 1)[1]
        assert "l_partkey" in sent and "concat_ws" not in sent


def test_tasks_follow_the_number_of_tickets(spark, folder, monkeypatch):
    monkeypatch.setattr(standins, "TASK_TICKETS", 100)
    assert "REPARTITION_BY_NUM" in _plan(Inputs(spark, folder).order_documents())
    assert f", {N_LINES // 100})" in _plan(Inputs(spark, folder).order_documents())


def test_rows_of_sound_files_do_not_travel(spark, tmp_path):
    for name in ("a", "b", "c"):
        (tmp_path / f"{name}.txt").write_text("x")
    rows = spark.range(60_000).select(
        F.sha2(F.col("id").cast("string"), 512).alias("value"),
        F.element_at(F.split(F.lit("a.txt,b.txt,c.txt"), ","), (F.col("id") % 3 + 1).cast("int")).alias("filename"),
        F.sha2(F.col("id").cast("string"), 256).alias("_path"),
        (F.col("id") == 7).alias("_bad"),
    )
    staged = stage(rows, list_files(spark, str(tmp_path)), "sound")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100KB")  # far less than the rows have
    try:
        sound = staged.sound()
        assert "BroadcastHashJoin" in _plan(sound) and "SortMergeJoin" not in _plan(sound)
        assert sound.count() == 59_999
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_the_ending_of_compressed_drops(spark, folder):
    tickets = CATALOGUE["nested_tickets"].build(spark, folder)
    assert [tuple(r) for r in tickets.groupBy("filename").count().collect()] == [(".json", N_LINES)]
