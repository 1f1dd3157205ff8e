"""Every registered query gives what its SQL text gives in DuckDB."""

from __future__ import annotations

import os
import re

import compare
import pytest

import __spark_entry__ as entry_file
from turnstile.suite.catalogue import CATALOGUE

FOLDER = os.environ.get("QUERY_TEST_DIR", "/root/testdata/sf0.001")
QUERIES = {name: q.build for name, q in CATALOGUE.items()}
SQL = {name: q.sql for name, q in CATALOGUE.items() if q.sql is not None}


@pytest.fixture(scope="module")
def con():
    connection = compare.open_tables(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, FOLDER), con, SQL[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_file.queries()) and set(SQL) <= set(entry_file.oracle_sql())


def test_entry(spark):
    assert entry_file.entry(spark).count() > 0


def _executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_needs_a_cartesian_product(spark):
    for name in ("fact_match", "describe_ticket_prices", "penetration", "match_scores", "fact_checks"):
        plan = _planned(QUERIES[name](spark, FOLDER))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_unused_parts_of_the_fact_table_are_not_read(spark):
    plan = _planned(QUERIES["fill_by_competition"](spark, FOLDER))
    assert plan.count("FileScan parquet") == 3, plan  # calendar, tickets, sessions
    assert "l_shipdate" not in plan  # neither scans nor weather
    assert "l_extendedprice" not in plan  # nor revenue


def test_tickets_are_folded_before_they_meet_sessions(spark):
    plan = _planned(QUERIES["tickets_by_date"](spark, FOLDER))
    join = plan.index("Join [session_id")
    assert "partial_sum" in plan[join:] or "partial_count" in plan[join:]


def test_repeated_keys_are_cut_before_the_shuffle(spark):
    plan = _planned(QUERIES["one_line_per_number"](spark, FOLDER))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_top_lists_do_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in _planned(QUERIES["weakest_matches"](spark, FOLDER))


def test_all_levels_of_a_drop_share_one_shuffle(spark):
    from turnstile.suite.standins import Inputs

    plan = _planned(Inputs(spark, FOLDER).order_documents())
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_filters_and_columns_reach_the_scan(spark):
    plan = _planned(QUERIES["rank_points"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull" in plan or "EqualNullSafe" in plan or "EqualTo(o_orderstatus,F)" in plan
    assert "p_name" not in plan


def test_drops_of_one_large_order_stay_small(spark, tmp_path):
    from pyspark.sql import functions as F

    from turnstile.suite.standins import DROP_SIZE, Inputs

    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").limit(3 * DROP_SIZE + 7)
    lines.withColumn("l_orderkey", F.lit(1).cast("bigint")).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    documents = Inputs(spark, str(tmp_path)).order_documents()
    products = F.flatten(F.col("orders.products"))
    per_drop = documents.groupBy("drop").agg(F.sum(F.size(F.flatten(products["tickets"]))).alias("n"))
    assert [r.n for r in per_drop.orderBy("drop").collect()] == [DROP_SIZE] * 3 + [7]
    path = f"{tmp_path}/drops"
    documents.select("orders").write.json(path)
    back = spark.read.schema("orders " + documents.schema["orders"].dataType.simpleString()).json(path)
    tickets = back.select(F.explode("orders").alias("o")).select(F.explode("o.products").alias("p"))
    assert tickets.select(F.explode("p.tickets")).count() == 3 * DROP_SIZE + 7
