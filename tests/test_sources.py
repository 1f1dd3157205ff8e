"""Readers, reports and sinks on files with every known defect."""

from __future__ import annotations

import datetime as dt
import json
import subprocess
import sys
from pathlib import Path

import pytest
import raw_files
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile import schemas
from turnstile.plans import job
from turnstile.sources import csv_files, files, json_files, landed, report, tables


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    return str(raw_files.write(tmp_path_factory.mktemp("raw")))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_absent_files_are_none(spark, raw):
    nowhere = f"{raw}/nowhere/*.json"
    assert csv_files.read_named_csv(spark, f"{raw}/nowhere.csv", schemas.SURVEY) is None
    assert csv_files.read_named_csv(spark, f"{raw}/nowhere.csv") is None
    assert csv_files.read_scans(spark, f"{raw}/nowhere/scan_*.csv") is None
    assert json_files.read_tickets(spark, nowhere) is None
    assert json_files.read_reference_lists(spark, nowhere) is None
    assert json_files.read_weather(spark, nowhere) is None
    assert json_files.read_holidays(spark, nowhere) is None
    assert json_files.read_population(spark, nowhere) is None
    assert json_files.read_streaks(spark, nowhere) is None
    assert report.order_file_report(spark, nowhere) is None
    assert report.scan_file_report(spark, nowhere) is None
    with pytest.raises(FileNotFoundError):
        json_files.read_standings(spark, f"{raw}/nowhere/*.parquet")


def test_required_files_must_exist(spark, raw):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        csv_files.read_contacts(spark, f"{raw}/nowhere.csv")


def test_named_csv_matches_columns_by_name(spark, raw):
    calendar = csv_files.read_named_csv(spark, f"{raw}/dataset/calendrier_matchs.csv", schemas.CALENDAR)
    assert dict(calendar.dtypes)["date"] == "date" and dict(calendar.dtypes)["heure"] == "string"
    assert dict(calendar.dtypes)["arbitre"] == "int"  # not declared: inferred
    assert calendar.orderBy("match_id").first().asDict() == {
        "match_id": "M001", "date": dt.date(2025, 10, 3), "heure": "20:45", "competition": "EuroLeague", "journee": "J1",
        "adversaire": "Club, A", "salle": "Arena", "capacite_salle": 4, "arbitre": 7,
    }


def test_undeclared_csv_is_inferred(spark, raw):
    squad = csv_files.read_named_csv(spark, f"{raw}/dataset/effectif.csv")
    assert squad.dtypes == [("joueur", "string"), ("numero", "int"), ("taille", "double"), ("naissance", "date")]


def test_text_csv_stays_text(spark, raw):
    till = csv_files.read_till(spark, f"{raw}/dataset/boutique_ventes_avoirs.csv")
    assert {t for _, t in till.dtypes} == {"string"} and till.count() == 5
    assert till.first().LIGNE_PrixVente == "39,00"
    assert {t for _, t in csv_files.read_contacts(spark, f"{raw}/dataset/contacts.csv").dtypes} == {"string"}


def test_scans_with_and_without_header(spark, raw):
    scans = csv_files.read_scans(spark, f"{raw}/{job.SCANS}")
    assert scans.columns == ["barcode", "scan_ts_utc", "portique", "ext_id", "type_billet", "resultat", "filename", "date_fichier"]
    assert rows(scans.groupBy("date_fichier", "resultat").count()) == [
        ("20251003", "KO", 1), ("20251003", "OK", 2), ("20251017", "OK", 2),
    ]
    assert scans.filter("barcode = 'B3'").first().scan_ts_utc == dt.datetime(2025, 10, 3, 19, 30)
    assert {r.filename for r in scans.select("filename").distinct().collect()} == {"scan_20251003.csv", "scan_20251017.csv"}


def test_scan_report(spark, raw):
    by_file = {r.filename: r for r in report.scan_file_report(spark, f"{raw}/{job.SCANS}").collect()}
    assert {n: (r.state, r.n_rows, r.has_header) for n, r in by_file.items()} == {
        "scan_20251003.csv": ("ok", 3, True),
        "scan_20251017.csv": ("ok", 2, False),
        "scan_20251026.csv": ("empty", 0, None),
        "scan_20251102.csv": ("corrupt", 0, True),
    }
    summary = report.load_summary(report.scan_file_report(spark, f"{raw}/{job.SCANS}")).first()
    assert tuple(summary) == (5, 4, 2, 2, 1)


def test_tickets_from_nested_drops(spark, raw):
    tickets = json_files.read_tickets(spark, f"{raw}/{job.ORDERS}")
    assert len(tickets.columns) == 23
    assert {r.bar_code for r in tickets.collect()} == {f"B{i}" for i in range(1, 11)}
    assert tickets.count() == 11  # B1 comes twice, both are kept
    one = tickets.filter("ticket_id = 3").first()
    assert (one.order_id, one.ext_id, one.product_type_id, one.amount, one.seat_number, one.product_is_cancelled) == (
        1, "C1", 2, 10.005, "3", False,
    )
    assert one.filename == "ORDERS_20250901_235959.json"


def test_order_report(spark, raw):
    by_file = {r.filename: (r.state, r.n_rows) for r in report.order_file_report(spark, f"{raw}/{job.ORDERS}").collect()}
    assert by_file == {
        "ORDERS_20250901_235959.json": ("ok", 7),
        "ORDERS_20250902_235959.json": ("ok", 4),
        "ORDERS_20250903_235959.json": ("corrupt", 0),
        "ORDERS_20250904_235959.json": ("empty", 0),
    }
    assert tuple(report.load_summary(report.order_file_report(spark, f"{raw}/{job.ORDERS}")).first()) == (11, 4, 2, 2)
    bad = json_files.unreadable_files(json_files.read_order_drops(spark, f"{raw}/{job.ORDERS}"))
    assert [r.filename for r in bad.collect()] == ["ORDERS_20250903_235959.json"]


def test_a_file_counts_as_a_whole(spark, tmp_path):
    good = json.dumps({"orders": [raw_files.order(1, 1, [raw_files.product(1, False, [raw_files.ticket(1, 1)])])]})
    (tmp_path / "mixed.json").write_text(good + "\n" + good[:80] + "\n" + good + "\n")
    (tmp_path / "sound.json").write_text(good.replace("B1", "B2") + "\n")
    tickets = json_files.read_tickets(spark, f"{tmp_path}/*.json", one_document_per_file=False)
    assert [r.bar_code for r in tickets.collect()] == ["B2"]
    states = {r.filename: r.state for r in report.order_file_report(spark, f"{tmp_path}/*.json", False).collect()}
    assert states == {"mixed.json": "corrupt", "sound.json": "ok"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_staged_drops_are_not_parsed_again(spark, raw):
    drops = json_files.stage_order_drops(spark, f"{raw}/{job.ORDERS}")
    assert drops.totals == {"n_rows": 3, "n_bad": 1, "n_tickets": 11}
    lists = json_files.staged_reference_lists(drops)
    made = [json_files.staged_tickets(drops), report.staged_order_report(drops), drops.bad_files(), *lists.values()]
    assert not any("FileScan json" in _plan(df) for df in made)
    assert rows(made[0]) == rows(json_files.read_tickets(spark, f"{raw}/{job.ORDERS}"))
    for name, expected in json_files.read_reference_lists(spark, f"{raw}/{job.ORDERS}").items():
        assert rows(lists[name]) == rows(expected)
    # The report reads marks and counts, not the documents.
    assert "customer" not in _plan(made[1]) and "orders#" not in _plan(made[2])


def test_staged_scans_are_not_parsed_again(spark, raw):
    scans = csv_files.stage_scans(spark, f"{raw}/{job.SCANS}")
    assert scans.totals["n_bad"] == 1 and scans.totals["n_headers"] == 2
    made = [csv_files.staged_scans(scans), report.staged_scan_report(scans)]
    assert not any("FileScan csv" in _plan(df) for df in made)
    assert "barcode" not in _plan(made[1])


def test_only_empty_files(spark, tmp_path):
    (tmp_path / "ORDERS_1.json").write_text("")
    (tmp_path / "scan_1.csv").write_text("")
    drops = json_files.stage_order_drops(spark, f"{tmp_path}/*.json", one_document_per_file=False)
    assert drops.totals == {"n_rows": 0, "n_bad": 0, "n_tickets": 0}
    assert json_files.staged_tickets(drops).count() == 0 and json_files.staged_reference_lists(drops)["sessions"].count() == 0
    assert [r.state for r in report.staged_order_report(drops).collect()] == ["empty"]
    scans = csv_files.stage_scans(spark, f"{tmp_path}/*.csv")
    assert csv_files.staged_scans(scans).count() == 0
    assert [r.state for r in report.staged_scan_report(scans).collect()] == ["empty"]


def test_unread_values_are_counted_as_rows_are_written(spark, tmp_path):
    (tmp_path / "r.csv").write_text("date,lieu,more,rang_pbb_avant\n2025-10-17,X,1,3\nsoon,Y,2,n/a\n,Z,3,\n")
    typed, seen, declared = csv_files.watched_csv(spark, str(tmp_path / "r.csv"), schemas.RESULTS)
    typed.write.parquet(str(tmp_path / "out"))
    assert csv_files.unread_counts(seen, declared) == {"date": 1, "lieu": 0, "rang_pbb_avant": 1}
    assert typed.dtypes == [("date", "date"), ("lieu", "string"), ("more", "int"), ("rang_pbb_avant", "int")]


ONE_RUN = """
import json, sys, tempfile
from turnstile.plans import job
from turnstile.session import build_session
raw, home = sys.argv[1:]
spark = build_session("run", "local[4]", **{
    "spark.ui.enabled": "false", "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{home}/log",
    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
    "spark.sql.warehouse.dir": f"{home}/warehouse", "spark.checkpoint.dir": f"{home}/shared", "spark.sql.shuffle.partitions": "2"})
log = job.run(spark, raw)
print(json.dumps({"rows": log.rows, "loads": log.loads, "unread": log.unread}))
spark.stop()
"""


def test_the_run_parses_each_drop_once(raw, tmp_path):
    (tmp_path / "log").mkdir()
    done = subprocess.run(
        [sys.executable, "-c", ONE_RUN, raw, str(tmp_path)], cwd=Path(__file__).parents[1], capture_output=True, text=True, timeout=600
    )
    assert done.returncode == 0, done.stderr[-3000:]
    told = json.loads(done.stdout.strip().splitlines()[-1])
    assert told["loads"]["orders"] == {"n_rows": 3, "n_bad": 1, "n_tickets": 11}
    assert told["rows"]["bronze.raw_billets"] == 11 and told["rows"]["bronze.raw_scans"] == 5
    assert set(told["unread"]) == {"resultats_matchs", "satisfaction", "calendrier_matchs", "web_sessions", "web_evenements", "campagnes_evenements"}
    scans = {"ORDERS_": 0, "scan_": 0}
    for line in next((tmp_path / "log").iterdir()).read_text().splitlines():
        event = json.loads(line)
        if not event["Event"].endswith("SparkListenerSQLExecutionStart"):
            continue
        for node in _nodes(event["sparkPlanInfo"]):
            for part in scans:
                scans[part] += node["nodeName"].startswith(("Scan json", "Scan csv")) and part in str(node["metadata"].get("Location"))
    assert scans == {"ORDERS_": 1, "scan_": 1}


def _nodes(plan):
    yield plan
    for child in plan["children"]:
        yield from _nodes(child)


def test_fields_of_all_files_are_merged_in_one_read(spark, tmp_path, monkeypatch):
    (tmp_path / "a.json").write_text(json.dumps({"results": [{"a": 1, "b": "x"}, {"a": 2.5, "c d": "2020-01-01", "n": None, "o": {"g": [1, 2]}}]}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"results": [{"a": 3, "z": True, "b": 7, "it's": "y"}], "more": 1}, indent=1))
    (tmp_path / "c.json").write_text(json.dumps({"other": 1}))
    (tmp_path / "d.json").write_text('{"results": [{"a": ')
    reads = []
    reader = type(spark.read)
    monkeypatch.setattr(reader, "json", lambda self, path, read=reader.json: reads.append(path) or read(self, path))
    got = json_files.read_holidays(spark, f"{tmp_path}/*.json")
    assert got.dtypes == [
        ("a", "double"), ("b", "string"), ("c d", "string"), ("it's", "string"), ("n", "string"), ("o", "struct<g:array<bigint>>"), ("z", "boolean"),
    ]
    assert rows(got.drop("o")) == rows_of([(1.0, "x", None, None, None, None), (2.5, None, "2020-01-01", None, None, None), (3.0, "7", None, "y", None, True)])
    assert [r.o.g for r in got.filter("o IS NOT NULL").collect()] == [[1, 2]]
    assert len(reads) == 1 and "FileScan json" not in _plan(got)
    # As Spark's own inference has it, which reads the files twice.
    inferred = spark.read.option("multiLine", True).json(f"{tmp_path}/[ab].json").select(F.inline("results"))
    assert dict(got.dtypes) == dict(inferred.dtypes) and rows(got) == rows(inferred.select(got.columns))


def test_lists_without_rows(spark, tmp_path):
    (tmp_path / "streaks_r4.json").write_text(json.dumps({"teams": []}))
    got = json_files.read_streaks(spark, f"{tmp_path}/streaks_r*.json")
    assert got.columns == ["round"] and got.count() == 0


def rows_of(values):
    return sorted(values, key=str)


def test_files_are_left_out_by_one_lazy_join(spark):
    data = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "_path string, v int")
    listed = spark.createDataFrame([("a",), ("b",)], "_path string")
    assert rows(files.without_files(data, listed, "_path")) == [("c", 3)]
    assert rows(files.without_files(data, listed.filter("false"), "_path")) == [("a", 1), ("b", 2), ("c", 3)]


def test_declared_columns_survive_other_notations(spark, tmp_path):
    path = str(tmp_path / "results.csv")
    (tmp_path / "results.csv").write_text("date,lieu,rang_pbb_avant\n17/10/2025,DOMICILE,3.0\n2025-10-18,X,n/a\n")
    got = csv_files.read_named_csv(spark, path, schemas.RESULTS)
    assert rows(got) == [(dt.date(2025, 10, 17), "DOMICILE", 3), (dt.date(2025, 10, 18), "X", None)]
    unread = {r.column: r.n_unread for r in csv_files.unread_values(spark, path, schemas.RESULTS).collect()}
    assert unread == {"date": 0, "lieu": 0, "rang_pbb_avant": 1}


def test_only_a_line_of_column_names_is_a_header(spark, tmp_path):
    (tmp_path / "scan_20250101.csv").write_text(
        "B1,2025-01-01T20:00:00+02:00,P1,e1,T,OK\nB2,2025-01-01 20:00:00,P1,e1,T,OK\nbarcode,,P1,e1,T,OK\nB3,late,P1,e1,T,OK\n"
    )
    scans = csv_files.read_scans(spark, f"{tmp_path}/scan_*.csv")
    assert rows(scans.select("barcode", "scan_ts_utc")) == [
        ("B1", dt.datetime(2025, 1, 1, 18)), ("B2", dt.datetime(2025, 1, 1, 20)), ("B3", None), ("barcode", None),
    ]
    assert report.scan_file_report(spark, f"{tmp_path}/scan_*.csv").first().n_unread_times == 1


def test_reference_lists_come_from_the_first_drop(spark, raw):
    lists = json_files.read_reference_lists(spark, f"{raw}/{job.ORDERS}")
    assert [r.id for r in lists["sessions"].orderBy("id").collect()] == [1, 2, 3]
    assert rows(lists["product_types"]) == [(1, "ABONNEMENT"), (2, "BILLET_UNITE")]
    assert rows(lists["order_status"]) == [(1, "Validée"), (8, "Annulée")]


def test_weather_lists_are_zipped_and_padded(spark, raw):
    weather = json_files.read_weather(spark, f"{raw}/{job.WEATHER}")
    assert weather.columns == ["heure", "temperature", "temperature_ressentie", "precipitation", "code_meteo"]
    assert rows(weather) == [
        ("2025-10-03T20:00", 12.0, 11.0, 0.4, 2), ("2025-10-03T20:00", 12.5, 11.0, 0.0, 1), ("2025-10-17T19:00", 9.0, None, 1.2, 3),
    ]


def test_weather_without_a_list(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps({"hourly": {"time": ["2025-01-01T00:00"], "temperature_2m": [1.0]}}))
    assert rows(json_files.read_weather(spark, f"{tmp_path}/*.json")) == [("2025-01-01T00:00", 1.0, None, None, None)]


def test_holidays_are_merged_by_name(spark, raw):
    holidays = json_files.read_holidays(spark, f"{raw}/{job.HOLIDAYS}")
    assert set(holidays.columns) == {"start_date", "end_date", "location", "zones"}
    assert rows(holidays.groupBy("location", "zones").count()) == [("Lyon", None, 1), ("Paris", "Zone C", 1), ("Paris", None, 1)]


def test_population_and_streaks(spark, raw):
    towns = json_files.read_population(spark, f"{raw}/{job.TOWNS}")
    assert {r.nom: list(r.codesPostaux) for r in towns.collect()} == {"Paris": ["75001"], "Vincennes": ["94300", "94301"]}
    streaks = json_files.read_streaks(spark, f"{raw}/{job.STREAKS}")
    assert rows(streaks.select("round", "club", "wins")) == [(1, "A", 1), (1, "B", 0), (12, "B", 7)]


def test_standings_merge_columns_over_rounds(spark, tmp_path):
    spark.createDataFrame([("A", 1)], "club string, wins int").write.parquet(f"{tmp_path}/standings_r1.parquet")
    spark.createDataFrame([("A", 2, 3)], "club string, wins int, losses int").write.parquet(f"{tmp_path}/standings_r4.parquet")
    got = json_files.read_standings(spark, f"{tmp_path}/standings_r*.parquet")
    assert rows(got.select("round", "club", "wins", "losses")) == [(1, "A", 1, None), (4, "A", 2, 3)]


# --- sinks ---------------------------------------------------------------------------------


def test_replace_and_append(spark):
    tables.ensure_schema(spark, "sinks")
    first = spark.createDataFrame([(1, "a")], "id int, s string")
    tables.replace_table(first, "sinks.t")
    tables.replace_table(first.withColumn("s", F.lit("b")), "sinks.t")
    tables.append_table(spark.createDataFrame([("c", 2)], "s string, id int"), "sinks.t")
    tables.append_table(spark.createDataFrame([(3,)], "id int"), "sinks.t")
    assert rows(spark.table("sinks.t")) == [(1, "b"), (2, "c"), (3, None)]
    with pytest.raises(ValueError, match="more"):
        tables.append_table(first.withColumn("more", F.lit(1)), "sinks.t")
    tables.append_table(first, "sinks.fresh")
    assert rows(spark.table("sinks.fresh")) == [(1, "a")]


def test_copy_of_tables(spark):
    tables.ensure_schema(spark, "b_side")
    tables.ensure_schema(spark, "s_side")
    tables.replace_table(spark.range(3), "b_side.raw_x")
    assert tables.copy_tables(spark, ["x", "y"], "b_side", "s_side") == ["y"]
    assert spark.table("s_side.x").count() == 3


def test_records(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2025, 1, 2), 3, 0.5), (dt.date(2025, 1, 1), None, None)], "date date, n bigint, x double")
    assert [json.loads(r.record) for r in tables.json_records(tables.by_date(df)).collect()] == [
        {"date": "2025-01-01", "n": None, "x": None}, {"date": "2025-01-02", "n": 3, "x": 0.5},
    ]
    tables.write_records(df, f"{tmp_path}/out")
    lines = [json.loads(line) for f in (tmp_path / "out").glob("*.json") for line in f.read_text().splitlines()]
    assert {"date": "2025-01-01", "n": None, "x": None} in lines and len(lines) == 2


# --- nest, then flatten -----------------------------------------------------------------------


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(1, 5), st.integers(1, 3), st.integers(1, 1000), st.one_of(st.none(), st.booleans())),
        min_size=1, max_size=40,
    )
)
def test_nesting_and_flattening_gives_the_tickets_back(spark, tmp_path_factory, data):
    folder = tmp_path_factory.mktemp("drops")
    tree: dict = {}
    for order_id, kind, number, flag in data:
        tree.setdefault(order_id, {}).setdefault((kind, flag), []).append(number)
    orders = [
        raw_files.order(o, 1, [raw_files.product(kind, flag, [raw_files.ticket(n, o) for n in numbers]) for (kind, flag), numbers in products.items()])
        for o, products in tree.items()
    ]
    half = len(orders) // 2
    for name, part in (("a", orders[:half]), ("b", orders[half:])):
        (folder / f"ORDERS_{name}.json").write_text(json.dumps({"orders": part}, indent=1))
    tickets = json_files.read_tickets(spark, f"{folder}/ORDERS_*.json")
    got = sorted(((r.order_id, r.product_type_id, r.ticket_id, r.product_is_cancelled) for r in tickets.collect()), key=str)
    assert got == sorted(data, key=str)


def test_a_batch_is_added_once(spark, tmp_path):
    path = str(tmp_path / "table")
    one, two = spark.range(3).toDF("v"), spark.range(5, 7).select(F.col("id").alias("v"), F.lit("x").alias("more"))
    assert tables.read_batches(spark, path) is None
    assert tables.append_batch(one, path, "2025-01") and not tables.append_batch(one, path, "2025-01")
    # A run that was cut off leaves rows without a line in the manifest.
    spark.range(100).toDF("v").write.parquet(f"{path}/data/_batch=2025-02")
    assert rows(tables.read_batches(spark, path)) == [(0,), (1,), (2,)]
    assert tables.append_batch(two, path, "2025-02") and tables.append_batch(one.limit(0), path, "2025-03")
    assert tables.committed_batches(spark, path) == {"2025-01": 3, "2025-02": 2, "2025-03": 0}
    assert rows(tables.read_batches(spark, path).select("v", "more")) == [(0, None), (1, None), (2, None), (5, "x"), (6, "x")]
    with pytest.raises(ValueError, match="named by"):
        tables.append_batch(one, path, "a/b")


def test_batches_of_a_table(spark):
    tables.ensure_schema(spark, "batches")
    one = spark.createDataFrame([(1, "a"), (2, "b")], "v int, w string")
    for _ in range(2):
        tables.append_table(one, "batches.t", batch="x")
        tables.append_table(one.select("w"), "batches.t", batch="y")
    assert rows(spark.table("batches.t").select("v", "w", "_batch")) == rows_of([(1, "a", "x"), (2, "b", "x"), (None, "a", "y"), (None, "b", "y")])
    tables.append_table(one.limit(1), "batches.plain")
    with pytest.raises(ValueError, match="without batches"):
        tables.append_table(one, "batches.plain", batch="x")


def test_landed_files_of_unlike_types(spark, tmp_path):
    for i, (sql, n) in enumerate(
        [("id AS v, 1 AS a", 2), ("CAST(id AS INT) AS v, 'x' AS a, DATE'2025-01-01' AS d", 2), ("id + 0.5D AS v, TIMESTAMP_NTZ'2025-01-01 10:00:00' AS d", 1)] * 2
    ):
        spark.range(n).selectExpr(*sql.split(", ")).coalesce(1).write.parquet(f"{tmp_path}/standings_r{i}.parquet")
    got = json_files.read_standings(spark, f"{tmp_path}/standings_r*.parquet", r"standings_r(\d+)\.")
    assert got.dtypes == [("v", "double"), ("a", "string"), ("d", "timestamp_ntz"), ("round", "int")]
    day = dt.datetime(2025, 1, 1)
    assert rows(got) == rows_of(
        [(float(v), "1", None, r) for v in (0, 1) for r in (0, 3)]
        + [(float(v), "x", day, r) for v in (0, 1) for r in (1, 4)]
        + [(0.5, None, day.replace(hour=10), r) for r in (2, 5)]
    )
    files = [f for f in spark.read.parquet(f"{tmp_path}/standings_r0.parquet", f"{tmp_path}/standings_r3.parquet").inputFiles()]
    assert len(landed.schema_groups(spark, files)) == 1
    with pytest.raises(FileNotFoundError):
        json_files.read_standings(spark, f"{tmp_path}/nothing_r*")


def test_wider_types():
    wider = landed.wider_type
    whole, real = T.LongType(), T.DoubleType()
    assert wider(T.IntegerType(), whole) == whole and wider(T.IntegerType(), T.FloatType()) == real and wider(T.ShortType(), T.FloatType()) == T.FloatType()
    assert wider(T.DecimalType(10, 2), T.DecimalType(8, 4)) == T.DecimalType(12, 4) and wider(T.DecimalType(20, 2), whole) == T.DecimalType(22, 2)
    assert wider(T.DecimalType(38, 2), whole) == T.DecimalType(38, 2) and wider(T.DecimalType(38, 30), whole) == real
    assert wider(T.NullType(), whole) == whole and wider(T.BooleanType(), whole) == T.StringType()
    one = T.StructType().add("a", T.IntegerType()).add("b", T.IntegerType())
    two = T.StructType().add("b", whole).add("c", T.StringType())
    assert wider(one, two) == T.StructType().add("a", T.IntegerType()).add("b", whole).add("c", T.StringType())
    assert wider(T.ArrayType(T.IntegerType()), T.ArrayType(whole)) == T.ArrayType(whole)
