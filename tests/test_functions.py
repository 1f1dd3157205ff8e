"""Column functions on single values."""

from __future__ import annotations

import datetime as dt

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnstile.functions import calendar, labels, numbers, parsing


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v")).alias("r")).collect()]


def test_dates(spark):
    cases = {
        "2024-01-05": dt.date(2024, 1, 5),
        "2024/1/5": dt.date(2024, 1, 5),
        " 2024-01-05 ": dt.date(2024, 1, 5),
        "2024-01-05T20:45:00": dt.date(2024, 1, 5),
        "05/03/2024": dt.date(2024, 3, 5),
        "5/3/2024 ": dt.date(2024, 3, 5),
        "05-03-2024": dt.date(2024, 3, 5),
        "2024": None,
        "2024-01": None,
        "2024-01/05": None,
        "2024-02-30": None,
        "31/02/2024": None,
        "20240105": None,
        "2024-01-05x": None,
        "05/03/24": None,
        "": None,
        "inconnue": None,
        None: None,
    }
    parsed = values(
        spark,
        lambda c: parsing.flexible_date(c, parsing.DAY_FIRST_SLASH, parsing.DAY_FIRST_DASH),
        list(cases),
    )
    assert dict(zip(cases, parsed)) == cases


def test_two_layouts_leave_the_third_unread(spark):
    assert values(spark, lambda c: parsing.flexible_date(c, parsing.DAY_FIRST_SLASH), ["05-03-2024"]) == [None]


def test_numbers(spark):
    texts = ["39,00", "1.5", "2.5", "-0.5", " 7 ", "1e2", "1,5,2", "1.5d", "0x10", "", "n/a", "2147483648", None]
    assert values(spark, parsing.comma_number, texts) == [
        39.0, 1.5, 2.5, -0.5, 7.0, 100.0, None, None, None, None, None, 2147483648.0, None,
    ]
    assert values(spark, parsing.whole_number, texts) == [
        None, 2, 3, -1, 7, 100, None, None, None, None, None, None, None,
    ]


def test_truth_values(spark):
    texts = ["true", "T", "1", "yes", "false", "n", "0", "on", "2", "", None]
    assert values(spark, parsing.truth_value, texts) == [
        True, True, True, True, False, False, False, None, None, None, None,
    ]


def test_dates_keep_the_written_day(spark):
    texts = ["2025-10-18T00:00:00+02:00", "2025-10-17T22:00:00Z", "2025-10-18"]
    assert values(spark, parsing.date_as_written, texts) == [
        dt.date(2025, 10, 18), dt.date(2025, 10, 17), dt.date(2025, 10, 18),
    ]


def test_names(spark):
    assert values(spark, lambda c: parsing.number_in_name(c, r"streaks_r(\d+)\.json"), ["streaks_r07.json", "x"]) == [7, None]
    assert values(spark, lambda c: parsing.token_in_name(c, r"scan_(.*)\.csv"), ["scan_20251017.csv", "x"]) == ["20251017", None]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6), min_size=1, max_size=50), st.integers(0, 4))
def test_rounding_is_that_of_duckdb(spark, xs, digits):
    ours = values(spark, lambda c: numbers.round_half_away(c, digits), xs, "double")
    theirs = [duckdb.execute("SELECT round(CAST(? AS DOUBLE), CAST(? AS INTEGER))", [x, digits]).fetchone()[0] for x in xs]
    assert ours == theirs


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6), min_size=1, max_size=50))
def test_half_even_rounding_is_that_of_numpy(spark, xs):
    import numpy as np

    assert values(spark, lambda c: numbers.round_half_even(c, 2), xs, "double") == list(np.round(np.array(xs), 2))


def test_money_ignores_the_order_of_the_sum(spark):
    assert values(spark, numbers.round_money, [41075.505, 41075.50499999999, None], "double") == [41075.51, 41075.51, None]


def test_ratios(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (None, 2)], "a int, b int")
    got = df.select(numbers.rate(F.col("a"), F.col("b"), 3), numbers.percent(F.col("a"), F.col("b"), 1)).collect()
    assert [tuple(r) for r in got] == [(0.333, 33.3), (None, None), (None, None)]
    assert values(spark, numbers.percent_label, [0.8125, None], "double") == ["81.3%", "N/A"]


def test_kickoff(spark):
    df = spark.createDataFrame(
        [(dt.date(2025, 10, 26), "20:45"), (dt.date(2025, 10, 26), "02:30:00"), (dt.date(2025, 10, 26), None)],
        "d date, h string",
    )
    for zone in ("UTC", "Europe/Paris"):
        before = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = [r[0] for r in df.select(calendar.kickoff_hour(F.col("d"), F.col("h"))).collect()]
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
        assert got == [dt.datetime(2025, 10, 26, 20), dt.datetime(2025, 10, 26, 2), None]
    assert values(spark, calendar.clock_minutes, ["20:45", "13:30:00", "x", None]) == [1245, 810, None, None]
    assert values(spark, calendar.time_slot, ["17:59", "18:00", None]) == ["Après-midi", "Soirée", None]


def test_weekdays(spark):
    days = [dt.date(2024, 1, 1 + i) for i in range(7)]
    assert values(spark, calendar.weekday_name, days, "date") == list(calendar.WEEKDAYS)
    assert values(spark, calendar.weekday_position, ["Monday", "Sunday", "x", None]) == [0, 6, None, None]
    assert values(spark, calendar.day_token, days[:1], "date") == ["20240101"]


def test_labels(spark):
    assert values(spark, labels.result_label, [1, 0, 2, None], "int") == ["Victoire", "Défaite", None, None]
    names = ["Betclic ÉLITE Playoffs", "EuroLeague", "Betclic ÉLITE", None]
    assert values(spark, labels.competition_group, names) == ["Playoffs", "EuroLeague", "Betclic ÉLITE", "Betclic ÉLITE"]
    assert values(spark, labels.high_conversion, [15.0, 15.01, None], "double") == [False, True, None]
    df = spark.createDataFrame([("a", "b"), (None, "b")], "a string, b string")
    assert [r[0] for r in df.select(labels.channel_label(F.col("a"), F.col("b"))).collect()] == ["a / b", None]
