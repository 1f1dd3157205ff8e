"""Operators against plain Python on small tables, with skewed and empty inputs."""

from __future__ import annotations

import re
import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnstile.operators import dedupe, lookups, stats
from turnstile.operators.label_ridge import fit_label_ridge
from turnstile.operators.ridge import fit_ridge


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- one row per key ---------------------------------------------------------------


def test_first_per_key_does_not_depend_on_partitions(spark):
    data = [(1, "a", 3), (1, "a", 1), (1, "b", 2), (2, None, 5), (2, None, 4)]
    want = [(1, "a", 1), (1, "b", 2), (2, None, 4)]
    for seed in range(3):
        shuffled = random.Random(seed).sample(data, len(data))
        df = spark.createDataFrame(shuffled, "k int, s string, v int").repartition(4)
        assert rows(dedupe.first_per_key(df, ["k", "s"])) == want


def test_first_per_key_with_a_hot_key(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") < 20_000, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    kept = dedupe.first_per_key(df, ["k"])
    assert kept.count() == 40_001
    assert kept.filter("k = 0").first().v == 0


def test_duplicate_count(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert rows(dedupe.duplicate_count(df, "k")) == [(4, 2, 2)]
    assert rows(dedupe.duplicate_count(df.limit(0), "k")) == [(0, 0, 0)]


# --- lookups --------------------------------------------------------------------------


def test_dates_in_periods(spark):
    day = lambda d: dt.date(2025, 10, d)
    df = spark.createDataFrame([(day(d),) for d in range(1, 13)], "date date")
    periods = spark.createDataFrame(
        [(day(3), day(5)), (day(4), day(6)), (day(9), day(9)), (day(12), day(11)), (None, day(2))], "s date, e date"
    )
    got = lookups.flag_dates_in_periods(df, "date", periods, "s", "e", "flag").orderBy("date").collect()
    assert len(got) == 12
    assert {r.date.day for r in got if r.flag} == {3, 4, 5, 6, 9}
    assert all(r.flag is not None for r in got)


def test_hours_are_single_rows(spark):
    at = dt.datetime(2025, 1, 1, 20)
    df = spark.createDataFrame(
        [(at, 5.0, 2.0), (at, 3.0, 1.0), (at, 3.0, 0.5), (dt.datetime(2025, 1, 1, 21), None, 7.0)],
        "hour_ts timestamp_ntz, temperature double, precipitation double",
    )
    assert rows(lookups.hourly_readings(df)) == [(at, 3.0, 0.5), (dt.datetime(2025, 1, 1, 21), None, 7.0)]


def test_unmatched_keys(spark):
    left = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "k string")
    right = spark.createDataFrame([("a",), ("z",)], "k string")
    assert rows(lookups.unmatched_keys(left, right, "k")) == [(3,)]


# --- statistics ----------------------------------------------------------------------------


def test_correlation_skips_pairs_and_constants(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, 1.0, 5.0), (3.0, 6.0, 5.0), (4.0, None, 5.0), (None, 9.0, 5.0)],
        "x double, y double, c double",
    )
    got = dict(rows(stats.correlations(df, "x", ["y", "c"])))
    assert got["y"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 1, 6])[0, 1])
    assert got["c"] is None


def test_least_squares_of_a_constant_is_unknown(spark):
    df = spark.createDataFrame([(1.0, 3.0, 1.0), (2.0, 5.0, 1.0), (4.0, 9.0, 1.0), (None, 7.0, 1.0)], "x double, y double, c double")
    slope, intercept = stats.least_squares(F.col("y"), F.col("x"))
    assert tuple(df.select(slope, intercept).first()) == (pytest.approx(2.0), pytest.approx(1.0))
    slope, intercept = stats.least_squares(F.col("y"), F.col("c"))
    assert tuple(df.select(slope, intercept).first()) == (None, None)


def test_group_summary_leaves_out_unknown_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 9.0), ("b", None)], "g string, v double")
    assert rows(stats.group_summary(df, "g", "v")) == [("a", 1.0, 1.0, 1.0, 1), ("b", None, None, None, 0)]


def test_cross_counts(spark):
    df = spark.createDataFrame([("x", "a"), ("x", "a"), ("y", "b"), (None, "a"), ("y", None)], "r string, c string")
    assert rows(stats.cross_counts(df, "r", "c", ["a", "b", "z"])) == [("x", 2, 0, 0), ("y", 0, 1, 0)]
    assert rows(stats.cross_counts(df, "r", "c")) == [("x", 2, 0), ("y", 0, 1)]


@settings(max_examples=12, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from("aab"), st.one_of(st.none(), st.integers(-5, 5), st.floats(-1e3, 1e3))),
        min_size=1,
        max_size=60,
    )
)
def test_quantiles_equal_pandas(spark, data):
    frame = pd.DataFrame(data, columns=["g", "v"])
    frame["v"] = frame["v"].astype(float)
    known = frame.dropna()
    df = spark.createDataFrame([(g, None if v is None else float(v)) for g, v in data], "g string, v double")
    wanted = {"lo": 0.0, "q": 0.25, "m": 0.5, "x": 0.9, "hi": 1.0}
    got = {r.g: r for r in stats.quantiles(df, "v", wanted, ["g"]).collect()}
    assert set(got) == set(known.g)
    for g, part in known.groupby("g").v:
        for name, p in wanted.items():
            assert got[g][name] == pytest.approx(part.quantile(p), abs=1e-9)
    if len(known):
        got = stats.quantiles(df, "v", wanted).first()
        for name, p in wanted.items():
            assert got[name] == pytest.approx(known.v.quantile(p), abs=1e-9)


def test_quantiles_of_large_skewed_groups(spark):
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        F.when(F.col("id") % 7 == 0, 1.0).otherwise(F.pow(F.hash("id").cast("double") % 1000, 3)).alias("v"),
    )
    got = {r.g: r for r in stats.quantiles(df, "v", stats.QUARTILES, ["g"]).collect()}
    want = df.toPandas().groupby("g").v.quantile([0.25, 0.5, 0.75]).unstack()
    assert len(got) == len(want) == 51
    for g, row in want.iterrows():
        assert [got[g].q25, got[g].q50, got[g].q75] == pytest.approx(list(row))


def test_describe(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0), ("b", 3.0), ("b", None), (None, 8.0)], "g string, v double")
    got = {r.g: r for r in stats.describe(df, "v", ["g"]).collect()}
    want = pd.Series([1.0, 2.0, 4.0]).describe()
    assert list(got["a"])[1:] == pytest.approx(list(want))
    assert got["b"]["std"] is None and got["b"]["count"] == 1
    everything = stats.describe(df, "v").first()
    assert list(everything) == pytest.approx(list(pd.Series([1.0, 2.0, 4.0, 3.0, 8.0]).describe()))
    assert stats.describe(df.filter("g = 'none'"), "v").first()["count"] == 0


def test_boxes(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, -50.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 1.0), ("b", None)], "g string, v double")
    got = {r.g: r for r in stats.box_summary(df, "v", ["g"]).collect()}
    q25, q50, q75 = np.percentile(values, [25, 50, 75])
    assert [got["a"].q25, got["a"].q50, got["a"].q75] == pytest.approx([q25, q50, q75])
    assert (got["a"].whisker_low, got["a"].whisker_high, got["a"].n_outliers) == (1.0, 5.0, 2)
    assert got["b"].n_outliers == 0
    assert rows(stats.box_outliers(df, "v", ["g"])) == [("a", -50.0), ("a", 100.0)]


@pytest.fixture
def skewed(spark):
    """Groups of unlike size and scale, one with a third of all rows, with values over many magnitudes."""
    rng = np.random.default_rng(17)
    return pd.DataFrame(
        {
            "g": np.where(np.arange(9000) % 3 == 0, "hot", np.char.add("g", (np.arange(9000) % 7).astype(str))),
            "v": np.concatenate([rng.normal(size=3000), rng.lognormal(0, 40, 3000), rng.integers(0, 9, 3000), ]) * np.where(rng.random(9000) < 0.1, -1e6, 1),
        }
    )


def test_ranges_are_cut_until_they_are_small(spark, skewed, monkeypatch):
    monkeypatch.setattr(stats, "RANGE_ROWS", 20)
    monkeypatch.setattr(stats, "MOST_CUTS", 7)
    cuts = []
    monkeypatch.setattr(stats, "_cut_points", lambda rows, cut=stats._cut_points: cuts.append(rows.count()) or cut(rows))
    df = spark.createDataFrame(skewed).repartition(8)
    wanted = {"lo": 0.0, "a": 0.1, "q": 0.25, "m": 0.5, "x": 0.999, "hi": 1.0}
    got = {r.g: r for r in stats.quantiles(df, "v", wanted, ["g"]).collect()}
    for g, part in skewed.groupby("g").v:
        assert [got[g][n] for n in wanted] == pytest.approx([part.quantile(p) for p in wanted.values()], rel=1e-12)
    # Several rounds, each over fewer values than the one before.
    assert len(cuts) > 2 and cuts == sorted(cuts, reverse=True) and cuts[-1] < cuts[0] / 2
    everything = stats.quantiles(df, "v", wanted).first()
    assert [everything[n] for n in wanted] == pytest.approx([skewed.v.quantile(p) for p in wanted.values()], rel=1e-12)


def test_values_beyond_all_numbers_are_ranked(spark, monkeypatch):
    monkeypatch.setattr(stats, "RANGE_ROWS", 2)
    inf, nan = float("inf"), float("nan")
    values = [-inf, -1e308, -0.0, 0.0, 5e-324, 1.0, 1.0, 1e308, inf, inf]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert stats.quantiles(df, "v", {f"r{i}": i / 9 for i in range(10)}).first()[3:7] == (0.0, 5e-324, 1.0, 1.0)
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, nan]], "v double")
    assert stats.quantiles(df, "v", {"m": 0.5}).first()[0] == 2.0


@pytest.mark.parametrize("range_rows", [10, 1 << 16])
def test_boxes_of_large_groups(spark, skewed, monkeypatch, range_rows):
    monkeypatch.setattr(stats, "RANGE_ROWS", range_rows)
    df = spark.createDataFrame(skewed).repartition(8)
    got = {r.g: r for r in stats.box_summary(df, "v", ["g"]).collect()}
    outliers = 0
    for g, part in skewed.groupby("g").v:
        q25, q75 = part.quantile(0.25), part.quantile(0.75)
        inside = part[(part >= q25 - 1.5 * (q75 - q25)) & (part <= q75 + 1.5 * (q75 - q25))]
        assert (got[g].whisker_low, got[g].whisker_high) == pytest.approx((inside.min(), inside.max()))
        assert got[g].n_outliers == len(part) - len(inside)
        outliers += len(part) - len(inside)
    assert stats.box_outliers(df, "v", ["g"]).count() == outliers
    summary = {r.g: r for r in stats.describe(df, "v", ["g"]).collect()}
    for g, part in skewed.groupby("g").v:
        assert list(summary[g])[1:] == pytest.approx(list(part.describe()))


def _meets_only_in_its_group(plan: str) -> bool:
    """Whether an exchange on the group key alone carries single values."""
    nodes = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: hashpartitioning\((.*?), \d+\)", plan)
    assert nodes
    return any("_v#" in columns and [k.split("#")[0] for k in keys.split(", ")] == ["g"] for columns, keys in nodes)


def test_values_never_meet_by_their_group_alone(spark, skewed, monkeypatch):
    plans = []

    def kept(df, purpose, write=stats.written_copy):
        plans.append(df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
        return write(df, purpose)

    monkeypatch.setattr(stats, "written_copy", kept)
    monkeypatch.setattr(stats, "RANGE_ROWS", 500)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = spark.createDataFrame(skewed)
        for made in (stats.describe(df, "v", ["g"]), stats.box_summary(df, "v", ["g"]), stats.box_outliers(df, "v", ["g"])):
            plans.append(made._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    with_exchange = [p for p in plans if "hashpartitioning" in p]
    assert len(with_exchange) > 8
    assert not any(_meets_only_in_its_group(p) for p in with_exchange)


# --- regression ------------------------------------------------------------------------------


def ridge_by_hand(x: np.ndarray, y: np.ndarray, alpha: float = 1.0):
    center = x.mean(axis=0)
    beta = np.linalg.solve((x - center).T @ (x - center) + alpha * np.eye(x.shape[1]), (x - center).T @ (y - y.mean()))
    return beta, y.mean() - center @ beta


def test_ridge_equals_refits(spark):
    rng = np.random.default_rng(7)
    n = 41
    frame = pd.DataFrame(
        {
            "rank": rng.integers(1, 19, n),
            "holiday": rng.integers(0, 2, n).astype(bool),
            "competition": rng.choice(["A", "B", "C"], n),
            "day": rng.choice(["Mon", "Fri", "Sun"], n),
        }
    )
    frame["y"] = 0.9 - 0.01 * frame["rank"] + 0.05 * (frame.competition == "B") + rng.normal(0, 0.05, n)
    design = pd.get_dummies(frame[["rank", "holiday", "competition", "day"]], columns=["competition", "day"], drop_first=True)
    x = design.to_numpy(dtype=float)
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    y = frame.y.to_numpy()

    df = spark.createDataFrame(frame)
    fit = fit_ridge(df, "y", ["rank", "holiday"], ["competition", "day"])
    assert fit.features == tuple(design.columns)
    beta, intercept = ridge_by_hand(x, y)
    assert fit.coefficients == pytest.approx(beta, abs=1e-12)

    scored = fit.score(df).toPandas()
    assert np.sort(scored.prediction) == pytest.approx(np.sort(intercept + x @ beta), abs=1e-12)
    errors = []
    for i in range(n):
        rest = np.arange(n) != i
        b, c = ridge_by_hand(x[rest], y[rest])
        errors.append(abs(y[i] - c - x[i] @ b))
    assert np.sort(scored.loo_error) == pytest.approx(np.sort(errors), abs=1e-12)

    evaluation = fit.evaluation(df).first()
    assert evaluation.mae == pytest.approx(np.mean(errors))
    assert evaluation.relative_error_pct == pytest.approx(np.mean(errors) / y.mean() * 100)
    ranking = [r.feature for r in fit.ranking(spark).collect()]
    assert ranking == list(design.columns[np.argsort(-np.abs(beta))])


def test_ridge_with_constant_and_unknown_labels(spark):
    data = [(1.0, 5.0, "x"), (2.0, 5.0, None), (4.0, 5.0, "y"), (3.0, 5.0, "x")]
    df = spark.createDataFrame([(2 * a + 1, a, b, c) for a, b, c in data], "y double, a double, b double, c string")
    fit = fit_ridge(df, "y", ["a", "b"], ["c"])
    assert fit.features == ("a", "b", "c_y")
    assert fit.coefficients[1] == 0.0
    assert fit.score(df).filter("loo_error is null").count() == 0


def test_ridge_refuses_incomplete_rows(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "y double, x double")
    with pytest.raises(ValueError, match="1 of 2 rows"):
        fit_ridge(df, "y", ["x"])


def test_one_reading_gives_both_values(spark):
    at = dt.datetime(2025, 1, 1, 20)
    df = spark.createDataFrame([(at, 5.0, None), (at, 7.0, 2.0)], "hour_ts timestamp_ntz, temperature double, precipitation double")
    assert rows(lookups.hourly_readings(df)) == [(at, 5.0, None)]


def test_no_label_is_left_out(spark):
    labels = [f"l{i:04d}" for i in range(1005)]
    df = spark.createDataFrame([(x, float(i % 7)) for i, x in enumerate(labels)], "label string, y double")
    model = fit_ridge(df.coalesce(2), "y", [], ["label"])
    assert model.features == tuple(f"label_{x}" for x in labels[1:])


def test_eliminated_labels_give_the_whole_model(spark):
    rng = np.random.default_rng(23)
    n = 3000
    frame = pd.DataFrame(
        {
            "rank": rng.integers(1, 19, n),
            "day": rng.choice(["Mon", "Fri", None, "Sun"], n),
            # A third of all rows have one label; a label has NULL for its name.
            "place": np.where(rng.random(n) < 0.34, "hot", np.char.add("p", rng.integers(0, 300, n).astype(str))),
        }
    )
    frame.loc[::50, "place"] = None
    frame["y"] = 40 - 0.3 * frame["rank"] + (frame.day == "Sun") + frame.place.map(lambda p: len(str(p))) + rng.normal(0, 2, n)
    df = spark.createDataFrame(frame).repartition(6)
    whole = fit_ridge(df, "y", ["rank"], ["day", "place"])
    parts = fit_label_ridge(df, "y", "place", ["rank"], ["day"])
    assert len(parts.features) == 3 and parts.inverse.shape == (4, 4)
    wanted = dict(zip(whole.features, whole.coefficients))
    got = {r.feature: r.coefficient for r in parts.ranking().collect()}
    assert set(got) == set(wanted)
    assert [got[f] for f in wanted] == pytest.approx(list(wanted.values()), abs=1e-9)
    columns = ["rank", "day", "place", "y", "prediction", "loo_error"]
    ours, theirs = (fit.score(df).select(columns).toPandas().sort_values(columns[:4]) for fit in (parts, whole))
    assert ours.prediction.to_numpy() == pytest.approx(theirs.prediction.to_numpy(), abs=1e-8)
    assert ours.loo_error.to_numpy() == pytest.approx(theirs.loo_error.to_numpy(), abs=1e-8)
    assert parts.evaluation(df).first().mae == pytest.approx(whole.evaluation(df).first().mae)


def test_eliminated_labels_without_other_features(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0), ("c", 9.0), (None, 4.0)], "g string, y double")
    whole, parts = fit_ridge(df, "y", [], ["g"]), fit_label_ridge(df, "y", "g")
    assert {r.feature: pytest.approx(r.coefficient) for r in parts.ranking().collect()} == dict(zip(whole.features, whole.coefficients))
    one = fit_label_ridge(df.filter("g = 'a'"), "y", "g")
    assert [r.prediction for r in one.score(df.filter("g = 'a'")).collect()] == [1.5, 1.5]
    with pytest.raises(ValueError, match="1 of 2 rows"):
        fit_label_ridge(spark.createDataFrame([("a", None), ("b", 3.0)], "g string, y double"), "y", "g")
