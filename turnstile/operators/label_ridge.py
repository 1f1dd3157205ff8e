"""Ridge regression with a categorical column of very many labels, which never reach the driver.

The model is that of ``ridge``: standardised features, one indicator per label but the first, a free intercept. In the
normal equations the indicators of one column form a diagonal block, so its coefficients are eliminated exactly: what
is left is a system for the intercept and the other features, corrected by one partial aggregate over the labels. The
driver holds the square of the number of *other* features only. The labels' coefficients, and what rows need for
their leave-one-out errors, are a table with one row per label, joined to the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions.numbers import ratio
from turnstile.operators.ridge import _active
from turnstile.session import written_copy


@dataclass(frozen=True)
class LabelRidgeFit:
    """Fitted model. ``labels`` has, by label, its coefficient, the inverse of its pivot, and its part in the other features."""

    target: str
    column: str
    numeric: tuple[str, ...]
    levels: dict[str, tuple[str, ...]]
    features: tuple[str, ...]
    shifts: tuple[float, ...]
    mean_target: float
    weights: np.ndarray
    inverse: np.ndarray
    scales: np.ndarray
    labels: DataFrame

    def ranking(self) -> DataFrame:
        """Standardised coefficients of all features, labels included: ``feature``, ``coefficient``."""
        named = zip(self.features, map(float, self.weights[1:] * self.scales))
        others = self.labels.sparkSession.createDataFrame(list(named), "feature string, coefficient double")
        name = F.concat(F.lit(f"{self.column}_"), "_label")
        return self.labels.select(name.alias("feature"), (F.col("_weight") * F.col("_scale")).alias("coefficient")).unionAll(others)

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` and ``loo_error``, the absolute error with the row left out.

        Rows meet their label's row by a join, which is split where a label holds many rows; labels that are
        NULL or unknown count as the first.
        """
        own = self.labels.select("_label", "_weight", "_pivot", "_shares")
        joined = df.withColumn("_label", F.col(self.column).cast("string")).join(own, "_label", "left")
        size = len(self.features) + 1
        shared = df.sparkSession.sparkContext.broadcast((self.weights, self.inverse))

        @F.pandas_udf("prediction double, leverage double")
        def scored(rows: pd.Series, shares: pd.Series) -> pd.DataFrame:
            weights, inverse = shared.value
            x, left = np.zeros((len(rows), size)), np.zeros((len(rows), size))
            for row, (own, apart) in enumerate(zip(rows, shares)):
                for e in own:
                    x[row, e["i"]] += e["v"]
                for e in apart:
                    left[row, e["i"]] -= e["v"]
            left += x
            return pd.DataFrame({"prediction": x @ weights, "leverage": np.einsum("ra,ab,rb->r", left, inverse, left)})

        prediction = F.lit(self.mean_target) + F.col("_scored.prediction") + F.coalesce("_weight", F.lit(0.0))
        leverage = F.col("_scored.leverage") + F.coalesce("_pivot", F.lit(0.0))
        return (
            joined.withColumn("_scored", scored(_entries(self.numeric, self.shifts, self.levels), F.coalesce("_shares", F.array().cast(_ENTRIES))))
            .withColumn("prediction", prediction)
            .withColumn("loo_error", F.abs(F.col(self.target).cast("double") - F.col("prediction")) / (1 - leverage))
            .select(*df.columns, "prediction", "loo_error")
        )

    def evaluation(self, df: DataFrame) -> DataFrame:
        """Mean leave-one-out error, mean target and their quotient in percent, as one row."""
        means = self.score(df).agg(F.avg("loo_error").alias("mae"), F.avg(F.col(self.target).cast("double")).alias("mean_target"))
        return means.withColumn("relative_error_pct", ratio(F.col("mae"), F.col("mean_target")) * 100.0)


_ENTRIES = "array<struct<i: int, v: double>>"


def _entries(numeric: Sequence[str], shifts: Sequence[float], levels: dict[str, tuple[str, ...]]) -> Column:
    """The intercept and the features that are not zero in a row, by place."""
    active = [(F.lit(0), F.lit(1.0)), *_active(numeric, shifts, levels)]
    entries = F.array(*(F.struct(place.cast("int").alias("i"), value.cast("double").alias("v")) for place, value in active))
    return F.filter(entries, lambda e: e["i"].isNotNull())


def fit_label_ridge(
    df: DataFrame, target: str, column: str, numeric: Sequence[str] = (), categorical: Sequence[str] = (), alpha: float = 1.0
) -> LabelRidgeFit:
    """Fit with the labels of ``column`` eliminated; the other categorical columns should have few labels.

    ``df`` is read four times: save it first if it is costly to derive. A label that holds many rows is folded
    in each input task. Driver: the square of the number of other features; the labels of ``column`` stay in Spark.
    """
    numbers = [F.col(c).cast("double") for c in (*numeric, target)]
    first = df.agg(
        F.count("*").alias("n"),
        F.count_if(F.greatest(*(c.isNull() for c in numbers), F.lit(False))).alias("n_incomplete"),
        F.avg(numbers[-1]).alias("target"),
        F.min(F.col(column).cast("string")).alias("base"),
        *(F.avg(c).alias(f"m{i}") for i, c in enumerate(numbers[:-1])),
        *(F.collect_set(F.col(c).cast("string")).alias(f"l{i}") for i, c in enumerate(categorical)),
    ).first()
    if not first.n or first.n_incomplete:
        raise ValueError(f"{first.n_incomplete} of {first.n} rows lack a number; remove or fill them first")
    levels = {c: tuple(sorted(first[f"l{i}"])) for i, c in enumerate(categorical)}
    features = (*numeric, *(f"{c}_{label}" for c in categorical for label in levels[c][1:]))
    shifts = tuple(first[f"m{i}"] for i in range(len(numeric)))
    size, answer = len(features) + 1, len(features) + 1  # the place of the target is after all features

    known = F.struct(F.lit(answer).alias("i"), (numbers[-1] - first.target).alias("v"))
    rows = df.select(F.col(column).cast("string").alias("_label"), F.array_append(_entries(numeric, shifts, levels), known).alias("row"))
    whole = np.zeros((size + 1, size + 1))
    for r in _pair_sums(rows, "row", F.lit(1.0)).collect():
        whole[r.i, r.j] = r.s
    n = whole[0, 0]
    spread = np.sqrt(np.maximum(np.diag(whole)[1:size] / n - (whole[0, 1:size] / n) ** 2, 0.0))

    # Per label: the sums of the features over its rows; then its pivot, its indicator's variance as the penalty.
    cells = rows.filter(F.col("_label") != first.base).select("_label", F.explode("row").alias("e"))
    cells = cells.groupBy("_label", F.col("e.i").alias("i")).agg(F.sum("e.v").alias("v"))
    sums = cells.groupBy("_label").agg(
        F.collect_list(F.struct("i", "v")).alias("sums"),  # at most one entry a feature
        F.max(F.when(F.col("i") == 0, F.col("v"))).alias("_n"),
    )
    share = F.col("_n") / F.lit(float(n))
    sums = sums.withColumn("_scale", F.sqrt(share * (1 - share))).withColumn("_pivot", 1 / (F.col("_n") + alpha * share * (1 - share)))
    sums = written_copy(sums, "label-sums")
    left = whole
    for r in _pair_sums(sums, "sums", F.col("_pivot")).collect():
        left[r.i, r.j] -= r.s

    penalty = alpha * np.append(0.0, np.where(spread > 0, spread**2, 1.0))
    inverse = np.linalg.inv(left[:size, :size] + np.diag(penalty))
    weights = inverse @ left[:size, answer]

    held = F.array(*(F.lit(float(w)) for w in weights))
    explained = F.aggregate(F.filter("sums", lambda e: e["i"] < answer), F.lit(0.0), lambda s, e: s + e["v"] * F.get(held, e["i"]))
    total = F.aggregate(F.filter("sums", lambda e: e["i"] == answer), F.lit(0.0), lambda s, e: s + e["v"])
    shares = F.transform(
        F.filter("sums", lambda e: e["i"] < answer), lambda e: F.struct(e["i"].alias("i"), (e["v"] * F.col("_pivot")).alias("v"))
    )
    labels = sums.select("_label", ((total - explained) * F.col("_pivot")).alias("_weight"), "_pivot", "_scale", shares.alias("_shares"))
    return LabelRidgeFit(
        target=target,
        column=column,
        numeric=tuple(numeric),
        levels=levels,
        features=features,
        shifts=shifts,
        mean_target=float(first.target),
        weights=weights,
        inverse=inverse,
        scales=np.where(spread > 0, spread, 1.0),
        labels=labels,
    )


def _pair_sums(df: DataFrame, entries: str, factor: Column) -> DataFrame:
    """Sums over the rows of the products of every two entries, times a factor of the row: ``i``, ``j``, ``s``."""
    return (
        df.select(F.explode(entries).alias("a"), entries, factor.alias("factor"))
        .select("a", F.explode(entries).alias("b"), "factor")
        .groupBy(F.col("a.i").alias("i"), F.col("b.i").alias("j"))
        .agg(F.sum(F.col("a.v") * F.col("b.v") * F.col("factor")).alias("s"))
    )
