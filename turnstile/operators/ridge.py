"""Ridge regression on numeric, boolean and categorical columns, with exact leave-one-out errors.

The rows stay distributed. Spark sums the cross products of the features, one
partial sum per feature pair and task; the driver solves the feature-by-feature
system, whose size depends on the number of labels and not on the rows; Spark
then scores the rows. Leave-one-out errors come from the leverage of each row,
``|residual| / (1 - leverage)``, and equal those of one refit per row.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstile.functions.numbers import ratio


@dataclass(frozen=True)
class RidgeFit:
    """Fitted model. ``features`` names the design columns in order."""

    target: str
    numeric: tuple[str, ...]
    levels: dict[str, tuple[str, ...]]
    features: tuple[str, ...]
    shifts: tuple[float, ...]
    mean_target: float
    n_rows: int
    centers: np.ndarray
    scales: np.ndarray
    coefficients: np.ndarray
    inverse: np.ndarray

    def ranking(self, spark) -> DataFrame:
        """Standardised coefficients, largest absolute value first."""
        rows = list(zip(self.features, map(float, self.coefficients)))
        return spark.createDataFrame(rows, "feature string, coefficient double").orderBy(
            F.abs("coefficient").desc(), "feature"
        )

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` and ``loo_error``, the absolute error with the row left out."""
        size = len(self.features)
        # One more, empty feature takes the place of labels without a column of their own.
        weights = np.append(self.coefficients / self.scales, 0.0)
        metric = np.zeros((size + 1, size + 1))
        metric[:size, :size] = self.inverse / np.outer(self.scales, self.scales)
        centers = np.append(self.centers, 0.0)
        intercept = self.mean_target - centers @ weights
        tilt, base = metric @ centers, centers @ metric @ centers + 1.0 / self.n_rows
        shared = df.sparkSession.sparkContext.broadcast((weights, metric, tilt))

        @F.pandas_udf("prediction double, leverage double")
        def scored(positions: pd.Series, values: pd.Series) -> pd.DataFrame:
            weights, metric, tilt = shared.value
            at, x = np.stack(positions.to_list()), np.stack(values.to_list())
            predicted = intercept + (weights[at] * x).sum(axis=1)
            spread = np.einsum("ra,rb,rab->r", x, x, metric[at[:, :, None], at[:, None, :]])
            return pd.DataFrame(
                {"prediction": predicted, "leverage": spread - 2 * (tilt[at] * x).sum(axis=1) + base}
            )

        active = _active(self.numeric, self.shifts, self.levels)
        error = F.col(self.target).cast("double") - F.col("_scored.prediction")
        return (
            df.withColumn(
                "_scored",
                scored(
                    F.array(*(F.coalesce(place - 1, F.lit(size)) for place, _ in active)),
                    F.array(*(v for _, v in active)),
                ),
            )
            .withColumn("prediction", F.col("_scored.prediction"))
            .withColumn("loo_error", F.abs(error) / (1 - F.col("_scored.leverage")))
            .drop("_scored")
        )

    def evaluation(self, df: DataFrame) -> DataFrame:
        """Mean leave-one-out error, mean target and their quotient in percent, as one row."""
        return (
            self.score(df)
            .agg(
                F.avg("loo_error").alias("mae"),
                F.avg(F.col(self.target).cast("double")).alias("mean_target"),
            )
            .withColumn("relative_error_pct", ratio(F.col("mae"), F.col("mean_target")) * 100.0)
        )


def _active(
    numeric: Sequence[str], shifts: Sequence[float], levels: dict[str, tuple[str, ...]]
) -> list[tuple[Column, Column]]:
    """Position (from 1) and value of the features that are not zero in a row.

    Numeric columns always count; a categorical column adds the one position of
    its label, or NULL for its first label, for NULL and for unknown labels.
    """
    parts = [
        (F.lit(i + 1), F.col(name).cast("double") - F.lit(shift))
        for i, (name, shift) in enumerate(zip(numeric, shifts))
    ]
    place = len(numeric)
    for name, labels in levels.items():
        position = F.lit(None).cast("int")
        if len(labels) > 1:
            places = json.dumps({label: place + i + 1 for i, label in enumerate(labels[1:])})  # one literal, however many
            position = F.try_element_at(F.from_json(F.lit(places), "map<string,int>"), F.col(name).cast("string"))
        parts.append((position, F.lit(1.0)))
        place += max(len(labels) - 1, 0)
    return parts


def fit_ridge(
    df: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str] = (), alpha: float = 1.0
) -> RidgeFit:
    """Fit on standardised features (population deviation) with a free intercept.

    Categorical columns become one indicator per label except the alphabetically
    first. ``df`` is read three times: save it first if it is costly to derive.
    All labels take part, however many. They are the width of the design that the
    caller chose, and the driver solves for it: three square matrices of doubles,
    24 bytes times the square of the number of features (2.4 GB at 10 000).
    """
    numbers = [F.col(c).cast("double") for c in (*numeric, target)]
    first = df.agg(
        F.count("*").alias("n"),
        F.count_if(F.greatest(*(c.isNull() for c in numbers), F.lit(False))).alias("n_incomplete"),
        F.avg(numbers[-1]).alias("target"),
        *(F.avg(c).alias(f"m{i}") for i, c in enumerate(numbers[:-1])),
    ).first()
    if not first.n or first.n_incomplete:
        raise ValueError(f"{first.n_incomplete} of {first.n} rows lack a number; remove or fill them first")

    levels: dict[str, tuple[str, ...]] = {c: () for c in categorical}
    if categorical:
        pairs = F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("label")) for c in categorical))
        found = (
            df.select(F.explode(pairs).alias("p"))
            .select("p.*")
            .filter(F.col("label").isNotNull())
            .distinct()
            .collect()
        )
        for c in categorical:
            levels[c] = tuple(sorted(r.label for r in found if r.name == c))
    features = [*numeric, *(f"{c}_{label}" for c in categorical for label in levels[c][1:])]
    size = len(features)

    shifts = tuple(first[f"m{i}"] for i in range(len(numeric)))
    active = _active(numeric, shifts, levels)
    entries = [
        F.struct(F.lit(0).alias("i"), F.lit(1.0).alias("v")),
        *(F.struct(position.alias("i"), value.alias("v")) for position, value in active),
        F.struct(F.lit(size + 1).alias("i"), (numbers[-1] - first.target).alias("v")),
    ]
    sums = (
        df.select(F.filter(F.array(*entries), lambda e: e["i"].isNotNull()).alias("row"))
        .select(F.explode("row").alias("a"), "row")
        .select("a", F.explode("row").alias("b"))
        .filter(F.col("a.i") <= F.col("b.i"))
        .groupBy(F.col("a.i").alias("i"), F.col("b.i").alias("j"))
        .agg(F.sum(F.col("a.v") * F.col("b.v")).alias("s"))
        .collect()
    )
    cross = np.zeros((size + 2, size + 2))
    for r in sums:
        cross[r.i, r.j] = cross[r.j, r.i] = r.s

    n = cross[0, 0]
    centered = cross[1:, 1:] - np.outer(cross[0, 1:], cross[0, 1:]) / n
    scales = np.sqrt(np.maximum(np.diag(centered)[:size], 0.0) / n)
    scales[scales == 0.0] = 1.0
    gram = centered[:size, :size] / np.outer(scales, scales)
    inverse = np.linalg.inv(gram + alpha * np.eye(size))
    return RidgeFit(
        target=target,
        numeric=tuple(numeric),
        levels=levels,
        features=tuple(features),
        shifts=shifts,
        mean_target=float(first.target + cross[0, size + 1] / n),
        n_rows=int(n),
        centers=cross[0, 1 : size + 1] / n,
        scales=scales,
        coefficients=inverse @ (centered[:size, size] / scales),
        inverse=inverse,
    )
