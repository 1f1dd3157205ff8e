"""Descriptive statistics as distributed aggregates.

Quantiles are exact and never gather a whole group in one task. Values are counted once, cut into ranges at points
that hold for all groups alike, and counted per range. Only ranges that hold a wanted rank are cut again, until
each is small; ranks are looked up inside those. See ``Ranges``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnstile.session import written_copy

# A range of a group that holds more distinct values than this is cut again.
RANGE_ROWS = 1 << 16
# The most points at which one round cuts, and into how many steps it cuts each range by its own bounds.
MOST_CUTS = 4095
STEPS = 16


def pearson(x: Column, y: Column) -> Column:
    """Correlation over rows where both are known; NULL when either is constant."""
    x, y = x.cast("double"), y.cast("double")
    x_known, y_known = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x_known) * F.stddev_pop(y_known))


def correlations(df: DataFrame, target: str, others: Sequence[str]) -> DataFrame:
    """Correlation of ``target`` with each other column, in one pass; one row per column."""
    one_row = df.agg(*(pearson(F.col(target), F.col(c)).alias(c) for c in others))
    return one_row.unpivot([], list(others), "variable", "correlation")


def group_summary(df: DataFrame, by: str, value: str) -> DataFrame:
    """Mean, minimum, maximum and count of known values per group; NULL groups left out."""
    return (
        df.filter(F.col(by).isNotNull())
        .groupBy(by)
        .agg(
            F.avg(value).alias("mean"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.count(value).alias("count"),
        )
    )


def cross_counts(df: DataFrame, rows: str, columns: str, values: Sequence[str] | None = None) -> DataFrame:
    """Counts for each pair of labels, one column per label of ``columns``; absent pairs are 0.

    With ``values`` the labels are fixed and no extra pass is needed to find them.
    """
    known = df.filter(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    return known.groupBy(rows).pivot(columns, list(values) if values else None).count().na.fill(0)


def least_squares(y: Column, x: Column) -> tuple[Column, Column]:
    """Slope and intercept of the least-squares line of ``y`` on ``x``.

    NULL pairs are skipped; a constant ``x`` gives NULL.
    """
    x, y = x.cast("double"), y.cast("double")
    x_known, y_known = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    slope = F.try_divide(F.covar_pop(x, y), F.var_pop(x_known))
    return slope, F.avg(y_known) - slope * F.avg(x_known)


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """How often each known value occurs per known group: keys, ``_v``, ``_c``.

    Repeats are added up before the shuffle, so neither a frequent value nor a
    large group gathers in one task.
    """
    known = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    for key in by:
        known = known.filter(F.col(key).isNotNull())
    return known.groupBy(*by, "_v").agg(F.count("*").alias("_c"))


def _cut_points(rows: DataFrame) -> list[float]:
    """Points that cut the values into near equal shares, more of them for more rows."""
    wanted = min(MOST_CUTS, max(7, rows.count() // (RANGE_ROWS // 4 or 1)))
    shares = [i / (wanted + 1) for i in range(1, wanted + 1)]
    points = rows.agg(F.percentile_approx("_v", shares, 4 * wanted)).first()[0]
    return sorted(set(points or []))


def _points_below(value: Column, points: list[float]) -> Column:
    """How many of the sorted points lie below the value, by halving."""
    if not points:
        return F.lit(0)
    held = F.array(*(F.lit(p) for p in points))
    halves = [1 << i for i in reversed(range(len(points).bit_length()))]
    return F.aggregate(
        F.array(*(F.lit(h) for h in halves)),
        F.lit(0),
        lambda at, by: at + F.when(F.get(held, at + by - 1) < value, by).otherwise(0),
    )


def _first_step(value: Column, low: Column, high: Column) -> Column:
    """Which of the steps between a range's bounds a value is on; the lowest value has one to itself."""
    share = F.try_divide(value - low, high - low)
    inside = F.when(share <= 1, F.floor(share * (STEPS - 2)).cast("int") + 1).otherwise(STEPS - 1)
    return F.when(value == low, 0).otherwise(inside)


@dataclass
class Ranges:
    """The counted values of groups, cut into ranges.

    ``values`` has the keys, ``_v``, ``_c`` and ``_part``, the range within the group; ``parts`` has one row per
    range: ``_size`` values of which ``_width`` distinct, from ``_low`` to ``_high``, after ``_before`` smaller ones of ``_n``
    in the group, and the sums of the values' distances from ``middle`` and of their squares.
    """

    by: list[str]
    values: DataFrame
    parts: DataFrame
    middle: float

    @classmethod
    def of(cls, df: DataFrame, value: str, by: Sequence[str] = ()) -> Ranges:
        """Count and cut: one pass over the source, one over the counted values.

        The cut points come from a sketch of all groups' values, so no value travels to meet its group's: a group that
        holds a third of all values is cut as finely as the whole. The sketch decides how even the ranges are, not the result.
        """
        by = list(by)
        counted = written_copy(value_counts(df, value, by), "counted")
        points = _cut_points(counted)
        middle = points[len(points) // 2] if points else 0.0
        values = counted.withColumn("_part", _points_below(F.col("_v"), points))
        away = F.col("_v") - F.lit(middle)
        sizes = values.groupBy(*by, "_part").agg(
            F.sum("_c").alias("_size"),
            F.count("*").alias("_width"),
            F.min("_v").alias("_low"),
            F.max("_v").alias("_high"),
            F.sum(away * F.col("_c")).alias("_away"),
            F.sum(away * away * F.col("_c")).alias("_squares"),
        )
        group = Window.partitionBy(*by)
        parts = sizes.withColumns(
            {"_n": F.sum("_size").over(group), "_before": F.sum("_size").over(group.orderBy("_part")) - F.col("_size")}
        )
        return cls(by, values, written_copy(parts, "ranges"), middle)

    def in_parts(self, parts: DataFrame) -> DataFrame:
        """The values of some ranges, with those ranges' columns."""
        return self.values.join(parts, [*self.by, "_part"])

    def at_ranks(self, probabilities: dict[str, float]) -> DataFrame:
        """Quantiles with linear interpolation, one row per group, one column per name."""
        key = [*self.by, "_range", "_part"]

        def low_rank(p: float) -> Column:
            return F.floor((F.col("_n") - 1) * F.lit(p))

        def holds_a_rank(start: Column, end: Column) -> Column:
            hit = F.lit(False)
            for p in probabilities.values():
                hit = hit | ((low_rank(p) < end) & (low_rank(p) + 1 >= start))
            return hit

        bounds = ["_n", "_before", "_width", "_low", "_high"]
        rows = self.values.withColumn("_range", F.lit(0).cast("long"))
        left = self.parts.withColumn("_range", F.lit(0).cast("long"))
        left = left.filter(holds_a_rank(F.col("_before"), F.col("_before") + F.col("_size"))).select(*key, *bounds)
        while (left.agg(F.max("_width")).first()[0] or 0) > RANGE_ROWS:
            # A range is known by how many values lie below it. It is cut at points for all ranges and by its own bounds.
            kept = rows.join(left, key).drop("_range", "_part", "_width").withColumnRenamed("_before", "_range")
            kept = written_copy(kept, "narrowed")
            part = _points_below(F.col("_v"), _cut_points(kept)) * STEPS + _first_step(F.col("_v"), F.col("_low"), F.col("_high"))
            cut = kept.withColumn("_part", part)
            sizes = cut.groupBy(*key, "_n").agg(
                F.sum("_c").alias("_size"), F.count("*").alias("_width"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
            )
            so_far = F.sum("_size").over(Window.partitionBy(*self.by, "_range").orderBy("_part"))
            sizes = sizes.withColumn("_before", F.col("_range") + so_far - F.col("_size"))
            sizes = sizes.filter(holds_a_rank(F.col("_before"), F.col("_before") + F.col("_size")))
            left, rows = written_copy(sizes.select(*key, *bounds), "ranges"), cut.drop("_n", "_low", "_high")

        inside = Window.partitionBy(*key).orderBy("_v")
        ranked = (
            rows.join(left, key)
            .withColumn("_end", F.col("_before") + F.sum("_c").over(inside))
            .withColumn("_start", F.col("_end") - F.col("_c"))
        )

        def at_rank(rank: Column) -> Column:
            return F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), F.col("_v")))

        def interpolated(p: float) -> Column:
            low = at_rank(low_rank(p))
            high = F.coalesce(at_rank(low_rank(p) + 1), low)
            share = F.max((F.col("_n") - 1) * F.lit(p) - low_rank(p))
            return F.when(share == 0, low).otherwise(low + (high - low) * share)

        return ranked.groupBy(*self.by).agg(*(interpolated(p).alias(name) for name, p in probabilities.items()))

    def moments(self) -> DataFrame:
        """Count, mean, sample deviation, minimum and maximum per group, from the ranges alone."""
        n, away = F.sum("_size"), F.sum("_away")
        spread = F.greatest(F.sum("_squares") - away * away / n, F.lit(0.0))
        return self.parts.groupBy(*self.by).agg(
            F.coalesce(n, F.lit(0)).alias("count"),
            (F.lit(self.middle) + away / n).alias("mean"),
            F.when(n > 1, F.sqrt(spread / (n - 1))).alias("std"),
            F.min("_low").alias("min"),
            F.max("_high").alias("max"),
        )


def quantiles(df: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group, one column per name."""
    return Ranges.of(df, value, by).at_ranks(probabilities)


def _joined(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Two tables with one row per group side by side; of one row each without keys."""
    return left.join(right, by) if by else left.join(right)


# Names and positions of the quartiles in a summary.
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of the known values."""
    by = list(by)
    ranges = Ranges.of(df, value, by)
    summary = _joined(ranges.moments(), ranges.at_ranks(QUARTILES), by)
    return summary.select(*by, "count", "mean", "std", "min", *QUARTILES, "max")


# Fixed value: whiskers reach the last value within this many interquartile ranges.
WHISKER_REACH = 1.5


def _fenced_parts(ranges: Ranges, quartiles: DataFrame) -> DataFrame:
    """The ranges with the fences of their group, and whether a fence runs through them or they lie beyond both."""
    reach = WHISKER_REACH * (F.col("q75") - F.col("q25"))
    fences = quartiles.select(*ranges.by, (F.col("q25") - reach).alias("_fence_low"), (F.col("q75") + reach).alias("_fence_high"))
    inside = (F.col("_low") >= F.col("_fence_low")) & (F.col("_high") <= F.col("_fence_high"))
    beyond = (F.col("_high") < F.col("_fence_low")) | (F.col("_low") > F.col("_fence_high"))
    return _joined(ranges.parts, fences, ranges.by).withColumns({"_inside": inside, "_beyond": beyond})


def _within_fences() -> Column:
    return F.col("_v").between(F.col("_fence_low"), F.col("_fence_high"))


def box_summary(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Quartiles, whisker ends and number of outliers per group.

    Ranges that lie on one side of the fences answer by their bounds and sizes; values are looked at only in the
    ranges through which a fence runs, at most two a group.
    """
    by = list(by)
    ranges = Ranges.of(df, value, by)
    quartiles = written_copy(ranges.at_ranks(QUARTILES), "quartiles")
    parts = _fenced_parts(ranges, quartiles)
    whole = parts.filter(F.col("_inside") | F.col("_beyond")).select(
        *by,
        F.when(F.col("_inside"), F.col("_low")).alias("_first"),
        F.when(F.col("_inside"), F.col("_high")).alias("_last"),
        F.when(F.col("_beyond"), F.col("_size")).otherwise(0).alias("_out"),
    )
    cut = parts.filter(~F.col("_inside") & ~F.col("_beyond")).select(*by, "_part", "_fence_low", "_fence_high")
    single = ranges.in_parts(cut).select(
        *by,
        F.when(_within_fences(), F.col("_v")).alias("_first"),
        F.when(_within_fences(), F.col("_v")).alias("_last"),
        F.when(_within_fences(), 0).otherwise(F.col("_c")).alias("_out"),
    )
    ends = whole.unionByName(single).groupBy(*by).agg(
        F.min("_first").alias("whisker_low"), F.max("_last").alias("whisker_high"), F.sum("_out").alias("n_outliers")
    )
    return _joined(quartiles, ends, by).select(*by, *QUARTILES, "whisker_low", "whisker_high", "n_outliers")


def box_outliers(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Rows outside the fences of their group: those whose group and value are among the outlying ones."""
    by = list(by)
    ranges = Ranges.of(df, value, by)
    parts = _fenced_parts(ranges, ranges.at_ranks(QUARTILES)).filter(~F.col("_inside"))
    outlying = ranges.in_parts(parts.select(*by, "_part", "_fence_low", "_fence_high")).filter(~_within_fences())
    known = df.withColumn("_v", F.col(value).cast("double"))
    return known.join(outlying.select(*by, "_v"), [*by, "_v"], "left_semi").select(df.columns)
