"""Panels and ordered analytics: dense grids, lags, rolling sums, ranks, modes and quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.operators.ordered import numbered, quantiles


def dense_panel(counts: DataFrame, month: str, keys: Sequence[str], value: str) -> DataFrame:
    """Every month from the first to the last for every value of each key; absent combinations are 0.

    The grid is made from distinct keys and a sequence of months; only the counts are shuffled for it.
    """
    span = counts.agg(F.min(month).alias("__a"), F.max(month).alias("__b"))
    grid = span.select(F.explode(F.sequence("__a", "__b", F.expr("interval 1 month"))).alias(month))
    for k in keys:
        grid = grid.crossJoin(counts.select(k).distinct())
    return grid.join(counts, [month, *keys], "left").select(month, *keys, F.coalesce(value, F.lit(0)).cast("long").alias(value))


def lag_features(panel: DataFrame, month: str, keys: Sequence[str], value: str, lags: Sequence[int] = (1, 2, 3, 4, 5, 6, 9, 10, 11, 12, 13, 14, 15), sums: Sequence[int] = (3, 6, 12), ahead: int = 3) -> DataFrame:
    """Lags, sums over full frames before the month, and the target: the sum of the next months, null unless all exist. One sort serves all."""
    by = Window.partitionBy(*keys).orderBy(month)
    v = F.col(value)
    out = {f"lag_{k}": F.lag(v, k).over(by) for k in lags}
    for n in sums:
        frame = by.rowsBetween(-n, -1)
        out[f"sum_{n}"] = F.when(F.count(v).over(frame) == n, F.sum(v).over(frame))
    target = F.lead(v, 1).over(by)
    for k in range(2, ahead + 1):
        target = target + F.lead(v, k).over(by)
    out[f"target_{ahead}m"] = target
    return panel.withColumns(out)


def derived_features(features: DataFrame, month: str) -> DataFrame:
    """Seasonal naive forecast, momentum, year over year, and the month's place on the year's circle."""
    angle = F.lit(2.0) * F.pi() * F.month(F.add_months(month, 1)) / 12
    return features.withColumns(
        {
            "seasonal_naive_3m": F.col("lag_9") + F.col("lag_10") + F.col("lag_11"),
            "momentum": F.col("lag_1") + F.col("lag_2") + F.col("lag_3") - F.col("lag_4") - F.col("lag_5") - F.col("lag_6"),
            "year_over_year": F.col("lag_1") - F.col("lag_13"),
            "month_sin": F.sin(angle),
            "month_cos": F.cos(angle),
        }
    )


def rank_percent(value: str, keys: Sequence[str]) -> Column:
    """Average rank among equals, as a percent of the group."""
    peers = Window.partitionBy(*keys, value)
    return 100.0 * (F.rank().over(Window.partitionBy(*keys).orderBy(value)) + (F.count("*").over(peers) - 1) / 2) / F.count("*").over(Window.partitionBy(*keys))


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of each group, with their place; rows beyond k are cut before the shuffle."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("place", F.row_number().over(by)).where(F.col("place") <= k)


def mode_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """The most frequent filled value of each key; the least of equals."""
    counted = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    best = counted.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col(value).alias("v"))).alias("best"))
    return best.select(key, F.col("best.v").alias(value), (-F.col("best.m")).alias("n"))


def largest_gap(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """The greatest number of days between neighbouring dates of each group; 0 for a single one."""
    days = df.select(*keys, date).where(F.col(date).isNotNull()).distinct()
    by = Window.partitionBy(*keys).orderBy(date)
    return days.withColumn("__gap", F.datediff(date, F.lag(date).over(by))).groupBy(*keys).agg(F.coalesce(F.max("__gap"), F.lit(0)).cast("long").alias("max_gap_days"))


def quantile_rows(df: DataFrame, total: str, code: str, quantiles: Sequence[float] = (0.1, 0.5, 0.9)) -> DataFrame:
    """The rows at the nearest index (halves to even) of each quantile by (total, code), and the last; a row that is picked twice keeps its first label.

    Rows are numbered over ranges of the order; a handful of numbers is then looked up.
    """
    placed = numbered(df.select(code, total), total, code, to="__at")
    size = placed.agg(F.count("*").alias("n"))
    wanted = [F.struct((F.bround((F.col("n") - 1) * F.lit(q)).cast("long") + 1).alias("__at"), F.lit(i).alias("o"), F.lit(f"q{round(100 * q):02d}").alias("label")) for i, q in enumerate(quantiles)]
    wanted.append(F.struct(F.col("n").alias("__at"), F.lit(len(quantiles)).alias("o"), F.lit("max").alias("label")))
    picks = size.where("n > 0").select(F.inline(F.array(*wanted))).groupBy("__at").agg(F.min_by("label", "o").alias("label"))
    return placed.join(F.broadcast(picks), "__at").select("label", code, total)


def quantile_by(df: DataFrame, keys: Sequence[str], value: str, q: float) -> DataFrame:
    """The linearly interpolated quantile of each group, without a group's values in one place."""
    return quantiles(df, keys, value, q)
