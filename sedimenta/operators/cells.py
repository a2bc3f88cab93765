"""Counts, shares and k-anonymous cells."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.session import durable


def cell_counts(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Rows of each combination of keys; nulls are a value of their own. Combined map-side, one shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("cell_count"))


def k_anonymous_cells(df: DataFrame, keys: Sequence[str | Column], k: int = 10) -> DataFrame:
    """The cells of at least k rows."""
    return cell_counts(df, keys).where(F.col("cell_count") >= k)


def suppression(df: DataFrame, keys: Sequence[str | Column], k: int = 10) -> DataFrame:
    """Cells and rows that k-anonymity releases and suppresses; they add up to the totals."""
    kept = F.col("cell_count") >= k
    n = F.col("cell_count")
    return cell_counts(df, keys).agg(
        F.count("*").alias("cells_total"),
        F.count_if(kept).alias("cells_released"),
        F.count_if(~kept).alias("cells_suppressed"),
        F.coalesce(F.sum(n), F.lit(0)).alias("rows_total"),
        F.coalesce(F.sum(F.when(kept, n)), F.lit(0)).alias("rows_released"),
        F.coalesce(F.sum(F.when(~kept, n)), F.lit(0)).alias("rows_suppressed"),
    )


def group_counts(df: DataFrame, keys: Sequence[str], counted: str | None = None) -> DataFrame:
    """Rows of each group; with `counted`, only rows where that column is filled."""
    return df.groupBy(*keys).agg(F.count(F.col(counted) if counted else F.lit(1)).alias("n"))


def year_histogram(df: DataFrame, date: str, last: int | None = None) -> DataFrame:
    """Rows of each year; null dates are left out; `last` keeps the latest years."""
    out = df.where(F.col(date).isNotNull()).groupBy(F.year(date).cast("long").alias("year")).agg(F.count("*").alias("n"))
    return out if last is None else out.orderBy(F.desc("year")).limit(last)


def share_of_total(df: DataFrame, key: str) -> DataFrame:
    """Rows and percent of all rows, over rows whose key is filled."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return counted.crossJoin(F.broadcast(counted.agg(F.sum("n").alias("__all")))).select(key, "n", F.round(100.0 * F.col("n") / F.col("__all"), 4).alias("share_percent"))


def row_shares(df: DataFrame, row: str, column: str) -> DataFrame:
    """Percent of each column value within its row value, in long form; pivot it with pivot_shares."""
    counted = df.groupBy(row, column).agg(F.count("*").alias("n"))
    return counted.withColumn("share_percent", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(row)), 4))


def pivot_shares(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """A column of percents for each value, absent combinations 0."""
    wide = df.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1))).na.fill(0)
    total = sum((F.col(f"`{v}`") for v in values[1:]), F.col(f"`{values[0]}`"))
    return wide.select(row, *[F.round(100.0 * F.col(f"`{v}`") / F.nullif(total, F.lit(0)), 4).alias(v) for v in values])


def region_screen(df: DataFrame, key: str, date: str, years: tuple[int, int], status: str, active: str, source: str, sources: Sequence[str], x: str, y: str) -> DataFrame:
    """One pass for a region's screening table: rows, share of recent dates, coordinate coverage, share of the active status (of rows with a status) and shares of sources."""
    n = F.count("*")
    recent = F.count_if(F.year(date).between(*years))
    return df.groupBy(key).agg(
        n.alias("n"),
        F.round(100.0 * recent / n, 4).alias("recent_percent"),
        F.round(100.0 * F.count_if(F.col(x).isNotNull() & F.col(y).isNotNull()) / n, 4).alias("coordinate_percent"),
        F.round(100.0 * F.count_if(F.col(status) == active) / F.nullif(F.count(status), F.lit(0)), 4).alias("active_percent"),
        *[F.round(100.0 * F.count_if(F.col(source) == s) / n, 4).alias(f"{s.lower()}_percent") for s in sources],
    )


def freshness(df: DataFrame, key: str, date: str) -> DataFrame:
    """The latest date of each key."""
    return df.groupBy(key).agg(F.max(date).alias("latest"))


def distinct_sets(df: DataFrame, source: str, value: str) -> DataFrame:
    """How many distinct values each source has, and whether it has all values of all sources."""
    pairs = df.select(source, value).where(F.col(value).isNotNull()).distinct()
    total = pairs.agg(F.count_distinct(value).alias("total"))
    return pairs.groupBy(source).agg(F.count("*").alias("n_values")).crossJoin(F.broadcast(total)).select(source, "n_values", (F.col("n_values") == F.col("total")).alias("has_all"))


def page_cost(df: DataFrame, key: str, page_size: int = 100) -> DataFrame:
    """Requests to read all groups in pages: the sum of ceil(rows / page_size)."""
    groups = df.groupBy(key).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count("*").alias("group_count"), F.coalesce(F.sum(F.ceil(F.col("n") / page_size)), F.lit(0)).cast("long").alias("pages"))


def page_bounds(rows: Column, groups: Column, page_size: int = 100) -> tuple[Column, Column]:
    """Least and greatest number of pages of so many rows in so many non-empty groups."""
    lower = F.greatest(groups, F.ceil(rows / page_size)).cast("long")
    return lower, lower + groups - 1


def rollup_cells(df: DataFrame, keys: Sequence[str], k: int = 10, n: str = "cell_count") -> DataFrame:
    """(keys..., level, cell_count, status): the counts of all levels of a hierarchy, none of which tells a hidden one.

    Level l groups by the first l keys (0: the whole table); the keys below are null. Cells of fewer than k rows are
    SUPPRESSED. A cell is the sum of those one level below, so wherever a single count of such a sum is hidden,
    the smallest released one below (of equals the first by key) is hidden too: COMPLEMENT. Levels are settled from the top down; then every
    sum has no hidden count or two and more, and since sums form a tree no hidden count follows from any of them.
    Hidden counts are null. Null keys are values of their own; an empty table has no cells. One Expand counts all levels; children of a cell are
    summed up, never gathered.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(f"`{c}`").cast("string").alias(x) for c, x in zip(keys, names, strict=True)])
    cells = rows.rollup(*names).agg(F.count("*").alias("_n"), (F.lit(len(keys)) - F.bit_count(F.grouping_id())).cast("int").alias("level"))
    cells = durable(cells.withColumn("_low", F.col("_n") < k))

    def looked_up(rows: DataFrame, table: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
        """rows joined with table on columns, nulls being values; the table's other columns are added."""
        named = table.select(*[F.col(c).alias(f"{c}_of") for c in columns], *[c for c in table.columns if c not in columns])
        on = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"{c}_of")) for c in columns], F.lit(True))
        return rows.join(named, on, how).drop(*[f"{c}_of" for c in columns])

    above = cells.where("level = 0").withColumn("_more", F.lit(False))
    done = above
    for level in range(1, len(keys) + 1):
        at, kept = names[: level - 1], names[:level]
        here = cells.where(F.col("level") == level)
        least = F.min(F.when(~F.col("_low"), F.struct("_n", F.col(names[level - 1]).isNotNull().alias("_filled"), F.col(names[level - 1]).alias("_key"))))
        sums = here.groupBy(*at).agg(F.count_if("_low").alias("_hidden"), least.alias("_least")) if at else here.agg(F.count_if("_low").alias("_hidden"), least.alias("_least"))
        known = above.select(*at, (F.col("_low") | F.col("_more")).cast("int").alias("_up"))
        sums = looked_up(sums, known, at, "inner").where((F.col("_hidden") + F.col("_up") == 1) & F.col("_least").isNotNull())
        picks = sums.select(*at, F.col("_least._key").alias(names[level - 1]), F.lit(True).alias("_picked"))
        above = looked_up(here, picks, kept, "left").select(*cells.columns, F.coalesce("_picked", F.lit(False)).alias("_more"))
        above = durable(above)
        done = done.unionByName(above)
    status = F.when(F.col("_low"), "SUPPRESSED").when(F.col("_more"), "COMPLEMENT").otherwise("RELEASED")
    return done.select(*[F.col(x).alias(c) for c, x in zip(keys, names, strict=True)], "level", F.when(status == "RELEASED", F.col("_n")).alias(n), status.alias("status"))
