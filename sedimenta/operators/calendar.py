"""Observation dates, their costs, and task lists from plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class PlanError(ValueError):
    """A plan contradicts itself."""


def spans(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """(keys..., first_date, last_date): the dates that each group covers; groups without dates are left out."""
    return df.groupBy(*keys).agg(F.min(date).alias("first_date"), F.max(date).alias("last_date")).where("first_date IS NOT NULL")


def _monthly(a: Column, b: Column) -> Column:
    """The first day's day in every month before the last day (clamped to the month's length), and the last day; null if the last comes first."""
    months = F.sequence(F.lit(0), F.greatest(F.ceil(F.months_between(b, a)).cast("int"), F.lit(0)))
    each = F.filter(F.transform(months, lambda i: F.add_months(a, i)), lambda d: d < b)
    return F.when(a <= b, F.array_distinct(F.concat(F.array(a), each, F.array(b))))


def _stepped(a: Column, b: Column, days: int) -> Column:
    """Every `days` days from the first day on, and the last day; null if the last comes first."""
    if days < 1:
        raise PlanError("steps must be of one day at least")
    return F.when(a <= b, F.array_distinct(F.concat(F.transform(F.sequence(F.lit(0), F.datediff(b, a), F.lit(days)), lambda i: F.date_add(a, i)), F.array(b))))


def _span(spark: SparkSession, start: str, end: str) -> DataFrame:
    return spark.range(1).select(F.to_date(F.lit(start)).alias("first_date"), F.to_date(F.lit(end)).alias("last_date"))


def _exploded(of: DataFrame, keys: Sequence[str], dates: Column) -> DataFrame:
    return of.select(*keys, F.explode(dates).alias("observed_date"))


def monthly_of(of: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., observed_date): monthly dates of each span (see spans), its last day included. No shuffle."""
    return _exploded(of, keys, _monthly(F.col("first_date"), F.col("last_date")))


def stepped_of(of: DataFrame, days: int, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., observed_date): a date every `days` days of each span, its last day included. No shuffle."""
    return _exploded(of, keys, _stepped(F.col("first_date"), F.col("last_date"), days))


def monthly_dates(spark: SparkSession, start: str, end: str) -> DataFrame:
    """(observed_date): the monthly dates of one span."""
    return monthly_of(_span(spark, start, end))


def stepped_dates(spark: SparkSession, start: str, end: str, days: int) -> DataFrame:
    """(observed_date): the dates of one span, every `days` days."""
    return stepped_of(_span(spark, start, end), days)


def scenarios_of(of: DataFrame, reform: str, bounds: Mapping[str, tuple[int, int]], keys: Sequence[str] = (), approved: str = "MONTHLY") -> DataFrame:
    """Cost of four cadences over each span: dates before and after the reform, the greatest gap in days (0 for one date), and bounds of the requests.

    bounds: 'before' and 'after' -> requests of one date, least and most. Dates stay arrays of their span: no shuffle.
    """
    a, b, cut = F.col("first_date"), F.col("last_date"), F.to_date(F.lit(reform))
    dates = {"ENDPOINTS": F.when(a <= b, F.array_distinct(F.array(a, b))), "MONTHLY": _monthly(a, b), "WEEKLY": _stepped(a, b, 7), "DAILY": _stepped(a, b, 1)}
    each = of.select(*keys, F.inline(F.array(*[F.struct(F.lit(n).alias("scenario"), d.alias("dates_of")) for n, d in dates.items()]))).where("dates_of IS NOT NULL")
    held = F.col("dates_of")
    before = F.size(F.filter(held, lambda d: d < cut)).cast("long")
    gaps = F.transform(F.sequence(F.lit(2), F.size(held)), lambda i: F.datediff(F.element_at(held, i), F.element_at(held, i - 1)))
    counted = each.select(*keys, "scenario", F.size(held).cast("long").alias("dates"), before.alias("dates_before"), F.when(F.size(held) > 1, F.array_max(gaps)).otherwise(0).cast("long").alias("max_gap_days"))
    counted = counted.withColumn("dates_after", F.col("dates") - F.col("dates_before"))
    cost = [F.col("dates_before") * bounds["before"][i] + F.col("dates_after") * bounds["after"][i] for i in (0, 1)]
    return counted.select(*keys, "scenario", "dates", "dates_before", "dates_after", "max_gap_days", cost[0].alias("requests_least"), cost[1].alias("requests_most"), (F.col("scenario") == approved).alias("approved"))


def scenarios(spark: SparkSession, start: str, end: str, reform: str, bounds: Mapping[str, tuple[int, int]], approved: str = "MONTHLY") -> DataFrame:
    """The cadences' cost over one span."""
    return scenarios_of(_span(spark, start, end), reform, bounds, approved=approved)


def expand_plan(plan: DataFrame, key: str, rows: str, dates: str, page_size: int = 100, expected_pages: int | None = None) -> DataFrame:
    """A task for each row of the plan and each of its dates, with its pages; raises PlanError if their sum isn't what the plan says."""
    tasks = plan.select("*", F.explode(dates).alias("observed_date"), F.ceil(F.col(rows) / page_size).cast("long").alias("pages")).drop(dates)
    if expected_pages is not None and (tasks.agg(F.sum("pages")).first()[0] or 0) != expected_pages:
        raise PlanError("the plan's pages don't add up")
    return tasks
