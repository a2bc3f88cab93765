"""Set algebra, date-effective domains, task lists and linkage checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DomainError(ValueError):
    """A domain breaks its own rules."""


def effective_domain(current: DataFrame, new: DataFrame, deleted: DataFrame, code: str, reform: str) -> DataFrame:
    """(code, valid_from, valid_to): before the reform (current - new) + deleted, from it on current. Open ends are null."""
    day = F.to_date(F.lit(reform))
    none = F.lit(None).cast("date")
    part = lambda df, start, end: df.select(code).distinct().select(code, start.alias("valid_from"), end.alias("valid_to"))
    old = current.select(code).join(new.select(code), code, "left_anti")
    return part(old, none, none).unionByName(part(new, day, none)).unionByName(part(deleted, none, day))


def check_domain(current: DataFrame, new: DataFrame, deleted: DataFrame, code: str) -> None:
    """Raises DomainError unless new is part of current and deleted has nothing of it."""
    if new.join(current, code, "left_anti").limit(1).count():
        raise DomainError("a new code isn't current")
    if deleted.join(current, code, "left_semi").limit(1).count():
        raise DomainError("a deleted code is current")


def active_at(dates: DataFrame, date: str, domain: DataFrame) -> DataFrame:
    """Every date with the codes that are in force on it."""
    on = (domain.valid_from.isNull() | (domain.valid_from <= dates[date])) & (domain.valid_to.isNull() | (dates[date] < domain.valid_to))
    return dates.join(domain, on, "inner").drop("valid_from", "valid_to")


def domain_balance(official: DataFrame, observed: DataFrame, code: str) -> DataFrame:
    """(code, in_official, in_observed) of every code; the three cases are the two differences and the intersection."""
    a, b = (df.select(code).where(F.col(code).isNotNull()).distinct() for df in (official, observed))
    out = a.withColumn("in_official", F.lit(True)).join(b.withColumn("in_observed", F.lit(True)), code, "full_outer")
    return out.select(code, F.coalesce("in_official", F.lit(False)).alias("in_official"), F.coalesce("in_observed", F.lit(False)).alias("in_observed"))


def in_all_sources(df: DataFrame, source: str, key: str, exclude: DataFrame | None = None) -> DataFrame:
    """Keys of every source, with their rows, without those to exclude; two grouped passes, no list of keys."""
    counted = df.groupBy(source, key).agg(F.count("*").alias("n"))
    total = df.agg(F.count_distinct(source).alias("__sources"))
    out = counted.groupBy(key).agg(F.count("*").alias("__in"), F.sum("n").alias("total_rows")).crossJoin(F.broadcast(total)).where("__in = __sources").select(key, "total_rows")
    return out if exclude is None else out.join(exclude.select(key), key, "left_anti")


def exchange(before: DataFrame, after: DataFrame, code: str) -> DataFrame:
    """(codes_out, codes_in) between two domains."""
    both = domain_balance(before, after, code)
    return both.agg(F.count_if(~F.col("in_observed")).alias("codes_out"), F.count_if(~F.col("in_official")).alias("codes_in"))


def task_list(dates: DataFrame, date: str, sources: DataFrame, domain: DataFrame) -> DataFrame:
    """dates x sources x the codes in force: a list of requests, as long as it says."""
    return active_at(dates, date, domain).join(sources, F.lit(True), "inner")


def pending(planned: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Planned tasks that aren't done; raises DomainError if a task was done twice."""
    if done.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise DomainError("a task is done more than once")
    return planned.join(done.select(*keys), list(keys), "left_anti")


def coverage(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(expected, actual, missing, unexpected, repeated) tasks."""
    a = expected.select(*keys).distinct().withColumn("__e", F.lit(1))
    b = actual.groupBy(*keys).agg(F.count("*").alias("__n"))
    both = a.join(b, list(keys), "full_outer")
    return both.agg(
        F.count("__e").alias("expected"),
        F.count("__n").alias("actual"),
        F.count_if(F.col("__n").isNull()).alias("missing"),
        F.count_if(F.col("__e").isNull()).alias("unexpected"),
        F.count_if(F.col("__n") > 1).alias("repeated"),
    )


def sidecar_linkage(parent: DataFrame, sidecar: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """Counters that are zero when the sidecar is exactly one row for each parent row and row numbers are 1..n."""
    p = parent.select(*keys, F.lit(1).alias("__p"))
    s = sidecar.select(*keys, F.lit(1).alias("__s"))
    joined = p.join(s, list(keys), "full_outer").agg(
        F.count_if(F.col("__s").isNull()).alias("without_sidecar"), F.count_if(F.col("__p").isNull()).alias("without_parent"), F.count("*").alias("linked_rows")
    )
    own = parent.agg(F.count("*").alias("parent_rows"), (F.max(number) - F.count("*")).cast("long").alias("beyond_last"), (F.count("*") - F.count_distinct(number)).alias("repeated_numbers"))
    return joined.crossJoin(own)


def merge_summaries(key: str, *parts: DataFrame) -> DataFrame:
    """Joins of summaries by their key, each read once; the result raises while it is computed if a key is null, repeats, or isn't in all of them."""
    out: DataFrame | None = None
    for i, p in enumerate(parts):
        rest = [F.col(f"`{c}`") for c in p.columns if c != key]
        once = p.groupBy(key).agg(F.count("*").alias(f"__n{i}"), F.first(F.struct(*rest)).alias(f"__r{i}")) if rest else p.groupBy(key).agg(F.count("*").alias(f"__n{i}"))
        out = once if out is None else out.join(once, key, "full_outer")
    whole = F.col(key).isNotNull()
    for i in range(len(parts)):
        whole = whole & (F.coalesce(F.col(f"__n{i}"), F.lit(0)) == 1)
    checked = out.where(F.when(whole, True).otherwise(F.raise_error(F.lit("a key of the summaries is null, repeats, or isn't in all of them")).cast("boolean")))
    return checked.select(key, *[f"__r{i}.*" for i, p in enumerate(parts) if len(p.columns) > 1])
