"""Status episodes: maximal runs of one state per permit, with censoring of their boundaries (gaps and islands)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.functions import scalars as S
from sedimenta.operators.contract import Invariant, violations

STATE = ("source_status_code", "source_status_name", "source_detail_status_code", "source_detail_status_name")
KEY = ("source_key", "management_number")
QUALITIES = ("VALID", "MISSING", "INVALID")


class EpisodeError(ValueError):
    """Observations break a rule that episodes rely on."""


def normalise_observations(df: DataFrame) -> DataFrame:
    """States trimmed, blanks null; keys trimmed."""
    return df.select(
        *[S.text_or_null(F.col(c)).alias(c) for c in KEY], "observed_date", *[S.text_or_null(F.col(c)).alias(c) for c in STATE], "source_closure_date", "source_closure_date_quality"
    )


def observation_counters(df: DataFrame, start: str, end: str) -> DataFrame:
    """Observations outside the window, with an inconsistent closure date, with a blank key; repeated (permit, date) pairs. One aggregate after one shuffle by permit."""
    per_day = df.groupBy(*KEY, "observed_date").agg(
        F.count("*").alias("n"),
        F.count_if(~F.coalesce(F.col("source_closure_date_quality").isin(*QUALITIES), F.lit(False)) | ((F.col("source_closure_date_quality") == "VALID") != F.col("source_closure_date").isNotNull())).alias("bad"),
    )
    outside = ~F.coalesce(F.col("observed_date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))), F.lit(False))
    return per_day.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("observation_count"),
        F.count_if(F.col("n") > 1).alias("repeated_days"),
        F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias("outside_window"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("inconsistent_closure"),
        F.coalesce(F.sum(F.when(F.col(KEY[0]).isNull() | F.col(KEY[1]).isNull(), F.col("n"))), F.lit(0)).alias("blank_keys"),
    )


def require_observations(df: DataFrame, start: str, end: str, most: int | None = None) -> DataFrame:
    """df itself; raises EpisodeError if a counter isn't zero or there are more than `most` observations."""
    c = observation_counters(df, start, end).first().asDict()
    bad = [k for k in ("repeated_days", "outside_window", "inconsistent_closure", "blank_keys") if c[k]]
    if most is not None and c["observation_count"] > most:
        bad.append("observation_count")
    if bad:
        raise EpisodeError("observations rejected: " + ", ".join(bad))
    return df


def episodes(df: DataFrame, start: str, end: str, key: Sequence[str] = KEY, state: Sequence[str] = STATE) -> DataFrame:
    """The 23 columns of an episode. One shuffle by permit serves the windows and the grouping."""
    day = F.col("observed_date")
    return episodes_of_runs(df.select(*key, *state, "source_closure_date", "source_closure_date_quality", day.alias("first_date"), day.alias("last_date"), F.lit(1).cast("long").alias("n")), start, end, key, state)


def episodes_of_runs(runs: DataFrame, start: str, end: str, key: Sequence[str] = KEY, state: Sequence[str] = STATE) -> DataFrame:
    """The same from runs of equal observations (first_date, last_date, n days, state and closure date), such as single days."""
    by = Window.partitionBy(*key).orderBy("first_date")
    whole = F.struct(*state)
    change = F.when(F.row_number().over(by) == 1, 1).when(F.lag(whole).over(by).eqNullSafe(whole), 0).otherwise(1)
    numbered = runs.withColumn("__change", change).withColumn("episode_number", F.sum("__change").over(by.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
    closure = F.struct("source_closure_date", "source_closure_date_quality")
    runs = numbered.groupBy(*key, "episode_number").agg(
        F.min("first_date").alias("first_observed_date"),
        F.max("last_date").alias("last_observed_date"),
        F.sum("n").alias("observation_count"),
        F.min_by(F.struct(*state), "first_date").alias("__state"),
        F.min_by(closure, "first_date").alias("__first"),
        F.max_by(closure, "last_date").alias("__last"),
    )
    order = Window.partitionBy(*key).orderBy("episode_number")
    lower, upper = F.lag("last_observed_date").over(order), F.lead("first_observed_date").over(order)
    bounded = runs.withColumn("start_boundary_lower_date", lower).withColumn("end_boundary_upper_date", upper)
    return bounded.select(
        *key,
        "episode_number",
        F.to_date(F.lit(start)).alias("observation_window_start_date"),
        F.to_date(F.lit(end)).alias("observation_window_end_date"),
        "first_observed_date",
        "last_observed_date",
        "observation_count",
        *[F.col(f"__state.{c}").alias(c) for c in state],
        "start_boundary_lower_date",
        F.col("first_observed_date").alias("start_boundary_upper_date"),
        F.when(F.col("start_boundary_lower_date").isNull(), "LEFT_CENSORED").otherwise("INTERVAL_CENSORED").alias("start_censoring"),
        F.col("last_observed_date").alias("end_boundary_lower_date"),
        "end_boundary_upper_date",
        F.when(F.col("end_boundary_upper_date").isNull(), "RIGHT_CENSORED").otherwise("INTERVAL_CENSORED").alias("end_censoring"),
        F.col("end_boundary_upper_date").isNull().alias("right_censored"),
        F.col("__first.source_closure_date").alias("source_closure_date_first_observed"),
        F.col("__first.source_closure_date_quality").alias("source_closure_date_first_quality"),
        F.col("__last.source_closure_date").alias("source_closure_date_last_observed"),
        F.col("__last.source_closure_date_quality").alias("source_closure_date_last_quality"),
    )


#: What holds for every episode; an unknown (null) result is a violation.
EPISODE_INVARIANTS = (
    Invariant("episode_number", "episode_number >= 1"),
    Invariant("observation_count", "observation_count >= 1"),
    Invariant("window_start", "observation_window_start_date <= first_observed_date"),
    Invariant("first_last", "first_observed_date <= last_observed_date"),
    Invariant("window_end", "last_observed_date <= observation_window_end_date"),
    Invariant("start_upper", "start_boundary_upper_date = first_observed_date"),
    Invariant("end_lower", "end_boundary_lower_date = last_observed_date"),
    Invariant("start_label", "start_censoring IN ('LEFT_CENSORED', 'INTERVAL_CENSORED')"),
    Invariant("left_open", "start_censoring <> 'LEFT_CENSORED' OR start_boundary_lower_date IS NULL"),
    Invariant("start_order", "start_censoring <> 'INTERVAL_CENSORED' OR start_boundary_lower_date < start_boundary_upper_date"),
    Invariant("end_label", "end_censoring IN ('RIGHT_CENSORED', 'INTERVAL_CENSORED')"),
    Invariant("right_open", "end_censoring <> 'RIGHT_CENSORED' OR (end_boundary_upper_date IS NULL AND right_censored)"),
    Invariant("end_order", "end_censoring <> 'INTERVAL_CENSORED' OR (end_boundary_lower_date < end_boundary_upper_date AND NOT right_censored)"),
)


def verify_episodes(df: DataFrame) -> DataFrame:
    """(invariant, violations) of all episode rules in one scan."""
    return violations(df, EPISODE_INVARIANTS)


def first_reversal(df: DataFrame, before: str, after: str, status: str = "source_status_code", key: Sequence[str] = KEY) -> DataFrame:
    """For each permit that went from one status straight to another: the boundary dates of the first time, and whether the other fields of the state stayed those of the first observation."""
    by = Window.partitionBy(*key).orderBy("observed_date")
    seen = df.withColumn("__next", F.lead(status).over(by)).withColumn("__next_date", F.lead("observed_date").over(by))
    seen = seen.withColumn("__same", F.col("source_detail_status_code").eqNullSafe(F.first("source_detail_status_code").over(by)))
    turn = (F.col(status) == before) & (F.col("__next") == after)
    out = seen.groupBy(*key).agg(
        F.min(F.when(turn, F.col("observed_date"))).alias("last_before_date"),
        F.min(F.when(turn, F.col("__next_date"))).alias("first_after_date"),
        F.bool_and("__same").alias("identity_stable"),
    )
    return out.where("last_before_date IS NOT NULL")


def sole_candidate(start: DataFrame, end: DataFrame, key: str, status: str, before: str, after: str) -> DataFrame:
    """The one id that has the first status at the start and the second at the end; raises EpisodeError if there are none or several."""
    found = start.where(F.col(status) == before).select(key).join(end.where(F.col(status) == after).select(key), key).limit(2)
    if found.count() != 1:
        raise EpisodeError("exactly one id must change its status like this")
    return found
