"""Differences of two snapshots of one register, and what they say about its identifiers and statuses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.functions import scalars as S

#: Groups of fields; a group changes if any of its fields does.
GROUPS = {
    "status": ("status_code", "status_name"),
    "detail_status": ("detail_code", "detail_name"),
    "closure_date": ("closure_date",),
    "permit_date": ("permit_date",),
    "business_name": ("business_name",),
    "address": ("road_address", "lot_address"),
    "coordinates": ("x", "y"),
}
FIELDS = tuple(f for fields in GROUPS.values() for f in fields)
ALL_THREE = ("business_name", "address", "coordinates")


class DiffError(ValueError):
    """Snapshots can't be compared."""


def first_of_each(df: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """One row for each id: the first by the order columns. The number of rows beyond is df.count() less its own."""
    by = Window.partitionBy(key).orderBy(*(order or [key]))
    return df.withColumn("__place", F.row_number().over(by)).where("__place = 1").drop("__place")


def paired(start: DataFrame, end: DataFrame, key: str, fields: Sequence[str], partition: Sequence[str] = ()) -> DataFrame:
    """Full outer join by id, fields as a_ and b_, with in_a and in_b. Both sides are shuffled once, by key."""
    on = [*partition, key]
    a = start.select(*on, *[F.col(f).alias(f"a_{f}") for f in fields], F.lit(True).alias("in_a"))
    b = end.select(*on, *[F.col(f).alias(f"b_{f}") for f in fields], F.lit(True).alias("in_b"))
    return a.join(b, on, "full_outer").withColumns({x: F.coalesce(x, F.lit(False)) for x in ("in_a", "in_b")})


def groups_of(pairs: DataFrame, groups: Mapping[str, Sequence[str]] | None = None) -> Mapping[str, Sequence[str]]:
    """The given groups; else the standard ones, with the fields that were paired. Raises DiffError if a standard group has none."""
    if groups is not None:
        return groups
    found = {g: tuple(f for f in fields if f"a_{f}" in pairs.columns) for g, fields in GROUPS.items()}
    empty = [g for g, fields in found.items() if not fields]
    if empty:
        raise DiffError(f"no field of {empty} was paired")
    return found


def membership(pairs: DataFrame) -> DataFrame:
    """(common_ids, added_ids, disappeared_ids)"""
    a, b = F.col("in_a"), F.col("in_b")
    return pairs.agg(F.count_if(a & b).alias("common_ids"), F.count_if(~a & b).alias("added_ids"), F.count_if(a & ~b).alias("disappeared_ids"))


def changed(fields: Sequence[str]) -> Column:
    """Any of the fields differs; null differs from empty."""
    out = F.lit(False)
    for f in fields:
        out = out | ~F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}"))
    return out


def closure_direction(field: str = "closure_date") -> Column:
    a, b = (F.coalesce(S.trim(F.col(f"{s}_{field}")), F.lit("")) for s in "ab")
    return F.when((a == "") & (b != ""), "blank->value").when((a != "") & (b == ""), "value->blank").when(a != b, "value->different_value").otherwise("unchanged")


def _code(side: str, field: str = "status_code") -> Column:
    return F.coalesce(F.col(f"{side}_{field}"), F.lit(""))


def transition() -> Column:
    return F.concat(_code("a"), F.lit("->"), _code("b"))


def transitions(pairs: DataFrame) -> DataFrame:
    """Common ids of each status transition."""
    return pairs.where("in_a AND in_b").groupBy(transition().alias("transition")).agg(F.count("*").alias("n"))


def field_changes(pairs: DataFrame, groups: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(field_group, changed_rows) over common ids, one aggregate."""
    groups = groups_of(pairs, groups)
    one = pairs.where("in_a AND in_b").agg(*[F.count_if(changed(f)).alias(g) for g, f in groups.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(g).alias("field_group"), F.col(g).alias("changed_rows")) for g in groups])))


def closure_patterns(pairs: DataFrame, groups: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Transition and direction of the closure date, over common ids whose status changed."""
    groups = groups_of(pairs, groups)
    moved = pairs.where("in_a AND in_b").where(changed(groups["status"]))
    return moved.groupBy(F.concat(transition(), F.lit("|"), closure_direction()).alias("pattern")).agg(F.count("*").alias("n"))


def _counters(groups: Mapping[str, Sequence[str]], before: str, after: str) -> dict[str, Column]:
    both = F.col("in_a") & F.col("in_b")
    flag = {g: changed(f) for g, f in groups.items()}
    three = flag[ALL_THREE[0]] & flag[ALL_THREE[1]] & flag[ALL_THREE[2]]
    back = both & (_code("a") == before) & (_code("b") == after)
    out = {
        "status_and_closure_changed": both & flag["status"] & flag["closure_date"],
        "status_changed_without_closure": both & flag["status"] & ~flag["closure_date"],
        "closure_changed_without_status": both & ~flag["status"] & flag["closure_date"],
        "simultaneous_identity_changes": both & three,
        "reverse_total": back,
    }
    for d in ("value->blank", "blank->value", "value->different_value", "unchanged"):
        out["reverse_closure_" + d.replace("->", "_to_")] = back & (closure_direction() == d)
    out |= {f"reverse_{g}_changed": back & flag[g] for g in ("permit_date", "business_name", "address", "coordinates")}
    out["reverse_all_three_changed"] = back & three
    return out


def alignment(pairs: DataFrame, groups: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Whether status and closure date change together, and names, addresses and coordinates at once."""
    groups = groups_of(pairs, groups)
    names = ("status_and_closure_changed", "status_changed_without_closure", "closure_changed_without_status", "simultaneous_identity_changes")
    c = _counters(groups, "03", "01")
    return pairs.agg(*[F.count_if(c[n]).alias(n) for n in names])


def reverse_evidence(pairs: DataFrame, before: str = "03", after: str = "01", groups: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Ten counters of ids that went back from one status to another."""
    groups = groups_of(pairs, groups)
    return pairs.agg(*[F.count_if(c).alias(n) for n, c in _counters(groups, before, after).items() if n.startswith("reverse_")])


def repeated_ids(start: DataFrame, end: DataFrame, key: str, partition: Sequence[str] = ()) -> DataFrame:
    """(partition..., repeated_a, repeated_b, repeated_ids): rows beyond the first of an id, on either side and both. Partial counts before the one shuffle."""
    sides = start.select(*partition, key, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(end.select(*partition, key, F.lit(0).alias("a"), F.lit(1).alias("b")))
    ids = sides.groupBy(*partition, key).agg(*[(F.greatest(F.sum(s), F.lit(1)) - 1).alias(f"repeated_{s}") for s in "ab"])
    out = ids.groupBy(*partition).agg(*[F.coalesce(F.sum(f"repeated_{s}"), F.lit(0)).alias(f"repeated_{s}") for s in "ab"])
    return out.withColumn("repeated_ids", F.col("repeated_a") + F.col("repeated_b"))


def pair_audit(pairs: DataFrame, partition: Sequence[str] = (), repeated: DataFrame | None = None, groups: Mapping[str, Sequence[str]] | None = None, before: str = "03", after: str = "01") -> DataFrame:
    """A row for each partition (or one): membership, changes, alignment, reversals, vocabulary, and two verdicts.

    repeated: (partition..., repeated_ids), the rows beyond the first of an id in either snapshot, as repeated_ids()
    gives them.
    """
    groups = groups_of(pairs, groups)
    a, b = F.col("in_a"), F.col("in_b")
    aggs = [F.count_if(a).alias("start_ids"), F.count_if(b).alias("end_ids")]
    aggs += [F.count_if(a & b).alias("common_ids"), F.count_if(~a & b).alias("added_ids"), F.count_if(a & ~b).alias("disappeared_ids")]
    aggs += [F.count_if(a & b & changed(f)).alias(f"{g}_changes") for g, f in groups.items()]
    aggs += [F.count_if(c).alias(n) for n, c in _counters(groups, before, after).items()]
    aggs += [F.array_sort(F.collect_set(F.when(F.col(f"in_{s}"), _code(s)))).alias(f"codes_{s}") for s in "ab"]  # a status vocabulary: few values
    out = pairs.groupBy(*partition).agg(*aggs)
    if repeated is None:
        out = out.withColumn("repeated_ids", F.lit(0).cast("long"))
    else:
        out = (out.join(repeated, list(partition), "left") if partition else out.crossJoin(repeated)).withColumn("repeated_ids", F.coalesce("repeated_ids", F.lit(0)))
    return with_verdicts(out)


def with_verdicts(audit: DataFrame) -> DataFrame:
    """continuity of the ids and the lifecycle signal of the statuses, from the counters of a pair."""
    continuity = F.when(F.col("repeated_ids") > 0, "WEAK").when((F.col("disappeared_ids") > 0) | (F.col("permit_date_changes") > 0), "MIXED").otherwise("STRONG")
    signal = (
        F.when(F.col("status_changes") == 0, "INSUFFICIENT_EVENT_EVIDENCE")
        .when((F.col("status_changed_without_closure") > 0) | (F.col("closure_changed_without_status") > 0), "AMBIGUOUS")
        .when(F.col("reverse_total") > 0, "REVERSIBLE_OR_CORRECTION_SIGNAL")
        .otherwise("USABLE_FOR_FURTHER_AUDIT")
    )
    return audit.withColumns(
        {
            "continuity": continuity,
            "lifecycle_signal": signal,
            "codes_added": F.array_sort(F.array_except("codes_b", "codes_a")),
            "codes_removed": F.array_sort(F.array_except("codes_a", "codes_b")),
        }
    )


#: Counters of a pair audit that add up over pairs.
MEMBERS = ("start_ids", "end_ids", "common_ids", "added_ids", "disappeared_ids", "repeated_ids")


def totals_of(groups: Mapping[str, Sequence[str]] | None = None) -> list[str]:
    """All counters that a roll-up adds up, in order."""
    groups = GROUPS if groups is None else groups
    return [*MEMBERS, *[f"{g}_changes" for g in groups], *_counters(groups, "", "")]


def roll_up(audits: DataFrame, partition: Sequence[str], groups: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """One row over all pair audits: all totals, pairs of each verdict and flag, and the sample's verdicts.

    One pass: audits are gathered by pair (their number is that of the pairs, not of the rows). The result raises while it
    is computed if a pair comes twice or there is none. Transitions over all pairs are transitions() and closure_patterns().
    """
    row = F.struct(*[F.col(c) for c in audits.columns if c not in partition])
    by_pair = audits.groupBy(*partition).agg(F.count("*").alias("__times"), F.first(row).alias("__audit"))
    audits = by_pair.select(*partition, "__times", "__audit.*")
    flags = {
        "pairs_repeated": F.col("repeated_ids") > 0,
        "pairs_disappeared": F.col("disappeared_ids") > 0,
        "pairs_permit_date": F.col("permit_date_changes") > 0,
        "pairs_reversed": F.col("reverse_total") > 0,
        "pairs_mismatched": (F.col("status_changed_without_closure") > 0) | (F.col("closure_changed_without_status") > 0),
        "pairs_identity": F.col("simultaneous_identity_changes") > 0,
        "pairs_vocabulary": F.col("codes_a") != F.col("codes_b"),
        "pairs_strong": F.col("continuity") == "STRONG",
        "pairs_mixed": F.col("continuity") == "MIXED",
        "pairs_weak": F.col("continuity") == "WEAK",
        "pairs_ambiguous": F.col("lifecycle_signal") == "AMBIGUOUS",
        "pairs_reversible": F.col("lifecycle_signal") == "REVERSIBLE_OR_CORRECTION_SIGNAL",
        "pairs_usable": F.col("lifecycle_signal") == "USABLE_FOR_FURTHER_AUDIT",
        "pairs_without_events": F.col("lifecycle_signal") == "INSUFFICIENT_EVENT_EVIDENCE",
    }
    out = audits.agg(F.count("*").alias("pairs"), F.max("__times").alias("__times"), *[F.sum(s).alias(s) for s in totals_of(groups)], *[F.count_if(c).alias(n) for n, c in flags.items()])
    twice = F.raise_error(F.lit("there must be one audit for each pair")).cast("long")
    out = out.withColumn("pairs", F.when(F.coalesce("__times", F.lit(0)) == 1, F.col("pairs")).otherwise(twice)).drop("__times")
    return out.withColumns(
        {
            "sample_continuity": F.when(F.col("pairs_strong") == F.col("pairs"), "CONSISTENT_ACROSS_SAMPLE").otherwise("MIXED_SAMPLE"),
            "sample_signal": F.when(F.col("pairs_ambiguous") > 0, "MIXED_SAMPLE")
            .when(F.col("pairs_reversible") > 0, "REVERSIBLE_OR_CORRECTION_SIGNAL_PRESENT")
            .when(F.col("pairs_usable") > 0, "CONSISTENT_EVENT_SIGNAL")
            .otherwise("INSUFFICIENT_EVENT_EVIDENCE"),
        }
    )


def count_freeze(counts: DataFrame, keys: Sequence[str], moment: str, n: str, moments: Sequence[str]) -> DataFrame:
    """Counts of four moments (start, before, after, end): complete, positive, grown and frozen pairs, and pairs of zeros. Raises while it is computed if a task repeats."""
    once = counts.groupBy(*keys, moment).agg(F.count("*").alias("__times"), F.max(n).alias(n))
    counts = once.withColumn(n, F.when(F.col("__times") == 1, F.col(n)).otherwise(F.raise_error(F.lit("a count is given twice")).cast("long")))
    wide = counts.groupBy(*keys).pivot(moment, list(moments)).agg(F.max(n))
    t = [F.col(f"`{m}`") for m in moments]
    complete = t[0].isNotNull() & t[1].isNotNull() & t[2].isNotNull() & t[3].isNotNull()
    zero = (F.greatest(*t) == 0) & (F.least(*t) == 0)
    return wide.agg(
        F.count("*").alias("pairs"),
        F.count_if(complete).alias("complete_pairs"),
        F.count_if(complete & (t[1] > 0)).alias("positive_pairs"),
        F.count_if(complete & (t[1] > t[0])).alias("grown_pairs"),
        F.count_if(complete & (t[1] == t[2]) & (t[2] == t[3])).alias("frozen_pairs"),
        F.count_if(zero).alias("zero_pairs"),
        F.count_if(complete & (t[1] > 0) & (t[1] == t[0])).alias("positive_without_growth"),
    )
