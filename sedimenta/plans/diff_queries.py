"""Queries of snapshot differences, calendars and coordinates."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.operators import calendar as K
from sedimenta.operators import diff as D
from sedimenta.operators import geo as G
from sedimenta.operators import joins as J
from sedimenta.operators.contract import ColumnRule, Contract, Invariant, violations
from sedimenta.operators.permits import SIDECAR
from sedimenta.operators.windows import largest_gap
from sedimenta.plans.bindings import bind
from sedimenta.plans.registry import query
from sedimenta.session import shared_dir

_FIELDS = D.FIELDS
_PAIRS = "pairs AS (SELECT coalesce(a.authority_code, b.authority_code) AS authority_code, coalesce(a.id, b.id) AS id, a.id IS NOT NULL AS in_a, b.id IS NOT NULL AS in_b, " + ", ".join(f"a.{f} AS a_{f}, b.{f} AS b_{f}" for f in _FIELDS) + " FROM snap_a a FULL JOIN snap_b b ON a.id = b.id AND a.authority_code = b.authority_code)"
_BOTH = "in_a AND in_b"
_A, _B = "coalesce(a_status_code, '')", "coalesce(b_status_code, '')"
_CA, _CB = "trim(coalesce(a_closure_date, ''))", "trim(coalesce(b_closure_date, ''))"
_DIRECTION = f"CASE WHEN {_CA} = '' AND {_CB} <> '' THEN 'blank->value' WHEN {_CA} <> '' AND {_CB} = '' THEN 'value->blank' WHEN {_CA} <> {_CB} THEN 'value->different_value' ELSE 'unchanged' END"
_CHANGED = {"status": ["status_code", "status_name"], "detail_status": ["detail_code", "detail_name"], "closure_date": ["closure_date"], "permit_date": ["permit_date"], "business_name": ["business_name"], "address": ["road_address", "lot_address"], "coordinates": ["x", "y"]}


def _diff(group: str) -> str:
    return "(" + " OR ".join(f"a_{f} IS DISTINCT FROM b_{f}" for f in _CHANGED[group]) + ")"


_THREE = f"({_diff('business_name')} AND {_diff('address')} AND {_diff('coordinates')})"
_BACK = f"({_BOTH} AND {_A} = '03' AND {_B} = '01')"
_COUNTERS = {
    "status_and_closure_changed": f"{_BOTH} AND {_diff('status')} AND {_diff('closure_date')}",
    "status_changed_without_closure": f"{_BOTH} AND {_diff('status')} AND NOT {_diff('closure_date')}",
    "closure_changed_without_status": f"{_BOTH} AND NOT {_diff('status')} AND {_diff('closure_date')}",
    "simultaneous_identity_changes": f"{_BOTH} AND {_THREE}",
}
_REVERSE = {"reverse_total": _BACK}
_REVERSE |= {"reverse_closure_" + d.replace("->", "_to_"): f"{_BACK} AND {_DIRECTION} = '{d}'" for d in ("value->blank", "blank->value", "value->different_value", "unchanged")}
_REVERSE |= {f"reverse_{g}_changed": f"{_BACK} AND {_diff(g)}" for g in ("permit_date", "business_name", "address", "coordinates")} | {"reverse_all_three_changed": f"{_BACK} AND {_THREE}"}
_COUNT = lambda rules: ", ".join(f"count(*) FILTER (WHERE {r}) AS {n}" for n, r in rules.items())
_MEMBERS = {"common_ids": _BOTH, "added_ids": "NOT in_a AND in_b", "disappeared_ids": "in_a AND NOT in_b"}


def _pairs(spark, sf):
    return D.paired(bind(spark, sf, "snap_a"), bind(spark, sf, "snap_b"), "id", _FIELDS, ["authority_code"])


@query("j_diff", f"WITH {_PAIRS} SELECT {_COUNT(_MEMBERS)} FROM pairs")
def j_diff(spark, sf):
    """O-70"""
    return D.membership(_pairs(spark, sf))


@query("j_first_of_each", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS p FROM orders) WHERE p = 1")
def j_first_of_each(spark, sf):
    """O-70: of repeated ids the first counts"""
    return D.first_of_each(bind(spark, sf, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("d_transitions", f"WITH {_PAIRS} SELECT {_A} || '->' || {_B} AS transition, count(*) AS n FROM pairs WHERE {_BOTH} GROUP BY 1")
def d_transitions(spark, sf):
    """O-96"""
    return D.transitions(_pairs(spark, sf))


@query("d_field_changes", f"WITH {_PAIRS} " + " UNION ALL ".join(f"SELECT '{g}' AS field_group, count(*) FILTER (WHERE {_BOTH} AND {_diff(g)}) AS changed_rows FROM pairs" for g in _CHANGED))
def d_field_changes(spark, sf):
    """O-97"""
    return D.field_changes(_pairs(spark, sf))


@query("d_closure_dir", f"WITH {_PAIRS} SELECT {_A} || '->' || {_B} || '|' || {_DIRECTION} AS pattern, count(*) AS n FROM pairs WHERE {_BOTH} AND {_diff('status')} GROUP BY 1")
def d_closure_dir(spark, sf):
    """O-98"""
    return D.closure_patterns(_pairs(spark, sf))


@query("d_alignment", f"WITH {_PAIRS} SELECT {_COUNT(_COUNTERS)} FROM pairs")
def d_alignment(spark, sf):
    """O-99"""
    return D.alignment(_pairs(spark, sf))


@query("d_reverse_ev", f"WITH {_PAIRS} SELECT {_COUNT(_REVERSE)} FROM pairs")
def d_reverse_ev(spark, sf):
    """O-100"""
    return D.reverse_evidence(_pairs(spark, sf))


_AUDIT = f"""{_PAIRS}, audit AS (SELECT authority_code, {_COUNT({'start_ids': 'in_a', 'end_ids': 'in_b'} | _MEMBERS)}, {_COUNT({f'{g}_changes': f'{_BOTH} AND {_diff(g)}' for g in _CHANGED})}, {_COUNT(_COUNTERS | _REVERSE)},
  list_sort(list(DISTINCT {_A}) FILTER (WHERE in_a)) AS codes_a, list_sort(list(DISTINCT {_B}) FILTER (WHERE in_b)) AS codes_b, CAST(0 AS BIGINT) AS repeated_ids FROM pairs GROUP BY 1),
verdict AS (SELECT *, CASE WHEN repeated_ids > 0 THEN 'WEAK' WHEN disappeared_ids > 0 OR permit_date_changes > 0 THEN 'MIXED' ELSE 'STRONG' END AS continuity,
  CASE WHEN status_changes = 0 THEN 'INSUFFICIENT_EVENT_EVIDENCE' WHEN status_changed_without_closure > 0 OR closure_changed_without_status > 0 THEN 'AMBIGUOUS' WHEN reverse_total > 0 THEN 'REVERSIBLE_OR_CORRECTION_SIGNAL' ELSE 'USABLE_FOR_FURTHER_AUDIT' END AS lifecycle_signal,
  list_sort(list_filter(coalesce(codes_b, []), lambda x: NOT list_contains(coalesce(codes_a, []), x))) AS codes_added, list_sort(list_filter(coalesce(codes_a, []), lambda x: NOT list_contains(coalesce(codes_b, []), x))) AS codes_removed FROM audit)
"""


def _audit(spark, sf):
    return D.pair_audit(_pairs(spark, sf), ["authority_code"])


@query("d_classify", f"WITH {_AUDIT} SELECT authority_code, common_ids, status_changes, permit_date_changes, reverse_total, continuity, lifecycle_signal FROM verdict")
def d_classify(spark, sf):
    """O-101"""
    return _audit(spark, sf).select("authority_code", "common_ids", "status_changes", "permit_date_changes", "reverse_total", "continuity", "lifecycle_signal")


_SUMS = ["start_ids", "end_ids", *_MEMBERS, "repeated_ids", *[f"{g}_changes" for g in _CHANGED], *_COUNTERS, *_REVERSE]
_FLAGS = {
    "pairs_repeated": "repeated_ids > 0", "pairs_disappeared": "disappeared_ids > 0", "pairs_permit_date": "permit_date_changes > 0", "pairs_reversed": "reverse_total > 0",
    "pairs_mismatched": "status_changed_without_closure > 0 OR closure_changed_without_status > 0", "pairs_identity": "simultaneous_identity_changes > 0",
    "pairs_vocabulary": "codes_a <> codes_b", "pairs_strong": "continuity = 'STRONG'", "pairs_mixed": "continuity = 'MIXED'", "pairs_weak": "continuity = 'WEAK'", "pairs_without_events": "lifecycle_signal = 'INSUFFICIENT_EVENT_EVIDENCE'", "pairs_ambiguous": "lifecycle_signal = 'AMBIGUOUS'",
    "pairs_reversible": "lifecycle_signal = 'REVERSIBLE_OR_CORRECTION_SIGNAL'", "pairs_usable": "lifecycle_signal = 'USABLE_FOR_FURTHER_AUDIT'",
}


@query("d_rollup", f"""WITH {_AUDIT}, r AS (SELECT count(*) AS pairs, {', '.join(f'CAST(sum({s}) AS BIGINT) AS {s}' for s in _SUMS)}, {_COUNT(_FLAGS)} FROM verdict)
SELECT *, CASE WHEN pairs_strong = pairs THEN 'CONSISTENT_ACROSS_SAMPLE' ELSE 'MIXED_SAMPLE' END AS sample_continuity,
  CASE WHEN pairs_ambiguous > 0 THEN 'MIXED_SAMPLE' WHEN pairs_reversible > 0 THEN 'REVERSIBLE_OR_CORRECTION_SIGNAL_PRESENT' WHEN pairs_usable > 0 THEN 'CONSISTENT_EVENT_SIGNAL' ELSE 'INSUFFICIENT_EVENT_EVIDENCE' END AS sample_signal FROM r""")
def d_rollup(spark, sf):
    """O-102"""
    return D.roll_up(_audit(spark, sf), ["authority_code"])


@query("d_repeated", "SELECT o_orderpriority, CAST(sum(a) AS BIGINT) AS repeated_a, CAST(sum(b) AS BIGINT) AS repeated_b, CAST(sum(a) + sum(b) AS BIGINT) AS repeated_ids FROM (SELECT o_orderpriority, o_custkey, greatest(count(*) FILTER (WHERE o_orderstatus = 'F'), 1) - 1 AS a, greatest(count(*) FILTER (WHERE o_orderstatus = 'O'), 1) - 1 AS b FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2) GROUP BY 1")
def d_repeated(spark, sf):
    """O-99, O-102: rows beyond the first of an id in either snapshot"""
    o = bind(spark, sf, "orders")
    return D.repeated_ids(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'O'"), "o_custkey", ["o_orderpriority"])


@query("d_vocab", f"WITH {_AUDIT} SELECT authority_code, array_to_string(codes_added, ',') AS codes_added, array_to_string(codes_removed, ',') AS codes_removed FROM verdict")
def d_vocab(spark, sf):
    """O-103"""
    return _audit(spark, sf).select("authority_code", F.array_join("codes_added", ",").alias("codes_added"), F.array_join("codes_removed", ",").alias("codes_removed"))


_MOMENTS = ("1996-1", "1996-2", "1997-1", "1997-2")
_QUARTERS = "SELECT authority_code, source_key, CAST(year(permit_date) AS VARCHAR) || '-' || CASE WHEN month(permit_date) <= 6 THEN '1' ELSE '2' END AS moment, count(*) AS n FROM permit_v GROUP BY ALL"


@query("d_freeze", f"""
WITH q AS ({_QUARTERS}), w AS (SELECT authority_code, source_key, {', '.join(f"max(n) FILTER (WHERE moment = '{m}') AS t{i}" for i, m in enumerate(_MOMENTS))} FROM q GROUP BY 1, 2), c AS (SELECT *, t0 IS NOT NULL AND t1 IS NOT NULL AND t2 IS NOT NULL AND t3 IS NOT NULL AS ok FROM w)
SELECT count(*) AS pairs, count(*) FILTER (WHERE ok) AS complete_pairs, count(*) FILTER (WHERE ok AND t1 > 0) AS positive_pairs, count(*) FILTER (WHERE ok AND t1 > t0) AS grown_pairs, count(*) FILTER (WHERE ok AND t1 = t2 AND t2 = t3) AS frozen_pairs,
  count(*) FILTER (WHERE greatest(t0, t1, t2, t3) = 0 AND least(t0, t1, t2, t3) = 0) AS zero_pairs, count(*) FILTER (WHERE ok AND t1 > 0 AND t1 = t0) AS positive_without_growth FROM c""")
def d_freeze(spark, sf):
    """O-104"""
    moment = F.concat(F.year("permit_date").cast("string"), F.lit("-"), F.when(F.month("permit_date") <= 6, "1").otherwise("2"))
    counts = bind(spark, sf, "permit_v").groupBy("authority_code", "source_key", moment.alias("moment")).agg(F.count("*").alias("n"))
    return D.count_freeze(counts, ["authority_code", "source_key"], "moment", "n", _MOMENTS)


_SPAN = ("2026-01-01", "2026-09-06")


_SPANS = "s AS (SELECT source_key, min(permit_date) AS a, max(permit_date) AS b FROM permit_v GROUP BY 1)"
_MONTHLY = "SELECT source_key, a AS d FROM s UNION SELECT source_key, d FROM (SELECT source_key, b, CAST(a + to_months(CAST(i AS INTEGER)) AS DATE) AS d FROM s, range(0, 1200) t(i)) WHERE d < b UNION SELECT source_key, b FROM s"
_STEPPED = "SELECT source_key, CAST(unnest(generate_series(a, b, INTERVAL {0} DAY)) AS DATE) AS d FROM s UNION SELECT source_key, b FROM s"


def _spans(spark, sf):
    return K.spans(bind(spark, sf, "permit_v"), ["source_key"], "permit_date")


@query("c_monthly", f"WITH {_SPANS} SELECT source_key, d AS observed_date FROM ({_MONTHLY})")
def c_monthly(spark, sf):
    """O-110 over the dates that each source covers"""
    return K.monthly_of(_spans(spark, sf), ["source_key"])


@query("c_fixed_step", f"WITH {_SPANS} SELECT source_key, d AS observed_date FROM ({_STEPPED.format(7)})")
def c_fixed_step(spark, sf):
    """O-111 over the dates that each source covers"""
    return K.stepped_of(_spans(spark, sf), 7, ["source_key"])


@query("c_scenarios", f"""
WITH {_SPANS}, d AS (SELECT 'ENDPOINTS' AS scenario, source_key, a AS d FROM s UNION SELECT 'ENDPOINTS', source_key, b FROM s UNION SELECT 'MONTHLY', * FROM ({_MONTHLY}) UNION SELECT 'WEEKLY', * FROM ({_STEPPED.format(7)}) UNION SELECT 'DAILY', * FROM ({_STEPPED.format(1)})),
g AS (SELECT *, d - lag(d) OVER (PARTITION BY source_key, scenario ORDER BY d) AS gap FROM d)
SELECT source_key, scenario, count(*) AS dates, count(*) FILTER (WHERE d < DATE '1995-07-01') AS dates_before, count(*) FILTER (WHERE d >= DATE '1995-07-01') AS dates_after, CAST(coalesce(max(gap), 0) AS BIGINT) AS max_gap_days,
  count(*) FILTER (WHERE d < DATE '1995-07-01') * 30100 + count(*) FILTER (WHERE d >= DATE '1995-07-01') * 30132 AS requests_least, count(*) FILTER (WHERE d < DATE '1995-07-01') * 30800 + count(*) FILTER (WHERE d >= DATE '1995-07-01') * 30832 AS requests_most, scenario = 'MONTHLY' AS approved
FROM g GROUP BY 1, 2""")
def c_scenarios(spark, sf):
    """O-113 over the dates that each source covers"""
    return K.scenarios_of(_spans(spark, sf), "1995-07-01", {"before": (30100, 30800), "after": (30132, 30832)}, ["source_key"])


@query("c_sample_tasks", "SELECT authority_code, n, d AS observed_date, CAST(ceil(n / 100.0) AS BIGINT) AS pages FROM (SELECT authority_code, count(*) AS n FROM permit_v GROUP BY 1), (VALUES (DATE '2026-01-01'), (DATE '2026-09-06')) AS t(d)")
def c_sample_tasks(spark, sf):
    """O-114"""
    plan = bind(spark, sf, "permit_v").groupBy("authority_code").agg(F.count("*").alias("n"))
    return K.expand_plan(plan.withColumn("dates", F.array(*[F.to_date(F.lit(d)) for d in _SPAN])), "authority_code", "n", "dates")


@query("c_gap_sources", "SELECT source_key, CAST(coalesce(max(g), 0) AS BIGINT) AS max_gap_days FROM (SELECT source_key, permit_date - lag(permit_date) OVER (PARTITION BY source_key ORDER BY permit_date) AS g FROM (SELECT DISTINCT source_key, permit_date FROM permit_v)) GROUP BY 1")
def c_gap_sources(spark, sf):
    """O-93, by source"""
    return largest_gap(bind(spark, sf, "permit_v"), ["source_key"], "permit_date")


_REGIONS = {"west": (124.0, 35.0, 127.0, 37.0), "east": (127.0, 35.0, 130.0, 37.0)}
_PREFIXES = {"west": ("0", "1"), "east": ("2", "3", "4")}


def _inside(a: str, b: str, box: tuple) -> str:
    return f"({a} BETWEEN {box[0]} AND {box[2]} AND {b} BETWEEN {box[1]} AND {box[3]})"


def _in_region(a: str, b: str) -> str:
    return f"((label IN (0, 1) AND {_inside(a, b, _REGIONS['west'])}) OR (label IN (2, 3, 4) AND {_inside(a, b, _REGIONS['east'])}))"


_PROBE = f"""SELECT count(*) AS sampled, count(*) FILTER (WHERE {_inside('x', 'y', G.COUNTRY_BOX)}) AS xy_inside, count(*) FILTER (WHERE {_inside('y', 'x', G.COUNTRY_BOX)}) AS yx_inside,
  count(*) FILTER (WHERE {_inside('x', 'y', G.COUNTRY_BOX)} AND {_inside('y', 'x', G.COUNTRY_BOX)}) AS both_inside, count(*) FILTER (WHERE NOT {_inside('x', 'y', G.COUNTRY_BOX)} AND NOT {_inside('y', 'x', G.COUNTRY_BOX)}) AS none_inside,
  count(*) FILTER (WHERE label IN (0, 1, 2, 3, 4)) AS eligible, count(*) FILTER (WHERE {_in_region('x', 'y')}) AS xy_region, count(*) FILTER (WHERE {_in_region('y', 'x')}) AS yx_region,
  count(*) FILTER (WHERE {_in_region('x', 'y')} AND {_in_region('y', 'x')}) AS both_region, count(*) FILTER (WHERE label IN (0, 1, 2, 3, 4) AND NOT {_in_region('x', 'y')} AND NOT {_in_region('y', 'x')}) AS none_region
FROM xy_v WHERE x IS NOT NULL AND y IS NOT NULL"""


def _probe(spark, sf):
    xy = bind(spark, sf, "xy_v").withColumn("address", F.col("label").cast("string"))
    return G.axis_probe(xy.where("label < 10"), "x", "y", "address", G.identity, G.COUNTRY_BOX, _REGIONS, _PREFIXES)


@query("g_axis_probe", _PROBE + " AND label < 10")
def g_axis_probe(spark, sf):
    """O-107"""
    return _probe(spark, sf)


@query("g_axis_assess", f"""
WITH p AS ({_PROBE} AND label < 10) SELECT sampled, eligible, CASE WHEN eligible >= 100 AND xy_region / eligible::DOUBLE >= 0.9 AND (xy_region - yx_region) / eligible::DOUBLE >= 0.4 THEN 'X_IS_EASTING'
  WHEN eligible >= 100 AND yx_region / eligible::DOUBLE >= 0.9 AND (yx_region - xy_region) / eligible::DOUBLE >= 0.4 THEN 'X_IS_NORTHING' WHEN sampled < 100 THEN 'INSUFFICIENT_SAMPLE'
  WHEN xy_inside / sampled::DOUBLE >= 0.95 AND (xy_inside - yx_inside) / sampled::DOUBLE >= 0.5 THEN 'X_IS_EASTING' WHEN yx_inside / sampled::DOUBLE >= 0.95 AND (yx_inside - xy_inside) / sampled::DOUBLE >= 0.5 THEN 'X_IS_NORTHING' ELSE 'AMBIGUOUS' END AS assessment FROM p""")
def g_axis_assess(spark, sf):
    """O-108"""
    return G.assess_axes(_probe(spark, sf)).select("sampled", "eligible", "assessment")


@query("g_transform")
def g_transform(spark, sf):
    """O-106: projected coordinates around the projection's origin; no oracle, SQL has no projections"""
    xy = bind(spark, sf, "xy_v").withColumns({"e": F.when(F.col("x").isNotNull(), 200000.0 + (F.col("x") - 127) * 60000), "n": F.when(F.col("y").isNotNull(), 500000.0 + (F.col("y") - 36) * 60000)})
    return G.with_geographic(xy, "e", "n").select("vec_id", "wgs84_longitude", "wgs84_latitude", "coordinate_quality")


@query("g_round_trip", "SELECT vec_id, CASE WHEN x IS NULL THEN NULL ELSE true END AS returns, CASE WHEN x IS NULL THEN false ELSE x BETWEEN 126 AND 128 AND y BETWEEN 33.96 AND 38.33 END AS in_area FROM xy_v")
def g_round_trip(spark, sf):
    """O-106, O-109: degrees to projected metres and back to within 1e-8 degrees (a millimetre), and whether they lie in the area of use"""
    belt, xy = G.MODIFIED_CENTRAL_BELT, bind(spark, sf, "xy_v")
    e, n = belt.from_wgs84(F.col("x"), F.col("y"))
    there = xy.withColumn("p", F.struct(e.alias("e"), n.alias("n")))
    lon, lat = belt.to_wgs84(F.col("p.e"), F.col("p.n"))
    back = there.withColumn("g", F.struct(lon.alias("lon"), lat.alias("lat")))
    return back.select("vec_id", ((F.abs(F.col("g.lon") - F.col("x")) < 1e-8) & (F.abs(F.col("g.lat") - F.col("y")) < 1e-8)).alias("returns"), G.in_area(F.col("x"), F.col("y")).alias("in_area"))


@query("g_quality", f"SELECT count(*) FILTER (WHERE x IS NOT NULL AND {_inside('x', 'y', (126.9, 35.9, 127.1, 36.1))}) AS transformed, count(*) FILTER (WHERE x IS NULL) AS missing, CAST(0 AS BIGINT) AS partial, CAST(0 AS BIGINT) AS not_finite, count(*) FILTER (WHERE x IS NOT NULL AND NOT {_inside('x', 'y', (126.9, 35.9, 127.1, 36.1))}) AS outside FROM xy_v")
def g_quality(spark, sf):
    """O-106, O-130: what becomes of the pairs"""
    return G.transform_counters(bind(spark, sf, "xy_v"), "x", "y", G.identity, (126.9, 35.9, 127.1, 36.1))


@query("v_geo", """
SELECT 'quality is known' AS invariant, CAST(0 AS BIGINT) AS violations UNION ALL SELECT 'null pairs are missing', CAST(0 AS BIGINT) UNION ALL SELECT 'transformed pairs are whole', CAST(0 AS BIGINT) UNION ALL SELECT 'inside the box', CAST(0 AS BIGINT)""")
def v_geo(spark, sf):
    """O-130"""
    rules = (
        Invariant("quality is known", "coordinate_quality IN ('TRANSFORMED', 'MISSING_SOURCE_COORDINATES')"),
        Invariant("null pairs are missing", "(wgs84_longitude IS NULL AND wgs84_latitude IS NULL) = (coordinate_quality = 'MISSING_SOURCE_COORDINATES')"),
        Invariant("transformed pairs are whole", "(wgs84_longitude IS NULL) = (wgs84_latitude IS NULL)"),
        Invariant("inside the box", "wgs84_longitude IS NULL OR (wgs84_longitude BETWEEN 124 AND 132 AND wgs84_latitude BETWEEN 32 AND 40)"),
    )
    return violations(g_transform(spark, sf), rules)


@query("v_parent", "SELECT count(*) AS row_count, count(*) FILTER (WHERE closure_date IS NOT NULL) AS closure_valid, count(*) - count(DISTINCT row_key) AS repeated_keys FROM permit_v")
def v_parent(spark, sf):
    """O-128: counters of a parent, recomputed"""
    p = bind(spark, sf, "permit_v")
    return p.agg(F.count("*").alias("row_count"), F.count("closure_date").alias("closure_valid"), (F.count("*") - F.count_distinct("row_key")).alias("repeated_keys"))


@query("v_sidecar", "SELECT CAST(0 AS BIGINT) AS without_sidecar, CAST(0 AS BIGINT) AS without_parent, count(*) AS linked_rows, count(*) AS parent_rows, CAST(max(vec_id) - count(*) AS BIGINT) AS beyond_last, CAST(0 AS BIGINT) AS repeated_numbers FROM embeddings")
def v_sidecar(spark, sf):
    """O-78, O-130: the geographic sidecar is one row for each parent row"""
    return J.sidecar_linkage(bind(spark, sf, "embeddings").select("vec_id"), g_transform(spark, sf).select("vec_id"), ["vec_id"], "vec_id")


_KEEP = ("source_key", "row_key", "authority_code", "management_number", "permit_date", "closure_date", "price")


def _build(rows):
    """A contract of permits for rows of that shape."""
    kinds = dict(rows.dtypes)
    return Contract("permits", tuple(ColumnRule(c, kinds[c], c == "closure_date") for c in _KEEP))


@query("v_build", """
WITH d AS (SELECT count(*) FILTER (WHERE row_key % 7 = 3) AS lost, count(*) FILTER (WHERE row_key % 7 <> 3 AND row_key % 11 = 5) AS blank FROM permit_v)
SELECT 'sound' AS build, unnest(['no files', 'columns', 'contract', 'codec', 'row groups', 'nulls', 'rows']) AS "check", CAST(0 AS BIGINT) AS violations
UNION ALL SELECT 'damaged', unnest(['no files', 'columns', 'contract', 'codec', 'row groups', 'nulls', 'rows']), CAST(unnest([0, 0, 0, 0, 0, blank, lost]) AS BIGINT) FROM d""")
def v_build(spark, sf):
    """O-09, O-128: a build of all permits is written, and its footers are checked against its contract; so is a copy without every seventh row and without some numbers"""
    import uuid

    from sedimenta.operators.build import write_parquet
    from sedimenta.operators.contract import tagged
    from sedimenta.sources.footers import build_faults, parquet_footers

    root = f"{shared_dir(spark)}/build-{uuid.uuid4().hex}"
    permits = bind(spark, sf, "permit_v").select(*_KEEP)
    contract = _build(permits)
    broken = permits.where("row_key % 7 <> 3").withColumn("management_number", F.when(F.col("row_key") % 11 != 5, F.col("management_number")))
    out = None
    for name, rows in (("sound", permits), ("damaged", broken)):
        write_parquet(tagged(rows, contract), f"{root}/{name}", rows_per_file=50_000)
        found = build_faults(parquet_footers(spark, f"{root}/{name}"), _KEEP, contract.name, "ZSTD", permits.count(), 50_000, ["management_number", "row_key"])
        found = found.select(F.lit(name).alias("build"), "check", "violations")
        out = found if out is None else out.unionByName(found)
    return out


@query("s_parquet_facts", """
SELECT unnest(['o_orderkey', 'o_custkey', 'o_totalprice', 'half']) AS "column", count(*) AS rows, CAST(unnest([0, 0, 0, count(*) FILTER (WHERE o_orderkey % 2 = 1)]) AS BIGINT) AS nulls,
  CAST(unnest([min(o_orderkey), min(o_custkey), NULL, min(o_orderkey) FILTER (WHERE o_orderkey % 2 = 0)]) AS BIGINT) AS least, CAST(unnest([max(o_orderkey), max(o_custkey), NULL, max(o_orderkey) FILTER (WHERE o_orderkey % 2 = 0)]) AS BIGINT) AS greatest FROM orders""")
def s_parquet_facts(spark, sf):
    """O-09: rows, nulls, least and greatest values of a written folder, out of its footers"""
    import uuid

    from sedimenta.operators.build import write_parquet
    from sedimenta.sources.footers import column_facts, parquet_footers

    path = f"{shared_dir(spark)}/facts-{uuid.uuid4().hex}"
    write_parquet(bind(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")).alias("half")), path)
    footers = parquet_footers(spark, path)
    whole = F.col("physical_type").isin("INT32", "INT64")
    bounds = footers.groupBy("column").agg(F.min(F.when(whole, F.col("least").try_cast("long"))).alias("least"), F.max(F.when(whole, F.col("greatest").try_cast("long"))).alias("greatest"))
    return column_facts(footers).select("column", "rows", "nulls").join(bounds, "column")


@query("v_damaged_sidecar", """
WITH s AS (SELECT vec_id FROM embeddings WHERE vec_id % 9 <> 0 UNION ALL SELECT -vec_id - 1 FROM embeddings WHERE vec_id % 10 = 1), p AS (SELECT vec_id FROM embeddings UNION ALL SELECT vec_id FROM embeddings WHERE vec_id % 8 = 3)
SELECT count(*) FILTER (WHERE s.vec_id IS NULL) AS without_sidecar, count(*) FILTER (WHERE p.vec_id IS NULL) AS without_parent, count(*) AS linked_rows, (SELECT count(*) FROM p) AS parent_rows,
  (SELECT CAST(max(vec_id) - count(*) AS BIGINT) FROM p) AS beyond_last, (SELECT count(*) - count(DISTINCT vec_id) FROM p) AS repeated_numbers FROM p FULL JOIN s ON p.vec_id = s.vec_id""")
def v_damaged_sidecar(spark, sf):
    """O-78, O-130 over a sidecar that lacks rows and has unknown ones, and a parent with repeated numbers"""
    v = bind(spark, sf, "embeddings").select("vec_id")
    side = v.where("vec_id % 9 <> 0").unionByName(v.where("vec_id % 10 = 1").select((-F.col("vec_id") - 1).alias("vec_id")))
    return J.sidecar_linkage(v.unionByName(v.where("vec_id % 8 = 3")), side, ["vec_id"], "vec_id")


@query("v_damaged_geo", """
WITH d AS (SELECT vec_id % 10 AS m, x IS NULL AS missing FROM xy_v)
SELECT 'transformed pairs are inside' AS invariant, count(*) FILTER (WHERE m IN (1, 2) AND NOT missing OR m = 4 AND missing) AS violations FROM d
UNION ALL SELECT 'missing pairs are null', count(*) FILTER (WHERE m = 3 OR m = 4 AND NOT missing) FROM d
UNION ALL SELECT 'coordinate_quality is set', count(*) FILTER (WHERE m = 4) FROM d
UNION ALL SELECT 'coordinate_quality is allowed', count(*) FILTER (WHERE m = 5) FROM d""")
def v_damaged_geo(spark, sf):
    """O-130 by the sidecar's contract, over a sidecar that was damaged by a rule on the row's number: a half and a far coordinate, a pair that should be missing, no quality and an unknown one"""
    m, q = F.col("vec_id") % 10, F.col("coordinate_quality")
    damage = {
        "wgs84_latitude": F.when(m == 3, 36.0).when(m == 2, F.lit(None)).otherwise(F.col("wgs84_latitude")),
        "wgs84_longitude": F.when((m == 1) & (q == "TRANSFORMED"), 1.0).when(m == 3, 127.0).otherwise(F.col("wgs84_longitude")),
        "coordinate_quality": F.when(m == 3, "MISSING_SOURCE_COORDINATES").when(m == 4, F.lit(None)).when(m == 5, "UNKNOWN").otherwise(q),
    }
    return violations(g_transform(spark, sf).withColumns(damage), [r for r in SIDECAR.rules() if "coordinate_quality" in r.rule])
