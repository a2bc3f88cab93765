"""Queries of profiles, audits and sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.functions import scalars as S
from sedimenta.operators import profile as P
from sedimenta.plans.bindings import bind
from sedimenta.plans.registry import query
from sedimenta.session import shared_dir
from sedimenta.plans.scalar_queries import _date, _float, _quality, _trim
from sedimenta.sources import snapshots as SRC

_COLUMNS = ("authority_code", "permit_date", "road_address", "status_name")


def _profile_row(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) FILTER (WHERE {c} = '') AS blank_count,
  count(*) FILTER (WHERE {c} <> '' AND {_trim(c)} = '') AS whitespace_count, count(*) FILTER (WHERE {_trim(c)} <> '') AS filled_count,
  round(100.0::DOUBLE * count(*) FILTER (WHERE {c} IS NULL OR {_trim(c)} = '') / count(*), 4) AS blank_percent, min(length({c})) AS min_length, max(length({c})) AS max_length FROM raw_v"""


@query("q_profile", " UNION ALL ".join(map(_profile_row, _COLUMNS)))
def q_profile(spark, sf):
    """O-42"""
    return P.column_profile(bind(spark, sf, "raw_v"), _COLUMNS)


@query("q_distinct_cap", " UNION ALL ".join(f"SELECT '{c}' AS column_name, least(count(DISTINCT {c}), 1000) AS distinct_count, count(DISTINCT {c}) <= 1000 AS is_exact FROM lineitem" for c in ("l_orderkey", "l_returnflag", "l_suppkey")))
def q_distinct_cap(spark, sf):
    """O-43"""
    return P.capped_distinct(bind(spark, sf, "lineitem"), ("l_orderkey", "l_returnflag", "l_suppkey"), 1000)


@query("q_numeric_probe", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({_float(c)}) AS numeric_count, min({_float(c)}) AS numeric_min, max({_float(c)}) AS numeric_max FROM raw_v" for c in ("x", "y", "phone")))
def q_numeric_probe(spark, sf):
    """O-44, over all rows"""
    return P.numeric_probe(bind(spark, sf, "raw_v"), ("x", "y", "phone"))


@query("q_date_probe", f"""
SELECT CASE WHEN {_date('permit_date', 'c')} IS NOT NULL THEN 'yyyyMMdd' WHEN {_date('permit_date', 'd')} IS NOT NULL THEN 'yyyy-M-d' WHEN {_date('permit_date', 's')} IS NOT NULL THEN 'yyyy/M/d' END AS format,
  count(*) AS n, min({_date('permit_date')}) AS first_date, max({_date('permit_date')}) AS last_date FROM raw_v WHERE nullif({_trim('permit_date')}, '') IS NOT NULL GROUP BY 1""")
def q_date_probe(spark, sf):
    """O-45"""
    return P.date_probe(bind(spark, sf, "raw_v"), "permit_date")


@query("q_top_values", "SELECT value, n, row_number() OVER (ORDER BY n DESC, value) AS place FROM (SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, value LIMIT 3)")
def q_top_values(spark, sf):
    """O-46"""
    return P.top_values(bind(spark, sf, "orders"), "o_orderpriority", 3)


_SETS = ("authority_code", "permit_date", "road_address", "phone", "x", "y")


@query("q_column_sets", "WITH t AS (" + " UNION ALL ".join(f"SELECT DISTINCT CAST(row_key % 5 AS VARCHAR) AS source, '{c}' AS column_name FROM raw_v WHERE nullif({_trim(c)}, '') IS NOT NULL" for c in _SETS) + """)
SELECT column_name, count(DISTINCT source) AS sources, count(DISTINCT source) = (SELECT count(DISTINCT source) FROM t) AS in_all, CASE WHEN count(DISTINCT source) = 1 THEN min(source) END AS only_in FROM t GROUP BY column_name""")
def q_column_sets(spark, sf):
    """O-47 over the columns that are filled in each fifth of the raw rows"""
    return P.column_sets(P.filled_columns(bind(spark, sf, "raw_v"), (F.col("row_key") % 5).cast("string"), list(_SETS)))


def _dup(name: str, key: str) -> str:
    return f"""SELECT '{name}' AS key_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS populated_rows, count(*) AS distinct_values, count(*) FILTER (WHERE n > 1) AS duplicated_values, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS rows_beyond_first, coalesce(max(n), 0) AS max_multiplicity
FROM (SELECT count(*) AS n FROM raw_v WHERE {key} IS NOT NULL GROUP BY {key})"""


_MANAGEMENT, _AUTHORITY = f"nullif({_trim('management_number')}, '')", f"nullif({_trim('authority_code')}, '')"


@query("q_dup_summary", f"{_dup('management', _MANAGEMENT)} UNION ALL {_dup('authority_management', f'({_AUTHORITY} || chr(31) || {_MANAGEMENT})')} UNION ALL {_dup('name_address', '(business_name || chr(31) || lot_address)')}")
def q_dup_summary(spark, sf):
    """O-48"""
    keys = {"management": S.text_or_null(F.col("management_number")), "authority_management": S.composite_key(F.col("authority_code"), F.col("management_number")), "name_address": F.concat_ws("\x1f", "business_name", "lot_address")}
    return P.duplicate_summary(bind(spark, sf, "raw_v"), keys)


@query("q_snapshot_audit", f"""
WITH typed AS (
  SELECT *, {_date('permit_date')} AS p, {_date('closure_date')} AS c, nullif({_trim('permit_date')}, '') IS NULL AS p_blank, nullif({_trim('closure_date')}, '') IS NULL AS c_blank,
    coalesce({_trim('status_name')} = 'closed', false) AS closed, nullif({_trim('x')}, '') IS NULL AS x_blank, nullif({_trim('y')}, '') IS NULL AS y_blank, {_float('x')} AS fx, {_float('y')} AS fy FROM raw_v)
SELECT count(*) AS rows, count(*) FILTER (WHERE {_AUTHORITY} IS NULL) AS authority_blank, count(*) FILTER (WHERE {_MANAGEMENT} IS NULL) AS management_blank,
  count(*) FILTER (WHERE p_blank) AS permit_blank, count(*) FILTER (WHERE NOT p_blank AND p IS NULL) AS permit_unparseable, count(*) FILTER (WHERE p > DATE '1997-06-30') AS permit_after_retrieval,
  count(*) FILTER (WHERE c_blank) AS closure_blank, count(*) FILTER (WHERE NOT c_blank AND c IS NULL) AS closure_unparseable, count(*) FILTER (WHERE c < p) AS closure_before_permit, count(*) FILTER (WHERE c > DATE '1997-06-30') AS closure_after_retrieval,
  count(*) FILTER (WHERE closed) AS closed_label, count(*) FILTER (WHERE closed AND c_blank) AS closed_label_without_closure, count(*) FILTER (WHERE NOT closed AND NOT c_blank) AS other_label_with_closure,
  count(*) FILTER (WHERE {_trim('business_name')} <> '') AS business_name_filled, count(*) FILTER (WHERE {_trim('phone')} <> '') AS phone_filled, count(*) FILTER (WHERE {_trim('road_address')} <> '') AS road_address_filled, count(*) FILTER (WHERE {_trim('lot_address')} <> '') AS lot_address_filled,
  count(*) FILTER (WHERE NOT x_blank AND NOT y_blank) AS coordinates_both, count(*) FILTER (WHERE x_blank AND y_blank) AS coordinates_none, count(*) FILTER (WHERE x_blank <> y_blank) AS coordinates_one,
  count(*) FILTER (WHERE NOT x_blank AND NOT y_blank AND (fx IS NULL OR fy IS NULL)) AS coordinates_unparseable, count(*) FILTER (WHERE fx = 0 AND fy = 0) AS coordinates_zero, count(*) FILTER (WHERE fx IS NOT NULL AND fy IS NOT NULL AND (fx < 0 OR fy < 0)) AS coordinates_negative,
  CASE WHEN count(*) FILTER (WHERE (closed AND c_blank) OR (NOT closed AND NOT c_blank)) > 0 THEN 'FALSE' ELSE 'NOT_FALSIFIED' END AS closure_date_sufficient
FROM typed""")
def q_snapshot_audit(spark, sf):
    """O-49"""
    return P.snapshot_audit(bind(spark, sf, "raw_v"), "1997-06-30", "closed", {"authority": "authority_code", "management": "management_number"})


@query("q_completeness", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS present, count(*) - count({c}) AS missing, round(100.0::DOUBLE * count({c}) / count(*), 2) AS present_percent FROM permit_v" for c in ("closure_date", "permit_date", "price")))
def q_completeness(spark, sf):
    """O-50"""
    return P.completeness(bind(spark, sf, "permit_v"), ("closure_date", "permit_date", "price"))


@query("q_status_map", "SELECT trim(status_code) AS status_code, trim(status_name) AS status_name, trim(detail_code) AS detail_code, trim(detail_name) AS detail_name, count(*) AS n FROM raw_v GROUP BY 1, 2, 3, 4")
def q_status_map(spark, sf):
    """O-51"""
    return P.value_combinations(bind(spark, sf, "raw_v"), ("status_code", "status_name", "detail_code", "detail_name"))


@query("q_uniqueness", "SELECT count(*) FILTER (WHERE n > 1) AS duplicate_keys, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey, l_suppkey)")
def q_uniqueness(spark, sf):
    """O-52"""
    return P.uniqueness(bind(spark, sf, "lineitem"), F.col("l_partkey"), F.col("l_suppkey"))


_DRY = ", ".join(
    ["count(*) AS row_count"]
    + [f"count(*) FILTER (WHERE {_quality(c)} = '{k}') AS {c}_{k.lower()}" for c in ("permit_date", "closure_date") for k in ("VALID", "MISSING", "INVALID")]
    + [f"count(*) FILTER (WHERE nullif({_trim(c)}, '') IS NOT NULL AND {_float(c)} IS NULL) AS {c}_bad" for c in "xy"]
    + [f"count(*) FILTER (WHERE nullif({_trim(c)}, '') IS NULL) AS {c}_blank" for c in ("authority_code", "management_number")]
)
_DRY_ARGS = (("permit_date", "closure_date"), ("x", "y"), ("authority_code", "management_number"))


@query("q_compat_head", f"SELECT {_DRY} FROM (SELECT * FROM raw_v ORDER BY row_key LIMIT 500)")
def q_compat_head(spark, sf):
    """O-53: the transform over the head of a source, which is what this check is about"""
    return P.transform_quality(SRC.head_rows(bind(spark, sf, "raw_v"), ["row_key"], 500), *_DRY_ARGS)


@query("q_dry_run", f"SELECT {_DRY} FROM raw_v")
def q_dry_run(spark, sf):
    """O-54"""
    return P.transform_quality(bind(spark, sf, "raw_v"), *_DRY_ARGS)


@query("q_cross_overlap", """
SELECT count(*) AS keys, count(*) FILTER (WHERE s > 1) AS shared_keys, count(*) FILTER (WHERE s > 1 AND c <= 1) AS same_context, count(*) FILTER (WHERE s > 1 AND c > 1) AS conflicting_context
FROM (SELECT l_suppkey, count(DISTINCT l_returnflag) AS s, count(DISTINCT l_linestatus) AS c FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY 1)""")
def q_cross_overlap(spark, sf):
    """O-55"""
    return P.key_overlap(bind(spark, sf, "lineitem"), "l_returnflag", F.col("l_suppkey"), F.col("l_linestatus"))


@query("s_csv_round_trip", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def s_csv_round_trip(spark, sf):
    """O-04, O-13: written as CSV into the shared folder and read back strictly"""
    import uuid

    names = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    SRC.write_csv(bind(spark, sf, "customer").select(*names), path)
    back = SRC.read_csv(spark, path, names)
    return back.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"), "c_mktsegment")


@query("s_parquet_round_trip", "SELECT * FROM nation")
def s_parquet_round_trip(spark, sf):
    """O-08, O-12"""
    import uuid

    from sedimenta.operators.build import write_parquet

    path = f"{shared_dir(spark)}/parquet-{uuid.uuid4().hex}"
    write_parquet(bind(spark, sf, "nation"), path)
    return spark.read.parquet(path)


@query("s_row_count", "SELECT count(*) AS n FROM lineitem")
def s_row_count(spark, sf):
    """O-09: answered from footers"""
    return bind(spark, sf, "lineitem").agg(F.count("*").alias("n"))


@query("s_head_sample", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10")
def s_head_sample(spark, sf):
    """O-10"""
    return SRC.head_rows(bind(spark, sf, "orders"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("s_concat_sources", "SELECT o_orderstatus AS source_key, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY 1")
def s_concat_sources(spark, sf):
    """O-14"""
    o = bind(spark, sf, "orders")
    parts = SRC.concat_sources({s: o.where(F.col("o_orderstatus") == s).select("o_orderkey") for s in ("F", "O", "P")})
    return parts.groupBy("source_key").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query("s_json_items", """
SELECT user_id AS page, event_id AS item_id, event_type AS kind FROM events WHERE user_id % 3 <> 2""")
def s_json_items(spark, sf):
    """O-03, O-07: users as pages whose items are arrays, single objects or null"""
    e = bind(spark, sf, "events")
    item = F.to_json(F.struct(F.col("event_id").alias("item_id"), F.col("event_type").alias("kind")))
    body = lambda x: F.concat(F.lit('{"response":{"body":{"items":{"item":'), x, F.lit("}}}}"))
    arrays = e.where("user_id % 3 = 0").groupBy("user_id", F.floor(F.col("event_id") / 100).alias("part")).agg(F.array_join(F.collect_list(item), ",").alias("items")).select(F.col("user_id").alias("page"), body(F.concat(F.lit("["), F.col("items"), F.lit("]"))).alias("body"))
    single = e.where("user_id % 3 = 1").select(F.col("user_id").alias("page"), body(item).alias("body"))
    none = e.where("user_id % 3 = 2").select(F.col("user_id").alias("page"), body(F.lit("null")).alias("body"))
    return SRC.json_items(arrays.unionByName(single).unionByName(none), "body", "item_id long, kind string")


@query("s_reference_domain", """
SELECT count(*) FILTER (WHERE n_nationkey % 5 <> 0) AS active, count(*) FILTER (WHERE n_nationkey % 5 <> 0 AND n_nationkey % 2 = 0) AS numeric, count(*) FILTER (WHERE n_nationkey % 5 <> 0 AND n_nationkey % 2 = 1) AS aggregate,
  count(*) FILTER (WHERE n_nationkey % 5 = 1) AS added, count(*) FILTER (WHERE n_nationkey % 5 = 0) AS removed FROM nation""")
def s_reference_domain(spark, sf):
    """O-11"""
    k = F.col("n_nationkey")
    rows = bind(spark, sf, "nation").select((k + 1).alias("number"), F.when(k % 2 == 0, F.lpad(k.cast("string"), 7, "0")).otherwise(F.concat(k.cast("string"), F.lit("_ALL"))).alias("code"), F.when(k % 5 == 0, "DELETED").when(k % 5 == 1, "NEW").alias("change"))
    return SRC.reference_domain(rows, "number", "code", "change")


@query("s_paged_history", """
SELECT event_type AS source_key, strftime(ts, '%Y%m%d') AS base_date, CAST(user_id % 2 AS VARCHAR) AS authority_code, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS id_sum, CAST(ceil(count(*) / 50.0) AS BIGINT) AS pages, count(*) AS announced
FROM events WHERE event_type <> 'error' AND ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-21' GROUP BY 1, 2, 3""")
def s_paged_history(spark, sf):
    """O-03, O-116: events landed as pages of 50 for each type, day and half of the users, and read back as their first pages plan it; sources and dates are pruned"""
    import uuid

    from sedimenta.sources.history import PagedHistory
    from sedimenta.sources.pages import land_pages, paged

    e = bind(spark, sf, "events").select(F.col("event_type").alias("source_key"), F.date_format("ts", "yyyyMMdd").alias("base_date"), (F.col("user_id") % 2).cast("string").alias("authority_code"), "event_id")
    root = f"{shared_dir(spark)}/pages-{uuid.uuid4().hex}"
    land_pages(paged(e, ["source_key", "base_date", "authority_code"], "event_id", F.struct(F.col("event_id").alias("item_id")), 50), root)
    spark.dataSource.register(PagedHistory)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    pages = spark.read.format("paged_history").option("root", root).load()
    pages = pages.where("source_key IN ('click', 'purchase', 'signup', 'view') AND base_date >= '20240111' AND base_date < '20240121'")
    items = SRC.json_items(pages, "body", "item_id long")
    keys = ("source_key", "base_date", "authority_code")
    return items.groupBy(*keys).agg(F.count("*").alias("rows"), F.sum("item_id").alias("id_sum"), F.count_distinct("page").alias("pages"), F.max("total_count").alias("announced"))


@query("q_sketch_overlap", """
WITH f AS (SELECT DISTINCT l_returnflag AS a, l_orderkey FROM lineitem)
SELECT x.a, y.a AS b, count(*) AS shared, true AS within FROM f x JOIN f y ON x.l_orderkey = y.l_orderkey AND x.a < y.a GROUP BY 1, 2""")
def q_sketch_overlap(spark, sf):
    """O-55, O-67, O-74 from sketches: orders shared by return flags, over sketches kept for each year and month of shipping; within: the estimate lies within four standard errors of the exact count beside it"""
    import uuid

    from sedimenta.operators import sketches as K

    root = f"{shared_dir(spark)}/sketches-{uuid.uuid4().hex}"
    lines = bind(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", F.date_format("l_shipdate", "yyyy-MM").alias("snapshot"))
    K.key_sketches(lines, ["snapshot", "l_returnflag"], "l_orderkey").write.partitionBy("snapshot").parquet(root)
    found = K.overlaps(K.merged(K.kept(spark, root), ["l_returnflag"]), "l_returnflag")
    flags = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_returnflag")).alias("flags"))  # at most three
    pairs = flags.select(F.explode("flags").alias("a"), "flags").select("a", F.explode("flags").alias("b")).where("a < b")
    exact = pairs.groupBy("a", "b").agg(F.count("*").alias("exact"))
    return exact.join(found, ["a", "b"]).select("a", "b", F.col("exact").alias("shared"), (F.abs(F.col("shared") - F.col("exact")) <= 4 * F.col("error") + 0.5).alias("within"))
