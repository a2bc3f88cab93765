"""Queries of the normalisers and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.functions import scalars as S
from sedimenta.operators import permits as P
from sedimenta.plans.bindings import bind
from sedimenta.plans.registry import query

_TRIM = r"regexp_replace({0}, '^[\s\x1c-\x1f\x{{85}}\p{{Z}}]+|[\s\x1c-\x1f\x{{85}}\p{{Z}}]+$', '', 'g')"


def _trim(c: str) -> str:
    return _TRIM.format(c)


def _date(c: str, formats: str = "cds") -> str:
    v = _trim(c)
    parts = {
        "c": f"CASE WHEN regexp_full_match({v}, '[0-9]{{8}}') THEN CAST(try_strptime({v}, '%Y%m%d') AS DATE) END",
        "d": f"CASE WHEN regexp_full_match({v}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') THEN CAST(try_strptime({v}, '%Y-%m-%d') AS DATE) END",
        "s": f"CASE WHEN regexp_full_match({v}, '[0-9]{{4}}/[0-9]{{1,2}}/[0-9]{{1,2}}') THEN CAST(try_strptime({v}, '%Y/%m/%d') AS DATE) END",
    }
    return f"coalesce({', '.join(parts[f] for f in formats)})" if len(formats) > 1 else parts[formats]


def _quality(c: str, formats: str = "cds") -> str:
    return f"CASE WHEN nullif({_trim(c)}, '') IS NULL THEN 'MISSING' WHEN {_date(c, formats)} IS NULL THEN 'INVALID' ELSE 'VALID' END"


def _float(c: str) -> str:
    v = _trim(c)
    number = f"CASE WHEN regexp_full_match({v}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST({v} AS DOUBLE) END"
    return f"(CASE WHEN abs({number}) < 'inf'::DOUBLE THEN {number} END)"


_TEXTS = {"authority_code": "authority_code", "management_number": "management_number", "status_code": "source_status_code", "status_name": "source_status_name", "detail_code": "source_detail_status_code", "detail_name": "source_detail_status_name",
  "business_name": "business_name", "type_name": "business_type_name", "hygiene_name": "hygiene_business_type_name", "lot_postal": "lot_postal_code", "road_postal": "road_postal_code", "lot_address": "lot_address", "road_address": "road_address",
  "update_type": "source_data_update_type", "updated_at": "source_data_updated_at_raw", "modified_at": "source_last_modified_at_raw"}
_RETRIEVED = "2026-09-07T10:30:00+09:00"


def source_rows(spark, sf):
    """The source's 39 columns from the raw view; those that the view doesn't have are null."""
    raw = bind(spark, sf, "source_v")
    named = {P.TEXTS[to]: F.col(c) for c, to in _TEXTS.items()} | {P.DATES[c]: F.col(c) for c in P.DATES} | {P.NUMBERS[f"source_coordinate_{c}"]: F.col(c) for c in "xy"} | {"전화번호": F.col("phone")}
    return raw.select("row_key", "source_key", *[named.get(c, F.lit(None).cast("string")).alias(c) for c in P.SOURCE_COLUMNS])


@query("t_transform_rows", f"""
SELECT source_key, row_key AS source_row_number, sha256('artifact') AS source_artifact_sha256, TIMESTAMP '2026-09-07 01:30:00' AS source_retrieved_at_utc,
  {', '.join(f"nullif({_trim(c)}, '') AS {to}" for c, to in _TEXTS.items())},
  {', '.join(f"{_date(c)} AS {c}, {_quality(c)} AS {c}_quality" for c in ('permit_date', 'closure_date'))}, {', '.join(f"{_float(c)} AS source_coordinate_{c}" for c in 'xy')}
FROM source_v""")
def transform_rows(spark, sf):
    """O-18: one projection from the 39 source columns to the 26 of the parent, whose faulty values are null (t_rejected_rows has those rows)"""
    import hashlib

    lineage = P.Lineage(F.col("source_key"), hashlib.sha256(b"artifact").hexdigest(), _RETRIEVED)
    parent = P.parent_rows(source_rows(spark, sf), lineage, "row_key", "null", ["source_key"])
    return parent.withColumn("source_retrieved_at_utc", F.to_utc_timestamp("source_retrieved_at_utc", F.current_timezone()).cast("timestamp_ntz"))


@query("t_rejected_rows", f"""
SELECT row_key, array_to_string(list_filter([CASE WHEN nullif({_trim('authority_code')}, '') IS NULL THEN 'authority_code is blank' END, CASE WHEN nullif({_trim('management_number')}, '') IS NULL THEN 'management_number is blank' END,
  {', '.join(f"CASE WHEN nullif({_trim(c)}, '') IS NOT NULL AND {_float(c)} IS NULL THEN 'source_coordinate_{c} is no finite number' END" for c in 'xy')}], lambda r: r IS NOT NULL), ', ') AS reasons
FROM source_v WHERE reasons <> ''""")
def rejected_rows(spark, sf):
    """O-18, O-20, O-23: the rows that the parent can't hold, and why"""
    return P.rejected_rows(source_rows(spark, sf), "row_key", ["source_key"]).select("row_key", F.array_join("reasons", ", ").alias("reasons"))


@query("t_trim_blank", f"SELECT row_key, nullif({_trim('management_number')}, '') AS management_number, nullif({_trim('business_name')}, '') AS business_name, nullif({_trim('status_name')}, '') AS status_name FROM raw_v")
def trim_blank(spark, sf):
    """O-19"""
    return bind(spark, sf, "raw_v").select("row_key", *[S.text_or_null(F.col(c)).alias(c) for c in ("management_number", "business_name", "status_name")])


@query("t_required_violations", f"SELECT count(*) FILTER (WHERE nullif({_trim('authority_code')}, '') IS NULL) AS authority_blank, count(*) FILTER (WHERE nullif({_trim('management_number')}, '') IS NULL) AS management_blank FROM raw_v")
def required_violations(spark, sf):
    """O-20"""
    return bind(spark, sf, "raw_v").agg(F.count_if(S.is_blank(F.col("authority_code"))).alias("authority_blank"), F.count_if(S.is_blank(F.col("management_number"))).alias("management_blank"))


@query("t_date_quality", f"SELECT row_key, {_date('permit_date')} AS permit_date, {_quality('permit_date')} AS permit_date_quality, {_date('closure_date')} AS closure_date, {_quality('closure_date')} AS closure_date_quality FROM raw_v")
def date_quality(spark, sf):
    """O-21"""
    return bind(spark, sf, "raw_v").select("row_key", *[x for c in ("permit_date", "closure_date") for x in (S.parse_date(F.col(c)).alias(c), S.date_quality(F.col(c)).alias(f"{c}_quality"))])


@query("t_date_quality_two", f"SELECT row_key, {_date('permit_date', 'cd')} AS permit_date, {_quality('permit_date', 'cd')} AS permit_date_quality FROM raw_v")
def date_quality_two(spark, sf):
    """O-22: without slashes, as history pages have them"""
    two = (S.COMPACT, S.DASHED)
    return bind(spark, sf, "raw_v").select("row_key", S.parse_date(F.col("permit_date"), two).alias("permit_date"), S.date_quality(F.col("permit_date"), two).alias("permit_date_quality"))


@query("t_float_parse", f"SELECT row_key, {_float('x')} AS x, {_float('y')} AS y, nullif({_trim('x')}, '') IS NOT NULL AND {_float('x')} IS NULL AS x_bad, nullif({_trim('y')}, '') IS NOT NULL AND {_float('y')} IS NULL AS y_bad FROM raw_v")
def float_parse(spark, sf):
    """O-23"""
    return bind(spark, sf, "raw_v").select("row_key", *[S.parse_float(F.col(c)).alias(c) for c in "xy"], *[S.float_is_bad(F.col(c)).alias(f"{c}_bad") for c in "xy"])


@query("t_ts_utc", """
SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL WHEN event_id % 4 = 2 THEN date_trunc('second', ts) - INTERVAL 9 HOUR ELSE date_trunc('second', ts) END AS at_utc FROM events""")
def ts_utc(spark, sf):
    """O-24: instants with Z, without an offset (null) and with +09:00"""
    e = bind(spark, sf, "events")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    raw = F.when(F.col("event_id") % 4 == 3, text).when(F.col("event_id") % 4 == 2, F.concat(text, F.lit("+09:00"))).otherwise(F.concat(text, F.lit("Z")))
    return e.select("event_id", F.to_utc_timestamp(S.parse_instant(raw), F.current_timezone()).cast("timestamp_ntz").alias("at_utc"))


@query("t_local_date", "SELECT event_id, CAST(ts + INTERVAL 9 HOUR AS DATE) AS seoul_date FROM events")
def local_date(spark, sf):
    """O-25: ts is taken as UTC"""
    e = bind(spark, sf, "events")
    return e.select("event_id", S.local_date(F.from_utc_timestamp(F.col("ts").cast("timestamp"), "UTC")).alias("seoul_date"))


@query("t_year_month", "SELECT row_key, CAST(year(closure_date) AS BIGINT) AS closure_year, CAST(month(permit_date) AS BIGINT) AS permit_month FROM permit_v")
def year_month(spark, sf):
    """O-26"""
    return bind(spark, sf, "permit_v").select("row_key", F.year("closure_date").cast("long").alias("closure_year"), F.month("permit_date").cast("long").alias("permit_month"))


@query("t_coalesce_blank", "SELECT row_key, coalesce(road_address, lot_address) AS plain, coalesce(nullif(road_address, ''), lot_address) AS blank_aware FROM raw_v")
def coalesce_blank(spark, sf):
    """O-27"""
    return bind(spark, sf, "raw_v").select("row_key", F.coalesce("road_address", "lot_address").alias("plain"), S.first_filled(F.col("road_address"), F.col("lot_address")).alias("blank_aware"))


@query("t_first_token", "SELECT doc_id, string_split(text, ' ')[1] AS token FROM documents")
def first_token(spark, sf):
    """O-28"""
    return bind(spark, sf, "documents").select("doc_id", S.first_token(F.col("text")).alias("token"))


@query("t_dict_map", "SELECT n_name, CASE n_name WHEN 'FRANCE' THEN 'Europe' WHEN 'GERMANY' THEN 'Europe' WHEN 'JAPAN' THEN 'Asia' END AS label FROM nation")
def dict_map(spark, sf):
    """O-29"""
    return bind(spark, sf, "nation").select("n_name", S.mapped(F.col("n_name"), {"FRANCE": "Europe", "GERMANY": "Europe", "JAPAN": "Asia"}).alias("label"))


@query("t_prefix_class", "SELECT p_partkey, CASE WHEN starts_with(p_type, 'PRO') OR starts_with(p_type, 'STA') THEN 'common' WHEN starts_with(p_type, 'E') THEN 'light' WHEN starts_with(p_type, 'S') THEN 'small' END AS type_class FROM part")
def prefix_class(spark, sf):
    """O-30"""
    return bind(spark, sf, "part").select("p_partkey", S.prefix_class(F.col("p_type"), {"common": ("PRO", "STA"), "light": ("E",), "small": ("S",)}).alias("type_class"))


@query("t_envelope", "SELECT vec_id, coalesce(x BETWEEN 126.5 AND 127.5 AND y BETWEEN 35.5 AND 36.5, false) AS inside FROM xy_v")
def envelope(spark, sf):
    """O-31"""
    return bind(spark, sf, "xy_v").select("vec_id", S.in_box(F.col("x"), F.col("y"), 126.5, 35.5, 127.5, 36.5).alias("inside"))


@query("t_code_format", """
SELECT o_orderkey, regexp_full_match(c, '[0-9]{7}') AS is_code, regexp_full_match(c, '([0-9]{7}|[0-9]{7}_ALL)') AS is_code_or_all
FROM (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN lpad(CAST(o_orderkey AS VARCHAR), 7, '0') WHEN 1 THEN lpad(CAST(o_orderkey AS VARCHAR), 7, '0') || '_ALL' ELSE 'x' END AS c FROM orders)""")
def code_format(spark, sf):
    """O-32"""
    k = F.col("o_orderkey")
    padded = F.lpad(k.cast("string"), 7, "0")
    c = F.when(k % 3 == 0, padded).when(k % 3 == 1, F.concat(padded, F.lit("_ALL"))).otherwise("x")
    return bind(spark, sf, "orders").select("o_orderkey", S.has_format(c, "code7").alias("is_code"), S.has_format(c, "code7_or_all").alias("is_code_or_all"))


@query("t_url_sanitise", r"""
SELECT page_id, regexp_replace(url, '([?&])(ref|token|key)=[^&#]*', '\1\2=REDACTED', 'g') AS clean_url, coalesce(lower(regexp_extract(url, '^https://([^/?#:@]*)', 1)) = 'ththou.example.com', false) AS allowed FROM pages""")
def url_sanitise(spark, sf):
    """O-33"""
    u = F.col("url")
    return bind(spark, sf, "pages").select("page_id", S.redact_url(u).alias("clean_url"), S.url_allowed(u, ["ththou.example.com"]).alias("allowed"))


@query("t_row_hash", """
SELECT n_nationkey, sha256(from_hex(lpad(to_hex(strlen(k)), 16, '0')) || encode(k) || from_hex(lpad(to_hex(strlen(n_name)), 16, '0')) || encode(n_name)) AS row_hash
FROM (SELECT n_nationkey, CAST(n_nationkey AS VARCHAR) AS k, n_name FROM nation)""")
def row_hash(spark, sf):
    """O-34"""
    return bind(spark, sf, "nation").select("n_nationkey", S.row_hash(F.col("n_nationkey"), F.col("n_name")).alias("row_hash"))


@query("t_bucket", "SELECT c_custkey, CAST('0x' || substr(sha256(CAST(c_custkey AS VARCHAR)), 1, 2) AS INTEGER) AS bucket FROM customer")
def bucket(spark, sf):
    """O-35"""
    return bind(spark, sf, "customer").select("c_custkey", S.hash_bucket(F.col("c_custkey").cast("string")).alias("bucket"))


@query("t_composite_key", f"SELECT row_key, nullif({_trim('authority_code')}, '') || chr(31) || nullif({_trim('management_number')}, '') AS permit_key FROM raw_v")
def composite_key(spark, sf):
    """O-36"""
    return bind(spark, sf, "raw_v").select("row_key", S.composite_key(F.col("authority_code"), F.col("management_number")).alias("permit_key"))


@query("t_percent", "SELECT c_custkey, round(100.0::DOUBLE * (c_custkey % 13) / nullif(c_custkey % 7, 0), 6) AS pct FROM customer")
def percent(spark, sf):
    """O-37"""
    return bind(spark, sf, "customer").select("c_custkey", S.percent(F.col("c_custkey") % 13, F.col("c_custkey") % 7).alias("pct"))


@query("t_status_raw", "SELECT status_code, detail_code, count(*) AS n FROM permit_v GROUP BY ALL")
def status_raw(spark, sf):
    """O-39: statuses are passed on as they are"""
    return bind(spark, sf, "permit_v").groupBy("status_code", "detail_code").agg(F.count("*").alias("n"))


@query("t_month_cyclic", "SELECT DISTINCT month, round(sin(2 * pi() * month(month + INTERVAL 1 MONTH) / 12), 9) + 0.0::DOUBLE AS month_sin, round(cos(2 * pi() * month(month + INTERVAL 1 MONTH) / 12), 9) + 0.0::DOUBLE AS month_cos FROM month_v")
def month_cyclic(spark, sf):
    """O-40"""
    s, c = S.month_cycle(F.col("month"))
    return bind(spark, sf, "month_v").select("month").distinct().select("month", F.round(s, 9).alias("month_sin"), F.round(c, 9).alias("month_cos"))


@query("t_clip", "SELECT c_custkey, greatest(c_acctbal, 0) AS balance FROM customer")
def clip(spark, sf):
    """O-41"""
    return bind(spark, sf, "customer").select("c_custkey", S.clip_low(F.col("c_acctbal")).alias("balance"))
