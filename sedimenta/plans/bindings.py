"""The test tables as snapshots: views in the SQL that Spark and DuckDB share, used by both."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages")

VIEWS = {
    # administrative permits: an order is a permit of its customer's nation
    "permit_v": """
SELECT c_mktsegment AS source_key, lpad(cast(c_nationkey AS string), 7, '0') AS authority_code, cast(o_orderkey AS string) AS management_number,
  o_orderkey AS row_key, cast(o_orderdate AS date) AS permit_date, o_orderstatus AS status_code, o_orderpriority AS detail_code,
  CASE WHEN o_orderstatus = 'F' THEN cast(o_orderdate AS date) + cast(o_orderkey % 400 AS int) END AS closure_date,
  c_name AS business_name, o_custkey AS custkey, o_totalprice AS price, c_nationkey AS nationkey
FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    # the same as source text, with damage by row number
    "raw_v": """
SELECT source_key, row_key,
  CASE WHEN row_key % 97 = 0 THEN '  ' ELSE authority_code END AS authority_code,
  CASE WHEN row_key % 89 = 0 THEN '' WHEN row_key % 83 = 0 THEN cast(row_key - 1 AS string) WHEN row_key % 79 = 0 THEN ' ' || management_number || ' ' ELSE management_number END AS management_number,
  CASE row_key % 8 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN replace(cast(permit_date AS string), '-', '') WHEN 3 THEN replace(cast(permit_date AS string), '-', '/')
    WHEN 4 THEN 'not-a-date' WHEN 5 THEN '2020-02-30' ELSE cast(permit_date AS string) END AS permit_date,
  CASE WHEN row_key % 13 = 0 THEN '2999-01-01' WHEN row_key % 17 = 0 THEN '1900-1-1' WHEN row_key % 19 = 0 THEN '99999999' ELSE coalesce(cast(closure_date AS string), '') END AS closure_date,
  status_code, CASE status_code WHEN 'F' THEN 'closed' WHEN 'O' THEN ' open ' ELSE 'partial' END AS status_name,
  detail_code, lower(detail_code) AS detail_name,
  CASE WHEN row_key % 29 = 0 THEN ' ' ELSE business_name END AS business_name,
  CASE WHEN row_key % 3 = 0 THEN '' ELSE '555-' || management_number END AS phone,
  CASE WHEN row_key % 5 = 0 THEN '' WHEN row_key % 5 = 1 THEN NULL ELSE 'Road ' || authority_code END AS road_address,
  'Lot ' || authority_code AS lot_address,
  CASE row_key % 9 WHEN 0 THEN '' WHEN 1 THEN ' ' WHEN 2 THEN 'NaN' WHEN 3 THEN 'Infinity' WHEN 4 THEN '1e3' WHEN 5 THEN 'abc' WHEN 6 THEN '0' WHEN 7 THEN '-12.5' ELSE cast(row_key AS string) || '.25' END AS x,
  CASE row_key % 5 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN '+7.' WHEN 3 THEN '.5' ELSE '1_000' END AS y
FROM {permit_v}""",
    # the raw rows with the columns of the source that only the parent keeps
    "source_v": """
SELECT *, CASE WHEN row_key % 31 = 0 THEN ' ' ELSE ' type ' || cast(row_key % 6 AS string) END AS type_name, CASE WHEN row_key % 2 = 0 THEN 'h' || cast(row_key % 6 AS string) END AS hygiene_name,
  lpad(cast(row_key % 997 AS string), 6, '0') AS lot_postal, CASE WHEN row_key % 3 = 0 THEN '' ELSE lpad(cast(row_key % 991 AS string), 5, '0') END AS road_postal,
  CASE WHEN row_key % 4 = 0 THEN 'U' ELSE 'I' END AS update_type, '2026-09-0' || cast(row_key % 9 + 1 AS string) || ' 02:40:00.0' AS updated_at, CASE WHEN row_key % 37 = 0 THEN NULL ELSE '2026080' || cast(row_key % 9 + 1 AS string) || '120000' END AS modified_at
FROM {raw_v}""",
    # one observation for each user and day: the last event
    "obs_v": """
SELECT source_key, management_number, observed_date, source_status_code, source_status_name, source_detail_status_code, source_detail_status_name, source_closure_date, source_closure_date_quality
FROM (
  SELECT 'events' AS source_key, cast(user_id AS string) AS management_number, cast(ts AS date) AS observed_date, event_type AS source_status_code, upper(event_type) AS source_status_name,
    CASE WHEN user_id % 3 = 0 THEN substr(event_type, 1, 1) END AS source_detail_status_code, cast(NULL AS string) AS source_detail_status_name,
    CASE WHEN event_id % 4 = 0 THEN cast(ts AS date) END AS source_closure_date, CASE WHEN event_id % 4 = 0 THEN 'VALID' ELSE 'MISSING' END AS source_closure_date_quality,
    row_number() OVER (PARTITION BY user_id, cast(ts AS date) ORDER BY ts DESC, event_id DESC) AS place
  FROM {events}) t
WHERE place = 1""",
    # two snapshots of customers: their last order before and after the start of 1998
    "snap_a": """
SELECT * FROM (
  SELECT c_nationkey AS authority_code, o_custkey AS id, CASE o_orderstatus WHEN 'F' THEN '03' WHEN 'O' THEN '01' ELSE '' END AS status_code, o_orderpriority AS detail_code,
    CASE WHEN o_orderstatus = 'F' THEN cast(cast(o_orderdate AS date) AS string) WHEN o_orderkey % 5 = 0 THEN '' END AS closure_date, CASE WHEN o_orderkey % 4 = 0 THEN c_name ELSE 'x' END AS business_name,
    cast(o_orderkey % 3 AS string) AS road_address, cast(o_orderkey % 2 AS string) AS x, CASE WHEN o_orderkey % 7 = 0 THEN o_orderstatus ELSE 'n' END AS status_name, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE substr(o_orderpriority, 3) END AS detail_name,
    CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE 'lot' END AS lot_address, CASE WHEN o_orderkey % 8 = 0 THEN '1' END AS y, CASE WHEN o_custkey % 50 = 0 THEN cast(o_orderkey AS string) ELSE 'd' END AS permit_date,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE o_orderdate < DATE '1998-01-01') t
WHERE place = 1""",
    "snap_b": """
SELECT * FROM (
  SELECT c_nationkey AS authority_code, o_custkey AS id, CASE o_orderstatus WHEN 'F' THEN '03' WHEN 'O' THEN '01' ELSE '' END AS status_code, o_orderpriority AS detail_code,
    CASE WHEN o_orderstatus = 'F' THEN cast(cast(o_orderdate AS date) AS string) WHEN o_orderkey % 5 = 0 THEN '' END AS closure_date, CASE WHEN o_orderkey % 4 = 0 THEN c_name ELSE 'x' END AS business_name,
    cast(o_orderkey % 3 AS string) AS road_address, cast(o_orderkey % 2 AS string) AS x, CASE WHEN o_orderkey % 7 = 0 THEN o_orderstatus ELSE 'n' END AS status_name, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE substr(o_orderpriority, 3) END AS detail_name,
    CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE 'lot' END AS lot_address, CASE WHEN o_orderkey % 8 = 0 THEN '1' END AS y, CASE WHEN o_custkey % 50 = 0 THEN cast(o_orderkey AS string) ELSE 'd' END AS permit_date,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE o_orderdate >= DATE '1998-01-01') t
WHERE place = 1""",
    # monthly counts by nation and segment, only months that occur
    "month_v": """
SELECT cast(date_trunc('month', o_orderdate) AS date) AS month, c_nationkey AS authority_code, c_mktsegment AS source_key, count(*) AS n
FROM {orders} JOIN {customer} ON o_custkey = c_custkey GROUP BY 1, 2, 3""",
    # coordinates, scaled from the first two components of the embeddings into a box
    "xy_v": """
SELECT vec_id, label, CASE WHEN vec_id % 11 = 0 THEN NULL ELSE 127.0 + 3 * cast({first} AS double) END AS x, CASE WHEN vec_id % 11 = 0 THEN NULL ELSE 36.0 + 3 * cast({second} AS double) END AS y
FROM {embeddings}""",
}
_SPARK_WORDS = {"first": "element_at(embedding, 1)", "second": "element_at(embedding, 2)"}
_DUCK_WORDS = {"first": "embedding[1]", "second": "embedding[2]"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _inputs(text: str) -> list[str]:
    return [x for x in dict.fromkeys(re.findall(r"\{(\w+)\}", text)) if x not in _SPARK_WORDS]


def bind(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table or view as a DataFrame."""
    if name in TABLES:
        return table(spark, sf_dir, name)
    text = VIEWS[name]
    for word, value in _SPARK_WORDS.items():
        text = text.replace("{" + word + "}", value)
    return spark.sql(text, **{x: bind(spark, sf_dir, x) for x in _inputs(text)})


def oracle(text: str) -> str:
    """DuckDB SQL: the query after the definitions of the views that it names."""
    order: list[str] = []

    def need(body: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b{name}\b", body) and name not in order:
                need(VIEWS[name])
                if name not in order:
                    order.append(name)

    need(text)
    plain = {x: x for x in (*TABLES, *VIEWS)} | _DUCK_WORDS
    views = [f"{name} AS ({VIEWS[name].format(**plain)})" for name in order]
    body = text.strip()
    if not views:
        return body
    return f"WITH {', '.join(views)}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {', '.join(views)} {body}"
