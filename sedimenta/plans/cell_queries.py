"""Queries of counts, shares, joins and domains."""

from __future__ import annotations

from pyspark.sql import functions as F

from sedimenta.operators import cells as C
from sedimenta.operators import joins as J
from sedimenta.plans.bindings import bind
from sedimenta.plans.registry import query

_KEYS = ("authority_code", "status_code")
_CELLS = "SELECT authority_code, status_code, CAST(year(permit_date) AS BIGINT) AS permit_year, CAST(year(closure_date) AS BIGINT) AS closure_year, count(*) AS cell_count FROM permit_v GROUP BY ALL"


_ROLLUP = """
WITH permits AS (SELECT c_mktsegment AS source_key, lpad(CAST(c_nationkey AS VARCHAR), 7, '0') AS authority_code, o_orderstatus || CAST(o_orderkey % 7 AS VARCHAR) AS status_code FROM orders JOIN customer ON o_custkey = c_custkey),
cells AS (SELECT source_key, authority_code, status_code, 3 - bit_count(grouping(source_key, authority_code, status_code)::INT) AS level, count(*) AS n, count(*) < 10 AS low FROM permits GROUP BY GROUPING SETS ((source_key, authority_code, status_code), (source_key, authority_code), (source_key), ())),
s0 AS (SELECT *, false AS more FROM cells WHERE level = 0),
l1 AS (SELECT c.*, p.low OR p.more AS up, count(*) FILTER (WHERE c.low) OVER () AS hidden, row_number() OVER (ORDER BY c.low, c.n, c.source_key) AS place FROM cells c CROSS JOIN s0 p WHERE c.level = 1),
s1 AS (SELECT source_key, authority_code, status_code, level, n, low, NOT low AND hidden + up::INT = 1 AND place = 1 AS more FROM l1),
l2 AS (SELECT c.*, p.low OR p.more AS up, count(*) FILTER (WHERE c.low) OVER w AS hidden, row_number() OVER (w ORDER BY c.low, c.n, c.authority_code) AS place FROM cells c JOIN s1 p ON c.source_key = p.source_key WHERE c.level = 2 WINDOW w AS (PARTITION BY c.source_key)),
s2 AS (SELECT source_key, authority_code, status_code, level, n, low, NOT low AND hidden + up::INT = 1 AND place = 1 AS more FROM l2),
l3 AS (SELECT c.*, p.low OR p.more AS up, count(*) FILTER (WHERE c.low) OVER w AS hidden, row_number() OVER (w ORDER BY c.low, c.n, c.status_code) AS place FROM cells c JOIN s2 p ON c.source_key = p.source_key AND c.authority_code = p.authority_code WHERE c.level = 3 WINDOW w AS (PARTITION BY c.source_key, c.authority_code)),
s3 AS (SELECT source_key, authority_code, status_code, level, n, low, NOT low AND hidden + up::INT = 1 AND place = 1 AS more FROM l3)
SELECT source_key, authority_code, status_code, CAST(level AS INT) AS level, CASE WHEN NOT low AND NOT more THEN n END AS cell_count, CASE WHEN low THEN 'SUPPRESSED' WHEN more THEN 'COMPLEMENT' ELSE 'RELEASED' END AS status
FROM (SELECT * FROM s0 UNION ALL SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3)"""


@query("a_rollup_cells", _ROLLUP)
def a_rollup_cells(spark, sf):
    """O-56, O-57 over all levels of the cell keys, with further cells hidden so that no hidden one follows"""
    p = bind(spark, sf, "permit_v").select("source_key", "authority_code", F.concat("status_code", (F.col("row_key") % 7).cast("string")).alias("status_code"))
    return C.rollup_cells(p, ["source_key", "authority_code", "status_code"])


def _cell_keys():
    return [*_KEYS, F.year("permit_date").cast("long").alias("permit_year"), F.year("closure_date").cast("long").alias("closure_year")]


def flagship(spark, sf):
    """k-anonymous permits by region, status and year."""
    nation = bind(spark, sf, "nation").select(F.col("n_nationkey").alias("nationkey"), F.col("n_regionkey").alias("region"))
    permits = bind(spark, sf, "permit_v").join(nation, "nationkey")
    return C.k_anonymous_cells(permits, ["region", "status_code", F.year("permit_date").cast("long").alias("permit_year")])


@query("a_kanon_cells", f"SELECT * FROM ({_CELLS}) WHERE cell_count >= 10")
def a_kanon_cells(spark, sf):
    """O-56"""
    return C.k_anonymous_cells(bind(spark, sf, "permit_v"), _cell_keys(), 10)


@query("a_kanon_region", "SELECT n_regionkey AS region, status_code, CAST(year(permit_date) AS BIGINT) AS permit_year, count(*) AS cell_count FROM permit_v JOIN nation ON nationkey = n_nationkey GROUP BY ALL HAVING count(*) >= 10")
def a_kanon_region(spark, sf):
    """O-56, the flagship"""
    return flagship(spark, sf)


@query("a_suppression", f"""
SELECT count(*) AS cells_total, count(*) FILTER (WHERE cell_count >= 10) AS cells_released, count(*) FILTER (WHERE cell_count < 10) AS cells_suppressed, CAST(coalesce(sum(cell_count), 0) AS BIGINT) AS rows_total,
  CAST(coalesce(sum(cell_count) FILTER (WHERE cell_count >= 10), 0) AS BIGINT) AS rows_released, CAST(coalesce(sum(cell_count) FILTER (WHERE cell_count < 10), 0) AS BIGINT) AS rows_suppressed FROM ({_CELLS})""")
def a_suppression(spark, sf):
    """O-57"""
    return C.suppression(bind(spark, sf, "permit_v"), _cell_keys(), 10)


@query("a_group_count", "SELECT source_key, status_code, count(*) AS n FROM permit_v GROUP BY ALL")
def a_group_count(spark, sf):
    """O-58"""
    return C.group_counts(bind(spark, sf, "permit_v"), ["source_key", "status_code"])


@query("a_group_count_filled", "SELECT road_address, count(road_address) AS n FROM raw_v GROUP BY ALL")
def a_group_count_filled(spark, sf):
    """O-58: counting the key itself gives the null group 0"""
    return C.group_counts(bind(spark, sf, "raw_v"), ["road_address"], "road_address")


@query("a_year_hist", "SELECT CAST(year(closure_date) AS BIGINT) AS year, count(*) AS n FROM permit_v WHERE closure_date IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 5")
def a_year_hist(spark, sf):
    """O-59: the last five years, which is the report"""
    return C.year_histogram(bind(spark, sf, "permit_v"), "closure_date", 5)


@query("a_share", "SELECT n_regionkey, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 4) AS share_percent FROM permit_v JOIN nation ON nationkey = n_nationkey GROUP BY 1")
def a_share(spark, sf):
    """O-60"""
    nation = bind(spark, sf, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_regionkey")
    return C.share_of_total(bind(spark, sf, "permit_v").join(nation, "nationkey"), "n_regionkey")


@query("a_row_pivot", "SELECT authority_code, source_key, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY authority_code), 4) AS share_percent FROM permit_v GROUP BY 1, 2")
def a_row_pivot(spark, sf):
    """O-61, long form"""
    return C.row_shares(bind(spark, sf, "permit_v"), "authority_code", "source_key")


@query("a_pivot_wide", "SELECT authority_code, " + ", ".join(f"round(100.0::DOUBLE * count(*) FILTER (WHERE status_code = '{s}') / count(*) FILTER (WHERE status_code IN ('F', 'O', 'P')), 4) AS \"{s}\"" for s in "FOP") + " FROM permit_v GROUP BY 1")
def a_pivot_wide(spark, sf):
    """O-61, wide form"""
    return C.pivot_shares(bind(spark, sf, "permit_v"), "authority_code", "status_code", ["F", "O", "P"])


_SCREEN = """
SELECT authority_code, count(*) AS n, round(100.0::DOUBLE * count(*) FILTER (WHERE year(permit_date) BETWEEN 1996 AND 1997) / count(*), 4) AS recent_percent,
  round(100.0::DOUBLE * count(*) FILTER (WHERE px IS NOT NULL AND py IS NOT NULL) / count(*), 4) AS coordinate_percent,
  round(100.0::DOUBLE * count(*) FILTER (WHERE s = 'O') / nullif(count(s), 0), 4) AS active_percent, round(100.0::DOUBLE * count(*) FILTER (WHERE source_key = 'BUILDING') / count(*), 4) AS building_percent,
  round(100.0::DOUBLE * count(*) FILTER (WHERE source_key = 'MACHINERY') / count(*), 4) AS machinery_percent
FROM (SELECT *, CASE WHEN row_key % 4 > 0 THEN price END AS px, CASE WHEN row_key % 3 > 0 THEN price END AS py, nullif(status_code, 'P') AS s FROM permit_v) GROUP BY 1"""


def _screen(spark, sf):
    k = F.col("row_key")
    p = bind(spark, sf, "permit_v").withColumns({"px": F.when(k % 4 > 0, F.col("price")), "py": F.when(k % 3 > 0, F.col("price")), "s": F.nullif(F.col("status_code"), F.lit("P"))})
    return C.region_screen(p, "authority_code", "permit_date", (1996, 1997), "s", "O", "source_key", ("BUILDING", "MACHINERY"), "px", "py")


@query("a_screening", _SCREEN)
def a_screening(spark, sf):
    """O-65: one pass for O-62, O-63 and O-64"""
    return _screen(spark, sf)


@query("a_recent_share", f"SELECT authority_code, recent_percent FROM ({_SCREEN})")
def a_recent_share(spark, sf):
    """O-62"""
    return _screen(spark, sf).select("authority_code", "recent_percent")


@query("a_coverage", f"SELECT authority_code, coordinate_percent FROM ({_SCREEN})")
def a_coverage(spark, sf):
    """O-63"""
    return _screen(spark, sf).select("authority_code", "coordinate_percent")


@query("a_status_share", f"SELECT authority_code, active_percent FROM ({_SCREEN})")
def a_status_share(spark, sf):
    """O-64: rows without a status are not part of the whole"""
    return _screen(spark, sf).select("authority_code", "active_percent")


@query("a_freshness", "SELECT source_key, max(permit_date) AS latest FROM permit_v GROUP BY 1")
def a_freshness(spark, sf):
    """O-66"""
    return C.freshness(bind(spark, sf, "permit_v"), "source_key", "permit_date")


@query("a_distinct_sets", "SELECT source_key, count(DISTINCT authority_code) AS n_values, count(DISTINCT authority_code) = (SELECT count(DISTINCT authority_code) FROM permit_v) AS has_all FROM permit_v GROUP BY 1")
def a_distinct_sets(spark, sf):
    """O-67"""
    return C.distinct_sets(bind(spark, sf, "permit_v"), "source_key", "authority_code")


@query("a_page_cost", "SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS group_count, CAST(sum(ceil(n / 100.0)) AS BIGINT) AS pages FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey)")
def a_page_cost(spark, sf):
    """O-68"""
    return C.page_cost(bind(spark, sf, "lineitem"), "l_suppkey")


@query("a_page_bounds", "SELECT source_key, n, g, greatest(g, CAST(ceil(n / 100.0) AS BIGINT)) AS pages_least, greatest(g, CAST(ceil(n / 100.0) AS BIGINT)) + g - 1 AS pages_most FROM (SELECT source_key, count(*) AS n, count(DISTINCT authority_code) AS g FROM permit_v GROUP BY 1)")
def a_page_bounds(spark, sf):
    """O-69"""
    by = bind(spark, sf, "permit_v").groupBy("source_key").agg(F.count("*").alias("n"), F.count_distinct("authority_code").alias("g"))
    low, high = C.page_bounds(F.col("n"), F.col("g"))
    return by.withColumns({"pages_least": low, "pages_most": high})


@query("j_left_dim", "SELECT authority_code, n_name, count(*) AS n FROM permit_v LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 3 > 0) d ON nationkey = n_nationkey GROUP BY 1, 2")
def j_left_dim(spark, sf):
    """O-71"""
    dim = bind(spark, sf, "nation").where("n_nationkey % 3 > 0").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    return bind(spark, sf, "permit_v").join(dim, "nationkey", "left").groupBy("authority_code", "n_name").agg(F.count("*").alias("n"))


def _domain(spark, sf):
    codes = bind(spark, sf, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 7, "0").alias("code"), F.col("n_nationkey").alias("k"))
    current, new, deleted = codes.where("k < 20"), codes.where("k < 20 AND k % 4 = 0"), codes.where("k >= 20")
    return current, new, deleted, J.effective_domain(current, new, deleted, "code", "1998-01-01")


_DOMAIN = "(SELECT lpad(CAST(n_nationkey AS VARCHAR), 7, '0') AS code, CASE WHEN n_nationkey < 20 AND n_nationkey % 4 = 0 THEN DATE '1998-01-01' END AS valid_from, CASE WHEN n_nationkey >= 20 THEN DATE '1998-01-01' END AS valid_to FROM nation)"


@query("j_asof_domain", f"SELECT permit_date, code FROM (SELECT DISTINCT permit_date FROM permit_v) JOIN {_DOMAIN} d ON (valid_from IS NULL OR valid_from <= permit_date) AND (valid_to IS NULL OR permit_date < valid_to)")
def j_asof_domain(spark, sf):
    """O-72"""
    dates = bind(spark, sf, "permit_v").select("permit_date").distinct()
    return J.active_at(dates, "permit_date", _domain(spark, sf)[3])


@query("j_set_algebra", """
SELECT coalesce(a.code, b.code) AS code, a.code IS NOT NULL AS in_official, b.code IS NOT NULL AS in_observed
FROM (SELECT DISTINCT n_nationkey AS code FROM nation WHERE n_nationkey % 5 > 0) a FULL JOIN (SELECT DISTINCT c_nationkey AS code FROM customer WHERE c_acctbal > 5000) b ON a.code = b.code""")
def j_set_algebra(spark, sf):
    """O-73"""
    official = bind(spark, sf, "nation").where("n_nationkey % 5 > 0").select(F.col("n_nationkey").alias("code"))
    observed = bind(spark, sf, "customer").where("c_acctbal > 5000").select(F.col("c_nationkey").alias("code"))
    return J.domain_balance(official, observed, "code")


@query("j_in_all_sources", "SELECT l_suppkey, CAST(count(*) AS BIGINT) AS total_rows FROM lineitem WHERE l_suppkey % 10 > 0 GROUP BY 1 HAVING count(DISTINCT l_returnflag) = (SELECT count(DISTINCT l_returnflag) FROM lineitem)")
def j_in_all_sources(spark, sf):
    """O-74"""
    exclude = bind(spark, sf, "supplier").where("s_suppkey % 10 = 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return J.in_all_sources(bind(spark, sf, "lineitem"), "l_returnflag", "l_suppkey", exclude)


@query("j_exchange", "SELECT count(*) FILTER (WHERE n_nationkey >= 20) AS codes_out, count(*) FILTER (WHERE n_nationkey < 20 AND n_nationkey % 4 = 0) AS codes_in FROM nation")
def j_exchange(spark, sf):
    """O-75"""
    domain = _domain(spark, sf)[3]
    return J.exchange(domain.where("valid_from IS NULL"), domain.where("valid_to IS NULL"), "code")


_TASKS = f"SELECT s.source_key, d.observed_date, c.code FROM (VALUES (DATE '1997-12-01'), (DATE '1998-01-01'), (DATE '1998-02-01')) AS d(observed_date), (SELECT DISTINCT c_mktsegment AS source_key FROM customer) s, {_DOMAIN} c WHERE (valid_from IS NULL OR valid_from <= observed_date) AND (valid_to IS NULL OR observed_date < valid_to)"


def _tasks(spark, sf):
    dates = spark.sql("SELECT * FROM VALUES (DATE'1997-12-01'), (DATE'1998-01-01'), (DATE'1998-02-01') AS t(observed_date)")
    sources = bind(spark, sf, "customer").select(F.col("c_mktsegment").alias("source_key")).distinct()
    return J.task_list(dates, "observed_date", sources, _domain(spark, sf)[3]).select("source_key", "observed_date", "code")


@query("j_tasks", _TASKS)
def j_tasks(spark, sf):
    """O-76"""
    return _tasks(spark, sf)


_DONE = "(substr(code, 7, 1) IN ('1', '3', '7') AND observed_date = DATE '1998-01-01')"


@query("j_pending", f"SELECT * FROM ({_TASKS}) WHERE NOT {_DONE}")
def j_pending(spark, sf):
    """O-77"""
    planned = _tasks(spark, sf)
    return J.pending(planned, planned.where(_DONE), ["source_key", "observed_date", "code"])


@query("d_coverage", f"SELECT count(*) AS expected, count(*) FILTER (WHERE NOT {_DONE}) AS actual, count(*) FILTER (WHERE {_DONE}) AS missing, CAST(0 AS BIGINT) AS unexpected, CAST(0 AS BIGINT) AS repeated FROM ({_TASKS})")
def d_coverage(spark, sf):
    """O-105"""
    planned = _tasks(spark, sf)
    return J.coverage(planned, planned.where(f"NOT {_DONE}"), ["source_key", "observed_date", "code"])


_LINK = """
SELECT (SELECT count(*) FROM p LEFT JOIN s ON p.k = s.k WHERE s.k IS NULL) AS without_sidecar, (SELECT count(*) FROM s LEFT JOIN p ON p.k = s.k WHERE p.k IS NULL) AS without_parent,
  (SELECT count(*) FROM p FULL JOIN s ON p.k = s.k) AS linked_rows, (SELECT count(*) FROM p) AS parent_rows, (SELECT CAST(max(k) - count(*) AS BIGINT) FROM p) AS beyond_last, (SELECT count(*) - count(DISTINCT k) FROM p) AS repeated_numbers"""


@query("j_sidecar", "WITH p AS (SELECT c_custkey AS k FROM customer), s AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 100 > 0)" + _LINK)
def j_sidecar(spark, sf):
    """O-78"""
    c = bind(spark, sf, "customer").select("c_custkey", "c_name")
    return J.sidecar_linkage(c, c.where("c_custkey % 100 > 0"), ["c_custkey", "c_name"], "c_custkey")


@query("j_three_way", """
SELECT a.source_key, a.n, b.latest, c.total FROM (SELECT source_key, count(*) AS n FROM permit_v GROUP BY 1) a JOIN (SELECT source_key, max(permit_date) AS latest FROM permit_v GROUP BY 1) b USING (source_key)
JOIN (SELECT source_key, round(sum(price), 1) AS total FROM permit_v GROUP BY 1) c USING (source_key)""")
def j_three_way(spark, sf):
    """O-79"""
    by = bind(spark, sf, "permit_v").groupBy("source_key")
    return J.merge_summaries("source_key", by.agg(F.count("*").alias("n")), by.agg(F.max("permit_date").alias("latest")), by.agg(F.round(F.sum("price"), 1).alias("total")))
