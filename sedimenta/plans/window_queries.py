"""Queries of episodes, panels, ranks and forecasting."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sedimenta.operators import build as B
from sedimenta.operators import episodes as E
from sedimenta.operators import forecast as M
from sedimenta.operators import windows as W
from sedimenta.plans.bindings import bind
from sedimenta.plans.registry import query
from sedimenta.session import durable, shared_dir
from sedimenta.streaming import keyed as K

START, END = "2020-01-01", "2030-12-31"
_STATE = ("source_status_code", "source_status_name", "source_detail_status_code", "source_detail_status_name")
_EPISODES = f"""
WITH o AS (SELECT *, row_number() OVER w AS rn, {', '.join(f'lag({c}) OVER w AS l{i}' for i, c in enumerate(_STATE))} FROM obs_v WINDOW w AS (PARTITION BY source_key, management_number ORDER BY observed_date)),
n AS (SELECT *, sum(CASE WHEN rn = 1 OR {' OR '.join(f'{c} IS DISTINCT FROM l{i}' for i, c in enumerate(_STATE))} THEN 1 ELSE 0 END) OVER (PARTITION BY source_key, management_number ORDER BY observed_date) AS e FROM o),
runs AS (SELECT source_key, management_number, CAST(e AS BIGINT) AS episode_number, min(observed_date) AS a, max(observed_date) AS b, count(*) AS n, {', '.join(f'first({c} ORDER BY observed_date) AS {c}' for c in _STATE)},
  first(source_closure_date ORDER BY observed_date) AS cf, first(source_closure_date_quality ORDER BY observed_date) AS qf, last(source_closure_date ORDER BY observed_date) AS cl, last(source_closure_date_quality ORDER BY observed_date) AS ql FROM n GROUP BY 1, 2, 3),
bounds AS (SELECT *, lag(b) OVER w AS lo, lead(a) OVER w AS hi FROM runs WINDOW w AS (PARTITION BY source_key, management_number ORDER BY episode_number)),
episodes AS (SELECT source_key, management_number, episode_number, DATE '{START}' AS observation_window_start_date, DATE '{END}' AS observation_window_end_date, a AS first_observed_date, b AS last_observed_date, n AS observation_count, {', '.join(_STATE)},
  lo AS start_boundary_lower_date, a AS start_boundary_upper_date, CASE WHEN lo IS NULL THEN 'LEFT_CENSORED' ELSE 'INTERVAL_CENSORED' END AS start_censoring, b AS end_boundary_lower_date, hi AS end_boundary_upper_date,
  CASE WHEN hi IS NULL THEN 'RIGHT_CENSORED' ELSE 'INTERVAL_CENSORED' END AS end_censoring, hi IS NULL AS right_censored, cf AS source_closure_date_first_observed, qf AS source_closure_date_first_quality, cl AS source_closure_date_last_observed, ql AS source_closure_date_last_quality FROM bounds)
"""


def _episodes(spark, sf):
    return E.episodes(bind(spark, sf, "obs_v"), START, END)


@query("w_episodes", _EPISODES + "SELECT * FROM episodes")
def w_episodes(spark, sf):
    """O-80, O-81"""
    return _episodes(spark, sf)


@query("w_episodes_stream", _EPISODES + "SELECT * FROM episodes")
def w_episodes_stream(spark, sf):
    """O-80 over a stream: the same observations in files of scattered days, some of them twice, by keyed state"""
    folder = f"{shared_dir(spark)}/episodes-{uuid.uuid4().hex}"
    obs = bind(spark, sf, "obs_v")
    again = obs.where("day(observed_date) % 7 = 0")  # these days arrive once more, in another file
    parts = obs.withColumn("part", F.abs(F.xxhash64("observed_date")) % 3).unionByName(again.withColumn("part", F.lit(3).cast("long")))
    parts.write.partitionBy("part").parquet(f"{folder}/parts")
    for part in (3, 1, 2, 0):  # one micro-batch each; days come in no order
        spark.read.schema(obs.schema).parquet(f"{folder}/parts/part={part}").write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(obs.schema).parquet(f"{folder}/in")
        K.follow_keyed_episodes(stream, f"{folder}/state", START, END, K.publisher(f"{folder}/out")).awaitTermination()
    return K.published(spark, f"{folder}/out")


@query("v_episodes", "SELECT unnest(['" + "', '".join(i.name for i in E.EPISODE_INVARIANTS) + "']) AS invariant, CAST(0 AS BIGINT) AS violations")
def v_episodes(spark, sf):
    """O-131: every rule holds for every episode"""
    return E.verify_episodes(_episodes(spark, sf))


@query("w_obs_invariants", """
SELECT CAST(sum(n) AS BIGINT) AS observation_count, count(*) FILTER (WHERE n > 1) AS repeated_days, CAST(sum(CASE WHEN d BETWEEN DATE '2020-01-01' AND DATE '2024-01-15' THEN 0 ELSE n END) AS BIGINT) AS outside_window,
  CAST(0 AS BIGINT) AS inconsistent_closure, CAST(0 AS BIGINT) AS blank_keys FROM (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1, 2)""")
def w_obs_invariants(spark, sf):
    """O-82, O-83: counters over all events, before one a day is chosen"""
    e = bind(spark, sf, "events")
    obs = e.select(F.lit("events").alias("source_key"), F.col("user_id").cast("string").alias("management_number"), F.to_date("ts").alias("observed_date"), F.lit(None).cast("date").alias("source_closure_date"), F.lit("MISSING").alias("source_closure_date_quality"))
    return E.observation_counters(obs, "2020-01-01", "2024-01-15")


@query("w_reversal", """
WITH s AS (SELECT *, lead(source_status_code) OVER w AS nx, lead(observed_date) OVER w AS nd, source_detail_status_code IS NOT DISTINCT FROM first(source_detail_status_code) OVER w AS same FROM obs_v WINDOW w AS (PARTITION BY source_key, management_number ORDER BY observed_date))
SELECT source_key, management_number, min(observed_date) FILTER (WHERE source_status_code = 'purchase' AND nx = 'view') AS last_before_date, min(nd) FILTER (WHERE source_status_code = 'purchase' AND nx = 'view') AS first_after_date, bool_and(same) AS identity_stable
FROM s GROUP BY 1, 2 HAVING count(*) FILTER (WHERE source_status_code = 'purchase' AND nx = 'view') > 0""")
def w_reversal(spark, sf):
    """O-84"""
    return E.first_reversal(bind(spark, sf, "obs_v"), "purchase", "view")


@query("w_candidate", "SELECT o_custkey AS id FROM orders WHERE o_orderkey = (SELECT min(o_orderkey) FROM orders)")
def w_candidate(spark, sf):
    """O-85: the one id whose status goes back"""
    first = bind(spark, sf, "orders").agg(F.min("o_orderkey").alias("o_orderkey"))
    one = bind(spark, sf, "orders").join(first, "o_orderkey").select(F.col("o_custkey").alias("id"))
    return E.sole_candidate(one.withColumn("s", F.lit("03")), one.withColumn("s", F.lit("01")), "id", "s", "03", "01")


_KEYS = ("authority_code", "source_key")
_PANEL = """
WITH span AS (SELECT min(month) AS a, max(month) AS b FROM month_v), months AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS month FROM span),
panel AS (SELECT m.month, k.authority_code, s.source_key, coalesce(v.n, 0) AS n FROM months m CROSS JOIN (SELECT DISTINCT authority_code FROM month_v) k CROSS JOIN (SELECT DISTINCT source_key FROM month_v) s
  LEFT JOIN month_v v ON v.month = m.month AND v.authority_code = k.authority_code AND v.source_key = s.source_key)
"""
_LAGS = (1, 2, 3, 4, 5, 6, 9, 10, 11, 12, 13, 14, 15)
_FEATURES = (
    _PANEL
    + ", f AS (SELECT *, "
    + ", ".join(f"lag(n, {k}) OVER w AS lag_{k}" for k in _LAGS)
    + ", "
    + ", ".join(f"CASE WHEN count(n) OVER w{k} = {k} THEN CAST(sum(n) OVER w{k} AS BIGINT) END AS sum_{k}" for k in (3, 6, 12))
    + ", lead(n, 1) OVER w + lead(n, 2) OVER w + lead(n, 3) OVER w AS target_3m FROM panel WINDOW w AS (PARTITION BY authority_code, source_key ORDER BY month)"
    + "".join(f", w{k} AS (PARTITION BY authority_code, source_key ORDER BY month ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)" for k in (3, 6, 12))
    + ") "
)


def _panel(spark, sf):
    return W.dense_panel(bind(spark, sf, "month_v"), "month", _KEYS, "n")


def _features(spark, sf):
    return W.lag_features(_panel(spark, sf), "month", _KEYS, "n", _LAGS)


@query("c_panel", _PANEL + "SELECT month, authority_code, source_key, n FROM panel")
def c_panel(spark, sf):
    """O-112"""
    return _panel(spark, sf)


@query("w_lags", _FEATURES + f"SELECT month, authority_code, source_key, n, {', '.join(f'lag_{k}' for k in _LAGS)} FROM f")
def w_lags(spark, sf):
    """O-86"""
    return _features(spark, sf).select("month", *_KEYS, "n", *[f"lag_{k}" for k in _LAGS])


@query("w_rolling", _FEATURES + "SELECT month, authority_code, source_key, sum_3, sum_6, sum_12 FROM f")
def w_rolling(spark, sf):
    """O-87"""
    return _features(spark, sf).select("month", *_KEYS, "sum_3", "sum_6", "sum_12")


@query("w_target", _FEATURES + "SELECT month, authority_code, source_key, target_3m FROM f")
def w_target(spark, sf):
    """O-88"""
    return _features(spark, sf).select("month", *_KEYS, "target_3m")


_NAIVE = "lag_9 + lag_10 + lag_11"


@query("w_derived", _FEATURES + f"SELECT month, authority_code, source_key, {_NAIVE} AS seasonal_naive_3m, lag_1 + lag_2 + lag_3 - lag_4 - lag_5 - lag_6 AS momentum, lag_1 - lag_13 AS year_over_year, round(sin(2 * pi() * month(month + INTERVAL 1 MONTH) / 12), 9) + 0.0::DOUBLE AS month_sin FROM f")
def w_derived(spark, sf):
    """O-89"""
    d = W.derived_features(_features(spark, sf), "month")
    return d.select("month", *_KEYS, "seasonal_naive_3m", "momentum", "year_over_year", F.round("month_sin", 9).alias("month_sin"))


_RANK = "100.0::DOUBLE * (rank() OVER (PARTITION BY c_mktsegment ORDER BY b) + (count(*) OVER (PARTITION BY c_mktsegment, b) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY c_mktsegment)"


@query("w_rank_pct", f"SELECT c_custkey, round({_RANK}, 6) AS rank_percent FROM (SELECT *, floor(c_acctbal / 100) AS b FROM customer)")
def w_rank_pct(spark, sf):
    """O-90"""
    c = bind(spark, sf, "customer").withColumn("b", F.floor(F.col("c_acctbal") / 100))
    return c.select("c_custkey", F.round(W.rank_percent("b", ["c_mktsegment"]), 6).alias("rank_percent"))


@query("w_topk", "SELECT c_mktsegment, c_custkey, c_acctbal, place FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer) WHERE place <= 10")
def w_topk(spark, sf):
    """O-91"""
    return W.top_k(bind(spark, sf, "customer").select("c_mktsegment", "c_custkey", "c_acctbal"), ["c_mktsegment"], [F.desc("c_acctbal"), F.asc("c_custkey")], 10)


@query("w_mode", "SELECT authority_code, detail_code, n FROM (SELECT authority_code, detail_code, count(*) AS n, row_number() OVER (PARTITION BY authority_code ORDER BY count(*) DESC, detail_code) AS p FROM permit_v WHERE detail_code IS NOT NULL GROUP BY 1, 2) WHERE p = 1")
def w_mode(spark, sf):
    """O-92"""
    return W.mode_by(bind(spark, sf, "permit_v"), "authority_code", "detail_code")


@query("w_max_gap", "SELECT authority_code, CAST(coalesce(max(g), 0) AS BIGINT) AS max_gap_days FROM (SELECT authority_code, permit_date - lag(permit_date) OVER (PARTITION BY authority_code ORDER BY permit_date) AS g FROM (SELECT DISTINCT authority_code, permit_date FROM permit_v)) GROUP BY 1")
def w_max_gap(spark, sf):
    """O-93"""
    return W.largest_gap(bind(spark, sf, "permit_v"), ["authority_code"], "permit_date")


@query("w_nearest_idx", """
WITH s AS (SELECT custkey AS code, count(*) AS total FROM permit_v GROUP BY 1), p AS (SELECT *, row_number() OVER (ORDER BY total, code) - 1 AS i, count(*) OVER () AS n FROM s),
q AS (SELECT * FROM (VALUES (0, 'q10', 0.1::DOUBLE), (1, 'q50', 0.5::DOUBLE), (2, 'q90', 0.9::DOUBLE)) AS t(o, label, q)),
hits AS (SELECT q.o, q.label, p.code, p.total FROM p JOIN q ON p.i = CAST(round_even((p.n - 1) * q.q, 0) AS BIGINT) UNION ALL SELECT 3, 'max', code, total FROM p WHERE i = n - 1)
SELECT label, code, total FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY o) AS k FROM hits) WHERE k = 1""")
def w_nearest_idx(spark, sf):
    """O-94"""
    scales = bind(spark, sf, "permit_v").groupBy(F.col("custkey").alias("code")).agg(F.count("*").alias("total"))
    return W.quantile_rows(scales, "total", "code")


@query("w_q90", "SELECT c_mktsegment, round(quantile_cont(c_acctbal, 0.9), 4) AS quantile FROM customer GROUP BY 1")
def w_q90(spark, sf):
    """O-95"""
    return W.quantile_by(bind(spark, sf, "customer"), ["c_mktsegment"], "c_acctbal", 0.9).select("c_mktsegment", F.round("quantile", 4).alias("quantile"))


_CUTOFFS = ("1996-06-01", "1996-09-01", "1996-12-01", "1997-03-01", "1997-06-01")
_FOLD_TABLE = "(VALUES " + ", ".join(f"(DATE '{c}')" for c in _CUTOFFS) + ") AS c(cutoff)"


@query("m_folds", _FEATURES + f"SELECT cutoff, CASE WHEN month = cutoff THEN 'TEST' ELSE 'TRAIN' END AS role, count(*) AS n FROM f JOIN {_FOLD_TABLE} ON (month <= cutoff - INTERVAL 3 MONTH AND target_3m IS NOT NULL) OR month = cutoff GROUP BY 1, 2")
def m_folds(spark, sf):
    """O-117"""
    return M.folds(_features(spark, sf), "month", "target_3m", _CUTOFFS).groupBy("cutoff", "role").agg(F.count("*").alias("n"))


@query("m_blend", _FEATURES + f"SELECT month, authority_code, source_key, round(0.7::DOUBLE * greatest(lag_1 - lag_2, 0) + 0.3::DOUBLE * greatest({_NAIVE}, 0), 6) AS blend FROM f WHERE lag_11 IS NOT NULL")
def m_blend(spark, sf):
    """O-119"""
    f = W.derived_features(_features(spark, sf), "month").where("lag_11 IS NOT NULL")
    return f.select("month", *_KEYS, F.round(M.blend((F.col("lag_1") - F.col("lag_2")).cast("double"), F.col("seasonal_naive_3m").cast("double")), 6).alias("blend"))


_TEST = _FEATURES + f", t AS (SELECT cutoff, authority_code, source_key, CAST(target_3m AS DOUBLE) AS y, CAST(greatest({_NAIVE}, 0) AS DOUBLE) AS naive, CAST(greatest(lag_1 * 3, 0) AS DOUBLE) AS last3 FROM f JOIN {_FOLD_TABLE} ON month = cutoff WHERE lag_11 IS NOT NULL AND target_3m IS NOT NULL), " + """
long AS (SELECT cutoff, authority_code, source_key, y, naive AS p, 'naive' AS model FROM t UNION ALL SELECT cutoff, authority_code, source_key, y, last3, 'last3' FROM t),
placed AS (SELECT *, row_number() OVER (PARTITION BY cutoff, model ORDER BY p DESC, authority_code, source_key) AS k, count(*) OVER (PARTITION BY cutoff, model) AS m FROM long),
scores AS (SELECT cutoff, model, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse, sum(abs(y - p)) / greatest(sum(y), 1) AS wape, coalesce(sum(y) FILTER (WHERE k <= greatest(1, ceil(m * 0.1::DOUBLE))), 0) / greatest(sum(y), 1) AS top_capture FROM placed GROUP BY 1, 2)
"""


def _scored(spark, sf):
    f = W.derived_features(_features(spark, sf), "month").where("lag_11 IS NOT NULL AND target_3m IS NOT NULL")
    test = M.folds(f, "month", "target_3m", _CUTOFFS).where("role = 'TEST'").withColumns({"naive": F.col("seasonal_naive_3m").cast("double"), "last3": (F.col("lag_1") * 3).cast("double")})
    return test, M.metrics(test, ["cutoff"], "target_3m", ["naive", "last3"], _KEYS)


@query("m_metrics", _TEST + "SELECT cutoff, model, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(wape, 6) AS wape, round(top_capture, 6) AS top_capture, round(top_capture / 0.1::DOUBLE, 6) AS top_lift FROM scores")
def m_metrics(spark, sf):
    """O-120"""
    scored = _scored(spark, sf)[1]
    return scored.select("cutoff", "model", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "wape", "top_capture", "top_lift")])


@query("m_best", _TEST + ", means AS (SELECT model, avg(wape) AS m FROM scores GROUP BY 1) SELECT arg_min(model, m) AS best, round(min(m), 6) AS best_value, round(max(m) FILTER (WHERE model = 'naive'), 6) AS baseline_value, round((max(m) FILTER (WHERE model = 'naive') - min(m)) / max(m) FILTER (WHERE model = 'naive'), 6) AS improvement FROM means")
def m_best(spark, sf):
    """O-121"""
    best = M.best_model(_scored(spark, sf)[1], "naive")
    return best.select("best", *[F.round(c, 6).alias(c) for c in ("best_value", "baseline_value", "improvement")])


@query("m_band", _TEST + """, w AS (SELECT source_key, quantile_cont(abs(y - naive), 0.9) AS band FROM t WHERE cutoff < DATE '1997-06-01' GROUP BY 1)
SELECT t.source_key, t.authority_code, round(greatest(naive - band, 0), 4) AS band_low, round(naive + band, 4) AS band_high, y BETWEEN greatest(naive - band, 0) AND naive + band AS covered FROM t JOIN w USING (source_key) WHERE cutoff = DATE '1997-06-01'""")
def m_band(spark, sf):
    """O-122"""
    test = _scored(spark, sf)[0]
    last = F.to_date(F.lit(_CUTOFFS[-1]))
    band = M.residual_band(test.where(F.col("cutoff") < last), test.where(F.col("cutoff") == last), "source_key", "target_3m", "naive")
    return band.select("source_key", "authority_code", F.round("band_low", 4).alias("band_low"), F.round("band_high", 4).alias("band_high"), "covered")


@query("m_seasonality", "SELECT CAST(month(month) AS BIGINT) AS month_of_year, source_key, round(avg(n), 6) AS mean_value FROM month_v GROUP BY 1, 2")
def m_seasonality(spark, sf):
    """O-124"""
    return M.seasonality(bind(spark, sf, "month_v"), "month", "source_key", "n").withColumn("mean_value", F.round("mean_value", 6))


_LEARNERS, _CATEGORIES = ("poisson", "tweedie", "squared"), ("authority_code", "source_key")


def _model_frames(spark, sf):
    """(training rows, test rows, features) of all folds: every row that has the baseline and its target, and every feature.

    What lies before the panel's first month is 0 in a feature, and `unknown` counts such features of the row.
    """
    names = [f"lag_{k}" for k in _LAGS] + ["sum_3", "sum_6", "sum_12", "seasonal_naive_3m", "momentum", "year_over_year", "month_sin", "month_cos"]
    f = W.derived_features(_features(spark, sf), "month").where("seasonal_naive_3m IS NOT NULL AND target_3m IS NOT NULL")
    f = f.withColumn("unknown", sum(F.col(c).isNull().cast("int") for c in names)).na.fill(0, names)
    both = durable(M.folds(f, "month", "target_3m", _CUTOFFS))
    both = durable(both.coalesce(1 + both.count() // 100_000))  # learners read it again for each pass, in tasks by its rows and not by the session's shuffles
    return both.where("role = 'TRAIN'"), both.where("role = 'TEST'"), [*names, "unknown"]


@query("m_models")
def m_models(spark, sf):
    """O-118: metrics of fitted regressors next to the baseline in every fold; no oracle, the numbers depend on the learner"""
    train, test, names = _model_frames(spark, sf)
    out, _ = M.walk_forward(train, test, "cutoff", _LEARNERS, _CATEGORIES, names, "target_3m")
    out = durable(out.withColumn("seasonal_ml_blend", M.blend(F.col("poisson"), F.col("seasonal_naive_3m").cast("double"))))
    return M.metrics(out, ["cutoff"], "target_3m", [*_LEARNERS, "seasonal_naive_3m", "seasonal_ml_blend"], _KEYS)


_NINE = ("1998-03-01", "1998-06-01", "1998-09-01", "1998-12-01", "1999-03-01", "1999-06-01", "1999-09-01", "1999-12-01", "2000-03-01")
_HOLDOUT = "2000-09-01"


def _boosted(spark, sf):
    """(rows with forecasts, trees, features) of Poisson and Tweedie counts over nine folds and a holdout, all grown together."""
    from sedimenta.operators import boosting as T

    cutoffs, powers = [*_NINE, _HOLDOUT], {"poisson": 1.0, "tweedie": 1.3}
    f = W.derived_features(_features(spark, sf), "month").where("lag_12 IS NOT NULL")
    names = [f"lag_{k}" for k in (1, 2, 3, 12)] + ["sum_12", "seasonal_naive_3m", "momentum", "month_sin", "month_cos", "nation"]
    rows = M.folds(f, "month", "target_3m", cutoffs).select("cutoff", "month", *_KEYS, "target_3m", *names[:-1], F.col("authority_code").cast("int").alias("nation"), (F.col("role") == "TRAIN").alias("learn"))
    at = F.array_position(F.lit(list(cutoffs)), F.col("cutoff").cast("string")).cast("int") - 1
    rows = durable(rows).withColumn("loss", F.explode(F.lit(list(powers)))).withColumn("fit", at * len(powers) + F.array_position(F.lit(list(powers)), F.col("loss")).cast("int") - 1)
    out, trees = T.grow(rows, names, "target_3m", "fit", "learn", list(powers.values()) * len(cutoffs), T.Growth(trees=8))
    return out, trees, names


@query("m_boosted")
def m_boosted(spark, sf):
    """O-118: boosted Poisson and Tweedie counts and their blend over nine folds and a holdout; tested against a plain fit"""
    out, _, _ = _boosted(spark, sf)
    test = out.where("NOT learn AND target_3m IS NOT NULL").groupBy("cutoff", *_KEYS, "target_3m", "seasonal_naive_3m").pivot("loss", ["poisson", "tweedie"]).agg(F.first("prediction"))
    test = test.withColumn("seasonal_naive_3m", F.col("seasonal_naive_3m").cast("double"))
    test = test.withColumn("seasonal_ml_blend", M.blend(F.col("poisson"), F.col("seasonal_naive_3m")))
    scores = M.metrics(test, ["cutoff"], "target_3m", ["poisson", "tweedie", "seasonal_naive_3m", "seasonal_ml_blend"], _KEYS)
    return scores.withColumn("role", F.when(F.col("cutoff") == F.to_date(F.lit(_HOLDOUT)), "HOLDOUT").otherwise("FOLD"))


@query("m_contributions")
def m_contributions(spark, sf):
    """O-123: mean absolute Shapley value of each feature in the forecasts of each fold and loss; tested against the definition"""
    from sedimenta.operators import contributions as C

    out, trees, names = _boosted(spark, sf)
    return C.mean_contributions(C.contributions(trees, out.where("NOT learn"), names, "fit"), names, ["cutoff", "loss"])


@query("m_importance")
def m_importance(spark, sf):
    """O-123: importances of the boosted model of each fold; no oracle"""
    train, test, names = _model_frames(spark, sf)
    _, models = M.walk_forward(train, test, "cutoff", ["squared"], _CATEGORIES, names, "target_3m")
    found = [(cutoff, *row) for cutoff, m in models.items() for row in M.importances(m["squared"], train)]
    return spark.createDataFrame(found, "cutoff date, feature string, importance double")


@query("v_cells", """
WITH c AS (SELECT authority_code, status_code, count(*) AS cell_count FROM permit_v GROUP BY ALL HAVING count(*) >= 10)
SELECT count(*) FILTER (WHERE cell_count < 10) AS below_k, count(*) AS cells, CAST(coalesce(sum(cell_count), 0) AS BIGINT) AS rows, true AS rows_match FROM c""")
def v_cells(spark, sf):
    """O-129"""
    from sedimenta.operators.cells import k_anonymous_cells, suppression

    p, keys = bind(spark, sf, "permit_v"), ["authority_code", "status_code"]
    totals = suppression(p, keys).first()
    return B.verify_cells(k_anonymous_cells(p, keys), totals.rows_total, totals.rows_released)


@query("v_release", "SELECT CAST(count(*) AS BIGINT) AS rows_a, CAST(count(*) AS BIGINT) AS rows_b, CAST(0 AS BIGINT) AS only_a, CAST(0 AS BIGINT) AS only_b FROM customer")
def v_release(spark, sf):
    """O-132: a CSV round trip holds the same rows as its Parquet source"""
    from sedimenta.plans.profile_queries import s_csv_round_trip

    csv = s_csv_round_trip(spark, sf)
    return B.same_rows(csv, bind(spark, sf, "customer").select(*csv.columns))


_HURT = {"episode_number": "u % 5 = 0", "observation_count": "u % 7 = 0", "window_start": "u % 11 = 0", "window_end": "u % 13 = 0", "start_upper": "u % 17 = 0", "start_order": "u % 17 = 0 AND u % 19 <> 0 AND start_censoring = 'INTERVAL_CENSORED'",
  "start_label": "u % 19 = 0", "right_open": "u % 23 = 0 AND end_censoring = 'RIGHT_CENSORED'", "end_order": "u % 23 = 0 AND end_censoring = 'INTERVAL_CENSORED'"}


@query("v_damaged_episodes", _EPISODES + ", d AS (SELECT *, CAST(management_number AS BIGINT) AS u FROM episodes) " + " UNION ALL ".join(f"SELECT '{i.name}' AS invariant, count(*) FILTER (WHERE {_HURT.get(i.name, 'false')}) AS violations FROM d" for i in E.EPISODE_INVARIANTS))
def v_damaged_episodes(spark, sf):
    """O-131 over episodes that were damaged by a rule on the permit's number: each rule finds its rows"""
    u = F.col("management_number").cast("long")
    hurt = lambda n, column, value: F.when(u % n == 0, value).otherwise(F.col(column))
    damage = {
        "episode_number": hurt(5, "episode_number", F.lit(0)),
        "observation_count": hurt(7, "observation_count", F.lit(0)),
        "observation_window_start_date": hurt(11, "observation_window_start_date", F.date_add("first_observed_date", 1)),
        "observation_window_end_date": hurt(13, "observation_window_end_date", F.date_sub("last_observed_date", 1)),
        "start_boundary_upper_date": hurt(17, "start_boundary_upper_date", F.lit(None).cast("date")),
        "start_censoring": hurt(19, "start_censoring", F.lit("OPEN")),
        "right_censored": hurt(23, "right_censored", ~F.col("right_censored")),
    }
    return E.verify_episodes(_episodes(spark, sf).withColumns(damage))


@query("v_damaged_release", """
WITH a AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 1 THEN upper(c_mktsegment) || '!' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 7 <> 0 UNION ALL SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 13 = 2),
b AS (SELECT c_custkey, c_mktsegment FROM customer)
SELECT (SELECT count(*) FROM a) AS rows_a, (SELECT count(*) FROM b) AS rows_b, (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS only_a, (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS only_b""")
def v_damaged_release(spark, sf):
    """O-132 over a release with rows that are lost, changed and repeated"""
    whole = bind(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    k = F.col("c_custkey")
    changed = whole.where(k % 7 != 0).withColumn("c_mktsegment", F.when(k % 11 == 1, F.concat(F.upper("c_mktsegment"), F.lit("!"))).otherwise(F.col("c_mktsegment")))
    return B.same_rows(changed.unionByName(whole.where(k % 13 == 2)), whole)
