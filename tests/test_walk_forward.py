"""Fitted regressors over all folds: none is left out, and each is that of its own training rows."""

import datetime
from functools import partial

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import forecast as M
from sedimenta.plans import window_queries as Q

FOLDER = "/root/testdata/sf0.001"


def test_each_fold_has_its_own_models(spark):
    rows = [(f, i, "ab"[i % 2], float(i % 7), (i * f) % 5, i % 4 == 0) for f in (1, 2, 3) for i in range(60)]
    rows += [(4, i, "a", 1.0, 2, True) for i in range(3)]  # nothing to learn from
    df = spark.createDataFrame(rows, "fold int, id int, kind string, x double, y long, test boolean")
    train, test = df.where("NOT test"), df.where("test")
    out, models = M.walk_forward(train, test, "fold", ["poisson", "squared"], ["kind"], ["x"], "y", maxIter=3)
    assert out.columns == [*df.columns, "poisson", "squared"] and set(models) == {1, 2, 3}
    got = {(r.fold, r.id): (r.poisson, r.squared) for r in out.collect()}
    assert len(got) == test.count() and {got[4, i] for i in range(3)} == {(0.0, 0.0)}
    for f in (1, 2, 3):
        one, _ = M.fit_and_predict(train.where(F.col("fold") == f), test.where(F.col("fold") == f), ["poisson", "squared"], ["kind"], ["x"], "y", maxIter=3)
        for r in one.collect():
            assert got[f, r.id] == pytest.approx((r.poisson, r.squared))
    nothing, models = M.walk_forward(train.where("false"), test.where("false"), "fold", ["poisson"], ["kind"], ["x"], "y")
    assert nothing.columns[-1] == "poisson" and nothing.isEmpty() and models == {}


def test_frames_hold_every_fold_row_and_feature(spark):
    train, test, names = Q._model_frames(spark, FOLDER)
    panel = M.folds(Q._features(spark, FOLDER).where("lag_11 IS NOT NULL AND target_3m IS NOT NULL"), "month", "target_3m", Q._CUTOFFS)
    want = {(r.cutoff, r.role): r["count"] for r in panel.groupBy("cutoff", "role").count().collect()}
    assert {(r.cutoff, r.role): r["count"] for r in train.union(test).groupBy("cutoff", "role").count().collect()} == want and len(want) == 2 * len(Q._CUTOFFS)
    assert {*(f"lag_{k}" for k in Q._LAGS), "sum_3", "sum_6", "sum_12", "momentum", "year_over_year", "month_sin", "month_cos"} <= set(names)
    both = train.union(test)
    assert both.where(" OR ".join(f"{c} IS NULL" for c in names)).isEmpty()
    first = both.where("month = '1995-12-01'").first()  # 11 months are known before it
    assert (first.unknown, first.lag_12, first.lag_15, first.sum_12, first.year_over_year) == (6, 0, 0, 0, 0)
    assert both.where("month >= '1996-04-01' AND unknown > 0").isEmpty()


def test_learners_passes_do_not_grow_with_shuffle_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        train, test, _ = Q._model_frames(spark, FOLDER)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert train.rdd.getNumPartitions() == test.rdd.getNumPartitions() == 1


def test_models_and_importances_cover_all_folds(spark, monkeypatch):
    monkeypatch.setattr(M, "model_pipeline", partial(M.model_pipeline, maxIter=1))  # what is learned doesn't matter here
    got = {(str(r.cutoff), r.model): r for r in Q.m_models(spark, FOLDER).collect()}
    assert set(got) == {(c, m) for c in Q._CUTOFFS for m in ("poisson", "tweedie", "squared", "seasonal_naive_3m", "seasonal_ml_blend")}
    for r in Q.m_metrics(spark, FOLDER).where("model = 'naive'").collect():
        same = got[str(r.cutoff), "seasonal_naive_3m"]
        for measure in ("mae", "rmse", "wape", "top_capture", "top_lift"):
            assert same[measure] == pytest.approx(r[measure], abs=1e-6)
    sums = {r.cutoff: r.s for r in Q.m_importance(spark, FOLDER).groupBy("cutoff").agg(F.sum("importance").alias("s")).collect()}
    assert sums == {datetime.date.fromisoformat(c): pytest.approx(1.0) for c in Q._CUTOFFS}
