"""Boosted counts against a plain numpy fit of the same bins, and against the linear models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.operators import boosting as B
from sedimenta.operators.forecast import model_pipeline

GROWTH = B.Growth(trees=4, depth=2, bins=8, least_rows=15)


def table(spark, n=900, seed=4):
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(size=n), rng.integers(0, 4, n), rng.normal(size=n)
    y = rng.poisson(np.exp(0.3 + 1.2 * (a > 0.5) * (b == 2) + 0.6 * (c < -0.2)))
    rows = [(i, float(a[i]) if i % 17 else None, int(b[i]), float(c[i]), int(y[i]) if i % 29 else None, i % 5 != 0) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, a double, b int, c double, y long, learn boolean")
    return df.withColumn("model", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("prediction_of_another", F.lit("x"))


def plain_fit(rows, edges, power, growth):
    """Splits and forecasts of one group, row by row."""
    x = np.array([[0 if v is None else 1 + sum(e < v for e in edges[k]) for k, v in enumerate((r.a, r.b, r.c))] for r in rows])
    learn = np.array([r.learn and r.y is not None for r in rows])
    y = np.array([r.y if r.y is not None else 0 for r in rows], float)
    margin = np.full(len(rows), np.log(y[learn].mean()))
    splits = []
    for _ in range(growth.trees):
        g = np.exp((2 - power) * margin) - y * np.exp((1 - power) * margin)
        h = (2 - power) * np.exp((2 - power) * margin) - (1 - power) * y * np.exp((1 - power) * margin)
        add = np.zeros(len(rows))

        def split(at, level, g=g, h=h, add=add):
            own = at & learn
            score = lambda m: g[m].sum() ** 2 / (h[m].sum() + growth.ridge)
            best, cut = 1e-9, None
            for f in range(3):
                for b in range(growth.bins + 1):
                    left, right = own & (x[:, f] <= b), own & (x[:, f] > b)
                    if min(left.sum(), right.sum()) >= growth.least_rows and (gain := score(left) + score(right) - score(own)) > best * (1 + 1e-9):
                        best, cut = gain, (f, b)
            if cut is None or level == growth.depth:
                add[at] = -growth.shrink * g[own].sum() / (h[own].sum() + growth.ridge)
                return
            splits.append(cut)
            split(at & (x[:, cut[0]] <= cut[1]), level + 1)
            split(at & (x[:, cut[0]] > cut[1]), level + 1)

        split(np.ones(len(rows), bool), 0)
        margin = margin + add
    return splits, np.exp(margin)


def test_same_trees_as_a_plain_fit(spark):
    df = table(spark).repartition(5)
    out, fitted = B.grow(df, ["a", "b", "c"], "y", "model", "learn", [1.0, 1.3], GROWTH)
    assert out.columns == [*df.columns, "prediction"]
    for model, power in enumerate((1.0, 1.3)):
        rows = out.where(F.col("model") == model).orderBy("id").collect()
        splits, forecasts = plain_fit(rows, fitted.edges, power, GROWTH)
        got = []
        for tree in fitted.trees:
            for i in (1, 2, 3):
                if tree.cut[model, i] <= GROWTH.bins:
                    got.append((int(tree.feature[model, i]), int(tree.cut[model, i])))
        assert got == splits
        assert np.allclose([r.prediction for r in rows], forecasts)
    again = B.predict(fitted, df, ["a", "b", "c"], "model").orderBy("model", "id").collect()
    assert np.allclose([r.prediction for r in again], [r.prediction for r in out.orderBy("model", "id").collect()])


def test_better_than_linear(spark):
    df = table(spark, 3000, 9).where("model = 0").na.drop()
    out, _ = B.grow(df, ["a", "b", "c"], "y", "model", "learn", [1.0], B.Growth(trees=10))
    train, test = df.where("learn"), out.where("NOT learn")
    linear = model_pipeline("poisson", [], ["a", "b", "c"], "y").fit(train).transform(test.drop("prediction"))
    y = F.col("y").cast("double")
    boosted, plain = test.agg(B.deviance(y, F.col("prediction"), 1)).first()[0], linear.agg(B.deviance(y, F.col("prediction"), 1)).first()[0]
    assert boosted < 0.95 * plain


def test_odd_groups(spark):
    df = spark.createDataFrame([(0, 1.0, 3, True), (0, None, 0, True), (1, 2.0, None, True), (0, float("nan"), None, False)], "model int, a double, y int, learn boolean")
    out, _ = B.grow(df, ["a"], "y", "model", "learn", [1.0, 1.5], GROWTH)
    assert sorted((r.model, round(r.prediction, 6)) for r in out.collect()) == [(0, 1.5), (0, 1.5), (0, 1.5), (1, 0.0)]
    with pytest.raises(ValueError, match="negative"):
        B.grow(df.withColumn("y", F.lit(-1)), ["a"], "y", "model", "learn", [1.0, 1.5], GROWTH)


def test_learners_read_the_panel_once(spark):
    """The panel is kept, so no pass of a learner joins or broadcasts the tables anew."""
    from sedimenta.plans.window_queries import _model_frames

    for frame in _model_frames(spark, "/root/testdata/sf0.001")[:2]:
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Relation" not in plan and frame.columns
