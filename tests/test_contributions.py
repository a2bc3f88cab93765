"""Contributions of features against Shapley values by their definition, and their sum against the forecasts."""

import random
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.operators import boosting as T
from sedimenta.operators import contributions as C


@pytest.fixture(scope="module")
def fitted(spark):
    drawn = random.Random(11)
    rows = [(i, i % 2, float(drawn.randrange(20)), float(drawn.randrange(6)) if i % 9 else None, drawn.random(), i % 5 != 0) for i in range(600)]
    rows = [(*r, int(r[2] * (1 + (r[3] or 0)) / 8 + 3 * (r[4] > 0.5))) for r in rows]
    df = spark.createDataFrame(rows, "id long, fit int, a double, b double, c double, learn boolean, y int")
    growth = T.Growth(trees=3, depth=3, bins=8, least_rows=10)
    out, ensemble = T.grow(df, ["a", "b", "c"], "y", "fit", "learn", [1.0, 1.4, 1.0], growth)  # nothing belongs to the third group
    return df, out, ensemble


def by_definition(ensemble, group, x):
    """Every coalition of all features, each tree walked anew."""
    nodes, players = 1 << ensemble.growth.depth, range(len(x))

    def walk(tree, i, known):
        if i >= nodes:
            return tree.value[group, i - nodes]
        f, cut, cover = tree.feature[group, i], tree.cut[group, i], tree.cover[group]
        if f in known:
            return walk(tree, 2 * i + int(x[f] > cut), known)
        return sum(walk(tree, j, known) * cover[j] / cover[i] for j in (2 * i, 2 * i + 1) if cover[j])

    worth = {s: sum(walk(t, 1, s) for t in ensemble.trees) for k in range(len(x) + 1) for s in combinations(players, k)}
    out = []
    for f in players:
        rest = [j for j in players if j != f]
        out.append(sum(factorial(k) * factorial(len(rest) - k) / factorial(len(x)) * (worth[tuple(sorted((*s, f)))] - worth[s]) for k in range(len(x)) for s in combinations(rest, k)))
    return out, worth[()]


def test_equal_to_the_definition(fitted):
    _, _, ensemble = fitted
    drawn = np.random.default_rng(4)
    x = drawn.integers(0, 9, (40, 3))
    expected = C.expected_margins(ensemble)
    for group in (0, 1):
        got = C.shapley(ensemble, group, x)
        assert np.abs(got).max() > 0.01
        for row, values in zip(x, got, strict=True):
            want, base = by_definition(ensemble, group, row)
            assert np.allclose(values, want, atol=1e-12)
            assert ensemble.start[group] + base == pytest.approx(expected[group])


def test_they_add_up_to_the_forecasts(spark, fitted):
    _, out, ensemble = fitted
    explained = C.contributions(ensemble, out, ["a", "b", "c"], "fit")
    off = F.abs(F.col("contribution_expected") + F.aggregate("contribution", F.lit(0.0), lambda s, v: s + v) - F.ln("prediction"))
    assert explained.agg(F.max(off)).first()[0] < 1e-9
    means = {(r.fit, r.feature): r for r in C.mean_contributions(explained, ["a", "b", "c"], ["fit"]).collect()}
    assert len(means) == 6 and all(r.rows == 300 and r.mean_abs >= abs(r.mean) for r in means.values())
    assert max((0, f) for f in "abc") in means and means[0, "a"].mean_abs > means[0, "c"].mean_abs


def test_odd_rows(spark, fitted):
    df, _, ensemble = fitted
    some = spark.createDataFrame([(1, None, 1.0, None, 0.1, "x"), (2, 0, None, None, None, None), (2, 0, None, None, None, None), (3, 2, 1.0, 1.0, 1.0, "y")], "id long, fit int, a double, b double, c double, contribution_note string")
    got = {(r.id, r.fit): r for r in C.contributions(ensemble, some, ["a", "b", "c"], "fit").collect()}
    assert got[1, None].contribution is None and len(got[2, 0].contribution) == 3
    assert got[3, 2].contribution == [0.0, 0.0, 0.0] and got[3, 2].contribution_expected == -30.0
    assert C.contributions(ensemble, some.limit(0), ["a", "b", "c"], "fit").count() == 0
