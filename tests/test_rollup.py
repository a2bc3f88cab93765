"""Counts of a hierarchy: totals are right, and linear algebra can't tell a hidden one."""

import collections
import random

import numpy as np
import pytest

from sedimenta.operators.cells import rollup_cells

KEYS = ["a", "b", "c"]


def make(seed):
    rng = random.Random(seed)
    weights = [rng.random() ** 4 for _ in range(40)]
    return [(rng.choice("xyz"), rng.choice(["p", "q", None, "r", "s"][: rng.randint(1, 5)]), rng.choices("klmno", weights[:5])[0]) for _ in range(rng.choice([6, 60, 300, 900]))]


@pytest.mark.parametrize("seed", range(6))
def test_nothing_hidden_follows(spark, seed):
    rows = make(seed)
    got = {(r.level, *(r[k] for k in KEYS[: r.level])): r for r in rollup_cells(spark.createDataFrame([(*r, 1) for r in rows], "a string, b string, c string, level int"), KEYS).collect()}
    want = collections.Counter((level, *r[:level]) for r in rows for level in range(4))
    assert set(got) == set(want)
    for cell, r in got.items():
        assert (r.status == "SUPPRESSED") == (want[cell] < 10)
        assert r.cell_count == (want[cell] if r.status == "RELEASED" else None)
    hidden = [c for c, r in got.items() if r.cell_count is None]
    sums = []
    for cell in got:
        below = [c for c in got if c[0] == cell[0] + 1 and c[1 : cell[0] + 1] == cell[1:]]
        if below:
            sums.append([(c == cell) * 1.0 - (c in below) * 1.0 for c in hidden])
    if hidden:  # a count is determined if every solution of the sums agrees on it
        _, s, v = np.linalg.svd(np.array(sums), full_matrices=True)
        free = v[int((s > 1e-9).sum()) :]
        assert (np.abs(free).max(axis=0) > 1e-9).all()


def test_rollup_of_nothing(spark):
    df = spark.createDataFrame([], "a string, b string, c string")
    assert rollup_cells(df, KEYS).count() == 0
