"""Bounds of many queries, worked out slice by slice: equal to brute force, and a step's matrix stays small."""

import tracemalloc

import numpy as np
import pyarrow as pa

from sedimenta.llm import knn


def test_more_queries_than_a_slice(spark):
    drawn = np.random.default_rng(8)
    x = drawn.normal(0, 1, (1400, 4))
    df = spark.createDataFrame([(i, [float(c) for c in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>").coalesce(1)
    whole = np.floor(256 * x).astype(np.int64)
    score = whole @ whole.T
    np.fill_diagonal(score, np.iinfo(np.int64).min + 1)  # the least itself has no negative
    want = set()
    for i, row in enumerate(score):
        for rank, j in enumerate(np.lexsort((np.arange(len(row)), -row))[:5]):
            want.add((i, rank + 1, int(j), int(row[j])))
    assert knn.SLICE < 1400
    assert {tuple(r) for r in knn.top_inner_products(df, every=1).collect()} == want


def test_slices_of_lists_keep_their_values():
    column = pa.array([[1, 2], [3], [], [4, 5]], pa.list_(pa.int64()))
    assert knn._matrix(column.slice(1, 3), 2).tolist() == [[3, 0], [0, 0], [4, 5]]


def test_memory_of_a_step():
    pivots, dims = 512, 64
    x, p = np.ones((knn.SLICE, dims), np.int64), np.ones((pivots, dims), np.int64)
    near_cell = np.repeat(np.arange(pivots), 6)
    tracemalloc.start()
    d = knn._distances(x, np.zeros(len(x)), p, np.zeros(pivots))
    upper = np.minimum.reduceat(d[:, near_cell] + 1.0, np.arange(len(near_cell)), axis=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert upper.shape == (knn.SLICE, pivots * 6) and peak < 64 << 20
