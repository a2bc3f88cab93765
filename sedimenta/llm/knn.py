"""Exact top-k inner products by a Voronoi kNN join.

Inner products become distances: with M the largest norm, each data vector x gets one more component
sqrt(M^2 - |x|^2) and each query q a zero; then |q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so the nearest are
the highest scores. Queries and data are grouped by their nearest pivot. Per-cell summaries (the
least distances to the pivot, and the largest of the queries) bound how far the k-th neighbour of any
query of a cell can be; a data vector is sent to a block of query cells only if the triangle
inequality leaves it a chance there. Blocks are solved locally as small matrix products, and a
bounded number of winners of each is merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.store import Scratch

#: Pivots at least and at most (about the square root of the number of vectors; a sample that only steers the search), queries and data vectors of a local block.
PIVOTS, QUERY_BLOCK, DATA_BLOCK = (16, 512), 4096, 16384
#: Queries whose bounds one step of a task works out: with 512 pivots and 6 rows of each a matrix of 13 MB.
SLICE = 512


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(id, v array<long>): floor(scale * x) of each component; vectors null or with a null or non-finite component, and null ids, are left out."""
    odd = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(~odd)
    return whole.select(F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A row for each list; short lists are filled up with zeros."""
    at = np.asarray(column.offsets)
    flat = np.asarray(column.values)[at[0] : at[-1]]
    size = np.diff(at)
    out = np.zeros((len(size), dims), np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(at[:-1] - at[0], size)] = flat
    return out


def _distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray, pivot_extra: np.ndarray) -> np.ndarray:
    square = (x.astype(float) ** 2).sum(axis=1) + extra**2
    pivot_square = (pivots.astype(float) ** 2).sum(axis=1) + pivot_extra**2
    cross = x.astype(float) @ pivots.T.astype(float) + np.outer(extra, pivot_extra)
    return np.sqrt(np.maximum(square[:, None] + pivot_square[None] - 2 * cross, 0))


def _blocks(counts: dict[int, int], most: int) -> tuple[dict[int, tuple[int, int]], int]:
    """cell -> (first block, number of blocks): neighbouring small cells share a block, large ones are split."""
    out, block, room = {}, -1, 0
    for cell in sorted(counts):
        n = counts[cell]
        if n > most:
            parts = -(-n // most)
            out[cell], block, room = (block + 1, parts), block + parts, 0
        elif n <= room:
            out[cell], room = (block, 1), room - n
        else:
            block, room = block + 1, most - n
            out[cell] = (block, 1)
    return out, block + 1


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, id, score) of the k highest finite scores of each row, ties to smaller ids; ids are sorted, and of equal ones the higher score counts."""
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    if len(first) < len(ids):
        score, ids = np.maximum.reduceat(score, first, axis=1), ids[first]
    least = np.iinfo(score.dtype).min if score.dtype.kind == "i" else -np.inf
    kth = np.partition(score, score.shape[1] - k, axis=1)[:, [score.shape[1] - k]] if score.shape[1] > k else least
    row, col = np.nonzero((score >= kth) & (score > least))
    order = np.lexsort((ids[col], -score[row, col], row))
    row, col = row[order], col[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], ids[col[keep]], score[row[keep], col[keep]].astype(np.int64)


def top_inner_products(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    every: int = 50,
    scale: float = 256.0,
    pivots: int | None = None,
    query_block: int = QUERY_BLOCK,
    data_block: int = DATA_BLOCK,
) -> DataFrame:
    """(query_id long, rank int, vec_id long, score long): the k highest inner products of each query with the other rows.

    Vectors are compared as floor(scale * x). Queries are the rows whose id is divisible by `every`;
    candidates are all rows of other ids; ties go to the smaller id; a query with fewer than k
    candidates returns them all. Vectors that are null or hold a null or non-finite component take no
    part, nor do null ids. Shorter vectors count as filled up with zeros. Repeated rows count once; of
    several vectors of one id the pair with the highest score counts. Other columns are ignored,
    whatever their names; an empty table gives an empty result. Scores are exact integers; a table
    with vectors so large that a score may not fit a long (a squared length of 2**63 or more) is an error.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "knn")
    v = scratch.save(quantised(vectors, id_col, vector_col, scale).distinct())
    size = v.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dims"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("norm"), F.count_if(F.col("id") % every == 0).alias("queries")).first()
    if not size.n or not size.queries or not size.dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims, top = size.dims, float(size.norm) or 1.0
    if top >= 2.0**63 * (1 - 1e-12):
        raise ValueError("inner products of these vectors may not fit 64 bits")
    # no sum of products exceeds `top`: doubles hold it exactly below 2**53, longs do beyond
    packed = np.int16 if top < 2.0**30 else np.int32 if top < 2.0**62 else np.int64
    exact = np.float64 if top < 2.0**53 else np.int64
    # of equal vectors only the k + 1 least ids can be among the k best of any query
    equal = Window.partitionBy("v").orderBy("id")
    data = scratch.save(v.withColumn("__n", F.row_number().over(equal)).where(F.col("__n") <= k + 1).drop("__n"))
    pivots = pivots or int(np.clip(size.n**0.5, *PIVOTS))
    sample = data.select("v").orderBy(F.xxhash64("v"), "v").limit(pivots * (k + 1)).collect()
    p = np.array(list(dict.fromkeys(tuple(r.v) + (0,) * (dims - len(r.v)) for r in sample))[:pivots], np.int64)
    p_extra = np.sqrt(np.maximum(top - (p.astype(float) ** 2).sum(axis=1), 0))
    slack = 1e-6 * np.sqrt(top) + 1e-6

    def distances(x: np.ndarray, as_query: bool) -> np.ndarray:
        return _distances(x, np.zeros(len(x)) if as_query else np.sqrt(np.maximum(top - (x.astype(float) ** 2).sum(axis=1), 0)), p, p_extra)

    def of_data(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = distances(_matrix(batch.column(1), dims), False)
                cell = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell])], ["id", "cell", "d"])

    # the nearest of each cell of the data: k + 1 ids, of which one may be the query's own
    placed = data.mapInArrow(of_data, "id long, cell int, d double").groupBy("cell", "id").agg(F.min("d").alias("d"))
    closest = Window.partitionBy("cell").orderBy("d", "id")
    near = placed.withColumn("n", F.row_number().over(closest)).where(F.col("n") <= k + 1).orderBy("id").collect()
    near_id, near_cell, near_d = np.array([r.id for r in near]), np.array([r.cell for r in near]), np.array([r.d for r in near])
    first_of = np.flatnonzero(np.append(True, near_id[1:] != near_id[:-1]))

    def of_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, SLICE) for whole in batches for i in range(0, whole.num_rows, SLICE)):
            x = _matrix(batch.column(1), dims)
            d = distances(x, True)
            cell = d.argmin(axis=1)
            upper = np.minimum.reduceat(d[:, near_cell] + near_d, first_of, axis=1)  # no farther than by way of the pivot
            upper[np.asarray(batch.column(0))[:, None] == near_id[first_of]] = np.inf
            theta = np.partition(upper, k - 1, axis=1)[:, k - 1] if upper.shape[1] >= k else np.full(len(d), np.inf)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x.astype(packed)], pa.binary()), pa.array(cell, pa.int32()), pa.array(d[np.arange(len(x)), cell]), pa.array(theta)], ["id", "x", "cell", "d", "theta"])

    queries = scratch.save(v.where(F.col("id") % every == 0).mapInArrow(of_queries, "id long, x binary, cell int, d double, theta double"))
    cells = {r.cell: r for r in queries.groupBy("cell").agg(F.count("*").alias("n"), F.max("d").alias("reach"), F.max("theta").alias("theta")).collect()}
    blocks, n_blocks = _blocks({c: r.n for c, r in cells.items()}, query_block)

    def of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The query blocks in which a data vector has a chance."""
        for whole in batches:
            for batch in (whole.slice(i, 2048) for i in range(0, whole.num_rows, 2048)):
                x = _matrix(batch.column(1), dims)
                d, wanted = distances(x, False), np.zeros((len(x), n_blocks), bool)
                for c, (block, parts) in blocks.items():
                    wanted[:, block : block + parts] |= (d[:, c] <= cells[c].reach + cells[c].theta + slack)[:, None]
                row, block = np.nonzero(wanted)
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(x) + 1)), pa.int32()), pa.array(block, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x.astype(packed)], pa.binary()), lists], ["id", "x", "blocks"])

    sent = scratch.save(data.mapInArrow(of_blocks, "id long, x binary, blocks array<int>")).withColumn("block", F.explode("blocks"))
    salts = sent.groupBy("block").agg(F.ceil(F.count("*") / data_block).cast("int").alias("salts"))
    sent = sent.join(salts, "block").select("id", "x", "block", F.pmod(F.xxhash64("id"), "salts").cast("int").alias("salt"))
    block_of = F.create_map(*[F.lit(y) for c, (b, parts) in blocks.items() for y in (c, b)])
    parts_of = F.create_map(*[F.lit(y) for c, (b, parts) in blocks.items() for y in (c, parts)])
    asked = queries.select("id", "x", (block_of[F.col("cell")] + F.pmod(F.xxhash64("id"), parts_of[F.col("cell")]).cast("int")).alias("block"))
    asked = asked.join(salts, "block").select("id", "x", "block", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))

    def solve(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        found = [np.zeros((3, 0), np.int64)]
        if len(q) and len(x):
            x = x.sort_values("id")
            a, b = (np.frombuffer(b"".join(t["x"]), packed).reshape(len(t), dims).astype(exact) for t in (q, x))
            qid, xid = q["id"].to_numpy(), x["id"].to_numpy()
            for lo in range(0, len(q), 256):
                score = a[lo : lo + 256] @ b.T
                score[qid[lo : lo + 256, None] == xid] = np.iinfo(exact).min if exact is np.int64 else -np.inf
                row, ids, value = _best(score, xid, k)
                found.append(np.stack([qid[lo + row], ids, value]))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), np.concatenate(found, axis=1), strict=True)))

    keys = ["block", "salt"]
    local = asked.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(solve, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = local.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
