"""MinHash near-dedup with sequential Bayesian verification and exact confirmation.

1. One pass turns each text into its shingle-set size, a 128-bit hash of the set and a MinHash
   signature. Texts with equal sets are one class; only class representatives go on.
2. Signatures are cut into bands; representatives that share a band are candidates. A bucket never
   emits all its pairs: in each round its hub (the member with most company over all buckets) is
   compared with the members of other components, components are merged, and only buckets that still
   hold several components go on. What is left after the star rounds is compared in full: small buckets
   pair by pair; large buckets are joined to clusters, dealt out as pairs of blocks, and a task counts all intersections of two blocks as a product of incidence matrices and
   returns no more links than join them.
3. A candidate pair's signatures are compared batch by batch; the pair is dropped as soon as the
   posterior probability that its similarity reaches the threshold falls below `miss`. Survivors are
   decided exactly on their full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.components import connected, roots
from sedimenta.llm.store import Scratch, settle
from sedimenta.llm.textbytes import distinct, lean, mix, shingle_sets, shingles, slim_batches, utf8, word_hashes

BANDS, ROWS = 32, 4
#: Members of a bucket that is compared pair by pair at most; texts of a block of a larger one, and columns of a matrix product.
SMALL, BLOCK, COLUMNS = 48, 512, 8192
#: Miss probability of the Bayesian pruning, and signature values compared at once.
MISS, BATCH = 1e-9, 32
_A, _B = (np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64) * np.uint64(2)) + np.array([[1], [0]], np.uint64)


def signatures(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """MinHash of each non-empty set hashes[at[i]:at[i+1]]: rows of BANDS * ROWS values of 32 bits."""
    out = np.empty((len(at) - 1, BANDS * ROWS), np.uint32)
    for j in range(BANDS * ROWS):
        out[:, j] = np.minimum.reduceat((h * _A[j] + _B[j]) >> np.uint64(32), at[:-1])
    return out


def features(docs: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """(id, n_shingles, h1, h2, sig) of every row; sig is null for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, h, at in shingle_sets(batch.column(1), k, 500_000):
                size = np.diff(at)
                some = size > 0
                sums = np.zeros((2, hi - lo), np.uint64)
                sig = np.full(hi - lo, None, object)
                if some.any():
                    edge = at[:-1][some]
                    sums[0, some] = np.add.reduceat(mix(h), edge)
                    sums[1, some] = np.add.reduceat(mix(h ^ np.uint64(0x5851F42D4C957F2D)), edge)
                    sig[some] = [x.tobytes() for x in signatures(h, np.append(edge, len(h)))]
                columns = [batch.column(0).slice(lo, hi - lo), pa.array(size, pa.int64()), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), pa.array(sig, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "h1", "h2", "sig"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).mapInArrow(lean(run), f"id {kind}, n long, h1 long, h2 long, sig binary")


def least_matches(n: int, threshold: float, miss: float) -> int:
    """The least number of equal values among n at which P(similarity >= threshold) is at least `miss`, by a uniform prior.

    The posterior is Beta(m + 1, n - m + 1), whose upper tail at t is P(Binomial(n + 1, t) <= m).
    """
    total = 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= miss:
            return m
    return n + 1


def _plausible(pairs: DataFrame, sigs: DataFrame, threshold: float, miss: float) -> DataFrame:
    """The pairs (a, b) that sequential comparison of signature batches doesn't prune."""
    steps = [(n, least_matches(n, threshold, miss)) for n in range(BATCH, BANDS * ROWS + 1, BATCH)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, BANDS * ROWS) for i in (2, 3))
            alive, equal = np.arange(len(a)), np.zeros(len(a), np.int64)
            for n, least in steps:
                equal = equal[: len(alive)] + (a[alive, n - BATCH : n] == b[alive, n - BATCH : n]).sum(axis=1)
                alive, equal = alive[equal >= least], equal[equal >= least]
            yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(alive)) for i in (0, 1)], ["a", "b"])

    kind = pairs.schema["a"].dataType.simpleString()
    left, right = (sigs.select(F.col("rep").alias(x), F.col("sig").alias(f"sig_{x}")) for x in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(lean(run), f"a {kind}, b {kind}")


def _sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = utf8(column)
    words, row, _, _ = word_hashes(data, offsets)
    return distinct(*shingles(words, row, len(column), k))


def _linked(pairs: DataFrame, texts: DataFrame, percent: int, k: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (y for whole in batches for x in slim_batches(whole, "text_a", 2_000_000) for y in slim_batches(x, "text_b", 2_000_000)):
            n = batch.num_rows
            (ha, ra), (hb, rb) = (_sets(batch.column(i), k) for i in (2, 3))
            h, row = np.concatenate([ha, hb]), np.concatenate([ra, rb])
            order = np.lexsort((h, row))
            h, row = h[order], row[order]
            both = np.bincount(row[1:][(h[1:] == h[:-1]) & (row[1:] == row[:-1])], minlength=n)
            union = np.bincount(row, minlength=n) - both
            keep = pa.array((union > 0) & (100 * both >= percent * union))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    kind = pairs.schema["a"].dataType.simpleString()
    left, right = (texts.select(F.col("rep").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(lean(run), f"a {kind}, b {kind}")


def block_links(h: np.ndarray, row: np.ndarray, n: int, left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between the rows `left` and `right` of distinct (hash, row) pairs, as few as join what they join."""
    size = np.bincount(row, minlength=n)
    _, shingle, many = np.unique(h, return_inverse=True, return_counts=True)
    shared = many[shingle] > 1
    _, shingle = np.unique(shingle[shared], return_inverse=True)
    row, order = row[shared], np.argsort(shingle, kind="stable")
    row, shingle = row[order], shingle[order]
    both = np.zeros((n, n), np.float32)
    for lo in range(0, int(shingle[-1]) + 1 if len(shingle) else 0, COLUMNS):
        part = slice(*np.searchsorted(shingle, [lo, lo + COLUMNS]))
        m = np.zeros((n, min(COLUMNS, int(shingle[-1]) + 1 - lo)), np.float32)
        m[row[part], shingle[part] - lo] = 1
        both += m @ m.T
    both = both.astype(np.int64)
    linked = (100 * both >= percent * (size[:, None] + size[None] - both)) & (size[:, None] > 0) & (size[None] > 0)
    inside = np.zeros((n, n), bool)
    inside[np.ix_(left, right)] = inside[np.ix_(right, left)] = True
    linked &= inside
    np.fill_diagonal(linked, False)
    out, seen = [], np.zeros(n, bool)
    for first in range(n):
        if seen[first]:
            continue
        seen[first], stack = True, [first]
        while stack:
            i = stack.pop()
            new = np.flatnonzero(linked[i] & ~seen)
            seen[new] = True
            out += [(i, int(j)) for j in new]
            stack += new.tolist()
    return out


def _block_links(members: DataFrame, texts: DataFrame, scratch: Scratch, percent: int, k: int) -> DataFrame:
    """Links (a, b) among the members (key, rep) of large buckets."""
    star = members.groupBy("key").agg(F.min("rep").alias("v"))
    names = roots(scratch, members.join(star, "key").select(F.col("rep").alias("u"), "v"))
    cluster = members.select("rep").distinct().join(names.select(F.col("u").alias("rep"), "v"), "rep", "left").select("rep", F.coalesce("v", "rep").alias("cluster"))
    cluster = scratch.save(cluster)
    blocks = cluster.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = cluster.join(blocks, "cluster").join(texts, "rep").withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("rep", "text", "cluster", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    kind = members.schema["rep"].dataType.simpleString()

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        rep, own, i, j = group.column("rep"), np.asarray(group.column("own")), group.column("i")[0].as_py(), group.column("j")[0].as_py()
        h, row = _sets(group.column("text"), k)
        found = block_links(h, row, group.num_rows, np.flatnonzero(own == i), np.flatnonzero(own == j), percent)
        a, b = (rep.take(pa.array([x[side] for x in found], pa.int64())) for side in (0, 1))
        return pa.table({"a": a, "b": b})

    return dealt.groupBy("cluster", "i", "j").applyInArrow(run, f"a {kind}, b {kind}").select(*_ordered("a", "b"))


def _leftover(live: DataFrame, near: Column, scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """(pairs, large): the pairs (a, b) of the small buckets of several components, and the members of the large ones."""
    sized = scratch.save(live.join(live.groupBy("key").agg(F.count("*").alias("size")), "key").select("key", "rep", "comp", "n", "size"))
    small, large = sized.where(F.col("size") <= SMALL), sized.where(F.col("size") > SMALL)
    left, right = (small.select("key", F.col("rep").alias(f"rep_{x}"), F.col("comp").alias(f"comp_{x}"), F.col("n").alias(f"n_{x}")) for x in "ab")
    pairs = left.join(right, "key").where("comp_a < comp_b").where(near).select(*_ordered("rep_a", "rep_b"))
    return pairs, large.select("key", "rep") if large.limit(1).count() else None


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def near_components(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = 80,
    k: int = 5,
    miss: float = MISS,
    stars: int = 2,
) -> DataFrame:
    """(doc_id, n_shingles long, component_id, kept boolean), a row for every input row.

    Two texts are linked if 100 * |A and B| >= percent * |A or B| for their sets of distinct k-word
    shingles (words: bytes outside x20 and x09-x0D, A-Z lower-cased; fewer words: the whole sequence is
    one shingle). component_id is the least id reachable over links, kept tells whether it is the row's
    own. Null, empty and blank texts have an empty set and are linked with nothing. Rows with a null id
    take no part: component null, kept true. Repeated rows are equal texts of one id; rows of one id
    with different texts count as linked through that id. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    every = scratch.save(features(docs, doc_id, text, k))
    named = every.where("id IS NOT NULL AND n > 0")
    classes = scratch.save(named.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.min("n").alias("n"), F.min_by("sig", "id").alias("sig")))
    band = [F.xxhash64(F.lit(i), F.substring("sig", 4 * ROWS * i + 1, 4 * ROWS)) for i in range(BANDS)]
    banded = classes.select("rep", "n", F.explode(F.array(*band)).alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = scratch.save(banded.join(shared, "key"))
    degree = members.groupBy("rep").agg(F.sum("size").alias("degree"))
    members = scratch.save(members.drop("size").join(degree, "rep"))
    wanted = degree.select("rep")
    texts = docs.select(F.col(doc_id).alias("rep"), F.col(text).alias("text")).join(wanted, "rep", "left_semi")
    texts = scratch.save(texts)
    sigs = classes.select("rep", "sig")
    labels = scratch.save(degree.select("rep", F.col("rep").alias("comp")))
    near = F.col("n_a") * percent <= F.col("n_b") * 100
    near = near & (F.col("n_b") * percent <= F.col("n_a") * 100)
    tested: DataFrame | None = None
    for turn in range(stars + 1):
        own = members.join(labels, "rep")
        open_keys = own.groupBy("key").agg(F.min("comp").alias("least"), F.max("comp").alias("most"), F.max_by("comp", F.struct("degree", -F.hash("rep"), "rep")).alias("main"))
        open_keys = open_keys.where("least < most").select("key", "main")
        live = scratch.save(own.join(open_keys, "key"))
        if turn < stars:
            hub = live if turn == 0 else live.where("comp != main")
            hub = hub.groupBy("key").agg(F.max_by(F.struct("rep", "comp", "n"), F.struct("degree", -F.hash("rep"), "rep")).alias("hub"))
            hub = hub.select("key", F.col("hub.rep").alias("hub"), F.col("hub.comp").alias("hub_comp"), F.col("hub.n").alias("n_b"))
            pairs = live.withColumnRenamed("n", "n_a").join(hub, "key").where("comp != hub_comp").where(near).select(*_ordered("rep", "hub"))
        else:
            pairs, large = _leftover(live, near, scratch)
        pairs = pairs.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = scratch.save(pairs)
        settle(spark)
        edges = _linked(_plausible(pairs, sigs, percent / 100, miss), texts, percent, k)
        if turn == stars and large is not None:
            edges = edges.unionByName(_block_links(large, texts, scratch, percent, k))
        edges = scratch.save(edges)
        settle(spark)
        labels = connected(scratch, labels, edges)
        settle(spark)
        tested = pairs if tested is None else tested.unionByName(pairs)
    named_classes = classes.join(labels, "rep", "left").select("h1", "h2", F.coalesce("comp", "rep").alias("comp"))
    out = every.drop("sig").withColumn("linkable", F.expr("id IS NOT NULL AND n > 0"))
    alone = out.where("NOT linkable").select("id", "n", F.col("id").alias("comp"))
    out = out.where("linkable").join(named_classes, ["h1", "h2"]).select("id", "n", "comp").unionByName(alone)
    return out.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"), F.expr("comp IS NULL OR id = comp").alias("kept"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of docs that stand for their group, all columns; options as for near_components.

    Of the rows of one id one stays: that with the least hash of all its columns, whatever the plan. Rows with a
    null id stay, as do null and empty texts; other columns may have any names but __gone and __row; maps aren't allowed.
    """
    found = near_components(docs, doc_id=doc_id, **options).where("NOT kept").select(F.col(doc_id).alias("__gone")).distinct()
    rest = docs.join(found, docs[doc_id] == found["__gone"], "left_anti")
    whole = F.struct(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    one = rest.where(F.col(f"`{doc_id}`").isNotNull()).groupBy(F.col(f"`{doc_id}`").alias("__gone")).agg(F.min(whole).alias("__row"))
    one = one.select(*[F.col(f"__row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
    return one.unionByName(rest.where(F.col(f"`{doc_id}`").isNull()))
