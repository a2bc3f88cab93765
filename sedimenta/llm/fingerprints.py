"""SimHash fingerprints of texts, and all pairs of fingerprints within a Hamming radius.

Terms are pairs of neighbouring words (the first word pairs with the start). Each term's hash votes on every
bit with the term's weight, so a term counts as often as it occurs, and the more the rarer it is in the corpus.
Corpus counts are kept in BUCKETS buckets of term hashes, so what is broadcast has a fixed size. All sums are
of integers: equal texts have equal fingerprints, however they are dealt out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.components import roots
from sedimenta.llm.store import Scratch
from sedimenta.llm.textbytes import chunks, lean, mix, slim_batches, utf8, word_hashes

BITS = 256
BUCKETS = 1 << 18
#: Terms whose votes are laid out at once.
SLICE = 1 << 14
#: Buckets of a table are compared in parts of so many fingerprints.
TILE = 2048
_START = np.uint64(0x5851F42D4C957F2D)


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each term, by row."""
    words, row, _, _ = word_hashes(data, offsets)
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[np.flatnonzero(np.r_[True, row[1:] != row[:-1]][: len(row)])] = _START
    return mix(before * np.uint64(3) + words), row


def fingerprints(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """A row of BITS / 8 bytes for each text; null, empty and blank texts have no bit set."""
    data, offsets = utf8(column)
    out = np.zeros((len(offsets) - 1, BITS // 8), np.uint8)
    for lo, hi in chunks(offsets):
        at = offsets[lo : hi + 1]
        term, row = term_hashes(data[at[0] : at[-1]], at - at[0])
        weight = weights[(term & np.uint64(len(weights) - 1)).astype(np.int64)]
        votes, total = np.zeros((hi - lo, BITS), np.int64), np.bincount(row, weight, hi - lo)
        for i in range(0, len(term), SLICE):
            part, its = term[i : i + SLICE], row[i : i + SLICE]
            wide = np.stack([mix(part ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) & 0xFFFFFFFFFFFFFFFF)) for k in range(BITS // 64)], 1)
            bits = np.unpackbits(wide.view(np.uint8), axis=1).astype(np.float32)  # whole numbers below 2**24: exact
            bits *= weight[i : i + SLICE, None].astype(np.float32)
            first = np.flatnonzero(np.r_[True, its[1:] != its[:-1]])
            votes[its[first]] += np.add.reduceat(bits, first, axis=0).astype(np.int64)
        out[lo:hi] = np.packbits(2 * votes > total[:, None], axis=1)
    return out


def term_weights(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Whole weights of 1 to 127 by bucket: four times the binary logarithm of how many terms there are for one of the bucket."""

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for lo, hi in chunks(offsets):
                at = offsets[lo : hi + 1]
                term, _ = term_hashes(data[at[0] : at[-1]], at - at[0])
                total += np.bincount((term & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    got = docs.select(text).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(BUCKETS, np.int64)
    n[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return np.clip(np.rint(4 * np.log2(1 + n.sum() / (n + 1))), 1, 127).astype(np.int64)


def likeness(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The share of bits in which fingerprints agree."""
    return 1 - np.bitwise_count(one ^ two).sum(1) / (8 * one.shape[1])


_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _compared(ids: list, texts: list[str], prints: np.ndarray, after: list[str], after_prints: np.ndarray, weights: np.ndarray) -> list[pa.Array]:
    """The columns of _COLUMNS for texts and the texts that come after them."""
    edited = [t[: len(t) - len(t) // 3] + a[: len(t) // 3] for t, a in zip(texts, after, strict=True)]
    changed = fingerprints(pa.array(edited, pa.large_string()), weights)
    return [
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
        _binary(prints), _binary(changed), pa.array(likeness(prints, changed)), pa.array(likeness(prints, after_prints)),
    ]


def neighbour_edits(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The fingerprint of each text and of its edit, whose last third is the beginning of the next document.

    Next is the next smaller id; after the last comes the first. Rows of one id are ordered by the hash of their
    text; rows without an id come last. Null texts are empty. A single row is its own next. Texts are dealt out once,
    by ranges of the ids; only the first and last row of each range wait for their neighbours.
    """
    spark = docs.sparkSession
    weights = spark.sparkContext.broadcast(term_weights(docs, text))

    @lean
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, none = [*_COLUMNS, "part", "kind", "text"], pa.null()
        held: tuple | None = None

        def odd(kind: int, one: tuple) -> pa.RecordBatch:
            i, t, p, part = one
            row = [pa.array([i], pa.int64()), pa.array([len(t)], pa.int64()), *[pa.array([None], none)] * 5, pa.array([part], pa.int32()), pa.array([kind], pa.int8()), pa.array([t])]
            row[2], row[3], row[4], row[5], row[6] = pa.array([None], pa.string()), pa.array([p.tobytes()], pa.binary()), pa.array([None], pa.binary()), pa.array([None], pa.float64()), pa.array([None], pa.float64())
            return pa.RecordBatch.from_arrays(row, names)

        for batch in (s for b in batches for s in slim_batches(b, "text", 4_000_000)):
            ids, texts, part = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()], batch.column(2)[0].as_py()
            prints = fingerprints(batch.column(1), weights.value)
            if held is None:
                yield odd(2, (ids[0], texts[0], prints[0], part))
            else:
                ids, texts, prints = [held[0], *ids], [held[1], *texts], np.concatenate([held[2][None], prints])
            n = len(ids) - 1
            held = (ids[n], texts[n], prints[n], part)
            if n:
                yield pa.RecordBatch.from_arrays([*_compared(ids[:n], texts[:n], prints[:n], texts[1:], prints[1:], weights.value), pa.array([part] * n, pa.int32()), pa.array([0] * n, pa.int8()), pa.array([None] * n, pa.string())], names)
        if held is not None:
            yield odd(1, held)

    @lean
    def join_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, prints, after, after_prints = (batch.column(i).to_pylist() for i in range(5))
            raw = [np.frombuffer(b"".join(p), np.uint8).reshape(-1, BITS // 8) for p in (prints, after_prints)]
            yield pa.RecordBatch.from_arrays(_compared(ids, texts, raw[0], after, raw[1], weights.value), _COLUMNS)

    order = [F.desc_nulls_last("doc_id"), F.asc("_tie")]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_tie"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text", F.spark_partition_id().alias("part"))
    walked = scratch.save(dealt.mapInArrow(walk, _SCHEMA + ", part int, kind byte, text string"))
    heads = walked.where("kind = 2").select("part", F.col("text").alias("after"), F.col("fingerprint").alias("after_print"))
    parts = heads.select("part")  # a row for each range
    by = Window.orderBy("part")
    follows = parts.select("part", F.coalesce(F.lead("part").over(by), F.min("part").over(Window.partitionBy())).alias("to"))
    lasts = walked.where("kind = 1").select("part", "doc_id", "text", "fingerprint").join(follows, "part")
    ends = lasts.join(heads.withColumnRenamed("part", "to"), "to").select("doc_id", "text", "fingerprint", "after", "after_print")
    return walked.where("kind = 0").select(*_COLUMNS).unionByName(ends.mapInArrow(join_ends, _SCHEMA))


def _tables(prints: DataFrame, radius: int) -> DataFrame:
    """(key, fingerprint, n): a row for each of radius + 1 blocks of bits, of which two fingerprints within the radius share one at least.

    Each block is a table of fingerprints with that block in front: the key is the block's number and its bits.
    """
    blocks, width = radius + 1, BITS // 8
    edges = [width * i // blocks for i in range(blocks + 1)]
    keys = [F.concat(F.lit(bytes([i])), F.substring("fingerprint", edges[i] + 1, edges[i + 1] - edges[i])) for i in range(blocks)]
    return prints.select(F.explode(F.array(*keys)).alias("key"), "fingerprint", "n")


def _within(radius: int, tile: int):
    blocks, width = radius + 1, BITS // 8
    edges = [width * i // blocks for i in range(blocks + 1)]

    def solve(key: bytes, mine: np.ndarray, other: np.ndarray, n: np.ndarray, apart: bool) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Links of each fingerprint of a bucket (by n), counted in the first table that a pair shares, and a spanning forest of them."""
        links, up, tree = np.zeros(len(mine), np.int64), np.arange(len(mine)), []

        def root(x: int) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for i in range(len(mine)):
            j = np.arange(i + 1, len(mine))
            if apart:
                j = j[other[j] != other[i]]
            x = mine[i] ^ mine[j]
            near = np.flatnonzero(np.bitwise_count(x.view(np.uint64)).sum(1) <= radius)
            x, j = x[near], j[near]
            for b in range(key[0]):  # an earlier table has the pair
                seen = ~x[:, edges[b] : edges[b + 1]].any(1)
                x, j = x[~seen], j[~seen]
            links[i] += n[j].sum()
            np.add.at(links, j, n[i])
            for k in j.tolist():
                a, b = root(i), root(k)
                if a != b:
                    up[max(a, b)] = min(a, b)
                    tree.append((i, k))
        return links, tree

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (key, one, two, side, fingerprint, n), a bucket or a pair of its parts after the other: (a, b, links)."""
        names = ["a", "b", "links"]
        group, prints, sides, sizes = None, [], [], []

        def solved() -> Iterator[pa.RecordBatch]:
            if len(prints) < 2:
                return
            mine, n = np.frombuffer(b"".join(prints), np.uint8).reshape(-1, width), np.array(sizes)
            links, tree = solve(group[0], mine, np.array(sides), n, group[1] != group[2])
            some = np.flatnonzero(links)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array([prints[i] for i in some], pa.binary()), pa.array([None] * len(some), pa.binary()), pa.array(links[some])], names)
                yield pa.RecordBatch.from_arrays([pa.array([prints[i] for i, _ in tree], pa.binary()), pa.array([prints[k] for _, k in tree], pa.binary()), pa.array([0] * len(tree), pa.int64())], names)

        for batch in batches:
            for *g, side, p, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if g != group:
                    yield from solved()
                    group, prints, sides, sizes = g, [], [], []
                prints.append(p)
                sides.append(side)
                sizes.append(n)
        yield from solved()

    return run


def near_classes(prints: DataFrame, scratch: Scratch, radius: int = 7, tile: int = TILE) -> DataFrame:
    """(fingerprint, class_id, n_links) of each distinct fingerprint among rows (doc_id, fingerprint).

    Two documents are linked if their fingerprints differ in at most `radius` bits (0 to 31); class_id is the
    smallest doc_id reachable, n_links the number of other documents that a document is linked with. Equal
    fingerprints are one row from the start. Buckets of over `tile` fingerprints are compared in pairs of parts;
    links are counted where they are found, and only a spanning forest of each bucket leaves it. Rows without an
    id count and link, but name no class; a class without ids has none. An empty table stays empty.
    """
    if not 0 <= radius < BITS // 8:
        raise ValueError("a radius must leave each block a byte")
    once = scratch.save(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    rows = _tables(once.select("fingerprint", "n"), radius)
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    parts = F.ceil(F.col("size") / tile).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    kept = rows.join(sizes, "key").withColumn("parts", parts).withColumn("own", own)
    dealt = kept.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("key", F.least("own", "with").alias("one"), F.greatest("own", "with").alias("two"), F.col("own").alias("side"), "fingerprint", "n")
    found = dealt.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two", "fingerprint").mapInArrow(_within(radius, tile), "a binary, b binary, links long")
    found = scratch.save(found)
    links = found.where("links > 0").groupBy(F.col("a").alias("fingerprint")).agg(F.sum("links").alias("links"))
    tops = roots(scratch, found.where("b IS NOT NULL").select(F.col("a").alias("u"), F.col("b").alias("v")))
    placed = once.join(tops.select(F.col("u").alias("fingerprint"), F.col("v").alias("top")), "fingerprint", "left").join(links, "fingerprint", "left")
    placed = scratch.save(placed.select("fingerprint", F.coalesce("top", "fingerprint").alias("top"), "least", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    ids = scratch.save(placed.groupBy("top").agg(F.min("least").alias("class_id")))
    return scratch.save(placed.join(ids, "top").select("fingerprint", "class_id", "n_links"))


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 7) -> DataFrame:
    """What neighbour_edits() says of each document, with fingerprints as lowercase hex, and its class among all fingerprints."""
    scratch = Scratch(docs.sparkSession, "fingerprints")
    rows = scratch.save(neighbour_edits(docs, scratch, doc_id, text))
    classes = near_classes(rows.select("doc_id", "fingerprint"), scratch, radius)
    out = rows.join(classes, "fingerprint")
    return out.select(*[F.lower(F.hex(c)).alias(c) if c.endswith("fingerprint") else F.col(c) for c in _COLUMNS], "class_id", "n_links")
