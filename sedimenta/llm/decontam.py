"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is short and a document may be long, so their Jaccard similarity says little. Items are
partitioned by the size of their shingle set; each partition has its own sketch length, taken from
its upper size bound and the threshold: of an item's shingles at most (1 - t) of them may miss from a
document that contains it, so one of its floor((1 - t) * size) + 1 least hash values (the item's
bottom MinHash sketch) is always in the document. A document's shingle hashes are looked up among
these sketches; each candidate is then decided by the exact share of the item's shingles that the
document holds. No document that contains an item is missed and nothing of the corpus is shuffled.
Words are compared in Unicode case folding, so a text in capitals holds what it holds in any case.
An item of n < k words is one shingle of n words; where such items occur, documents are also cut into
shingles of n words, so that short items are found inside long texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.textbytes import chunks, distinct, lean, shingles, slim_batches, utf8, word_hashes

#: Shingle hashes of items held by a worker at once: 8 MB; further items take further passes.
BLOCK = 1 << 20
#: Upper size bounds of the partitions grow by this factor.
STEP = 1.25


def _folded(column: pa.Array) -> pa.Array:
    """A copy of the texts in full case folding ("STRASSE" is "straße"); shingle_sets folds A-Z itself. Bytes outside UTF-8 stay as they are."""
    texts = [t if t is None or t.isascii() else t.decode("utf-8", "surrogateescape").casefold().encode("utf-8", "surrogateescape") for t in column.cast(pa.large_binary()).to_pylist()]
    return pa.array(texts, pa.large_binary()).view(pa.large_string())


def _shingled(column: pa.Array, k: int, short: int, own: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, hashes, offsets) of each chunk: the sorted set of k-word shingles of each text, and of n words for each bit n of short.

    own: instead, texts of n < k words have their one shingle of n words.
    """
    data, offsets = utf8(_folded(column))
    for lo, hi in chunks(offsets):
        at = offsets[lo : hi + 1]
        words, row, _, _ = word_hashes(data[at[0] : at[-1]], at - at[0])
        count = np.bincount(row, minlength=hi - lo)
        found = []
        for n in range(1, k + 1):
            if n == k or own or short >> n & 1:
                of = count[row] >= n if n == k or not own else count[row] == n
                found.append(shingles(words[of], row[of], hi - lo, n))
        h, its = distinct(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
        yield lo, hi, h, np.searchsorted(its, np.arange(hi - lo + 1))


def item_sets(items: DataFrame, item_id: str = "item_id", text: str = "text", k: int = 5) -> DataFrame:
    """(item, hashes array<long>, short int): the sorted shingle set of each item, and a bit for each number of words below k of its texts.

    Ids and texts that are null, and texts without words, are left out. Items of one id are one item.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(_folded(batch.column(1)))
            _, row, _, _ = word_hashes(data, offsets)
            count = np.bincount(row, minlength=batch.num_rows)
            short = np.where(count < k, 1 << np.minimum(count, k), 0)
            for lo, hi, h, at in _shingled(batch.column(1), k, 0, own=True):
                sets = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), sets, pa.array(short[lo:hi], pa.int32())], ["item", "hashes", "short"])

    kind = items.schema[item_id].dataType.simpleString()
    found = items.select(F.col(item_id).alias("item"), F.col(text).alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    found = found.mapInArrow(lean(run), f"item {kind}, hashes array<long>, short int").where("size(hashes) > 0")
    return found.groupBy("item").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("hashes")))).alias("hashes"), F.bit_or("short").alias("short"))


def sketch_length(size: int, threshold: float, step: float = STEP) -> int:
    """Bottom hashes to index for an item of this size: the length of its size partition."""
    bound = 1
    while bound < size:
        bound = max(bound + 1, int(bound * step))
    return min(size, int((1 - threshold) * bound + 1e-9) + 1)


def _needed(size: int, threshold: float) -> int:
    """The least number of shared shingles that is a share of at least the threshold."""
    need = max(1, int(size * threshold))
    while need < size * threshold - 1e-9:
        need += 1
    return need


def _lookup(block: list[tuple[int, np.ndarray]], threshold: float) -> tuple[np.ndarray, ...]:
    """Flat arrays for the worker: sketch hash -> item, each item's whole set, each item's need."""
    sketch_h, sketch_i, sets, at = [], [], [], [0]
    for n, (_, hashes) in enumerate(block):
        h = np.sort(hashes.view(np.uint64))
        bottom = h[: sketch_length(len(h), threshold)]
        sketch_h.append(bottom)
        sketch_i.append(np.full(len(bottom), n))
        sets.append(h)
        at.append(at[-1] + len(h))
    order = np.argsort(flat := np.concatenate(sketch_h), kind="stable")
    need = np.array([_needed(len(h), threshold) for h in sets])
    return flat[order], np.concatenate(sketch_i)[order], np.concatenate(sets), np.array(at), need


def _hits(h: np.ndarray, at: np.ndarray, lookup: tuple[np.ndarray, ...]) -> Iterator[tuple[int, int, int]]:
    """(text, item, shared) of every text whose sorted set holds at least the item's need."""
    keys, owner, sets, starts, need = lookup
    lo = np.searchsorted(keys, h, "left")
    spots = np.flatnonzero((lo < len(keys)) & (keys[np.minimum(lo, len(keys) - 1)] == h))
    if not len(spots):
        return
    hi = np.searchsorted(keys, h[spots], "right")
    rows = np.searchsorted(at, spots, "right") - 1
    pairs = {(int(r), int(i)) for r, a, b in zip(rows, lo[spots], hi, strict=True) for i in owner[a:b]}
    for r, i in sorted(pairs):
        own, item = h[at[r] : at[r + 1]], sets[starts[i] : starts[i + 1]]
        spot = np.searchsorted(own, item)
        shared = int(np.count_nonzero(own[np.minimum(spot, len(own) - 1)] == item))
        if shared >= need[i]:
            yield r, i, shared


def _blocks(sets: DataFrame, most: int) -> Iterator[tuple[list[tuple[object, np.ndarray]], int]]:
    """The items' sets in blocks of at most `most` hashes, and their bits of short lengths, one partition at a time on the driver."""
    block, size, short = [], 0, 0
    for row in sets.toLocalIterator():
        if block and size + len(row.hashes) > most:
            yield block, short
            block, size, short = [], 0, 0
        block.append((row["item"], np.array(row.hashes, np.int64)))
        size += len(row.hashes)
        short |= row.short
    if block:
        yield block, short


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = 0.8,
    k: int = 5,
    block: int = BLOCK,
) -> DataFrame:
    """(doc_id, item_id, n_shared long, n_item long, containment double) for each document and item where the
    document holds at least `threshold` of the item's distinct k-word shingles.

    Items are broadcast in blocks of at most `block` hashes (one pass over the documents for each), so
    no broadcast outgrows 8 * block bytes but for a single longer item. Null and empty texts contain
    nothing and are contained in nothing; items of fewer than k words count as one shingle of that
    many words; repeated document rows give repeated rows, repeated item ids one item;
    other columns are left out; empty tables give an empty result.
    """
    spark = docs.sparkSession
    id_kind, item_kind = docs.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"`{doc_id}` {id_kind}, `{item_id}` {item_kind}, n_shared long, n_item long"
    narrow = docs.select(F.col(doc_id), F.col(text).alias("__text"))
    found: DataFrame | None = None
    for part, short in _blocks(item_sets(items, item_id, item_text, k), block):
        shared = spark.sparkContext.broadcast((pa.array([i for i, _ in part]), _lookup(part, threshold)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared, short=short) -> Iterator[pa.RecordBatch]:
            names, lookup = shared.value
            sizes = np.diff(lookup[3])
            for batch in (x for whole in batches for x in slim_batches(whole, "__text")):
                for lo, _, h, at in _shingled(batch.column(1), k, short):
                    if hits := list(_hits(h, at, lookup)):
                        r, i, n = (np.array(x) for x in zip(*hits, strict=True))
                        columns = [batch.column(0).take(pa.array(r + lo)), names.take(pa.array(i)), pa.array(n, pa.int64()), pa.array(sizes[i], pa.int64())]
                        yield pa.RecordBatch.from_arrays(columns, [doc_id, item_id, "n_shared", "n_item"])

        out = narrow.mapInArrow(lean(run), schema)
        found = out if found is None else found.unionByName(out)
    if found is None:
        found = spark.createDataFrame([], schema)
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = 0.8,
    k: int = 5,
    block: int = BLOCK,
) -> DataFrame:
    """The rows of docs, all columns, whose text contains no item; the terms of contained_items hold.

    Rows are filtered where they are read: nothing is shuffled or joined, one pass for each block of items.
    Rows with null or empty texts stay.
    """
    spark = docs.sparkSession
    for part, short in _blocks(item_sets(items, item_id, item_text, k), block):
        shared = spark.sparkContext.broadcast(_lookup(part, threshold))
        at_text = docs.columns.index(text)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, at_text=at_text, short=short) -> Iterator[pa.RecordBatch]:
            lookup = shared.value
            for batch in (x for whole in batches for x in slim_batches(whole, text)):
                clean = np.ones(batch.num_rows, bool)
                for lo, _, h, at in _shingled(batch.column(at_text), k, short):
                    clean[[lo + r for r, _, _ in _hits(h, at, lookup)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(lean(run), docs.schema)
    return docs
