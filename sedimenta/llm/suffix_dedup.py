"""Exact substring dedup by a depth-limited radix sort of suffixes.

Suffixes are told apart only through their first `width` bytes, by most-significant-digit passes over
consecutive bytes; those that are still equal then are exactly the repeated windows. Only groups of two
or more suffixes go on from pass to pass.

To shuffle every suffix would take many times the size of the corpus, so a sieve comes first, which no
repeated window falls through: each window is filed under the least hash among its `gram`-byte grams, a
key that equal windows share. Neighbouring windows share it too, so a text sends one row for each run
of windows, about one for 40 bytes. A run alone under its key repeats nothing; runs under one key that are
equal (by a further hash of all their bytes) repeat as a whole; the suffixes of the other runs are sorted.

A group of suffixes is sorted in one task, by digits of 4 bytes and then of 16 up to the last byte of the
width. Suffixes of runs under a key of many (a passage that many texts
share, with a different text before it in each) are never gathered: the tasks that read the texts send a
row for each, dealt out by 128 bits of hash of the whole window.

Equal keys of one Arrow batch are combined before any shuffle, and groups are streamed in sorted
order, so a key that holds a large part of all rows needs no memory of its size.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.store import Scratch
from sedimenta.llm.textbytes import _BYTE, _P, _P_INV, chunks, lean, mix, powers, utf8

#: `width`, the grams' length, and the runs under one key whose suffixes one task sorts at most (3 MB of text, 130 MB as it sorts them).
WIDTH, GRAM, GROUP = 100, 20, 16_384
#: Bytes of the first digit and of all others; the last one is what is left of the window.
LEAD, DIGIT = 4, 16
#: Keys of more than GROUP runs that are sent to all tasks at most; more are joined.
BROADCAST = 200_000
_KEYS = "k1 long, k2 long, id long, pos long"
_NAMES = ["k1", "k2", "id", "pos"]
_START, _LEN = 31, 8
_Q = 0x9FB21C651E98DF25
_Q_INV = pow(_Q, -1, 1 << 64)


def _pack(tag: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """24 bits that tell apart texts of one id, 31 of the start, 8 of the length less `width`."""
    return (tag.astype(np.int64) << (_START + _LEN)) | (start.astype(np.int64) << _LEN) | size.astype(np.int64)


def _unpack(pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return pos >> (_START + _LEN), (pos >> _LEN) & ((1 << _START) - 1), pos & ((1 << _LEN) - 1)


def _sums(data: np.ndarray) -> np.ndarray:
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[data] * powers(_P, len(data)), out=total[1:])
    return total


def _least(keys: np.ndarray, span: int) -> np.ndarray:
    """The least of keys[i : i + span] for each i, by doubling."""
    have, out = 1, keys
    while 2 * have <= span:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(keys) - span + 1], out[span - have :]) if have < span else out


def runs(data: np.ndarray, offsets: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """(k1, k2, row, start, length) of the runs of windows that share their least gram."""
    none = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    n = len(data)
    if n < width:
        return none
    total, inverse = _sums(data), powers(_P_INV, n)
    g = mix((total[gram:] - total[:-gram]) * inverse[: n - gram + 1])
    bits = np.uint64(max(1, n.bit_length()))
    best = _least((g >> bits << bits) | np.arange(len(g), dtype=np.uint64), width - gram + 1)
    anchor = (best & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    valid = np.ones(len(anchor), bool)  # windows that end in the text where they start
    for edge in offsets[1:-1]:
        valid[max(0, edge - width + 1) : edge] = False
    at = np.flatnonzero(valid)
    if not len(at):
        return none
    new = np.ones(len(at), bool)
    new[1:] = (anchor[at[1:]] != anchor[at[:-1]]) | (at[1:] != at[:-1] + 1)
    first = at[new]
    end = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] + width
    k2 = mix((total[end] - total[first]) * inverse[first] + (end - first).astype(np.uint64))
    row = np.searchsorted(offsets, first, "right") - 1
    return g[anchor[first]], k2, row, first - offsets[row], end - first


def _tags(column: pa.Array) -> np.ndarray:
    return np.array([zlib.crc32(x.as_buffer()) & 0xFFFFFF if x.is_valid else 0 for x in column], np.int64)


def _combined(k1: np.ndarray, k2: np.ndarray, ids: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """Of equal keys the first by (id, pos) goes on; the others are repeats already: k1 and k2 null."""
    order = np.lexsort((pos, ids, k2, k1))
    k1, k2, ids, pos = k1[order].view(np.int64), k2[order].view(np.int64), ids[order], pos[order]
    again = np.zeros(len(k1), bool)
    if len(k1):  # the place of the first row, if it comes twice, doesn't repeat itself
        new = np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        again = (ids != ids[head]) | (pos != pos[head])
    return pa.RecordBatch.from_arrays([pa.array(k1, mask=again), pa.array(k2, mask=again), pa.array(ids), pa.array(pos)], _NAMES)


def _sorted_groups(keyed: DataFrame, pending: bool) -> DataFrame:
    """(id, pos, k1): k1 null: the row's two keys occurred earlier; else it is the first of its two keys and
    shares k1 with others (only if pending). Other rows fall away."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = held = None  # (k1, k2, id, pos) of the first row of the open group; (id, pos, k1) of the only content of the open k1
        for batch in batches:
            if not batch.num_rows:
                continue
            known = ~np.asarray(batch.column(0).is_valid())
            if known.any():
                yield pa.RecordBatch.from_arrays([batch.column(2).filter(pa.array(known)), batch.column(3).filter(pa.array(known)), pa.nulls(int(known.sum()), pa.int64())], ["id", "pos", "k1"])
                batch = batch.filter(pa.array(~known))
                if not batch.num_rows:
                    continue
            k1, k2, ids, pos = (np.asarray(x) for x in batch.columns)
            new1 = np.append(last is None or k1[0] != last[0], k1[1:] != k1[:-1])
            new2 = new1 | np.append(last is None or k2[0] != last[1], k2[1:] != k2[:-1])
            group = np.cumsum(new2)
            head = np.flatnonzero(new2)
            head_id, head_pos = (np.append(0 if last is None else last[i], x[head]) for i, x in ((2, ids), (3, pos)))
            again = (ids != head_id[group]) | (pos != head_pos[group])
            out = [(ids[again], pos[again], None)]
            if pending:
                family = np.cumsum(new1)
                contents = np.bincount(family[new2], minlength=family[-1] + 1)
                contents[0] += last is not None
                if held is not None and contents[0] > 1:
                    out.append(tuple(np.array([x]) for x in held))
                if held is not None and (contents[0] > 1 or new1.any()):
                    held = None
                wait = new2 & (contents[family] > 1)
                out.append((ids[wait], pos[wait], k1[wait]))
                tail = np.flatnonzero(new1)
                if len(tail) and contents[family[-1]] == 1:
                    held = ids[tail[-1]], pos[tail[-1]], k1[tail[-1]]
            last = k1[-1], k2[-1], head_id[-1], head_pos[-1]
            keys = pa.concat_arrays([pa.nulls(len(x[0]), pa.int64()) if x[2] is None else pa.array(x[2]) for x in out])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[i] for x in out])) for i in (0, 1)] + [keys], ["id", "pos", "k1"])

    spread = F.coalesce("k1", F.xxhash64("id", "pos"))
    dealt = keyed.repartition(spread).sortWithinPartitions("k1", "k2", "id", "pos")
    return dealt.mapInArrow(lean(run), "id long, pos long, k1 long")


def _first_pass(texts: DataFrame, width: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = np.asarray(batch.column(0)), _tags(batch.column(1))
            data, offsets = utf8(batch.column(1))
            parts = []
            for lo, hi in chunks(offsets):
                at = offsets[lo : hi + 1]
                k1, k2, row, start, size = runs(data[at[0] : at[-1]], at - at[0], width, gram)
                parts.append((k1, k2, ids[lo + row], _pack(tags[lo + row], start, size - width)))
            yield _combined(*(np.concatenate(x) for x in zip(*parts, strict=True))) if parts else _combined(*(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64)))

    return texts.mapInArrow(lean(run), _KEYS)


def _open_runs(texts: DataFrame, width: int) -> DataFrame:
    """(k1, id, pos, piece, many): the bytes of the runs that are listed in `open`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = np.asarray(batch.column(0)), _tags(batch.column(1))
            rows: list[tuple] = []
            for i in range(batch.num_rows):
                raw, listed = memoryview(batch.column(1)[i].as_buffer()), batch.column(2)[i].values
                pos, k1, many = np.asarray(listed.field("pos")), np.asarray(listed.field("k1")), listed.field("many").to_pylist()
                own, start, more = _unpack(pos)
                for j in np.flatnonzero(own == tags[i]).tolist():
                    rows.append((k1[j], ids[i], pos[j], raw[start[j] : start[j] + more[j] + width].tobytes(), many[j]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], ["k1", "id", "pos", "piece", "many"])

    return texts.mapInArrow(lean(run), "k1 long, id long, pos long, piece binary, many boolean")


class _Windows:
    """Every window of some pieces, in order: key of its run, piece, text and start."""

    def __init__(self, part: pa.Table, width: int):
        part = part.combine_chunks()
        pieces = part.column("piece").chunk(0)
        at = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1].astype(np.int64)
        self.data = np.frombuffer(pieces.buffers()[2], np.uint8)[at[0] : at[-1]]
        at = at - at[0]
        many = np.diff(at) - width + 1
        self.row = np.repeat(np.arange(part.num_rows), many)
        offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        tag, start, _ = _unpack(np.asarray(part.column("pos").chunk(0)))
        self.at, self.width, self.offset = at[self.row] + offset, width, offset
        self.k1, self.id = np.asarray(part.column("k1").chunk(0))[self.row], np.asarray(part.column("id").chunk(0))[self.row]
        self.tag, self.start = tag[self.row], start[self.row] + offset

    def hashes(self, at: np.ndarray, size: int, second: bool = False) -> np.ndarray:
        """Of the `size` bytes from each place; `second`: an independent one."""
        base, inverse = (_Q, _Q_INV) if second else (_P, _P_INV)
        total = np.empty(len(self.data) + 1, np.uint64)
        total[0] = 0
        np.cumsum((_BYTE[::-1] if second else _BYTE)[self.data] * powers(base, len(self.data)), out=total[1:])
        return mix((total[at + size] - total[at]) * powers(inverse, len(self.data) + 1)[at])

    def digit(self, at: np.ndarray, size: int) -> list[np.ndarray]:
        """The `size` bytes from each place as numbers in the order of the bytes, the most significant first."""
        out = []
        for lo in range(0, size, 8):
            number = np.zeros(len(at), np.uint64)
            for i in range(lo, min(lo + 8, size)):
                number = number << np.uint64(8) | self.data[at + i]
            out.append(number)
        return out

    def equal(self) -> tuple[np.ndarray, np.ndarray]:
        """(window, group): the windows that occur at least twice under their key; in a group the first comes first.

        A pass sorts each group by its next bytes and leaves groups of two and more; after the last byte of the width a group's windows are equal.
        """
        at, depth = np.arange(len(self.at)), 0
        _, group = np.unique(self.k1, return_inverse=True)
        while depth < self.width and len(at):
            size = min(LEAD if depth == 0 else DIGIT, self.width - depth)
            keys = self.digit(self.at[at] + depth, size)
            depth += size
            order = np.lexsort((*keys[::-1], group))  # stable, so places stay in order within a group
            at, group, keys = at[order], group[order], [k[order] for k in keys]
            new = np.append(True, group[1:] != group[:-1])
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            group = np.cumsum(new) - 1
            shared = np.bincount(group)[group] > 1
            at, group = at[shared], group[shared]
        return at, group


def _of_hot_runs(open_runs: DataFrame, width: int) -> DataFrame:
    """Keyed rows as of _first_pass, one for each window, keyed by two hashes of the window itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 8192) for b in batches for i in range(0, b.num_rows, 8192)):
            w = _Windows(pa.Table.from_batches([batch]), width)
            yield _combined(w.hashes(w.at, width), w.hashes(w.at, width, True), w.id, _pack(w.tag, w.start, np.zeros(len(w.start), np.int64)))

    return open_runs.mapInArrow(lean(run), _KEYS)


def _sorted_suffixes(open_runs: DataFrame, width: int) -> DataFrame:
    """(id, pos): the ranges of windows that occur earlier under the key of their run; groups are of GROUP runs at most."""

    def solved(part: pa.Table) -> pa.RecordBatch:
        w = _Windows(part, width)
        at, group = w.equal()
        head = at[np.searchsorted(group, group)]
        again = at[(w.id[at] != w.id[head]) | (w.tag[at] != w.tag[head]) | (w.start[at] != w.start[head])]
        again.sort()  # by piece and offset
        row, start = w.row[again], w.start[again]
        first = np.append(True, (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1))[: len(row)]
        a = np.flatnonzero(first)
        more = np.append(a[1:], len(row))[: len(a)] - a - 1
        return pa.RecordBatch.from_arrays([pa.array(w.id[again][a]), pa.array(_pack(w.tag[again][a], start[a], more))], ["id", "pos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None  # rows of the open group
        for batch in (b.slice(i, 8192) for b in batches for i in range(0, b.num_rows, 8192)):
            table = pa.Table.from_batches([batch])
            table = table if kept is None else pa.concat_tables([kept, table])
            k1 = np.asarray(table.column("k1").combine_chunks())
            cut = int(np.flatnonzero(k1 != k1[-1])[-1]) + 1 if len(k1) and k1[0] != k1[-1] else 0
            if cut:
                yield solved(table.slice(0, cut))
            kept = table.slice(cut)
        if kept is not None and kept.num_rows:
            yield solved(kept)

    return open_runs.repartition("k1").sortWithinPartitions("k1", "id", "pos").mapInArrow(lean(run), "id long, pos long")


def spans_of(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs of bytes that the ranges [start, end) cover."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.append(True, start[1:] > reach[:-1])
    return start[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)]


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(id, text, spans array<long>): every row of docs, and the packed ranges of bytes that occur earlier.

    What is listed for a text (its runs, its spans) is bounded by its own length.
    """
    if not 0 < gram <= width or width - gram >= 1 << _LEN:
        raise ValueError(f"grams must be no longer than the width, and shorter by {(1 << _LEN) - 1} bytes at most")
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix")
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    named = texts.where("id IS NOT NULL")
    found = scratch.save(_sorted_groups(_first_pass(named, width, gram), True))
    waiting = found.where("k1 IS NOT NULL")
    many = scratch.save(waiting.groupBy("k1").agg(F.count("*").alias("n")).where(F.col("n") > GROUP).select("k1", F.lit(True).alias("many")))
    few = many.count() <= BROADCAST
    waiting = waiting.join(F.broadcast(many) if few else many, "k1", "left").withColumn("many", F.coalesce("many", F.lit(False)))
    waiting = waiting.groupBy("id").agg(F.collect_list(F.struct("pos", "k1", "many")).alias("open"))
    # both joins read the texts dealt out by id, so that one exchange of the texts serves them
    opened = named.join(waiting, "id").select("id", "text", "open")
    runs = scratch.save(_open_runs(opened, width))
    again = found.where("k1 IS NULL").select("id", "pos").unionByName(_sorted_suffixes(runs.where("NOT many"), width))
    again = again.unionByName(_sorted_groups(_of_hot_runs(runs.where("many"), width), False).select("id", "pos"))
    spans = again.groupBy("id").agg(F.collect_list("pos").alias("spans"))
    nameless = texts.where("id IS NULL").withColumn("spans", F.lit(None).cast("array<long>"))
    return named.join(spans, "id", "left").unionByName(nameless)


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM, with_text: bool = False
) -> DataFrame:
    """(doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string[, kept binary]), a row for every input row.

    A byte goes if a `width`-byte string over it also starts earlier: in a smaller id, or in the same
    text at a smaller start. Overlaps count and all strings are judged on the input. Matches never
    cross texts. Null and empty texts, and texts shorter than `width`, keep everything. Ids are whole
    numbers; rows with a null id take no part and keep everything. Repeated rows are one place: they
    don't remove each other. Different texts of one id come in the order of a hash of their bytes. Other columns are left out, whatever their names. Texts may be up to 2**31 bytes.
    """
    names = [doc_id, "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for i in range(batch.num_rows):
                raw = batch.column(1)[i].as_buffer()
                data, packed = memoryview(raw), batch.column(2)[i].values
                a = b = np.zeros(0, np.int64)
                if packed is not None and len(packed):
                    own, start, more = _unpack(np.asarray(packed))
                    start, more = start[own == zlib.crc32(raw) & 0xFFFFFF], more[own == zlib.crc32(raw) & 0xFFFFFF]
                    if len(start):
                        a, b = spans_of(start, start + more + width)
                kept = b"".join(data[x:y] for x, y in zip(np.append(0, b).tolist(), np.append(a, len(data)).tolist(), strict=True))
                rows.append((len(data), len(data) - len(kept), len(a), hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][: len(names) - 1]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds))], names)

    schema = f"`{doc_id}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return repeated_spans(docs, doc_id, text, width, gram).select("id", "text", "spans").mapInArrow(lean(run), schema)
