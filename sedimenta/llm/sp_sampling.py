"""Sampled segmentations without replacement, and decoding.

A text's lattice has an edge for each piece of a sentencepiece vocabulary (bytes where no piece fits) and
a weight for each edge; a segmentation is a path, and its probability is the normalised product of its
weights. Adding Gumbel noise to the log-probabilities of all paths and taking the k largest draws k
distinct segmentations without replacement. No path is listed for that: the search is A-star over sets
of paths, best first by the set's perturbed maximum. The largest set yields its path; what is left of
it, split by the first edge at which a path turns off, goes back with a maximum drawn from a Gumbel
truncated at its parent's. The probability of a set is known exactly from backward sums over the
lattice. All random numbers are hashes of the row's key and the place in the text, so a row has the
same samples on every run.

The lattice splits at word-start marks, which no piece crosses: words are entered once in a lattice that a
worker keeps from batch to batch, up to a fixed size. The search takes all texts of a batch through each
of its k steps at once.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.textbytes import chunks, lean, mix, powers, utf8

_SPACE = "▁"
_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), 0x165667B19E3779F9
_BASE = 0x100000001B3 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
#: Bytes of text sampled at once, positions that a worker's lattice keeps, positions worked on at once.
TEXT, KEPT, SLICE = 150_000, 600_000, 1 << 16
#: Longest stretches of a word that are summed, and words that are drawn, by steps over all of a batch; longer ones go one by one.
STRETCH, WORD = 512, 64
#: Longest distance from the end of a stretch of sums that aren't logarithms, and the logarithm of their factor a character.
SHORT, FACTOR = 32, 4.0
#: Characters that begin longer pieces or come second in them, up to which pairs of them are kept as a table.
PAIRS = 2048


class Vocabulary:
    """Pieces, their log-weights, their bytes, and a hashed index of their prefixes by length."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        odd = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        is_byte = [model.is_byte(i) for i in range(n)]
        if "".join(model.encode("a  b", out_type=str)) != f"{_SPACE}a{_SPACE}{_SPACE}b" or sum(is_byte) != 256:
            raise ValueError("the model must keep every space, add one in front and have pieces for bytes")
        if any(p.rstrip(_SPACE) and _SPACE in p.lstrip(_SPACE) for p, o, b in zip(self.pieces, odd, is_byte, strict=True) if not (o or b)):
            raise ValueError("a piece crosses a word start")
        score = np.array([model.get_score(i) for i in range(n)])
        plain = np.flatnonzero(~(np.array(odd) | np.array(is_byte)))
        # scores of merge rules are ranks, not logarithms: a piece of rank r weighs 1 / (r + 1), as words do by Zipf's law
        ranks = bool(len(plain)) and bool(np.all(score[plain] == np.round(score[plain]))) and score[plain].min() < -1000
        weight = -np.log(np.minimum(-score, 1e6) + 1) if ranks else score
        self.weight = alpha * weight
        self.byte_weight = alpha * (weight[plain].min() - 1)
        self.byte_id = np.zeros(256, np.int32)
        for i in np.flatnonzero(is_byte):
            self.byte_id[int(self.pieces[i][3:-1], 16)] = i
        self.raw = [bytes([int(p[3:-1], 16)]) if b else p.replace(_SPACE, " ").encode() if not o else b"" for p, b, o in zip(self.pieces, is_byte, odd, strict=True)]
        self.raw_column = pa.array(self.raw, pa.large_binary())
        self.longest = max(len(self.pieces[i]) for i in plain)
        if self.longest > 62:
            raise ValueError("pieces must have 62 characters at most")
        by_length: list[dict[str, int]] = [{} for _ in range(self.longest)]
        for i in plain.tolist():
            piece = self.pieces[i]
            for size in range(1, len(piece)):
                by_length[size - 1].setdefault(piece[:size], -1)
            by_length[len(piece) - 1][piece] = i
        hashes, ids = [], []
        for size, found in enumerate(by_length, 1):
            points = np.frombuffer("".join(found).encode("utf-32-le"), np.uint32).reshape(-1, size)
            hashes.append(mix((_points(points.ravel()).reshape(-1, size) * powers(_BASE, size)).sum(axis=1, dtype=np.uint64) + np.uint64(size)))
            ids.append(np.fromiter(found.values(), np.int32, len(found)))
        order = np.argsort(h := np.concatenate(hashes))
        self.hashes, self.ids = np.append(h[order], np.uint64(2**64 - 1)), np.append(np.concatenate(ids)[order], np.int32(-2))
        self.first = np.searchsorted(self.hashes, np.arange(1 << 18, dtype=np.uint64) << np.uint64(46)).astype(np.int32)
        # beginnings of one and two characters are looked up by character; the last number is that of all other characters
        self.ones = np.full(0x110000, -2, np.int32)
        self.ones[[ord(c) for c in by_length[0]]] = list(by_length[0].values())
        letters = sorted({c for two in (by_length[1] if self.longest > 1 else ()) for c in two})
        self.number = np.full(0x110000, len(letters), np.int16)
        self.twos = None
        if len(letters) < PAIRS:
            self.number[[ord(c) for c in letters]] = np.arange(len(letters))
            self.twos = np.full((len(letters) + 1, len(letters) + 1), -2, np.int32)
            for two, i in (by_length[1] if self.longest > 1 else {}).items():
                self.twos[self.number[ord(two[0])], self.number[ord(two[1])]] = i

    def find(self, h: np.ndarray) -> np.ndarray:
        """The piece of each hash; -1: a beginning of pieces only, -2: nothing."""
        spot = self.first[h >> np.uint64(46)]
        wait = np.flatnonzero(self.hashes[spot] < h)
        while len(wait):
            spot[wait] += 1
            wait = wait[self.hashes[spot[wait]] < h[wait]]
        return np.where(self.hashes[spot] == h, self.ids[spot], -2)

    def joined(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of ids, and where those of each list ids[at[i]:at[i+1]] begin."""
        _, ends, data = self.raw_column.take(pa.array(ids)).buffers()
        total = np.frombuffer(ends, np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        return np.frombuffer(data, np.uint8)[: total[-1]] if data is not None else np.zeros(0, np.uint8), total[at]


def _points(points: np.ndarray) -> np.ndarray:
    return mix(points.astype(np.uint64) + _C2)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + size[0] - 1, then the same of the others."""
    return np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)


_LOADED: dict[tuple[str, float], Vocabulary] = {}


def vocabulary(path: str, alpha: float) -> Vocabulary:
    if (path, alpha) not in _LOADED:
        _LOADED[path, alpha] = Vocabulary(path, alpha)
    return _LOADED[path, alpha]


def split(texts: list[str]) -> tuple[np.ndarray, ...]:
    """(points, start, size, doc): the characters of all texts, spaces as marks and one in front of each, and their words.

    A word is one mark or more and what follows them; empty texts have none.
    """
    marked = [_SPACE + t.replace(" ", _SPACE) if t else "" for t in texts]
    points = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32)
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    mark = points == ord(_SPACE)
    first = mark.copy()
    first[1:] &= ~mark[:-1]
    first[(np.cumsum(size) - size)[size > 0]] = True
    start = np.flatnonzero(first)
    doc = np.searchsorted(np.cumsum(size), start, "right")
    return points, start, np.diff(np.append(start, len(points))), doc


class Lattice:
    """The lattices of many words, one after the other: the edges of a position lie together, the longest first,
    as it is the likeliest.

    share: the edge's probability, given its position; piece: the piece, or ~character for one that becomes
    bytes; left: characters up to the word's end. Words are told apart by 64-bit hashes. Those that come
    again are kept for the next texts, the others are forgotten.
    """

    def __init__(self, v: Vocabulary):
        self.v = v
        self.hashes, self.numbers, self.seen = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1 << 22, bool)
        self.start, self.size, self.left, self.ptr = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.length, self.piece, self.share = np.zeros(0, np.uint8), np.zeros(0, np.int32), np.zeros(0)
        self.kept = 0, 0, 0  # words, positions, edges

    def rows(self, points: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The numbers of these words; new ones are entered."""
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_points(points) * powers(_BASE, len(points)))])
        inverse = powers(_BASE_INV, len(points) + 1)
        h = mix((total[start + size] - total[start]) * inverse[start] + size.astype(np.uint64))
        h, first, back, many = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        spot = np.searchsorted(self.hashes, h)
        known = np.append(self.hashes, np.uint64(0))[spot] == h
        known &= spot < len(self.hashes)
        number = np.empty(len(h), np.int64)
        number[known] = self.numbers[spot[known]]
        new = np.flatnonzero(~known)
        if len(new):
            place = (h[new] >> np.uint64(42)).astype(np.int64)
            again = (many[new] > 1) | self.seen[place]
            self.seen[place] = True
            number[new[again]] = len(self.start) + np.arange(int(again.sum()))
            self.hashes, self.numbers = (np.insert(x, spot[new[again]], y[new[again]]) for x, y in ((self.hashes, h), (self.numbers, number)))
            number[new[~again]] = len(self.start) + int(again.sum()) + np.arange(int((~again).sum()))
            words, keep = first[np.concatenate([new[again], new[~again]])], first[new[again]]
            kept = len(self.start) + len(keep), len(self.left) + int(size[keep].sum())
            self._add(points, total, inverse, start[words], size[words])
            self.kept = *kept, int(self.ptr[kept[1]])
        return number[back]

    def forget(self) -> None:
        """Words that came once are forgotten; if too many are left, all are."""
        words, positions, edges = self.kept
        if positions > KEPT or len(self.share) > 12 * KEPT:
            self.__init__(self.v)
            return
        self.start, self.size, self.left, self.ptr = self.start[:words], self.size[:words], self.left[:positions], self.ptr[: positions + 1]
        self.length, self.piece, self.share = self.length[:edges], self.piece[:edges], self.share[:edges]

    def _add(self, points: np.ndarray, total: np.ndarray, inverse: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        if not len(start):
            return
        end, at = np.cumsum(size), _ranges(start, size)
        n = len(at)
        left = np.repeat(end, size) - np.arange(n)
        parts = [_edges(points, total, inverse, at[lo : lo + SLICE], left[lo : lo + SLICE], self.v) for lo in range(0, n, SLICE)]
        count = np.concatenate([p[0] for p in parts])
        length, piece, weight = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
        del parts
        ptr = np.concatenate([[0], np.cumsum(count)])
        share = _conditional(ptr, length, weight, self.v.longest)
        before, edges = len(self.left), len(self.share)
        self.start, self.size = self._grown("start", before + end - size), self._grown("size", size)
        self.left, self.ptr = self._grown("left", left), self._grown("ptr", edges + ptr[1:])
        self.length, self.piece, self.share = self._grown("length", length), self._grown("piece", piece), self._grown("share", share)

    def _grown(self, name: str, more: np.ndarray) -> np.ndarray:
        """The array of that name and more, in room that grows by half when it runs out."""
        have = getattr(self, name)
        room, n = have if have.base is None else have.base, len(have) + len(more)
        if n > len(room):
            room = np.empty(max(n, len(room) * 3 // 2), have.dtype)
            room[: len(have)] = have
        room[len(have) : n] = more
        return room[:n]

    def pick(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge of each position, by uniform numbers."""
        edge = self.ptr[node]
        rest = u - self.share[edge]
        wait = np.flatnonzero(rest >= 0)
        at, last, rest = edge[wait], self.ptr[node[wait] + 1] - 1, rest[wait]
        while len(wait):
            at = np.minimum(at + 1, last)
            go = np.flatnonzero((at < last) & ((rest := rest - self.share[at]) >= 0))
            edge[wait] = at
            wait, at, last, rest = wait[go], at[go], last[go], rest[go]
        return edge

    def others(self, node: np.ndarray, barred: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log-probability, edge) of the edges of each position but those of barred lengths: rows of `longest`, filled up with -inf."""
        edge = self.ptr[node][:, None] + np.arange(self.v.longest)
        there = edge < self.ptr[node + 1][:, None]
        edge = np.where(there, edge, self.ptr[node][:, None])
        gone = barred[:, None] >> self.length[edge].astype(np.int64) & 1
        with np.errstate(divide="ignore"):
            return np.where(there & (gone == 0), np.log(self.share[edge]), -np.inf), edge

    def ids(self, edge: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of edges, and where those of each list edge[at[i]:at[i+1]] begin."""
        piece = self.piece[edge]
        lone = np.flatnonzero(piece < 0)
        if not len(lone):
            return piece, at
        c = ~piece[lone].astype(np.int64)
        lead, more = np.array([0, 0xC0, 0xE0, 0xF0]), (c > 0x7F).astype(np.int64) + (c > 0x7FF) + (c > 0xFFFF)
        count = np.ones(len(piece), np.int64)
        count[lone] += more
        first = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.int32)
        out[first[piece >= 0]] = piece[piece >= 0]
        out[first[lone]] = self.v.byte_id[lead[more] + (c >> 6 * more)]
        for i in range(1, 4):
            deep = more >= i
            out[first[lone[deep]] + i] = self.v.byte_id[0x80 + (c[deep] >> 6 * (more[deep] - i) & 0x3F)]
        return out, np.concatenate([first, [len(out)]])[at]


def _edges(points: np.ndarray, total: np.ndarray, inverse: np.ndarray, place: np.ndarray, left: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, ...]:
    """(edges of each position; length, piece, weight of each edge), by position, the longest first; no edge leaves its word.

    place: where the positions are among the points, of which total and inverse are the running hashes.
    """
    at, p, found, count = np.arange(len(place)), place, [], np.ones(len(place), np.int64)
    own = points[place]
    number = v.number[own]
    for size in range(1, v.longest + 1):
        if size > 1:
            at = at[left[at] >= size]
            p = place[at]
        if size == 1:
            ids = v.ones[own]
        elif size == 2 and v.twos is not None:
            ids = v.twos[number[at], v.number[points[p + 1]]]
        else:
            ids = v.find(mix((total[p + size] - total[p]) * inverse[p] + np.uint64(size)))
        if size == 1:  # characters without a piece become bytes
            found.append((at, np.where(ids < 0, ~own.astype(np.int32), ids)))
        else:
            found.append((at[ids >= 0], ids[ids >= 0]))
            count[found[-1][0]] += 1
        at = at[ids > -2]  # beginnings of pieces go on
    free = np.cumsum(count)
    length, piece = np.empty(int(count.sum()), np.uint8), np.empty(int(count.sum()), np.int32)
    for size, (at, ids) in enumerate(found, 1):
        free[at] -= 1
        spot = free[at]
        length[spot], piece[spot] = size, ids
    weight, lone = v.weight[np.maximum(piece, 0)], np.flatnonzero(piece < 0)
    c = ~piece[lone]
    weight[lone] = v.byte_weight * (1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF))
    return count, length, piece, weight


def _conditional(ptr: np.ndarray, length: np.ndarray, weight: np.ndarray, longest: int) -> np.ndarray:
    """The probability of each edge, given its position, from backward sums.

    Sums run within stretches that no edge leaves, so what follows a stretch cancels out.
    """
    n, count = len(ptr) - 1, np.diff(ptr)
    reach = np.maximum.accumulate(np.arange(n) + length[ptr[:-1]])
    cut = np.flatnonzero(np.append(True, reach[:-1] <= np.arange(1, n)))
    size = np.diff(np.append(cut, n))
    far = np.repeat(np.append(cut[1:], n), size) - np.arange(n)  # to the end of the stretch
    share, beta = np.empty(len(weight)), np.zeros(n + longest + 1)
    order = np.argsort(far, kind="stable")
    order = order[: np.searchsorted(far[order], STRETCH, "right")]
    many = count[order]
    edges, first = _ranges(ptr[order], many), np.concatenate([[0], np.cumsum(many)])
    bound = np.searchsorted(far[order], np.arange(1, (far[order[-1]] if len(order) else 0) + 2))
    step, near = length[edges].astype(np.int64), min(len(bound), SHORT + 1)
    to, mass, w = np.repeat(order, many) + step, np.empty(len(edges)), weight[edges]
    # near the end of a stretch sums are taken as they are, a factor for each character keeps them in range; if that fails, and farther on, as logarithms
    scaled, sums = np.exp(w + FACTOR * step), np.ones(n + longest + 1)
    for d in range(1, near):
        lo, hi = bound[d - 1], bound[d]
        if lo < hi:
            e = slice(first[lo], first[hi])
            x = scaled[e] * np.where(step[e] == d, 1.0, sums[to[e]])
            total = np.add.reduceat(x, first[lo:hi] - first[lo])
            sums[order[lo:hi]] = total
            mass[e] = x / np.repeat(total, many[lo:hi])
    done = order[: bound[near - 1]] if near > 1 else order[:0]
    if len(done) and not (1e-250 < sums[done].min() and sums[done].max() < 1e250):
        done, near = done[:0], 1
    if len(done) < n:
        beta[done] = np.log(sums[done]) - FACTOR * far[done]
    share[edges[: first[len(done)]]] = mass[: first[len(done)]]
    for d in range(near, len(bound)):
        lo, hi = bound[d - 1], bound[d]
        if lo < hi:
            e, starts = slice(first[lo], first[hi]), first[lo:hi] - first[lo]
            x = w[e] + np.where(step[e] == d, 0.0, beta[to[e]])
            top = np.maximum.reduceat(x, starts)
            beta[order[lo:hi]] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, many[lo:hi])), starts))
            share[edges[e]] = np.exp(x - np.repeat(beta[order[lo:hi]], many[lo:hi]))
    for a, b in zip(cut[size > STRETCH].tolist(), (cut + size)[size > STRETCH].tolist(), strict=True):
        for hi in range(b - STRETCH, a, -SLICE):
            lo = max(a, hi - SLICE)
            e0, e1 = int(ptr[lo]), int(ptr[hi])
            starts, steps, w, sums = (ptr[lo : hi + 1] - e0).tolist(), length[e0:e1].tolist(), weight[e0:e1].tolist(), beta[lo : hi + longest].tolist()
            for p in range(hi - lo - 1, -1, -1):
                x = [w[e] + sums[p + steps[e]] for e in range(starts[p], starts[p + 1])]
                top = max(x)
                sums[p] = top + math.log(sum([math.exp(y - top) for y in x]))
            beta[lo:hi] = sums[: hi - lo]
            at = np.repeat(np.arange(lo, hi), count[lo:hi])
            share[e0:e1] = np.exp(weight[e0:e1] + beta[at + length[e0:e1]] - beta[at])
    return share


def _uniform(seed: np.ndarray, sample: int, at: np.ndarray) -> np.ndarray:
    h = mix(seed ^ mix(at.astype(np.uint64) * _C1 + np.uint64((sample + 1) * _C3 % 2**64)))
    return ((h >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53


def _key(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    return doc.astype(np.int64) << 40 | at


def _draw(lat: Lattice, doc: np.ndarray, node: np.ndarray, at: np.ndarray, seeds: np.ndarray, sample: int) -> tuple[np.ndarray, ...]:
    """Paths from these positions to their words' ends, one after the other: (doc, node, edge, at); at is the place in the text."""
    long = lat.left[node] > WORD
    seed, ahead, out, count = seeds[doc], at - node, [], np.zeros(len(node), np.int64)
    row = np.flatnonzero(~long)
    p, own, shift = node[row], seed[row], ahead[row]
    while len(p):
        e = lat.pick(p, _uniform(own, sample, p + shift))
        out.append((row, p, e))
        step = lat.length[e]
        more = lat.left[p] > step
        count[row[~more]] = len(out)
        go = np.flatnonzero(more)
        row, p, own, shift = row[go], p[go] + step[go], own[go], shift[go]
    short = len(out)
    for j in np.flatnonzero(long).tolist():
        n, spot = int(lat.left[node[j]]), 0
        for lo in range(0, n, SLICE):  # an edge for every position; those on the path count
            every = np.arange(lo, min(n, lo + SLICE))
            e = lat.pick(node[j] + every, _uniform(np.full(len(every), seed[j]), sample, at[j] + every))
            steps, visited = lat.length[e].tolist(), []
            while spot < lo + len(every):
                visited.append(spot)
                spot += steps[spot - lo]
            seen = np.array(visited, np.int64)
            out.append((np.full(len(seen), j), node[j] + seen, e[seen - lo]))
            count[j] += len(seen)
    total, free = int(count.sum()), np.cumsum(count) - count
    nodes, edges = np.empty(total, np.int64), np.empty(total, np.int64)
    for i, (row, p, e) in enumerate(out[:short]):  # the i-th edge of each path
        spot = free[row] + i
        nodes[spot], edges[spot] = p, e
    for row, p, e in out[short:]:  # a stretch of one path
        if len(row):
            spot = free[row[0]] + np.arange(len(row))
            nodes[spot], edges[spot] = p, e
            free[row[0]] += len(row)
    return np.repeat(doc, count), nodes, edges, nodes + np.repeat(ahead, count)


def _log_sums(x: np.ndarray, size: np.ndarray) -> np.ndarray:
    """log of the sum of exp of each stretch of x; -inf for empty ones."""
    out, full = np.full(len(size), -np.inf), size > 0
    if full.any():
        starts, many = (np.cumsum(size) - size)[full], size[full]
        top = np.maximum.reduceat(x, starts)
        with np.errstate(divide="ignore", invalid="ignore"):
            out[full] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(np.where(np.isfinite(top), top, 0.0), many)), starts))
    return out


def _truncated(mass: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbels of location `mass`, given that they are at most `bound`; -inf for sets without paths."""
    some, out = np.isfinite(mass) & np.isfinite(bound), np.full(len(mass), -np.inf)
    out[some] = -np.logaddexp(np.log(-np.log(u[some])) - mass[some], -bound[some])
    return out


class Paths:
    """A path of each text (none: value -inf), and the set it was drawn from: its first `free` edges are the set's, `barred` lengths (bits) don't follow them."""

    def __init__(self, lat: Lattice, drawn: tuple[np.ndarray, ...], value: np.ndarray, free: np.ndarray, barred: np.ndarray):
        doc, self.node, self.edge, self.at = drawn
        self.value, self.free, self.barred = value, free, barred
        self.ptr = np.searchsorted(doc, np.arange(len(value) + 1))
        share = lat.share[self.edge]
        edge = np.log(share)
        total = np.concatenate([[0.0], np.cumsum(edge)])
        before = total[:-1] - total[self.ptr[:-1]][doc]
        self.log, full = np.zeros(len(value)), np.diff(self.ptr) > 0
        if full.any():
            self.log[full] = np.add.reduceat(edge, self.ptr[:-1][full])
        sure = edge > -1e-12
        off = np.log1p(-np.where(sure, 0.5, share))
        self.turns = np.where(sure | (np.arange(len(doc)) < (self.ptr[:-1] + free)[doc]), -np.inf, before + off)  # log-probability of turning off at each edge
        some = np.flatnonzero(barred)
        if len(some):
            f = (self.ptr[:-1] + free)[some]
            rest, _ = lat.others(self.node[f], barred[some] | 1 << lat.length[self.edge[f]].astype(np.int64))
            self.turns[f] = before[f] + _log_sums(rest.ravel(), np.full(len(some), rest.shape[1]))
        self.rest = np.full(len(value), -np.inf)  # perturbed maximum of what is left of the set

    def left_over(self, doc: np.ndarray) -> np.ndarray:
        size = self.ptr[doc + 1] - self.ptr[doc]
        return _log_sums(self.turns if len(doc) == len(self.value) else self.turns[_ranges(self.ptr[doc], size)], size)

    def turn(self, doc: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge (its place in the arrays) at which to turn off, in proportion to the probabilities of the sets."""
        size = self.ptr[doc + 1] - self.ptr[doc]
        starts = np.cumsum(size) - size
        logs = self.turns if len(doc) == len(self.value) else self.turns[_ranges(self.ptr[doc], size)]
        total = np.concatenate([[0.0], np.cumsum(np.exp(logs - np.repeat(np.maximum.reduceat(logs, starts), size)))])
        low, high = total[starts], total[starts + size]
        want = np.clip(low + u * (high - low), low, np.nextafter(high, -np.inf))
        return self.ptr[doc] + np.searchsorted(total[1:], want, "right") - starts


def sample_paths(lat: Lattice, words: np.ndarray, doc: np.ndarray, seeds: np.ndarray, k: int) -> tuple[list[Paths], np.ndarray]:
    """The k (or all, if fewer) paths of the largest perturbed log-probability of each text, and the next such value.

    words: the lattice's word at each place of the texts, one after the other; doc: its text.
    """
    n, start, size = len(seeds), lat.start[words], lat.size[words]
    first = np.searchsorted(doc, np.arange(n + 1))
    at = np.cumsum(size) - size
    at = at - np.append(at, 0)[first[:-1]][doc] if len(at) else at
    place = _key(doc, at)
    noise = [_uniform(seeds, 1_000 + i, np.full(n, 1 << 39)) for i in range(4 * (k + 1))]
    none = np.zeros(n, np.int64)
    out = [Paths(lat, _draw(lat, doc, start, at, seeds, 0), -np.log(-np.log(noise[0])), none, none)]
    out[0].rest = _truncated(out[0].left_over(np.arange(n)), out[0].value, noise[1])
    for turn in range(1, k):
        rests = np.stack([p.rest for p in out])
        parent, live = rests.argmax(axis=0), np.isfinite(rests.max(axis=0))
        if not live.any():
            break
        value, free, barred, old, new = np.full(n, -np.inf), none.copy(), none.copy(), [], []
        for s, p in enumerate(out):
            own = np.flatnonzero(live & (parent == s))
            if not len(own):
                continue
            e = p.turn(own, noise[4 * turn][own])
            node, spot, count = p.node[e], p.at[e], e - p.ptr[own]
            bars = np.where(count == p.free[own], p.barred[own], 0) | 1 << lat.length[p.edge[e]].astype(np.int64)
            logs, edges = lat.others(node, bars)
            mass = np.cumsum(np.exp(logs - logs.max(axis=1, keepdims=True)), axis=1)
            pick = (mass <= np.minimum(noise[4 * turn + 1][own] * mass[:, -1], np.nextafter(mass[:, -1], 0))[:, None]).sum(axis=1)
            other = edges[np.arange(len(own)), pick]
            kept = _ranges(p.ptr[own], count)
            old += [(np.repeat(own, count), p.node[kept], p.edge[kept], p.at[kept]), (own, node, other, spot)]
            value[own], free[own], barred[own] = p.rest[own], count, bars
            p.turns[e] = -np.inf
            p.rest[own] = _truncated(p.left_over(own), value[own], noise[4 * turn + 3][own])
            # all that follows the turn is drawn anew: the rest of the word, then the words after it
            step = lat.length[other].astype(np.int64)
            inside = step < lat.left[node]
            new.append((own[inside], (node + step)[inside], (spot + step)[inside]))
            after = np.searchsorted(place, _key(own, spot), "right")
            after = _ranges(after, first[own + 1] - after)
            new.append((doc[after], start[after], at[after]))
        before, starts = _sorted(old, 3), _sorted(new, 2)
        child = Paths(lat, _after(before, _draw(lat, *starts, seeds, turn), n), value, free, barred)
        child.rest = _truncated(child.left_over(np.arange(n)), value, noise[4 * turn + 2])
        out.append(child)
    return out, np.max([p.rest for p in out], axis=0)


def _sorted(parts: list[tuple[np.ndarray, ...]], at: int) -> tuple[np.ndarray, ...]:
    """All parts, by text and place (the columns 0 and `at`)."""
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
    order = np.argsort(_key(columns[0], columns[at]), kind="stable")
    return tuple(x[order] for x in columns)


def _after(first: tuple[np.ndarray, ...], then: tuple[np.ndarray, ...], n: int) -> tuple[np.ndarray, ...]:
    """Of each of n texts the rows of `first`, then those of `then`; column 0 is the text."""
    a, b = (np.bincount(x[0], minlength=n) for x in (first, then))
    place_a = np.arange(len(first[0])) + (np.cumsum(b) - b)[first[0]]
    place_b = np.arange(len(then[0])) + np.cumsum(a)[then[0]]
    out = []
    for x, y in zip(first, then, strict=True):
        z = np.empty(len(x) + len(y), np.int64)
        z[place_a], z[place_b] = x, y
        out.append(z)
    return tuple(out)


def _seeds(keys: pa.Array, seed: int) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(f"{seed}\x1f{k}".encode(), digest_size=8).digest(), "little") for k in keys.to_pylist()], np.uint64)


def sample_encodings(
    docs: DataFrame, tokenizer: str, k: int = 3, alpha: float = 1.0, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, decode_to: str | None = None
) -> DataFrame:
    """(id, sample int, ids array<int>, n_tokens long, log_prob double, inclusion double), k rows for each row of docs.

    The samples of a text are distinct segmentations, in the order of their perturbed log-probabilities
    (sample 1 is an ordinary draw); a text with fewer than k segmentations returns them all. log_prob is the
    segmentation's log-probability, scaled by alpha before normalising; inclusion is the probability that
    it is among the k, given the k+1st value (1 if there is none; its last digits may vary from run to run).
    ids have no begin or end tokens. digest: instead of ids, ids_sha256 of their 32-bit little-endian bytes
    and round_trip, whether they decode to the text. decode_to names a further column for the text that the
    ids decode to. The row's key seeds its samples: equal keys and texts have equal ones, null keys too.
    Null and empty texts have one empty segmentation. U+2581 counts as the space it stands for. Whole texts
    are sampled, words of any length too; other columns are left out, whatever their names; an empty table
    gives an empty result.
    """
    narrow = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    kind = docs.schema[id_col].dataType.simpleString()
    value = "ids_sha256 string, round_trip boolean" if digest else "ids array<int>"
    names = [id_col, "sample", "n_tokens", "log_prob", "inclusion", *(["ids_sha256", "round_trip"] if digest else ["ids"]), *[decode_to] * bool(decode_to)]

    def some(batch: pa.RecordBatch, lat: Lattice) -> Iterator[pa.RecordBatch]:
        texts = batch.column(1).to_pylist()
        *words, doc = split(texts)
        words = lat.rows(*words)
        want = [t.replace(_SPACE, " ").encode() for t in texts] if digest else []
        samples, kappa = sample_paths(lat, words, doc, _seeds(batch.column(0), seed), k)
        for n, p in enumerate(samples, 1):
            there = np.isfinite(p.value)
            with np.errstate(over="ignore"):
                included = np.where(np.isfinite(kappa), -np.expm1(-np.exp(np.minimum(700.0, p.log - np.where(np.isfinite(kappa), kappa, 0.0)))), 1.0)
            ids, at = lat.ids(p.edge, p.ptr)
            ids = ids.astype("<i4", copy=False)
            columns = [batch.column(0), pa.array(np.full(len(texts), n, np.int32)), pa.array(np.diff(at)), pa.array(p.log), pa.array(included)]
            bounds = list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
            raw = []
            if digest or decode_to:
                data, cut = lat.v.joined(ids, at)
                data, cut = memoryview(data), cut.tolist()
                raw = [data[a + 1 : b] if b > a and data[a] == 32 else data[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
            if digest:
                view = memoryview(ids)
                columns += [pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in bounds]), pa.array([x == y for x, y in zip(raw, want, strict=True)], pa.bool_())]
            else:
                columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids)))
            if decode_to:
                columns.append(pa.array([str(x, "utf-8", "replace") for x in raw], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(there))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(tokenizer, alpha)
        lat = Lattice(v)
        for batch in batches:
            for lo, hi in chunks(utf8(batch.column(1))[1], TEXT):
                yield from some(batch.slice(lo, hi - lo), lat)
                lat.forget()

    return narrow.mapInArrow(lean(run), f"`{id_col}` {kind}, sample int, n_tokens long, log_prob double, inclusion double, {value}" + (f", `{decode_to}` string" if decode_to else ""))


def decode_ids(df: DataFrame, tokenizer: str, ids_col: str = "ids", to: str = "text") -> DataFrame:
    """df and a column of the texts of ids: pieces and bytes joined, marks as spaces, without the one in front.

    Null ids give null, empty ones an empty text; bytes that aren't UTF-8 become U+FFFD; null ids in a list
    and numbers outside the vocabulary are an error. A column of the name `to` is replaced; other columns
    stay, whatever their names.
    """
    rest = df.drop(to)
    at, names = rest.columns.index(ids_col), [*rest.columns, to]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(tokenizer, 1.0)
        for batch in batches:
            texts: list[str | None] = []
            for ids in batch.column(at):
                data, _ = v.joined(np.asarray(ids.values, np.int64), np.zeros(1, np.int64)) if ids.is_valid else (None, None)
                text = None if data is None else data.tobytes().decode("utf-8", "replace")
                texts.append(text[1:] if text and text[0] == " " else text)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names)

    return rest.mapInArrow(lean(run), rest.withColumn(to, F.lit("")).schema)
