"""Spelling variants among the words of a corpus: pairs of words one edit apart, by a positional q-gram index.

Words are cut into pairs of characters (q = 2, padded at both ends). One edit destroys at most q of a word's
grams, so two near words of L and at most L characters share L - 1 grams or more, at positions that differ by
what their lengths do. The index is dealt out by halves of words: one edit leaves the first or the second
half as it is, so every near pair meets in the shard of a half. In a shard the posting lists of the other half's
grams are merged: the shortest lists of a word give its candidates (enough of them that no near word is in
none), all grams count, and pairs over the bound are compared character by character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.store import Scratch
from sedimenta.llm.textbytes import lean, mix

#: What counts as a word: maximal runs of these.
LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Shards of more words are worked on in pairs of parts.
TILE = 4096
#: Characters of a matrix of words, and pairs compared, at once.
CELLS, PAIRS = 2_000_000, 200_000


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, run): each run of letters of each text, A-Z lower-cased."""
    run = F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0)))
    rows = docs.select(F.col(doc_id).alias("doc_id"), run.alias("run"))
    wide = F.translate("run", UPPER, LOWER)  # lower() would change other letters too
    return rows.withColumn("run", F.when(F.col("run").rlike("[À-Þ]"), wide).otherwise(F.lower("run")))


def with_slips(words: DataFrame, one_in: int = 97) -> DataFrame:
    """(word) of rows (doc_id, run), of which one in `one_in` loses a character, by the hash of id and run. A null id reads as an empty one."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run").cast("binary"))
    rows = words.select("run", h.alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    short = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.char_length("run")))
    return rows.select(F.when(F.col("h") % one_in == 0, short).otherwise(F.col("run")).alias("word"))


def common_words(words: DataFrame, length: int = 5, least: int = 3) -> DataFrame:
    """(word, n) of words of at least `length` characters that occur `least` times or more."""
    return words.where(F.char_length("word") >= length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _shards(words: DataFrame) -> DataFrame:
    """(key, probe, word, n): each word in the shards of its halves, and as a probe in those of words with a character more."""
    size = F.char_length("word")
    cut, more = F.floor(size / 2).cast("int"), F.floor((size + 1) / 2).cast("int")

    def place(side: str, of: F.Column, part: F.Column, probe: int) -> F.Column:
        return F.struct(F.concat(F.lit(side), of.cast("string"), F.lit(":"), part).alias("key"), F.lit(probe).cast("byte").alias("probe"))

    word, rest = F.col("word"), F.char_length("word")
    spots = F.array(
        place("<", size, word.substr(F.lit(1), cut), 0), place(">", size, word.substr(cut + 1, rest), 0),
        place("<", size + 1, word.substr(F.lit(1), more), 1), place(">", size + 1, word.substr(more, rest), 1),
    )
    return words.select(F.explode(spots).alias("s"), "word", "n").select("s.key", "s.probe", "word", "n")


def _ranges(lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, value): the values lo[i] .. lo[i] + n[i] - 1 of each i."""
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


def _rank(order: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The place (from 0) of each entry among those of its group, when entries are taken in the given order. of: groups, ascending in that order."""
    place = np.empty(len(order), np.int64)
    its = of[order]
    first = np.flatnonzero(np.r_[True, its[1:] != its[:-1]])
    place[order] = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    return place


def near_pairs(words: list[str], group: np.ndarray, probe: np.ndarray, part: np.ndarray, shared: np.ndarray, longest: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): places of near words of one group that share their first `shared` characters.

    Words of a group have its `longest` characters, probes one less; probes pair with the others only. Where
    `apart` is set, only words of different parts pair.
    """
    none = np.zeros(0, np.int64)
    size = longest - probe
    chars = np.array(words).reshape(-1)
    chars = chars.view(np.uint32).reshape(len(words), -1)
    wide = np.zeros((len(words), chars.shape[1] + 2), np.uint32)
    wide[:, 1:-1] = chars
    # grams that the shared part doesn't give: positions shared .. size of the padded word
    who, at = _ranges(shared, size + 1 - shared)
    one, two = wide[who, at].astype(np.uint64), wide[who, at + 1].astype(np.uint64)
    gram = mix(one << np.uint64(32) | two) ^ mix(group[who].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    key = mix(gram + at.astype(np.uint64))
    listed = np.flatnonzero(probe[who] == 0)
    by = listed[np.argsort(key[listed], kind="stable")]
    posting, owner = key[by], who[by]
    # of a word's grams at most two are not in a near word of its length, at most one in a near longer one
    entry = np.arange(len(who))
    lo, n = np.searchsorted(posting, key, "left"), np.searchsorted(posting, key, "right")
    n -= lo
    later = probe[who] == 1  # in a longer word the gram may lie one further
    key_1 = mix(gram[later] + (at[later] + 1).astype(np.uint64))
    lo_1 = np.searchsorted(posting, key_1, "left")
    n_1 = np.searchsorted(posting, key_1, "right") - lo_1
    cost = n.copy()
    cost[later] += n_1
    short = _rank(np.lexsort((cost, who)), who) < 3 - probe[who]
    pick, pick_1 = entry[short], np.flatnonzero(short[later])
    a = np.concatenate([np.repeat(who[pick], n[pick]), np.repeat(who[later][pick_1], n_1[pick_1])])
    b = np.concatenate([owner[_ranges(lo[pick], n[pick])[1]], owner[_ranges(lo_1[pick_1], n_1[pick_1])[1]]]) if len(a) else none
    ok = (group[a] == group[b]) & ((probe[a] == 1) | (a < b)) & (~apart[a] | (part[a] != part[b]))
    pairs = np.unique(a[ok] * np.int64(len(words)) + b[ok])
    out_a, out_b = [none], [none]
    for i in range(0, len(pairs), PAIRS):
        a, b = pairs[i : i + PAIRS] // len(words), pairs[i : i + PAIRS] % len(words)
        x, y, most = wide[a], wide[b], int(longest[b].max())
        same, shifted = (x == y)[:, : most + 2], np.zeros((len(a), most + 2), bool)
        shifted[:, :-1] = (x[:, : most + 1] == y[:, 1 : most + 2]) & (probe[a] == 1)[:, None]
        spot = np.arange(most + 1)
        in_word = spot[None] <= size[a][:, None]  # gram p has the characters p - 1 and p
        common = ((same[:, :-1] & same[:, 1:] | shifted[:, :-1] & shifted[:, 1:]) & in_word).sum(1)
        good = common >= longest[b] - 1
        a, b, same, shifted = a[good], b[good], same[good], shifted[good]
        spot = np.arange(most + 2)
        inside = (spot[None] >= 1) & (spot[None] <= size[a][:, None])
        unlike = (~same & inside).sum(1) == 1
        head = np.where(~same & inside, spot[None], size[a][:, None] + 1).min(1) - 1  # characters alike from the front
        tail = size[a] - np.where(~shifted & inside, spot[None], 0).max(1)  # and from the end, one further
        near = np.where(probe[a] == 1, head + tail >= size[a], unlike)
        out_a.append(a[near])
        out_b.append(b[near])
    return np.concatenate(out_a), np.concatenate(out_b)


def _first_alike(words: list[str], a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether words a and b have the same first n characters."""
    return np.fromiter((words[i][:k] == words[j][:k] for i, j, k in zip(a.tolist(), b.tolist(), n.tolist(), strict=True)), bool, len(a))


@lean
def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, one, two, side, probe, word, n) by shard or pair of its parts: (word, n_near, best_n, best) of what each word meets here."""

    def solved(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        new = np.fromiter((i == 0 or rows[i][:3] != rows[i - 1][:3] for i in range(len(rows))), bool, len(rows))
        group = np.cumsum(new) - 1
        heads = [rows[i] for i in np.flatnonzero(new)]
        long = np.array([int(r[0][1 : r[0].index(":")]) for r in heads])
        right = np.array([r[0][0] == ">" for r in heads])
        cut = long // 2
        probe, n = np.array([r[4] for r in rows], np.int64), np.array([r[6] for r in rows], np.int64)
        words = [r[5] for r in rows]
        turned = [w[::-1] if back else w for w, back in zip(words, right[group].tolist(), strict=True)]
        a, b = near_pairs(turned, group, probe, np.array([r[3] for r in rows]), np.where(right, long - cut, cut)[group], long[group], np.array([r[1] != r[2] for r in heads])[group])
        if not len(a):
            return
        twice = right[group[a]] & (probe[a] == 1)  # a missing character may leave both halves alike: the first counts
        keep = ~twice
        keep[twice] = ~_first_alike(words, a[twice], b[twice], cut[group[a[twice]]])
        a, b = np.concatenate([a[keep], b[keep]]), np.concatenate([b[keep], a[keep]])
        if not len(a):
            return
        place = np.empty(len(rows), np.int64)
        place[np.array(sorted(range(len(rows)), key=lambda i: (-rows[i][6], words[i])))] = np.arange(len(rows))
        by = np.lexsort((place[b], a))
        a, b = a[by], b[by]
        first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        yield pa.RecordBatch.from_arrays(
            [pa.array([words[i] for i in a[first]]), pa.array(np.diff(np.r_[first, len(a)])), pa.array(n[b[first]]), pa.array([words[i] for i in b[first]])], ["word", "n_near", "best_n", "best"]
        )

    held: list[tuple] = []
    shard: list[tuple] = []
    widest = 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if shard and row[:3] != shard[0][:3]:
                if len(shard) > 1:
                    held += shard
                    widest = max(widest, len(shard[0][5]) + 1)
                    if len(held) * widest > CELLS:
                        yield from solved(held)
                        held, widest = [], 0
                shard = []
            shard.append(row)
    if len(shard) > 1:
        held += shard
    if held:
        yield from solved(held)


def nearest_words(words: DataFrame, scratch: Scratch, tile: int = TILE) -> DataFrame:
    """(word, n_near, best_n, best) of words (word, n) that have near words: how many, and that of largest n (of equals the least)."""
    rows = scratch.save(_shards(words))
    large = rows.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > tile)
    parts = F.coalesce(F.ceil(F.col("size") / tile).cast("int"), F.lit(1))
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    rows = rows.join(large, "key", "left").withColumn("parts", parts).withColumn("own", own)
    dealt = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("key", F.least("own", "with").alias("one"), F.greatest("own", "with").alias("two"), F.col("own").alias("side"), "probe", "word", "n")
    found = dealt.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two").mapInArrow(_merge, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best"))


def roots_of(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(word, root): where the links (word, form) of each word end. Each round doubles the steps taken; there must be no circle."""
    now = scratch.save(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while now.where("moved").limit(1).count():
        on = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        now = scratch.save(now.select("word", "root").join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")))
    return now.select("word", "root")


def group_variants(words: DataFrame, scratch: Scratch, ratio: int = 2, tile: int = TILE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for words (word, n), each word once and of four characters or more.

    Two words are near if one edit (a character inserted, deleted or replaced) makes one the other. A word's
    form is its near word of largest n (of equals the least) if that n is at least `ratio` (2 or more) times
    its own; the root follows forms to the last and is the word itself if it has none. An empty table stays empty.
    """
    if ratio < 2:
        raise ValueError("forms could run in a circle")
    near = nearest_words(words, scratch, tile)
    known = words.join(near, "word", "left")
    form = F.col("best_n") >= ratio * F.col("n")
    known = scratch.save(known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(form, F.col("best")).alias("form"), F.when(form, F.col("best_n")).alias("form_n")))
    ends = roots_of(scratch, known.where("form IS NOT NULL"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
