"""op11, op12 and op13 against brute force, with null, empty, repeated and very long rows, and hot groups."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from sedimenta.llm import fingerprints, spelling
from sedimenta.llm.prefix_trie import branched_turns, conversation_trie, ordered_turns
from sedimenta.llm.store import Scratch

TURNS = "conv_id long, turn long, role string, text string, depth int, key string"


def rebuilt(rows):
    by = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    by = {c: [t[2:] for t in sorted(ts)] for c, ts in by.items()}
    out = {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = by.get(c - c % 5, [])[:h] + own[h:]
    return out


class Node:
    def __init__(self, depth, up, size):
        self.depth, self.up, self.size, self.members, self.ends, self.kids = depth, up, size, [], [], {}


def trie(convs):
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of each node."""
    root, order = Node(0, None, 0), []
    order.append(root)
    for c in sorted(convs):
        at = root
        at.members.append(c)
        for turn in convs[c]:
            if turn not in at.kids:
                at.kids[turn] = Node(at.depth + 1, at, len(turn[1].encode()))
                order.append(at.kids[turn])
            at = at.kids[turn]
            at.members.append(c)
        at.ends.append(c)
    leaves, saved = {}, {}
    for node in reversed(order):
        leaves[node] = sum(leaves[k] for k in node.kids.values()) or 1
        saved[node] = (len(node.members) - 1) * node.size + sum(saved[k] for k in node.kids.values())
    rows = [(n.members[0], n.depth, n.up.members[0] if n.up else None, len(n.members), len(n.kids), leaves[n], saved[n], hashlib.sha256(",".join(map(str, n.ends)).encode()).hexdigest()) for n in order]
    return sorted(rows, key=str) if convs else []


def run_trie(spark, rows):
    scratch = Scratch(spark, "test")
    df = spark.createDataFrame([(*r, 7, "k") for r in rows], TURNS)
    own = scratch.save(ordered_turns(df, "conv_id", "turn", "role", "text", scratch))
    turns, convs = branched_turns(own)
    return sorted(map(tuple, conversation_trie(scratch.save(turns), convs, scratch).collect()), key=str)


def test_trie_of_shared_beginnings(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "é", "", None, "ab" * 30])) for c in rng.sample(range(200), 90) for t in range(rng.randint(1, 7))]
    rows += [(c, t, "user", "same") for c in range(300, 340) for t in range(6)]  # one conversation many times
    rows += [(None, 1, "user", "x"), (400, None, "user", "first"), (400, 0, None, "second"), (400, 3, "b", "tie"), (400, 3, "a", "tie"), (400, 3, "a", "tie")]
    rng.shuffle(rows)
    assert run_trie(spark, rows) == trie(rebuilt(rows))


def test_trie_of_a_very_long_conversation(spark):
    """Longer than a segment of segments of block tops: all levels of chains and sums are used."""
    rows = [(10, t, "user", f"t{t}") for t in range(4500)]
    rows += [(12, t, "user", f"t{t}") for t in range(1, 301)] + [(14, t, "user", f"t{t}" if t < 4200 else "other") for t in range(4300)]
    convs = rebuilt(rows)
    assert max(map(len, convs.values())) > 16**3
    assert run_trie(spark, rows) == trie(convs)


def test_trie_of_nothing(spark):
    assert run_trie(spark, []) == []
    assert run_trie(spark, [(None, 1, "user", "x")]) == []


DOCS = "doc_id long, text string, fingerprint string, part int"


def documents():
    rng = random.Random(11)
    base = [" ".join(f"w{rng.randint(0, 500)}" for _ in range(400)) for _ in range(4)]
    rows = [(i, " ".join(f"w{rng.randint(0, 500)}" for _ in range(rng.randint(0, 60)))) for i in range(60)]
    rows += [(100 + i, base[i % 4] + f" tail{i}") for i in range(80)] + [(200 + i, base[0]) for i in range(20)]
    return rows + [(300, None), (301, ""), (302, " \n"), (303, "é"), (304, "x" * 200_000), (305, "long " * 60_000)]


def test_fingerprints_of_documents(spark):
    rows = documents()
    got = {r.doc_id: r for r in fingerprints.fingerprint_documents(spark.createDataFrame([(*r, "k", 1) for r in rows], DOCS).repartition(7)).collect()}
    order = [(i, t or "") for i, t in sorted(rows, reverse=True)]
    bits = {i: np.frombuffer(bytes.fromhex(got[i].fingerprint), np.uint8) for i, _ in order}
    apart = {(a, b): int(np.bitwise_count(bits[a] ^ bits[b]).sum()) for a, _ in order for b, _ in order}
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(order):
        j, after = order[(k + 1) % len(order)]
        edited = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_next == 1 - apart[i, j] / 256
        assert r.near_edited == 1 - np.bitwise_count(bits[i] ^ np.frombuffer(bytes.fromhex(r.edited_fingerprint), np.uint8)).sum() / 256
        assert r.n_links == sum(apart[i, o] <= 7 for o in bits) - 1
    assert len({got[200 + i].fingerprint for i in range(20)}) == 1
    long = [i for i, t in order if len(t) > 300 and i < 300]
    assert sum(got[i].near_edited > got[i].near_next for i in long) > 0.6 * len(long)


@pytest.mark.parametrize("tile", [16, 2048])
def test_near_classes(spark, tile):
    """A hot bucket of fingerprints within and beyond the radius, in one part and in many."""
    rng = random.Random(2)

    def flipped(p, n):
        for b in rng.sample(range(256), n):
            p ^= 1 << b
        return p

    centre = rng.getrandbits(256)
    prints = [flipped(centre, rng.randint(0, 4)) for _ in range(120)] + [rng.getrandbits(256) for _ in range(30)]
    chain = rng.getrandbits(256)
    for _ in range(12):  # neighbours are near, the ends aren't
        prints.append(chain := flipped(chain, 5))
    prints += [centre] * 10 + [0]
    rows = [(i if i % 9 else None, p.to_bytes(32, "big")) for i, p in enumerate(prints)]
    df = spark.createDataFrame([(i, bytearray(p)) for i, p in rows], "doc_id long, fingerprint binary")
    got = {bytes(r.fingerprint): (r.class_id, r.n_links) for r in fingerprints.near_classes(df, Scratch(spark, "test"), tile=tile).collect()}
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    near = [[(a ^ b).bit_count() <= 7 for b in prints] for a in prints]
    for a in range(len(prints)):
        for b in range(a):
            if near[a][b]:
                up[root(a)] = root(b)
    for a, (_, p) in enumerate(rows):
        ids = [i for k, (i, _) in enumerate(rows) if root(k) == root(a) and i is not None]
        assert got[p] == (min(ids, default=None), sum(near[a]) - 1)


def test_fingerprints_of_odd_tables(spark):
    df = spark.createDataFrame([(5, "a b c")], "doc_id long, text string")
    only = fingerprints.fingerprint_documents(df).collect()
    assert [(r.doc_id, r.near_next, r.class_id, r.n_links) for r in only] == [(5, 1.0, 5, 0)]
    assert fingerprints.fingerprint_documents(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(5, "a b c"), (5, "a b c"), (None, "z"), (5, None)], "doc_id long, text string")
    assert sorted(str((r.doc_id, r.n_chars, r.n_links)) for r in fingerprints.fingerprint_documents(twice).collect()) == ["(5, 0, 0)", "(5, 5, 1)", "(5, 5, 1)", "(None, 1, 0)"]
    with pytest.raises(ValueError, match="radius"):
        fingerprints.near_classes(twice.select("doc_id"), Scratch(spark, "test"), radius=32)


def test_equal_texts_have_equal_fingerprints_in_any_company():
    weights = np.random.default_rng(0).integers(1, 128, fingerprints.BUCKETS)
    texts = [t or "" for _, t in documents()]
    alone = np.concatenate([fingerprints.fingerprints(pa.array([t]), weights) for t in texts])
    assert (fingerprints.fingerprints(pa.array(texts), weights) == alone).all()


A_TO_Z = str.maketrans(spelling.UPPER, spelling.LOWER)


def edits(a, b):
    """Whether one inserted, deleted or replaced character makes a the other."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(counts):
    near = {w: [v for v in counts if v != w and abs(len(v) - len(w)) < 2 and edits(v, w)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * n else None
    out = []
    for w in counts:
        end = w
        while form[end]:
            end = form[end]
        out.append((w, form[w], end, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=str)


def grouped(spark, counts, **options):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted(map(tuple, spelling.group_variants(df, Scratch(spark, "test"), **options).collect()), key=str)


@pytest.mark.parametrize("tile", [8, 4096])
def test_variants_of_a_dense_vocabulary(spark, tile):
    """Few letters, so that shards are hot, characters repeat and most words have many near ones."""
    rng = random.Random(tile)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(4, 8))) for _ in range(700)} | {"aaaaaa", "aaaaaaa", "aaaaa", "𝒳yzzy", "𝒳yzz"}
    counts = {w: rng.choice([1, 2, 3, 7, 20, 100]) for w in words}
    assert grouped(spark, counts, tile=tile) == variants(counts)


def test_variants_with_a_very_long_word(spark):
    long = "".join(random.Random(1).choice("abcdef") for _ in range(30_000))
    counts = {long: 9, long[:500] + long[501:]: 2, long[:-1] + "z": 3, "short": 5, "shorts": 2}
    assert grouped(spark, counts) == variants(counts)


def test_variants_of_nothing(spark):
    df = spark.createDataFrame([], "word string, n long")
    assert spelling.group_variants(df, Scratch(spark, "test")).count() == 0
    with pytest.raises(ValueError, match="circle"):
        spelling.group_variants(df, Scratch(spark, "test"), ratio=1)


def test_words_of_texts(spark):
    rng = random.Random(8)
    pool = ["École", "ÉCOLE", "garçon", "straße", "x×y÷z", "İstanbul", "naïve", "Word", "ſtone"]
    rows = [(i, " ".join(rng.choice(pool) + rng.choice(["", "1", "-a"]) for _ in range(rng.randint(0, 80)))) for i in range(120)] + [(None, "Garçon garçon"), (7, None), (7, "")]
    want = collections.Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(A_TO_Z)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            want[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 97 == 0 else w] += 1
    df = spark.createDataFrame([(i, t, "r") for i, t in rows], "doc_id long, text string, run string")
    got = dict(spelling.common_words(spelling.with_slips(spelling.runs(df))).collect())
    assert got == {w: n for w, n in want.items() if n >= 3 and len(w) >= 5}
