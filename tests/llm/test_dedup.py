"""op1, op8 and op10 against brute force, on made-up texts with the cases that are easy to get wrong."""

import random

import pytest

from sedimenta.llm import near_dedup, suffix_dedup
from sedimenta.llm.decontam import contained_items, decontaminate
from tests.llm.brute import components, shingle_set, without_repeats

SCHEMA = "doc_id long, text string"


def near_copies():
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 10**6)}"
        rows.append((i * 3 % 101, " ".join(words)))
    rows += [(200 + i, " ".join(f"y{rng.randint(0, 400)}" for _ in range(rng.randint(0, 60)))) for i in range(40)]
    return rows + [(300, None), (301, ""), (302, " \n"), (303, "a b"), (304, "A  b"), (305, "a b c"), (306, "É é"), (307, "é É")]


@pytest.mark.parametrize(("stars", "small", "block"), [(0, 4, 16), (2, 48, 512)])
def test_near_components(spark, monkeypatch, stars, small, block):
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = near_copies()
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], SCHEMA + ", comp int, key string")
    assert {r[0]: tuple(r)[1:] for r in near_dedup.near_components(df, percent=85, stars=stars).collect()} == components(rows, 85)


def test_near_components_of_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b"), (5, "a b"), (5, "a b"), (2, "a b"), (7, None)], SCHEMA)
    got = sorted(map(tuple, near_dedup.near_components(df).collect()), key=str)
    assert got == sorted([(None, 1, None, True), (5, 1, 2, False), (5, 1, 2, False), (2, 1, 2, True), (7, 0, 7, True)], key=str)
    assert near_dedup.near_components(df.limit(0)).count() == 0
    kept = near_dedup.deduplicate(df.unionByName(df)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [2, 7]


@pytest.mark.parametrize("percent", [80, 85])
def test_recall_near_the_threshold(spark, percent):
    """Pairs at and just above the threshold among copies of passages in common: every link is found."""
    rng = random.Random(percent)
    rows, common = [], " ".join(f"c{i}" for i in range(40))
    for i in range(150):
        words = [f"w{rng.randint(0, 10**7)}" for _ in range(300)]
        other = list(words)
        for at in rng.sample(range(0, 300, 6), {80: 5, 85: 3}[percent] + rng.randint(-1, 1)):
            other[at] = f"x{rng.randint(0, 10**7)}"
        rows += [(2 * i, " ".join(words) + " " + common), (2 * i + 1, " ".join(other) + " " + common)]
    want = components(rows, percent)
    got = {r[0]: tuple(r)[1:] for r in near_dedup.near_components(spark.createDataFrame(rows, SCHEMA), percent=percent).collect()}
    assert sum(v[2] for v in want.values()) < len(rows) - 50 and got == want


def test_one_row_of_an_id_stays_whatever_the_plan(spark):
    rows = [(1, f"text {i} of many", "en", i) for i in range(20)] + [(2, None, None, None), (2, "", "x", 1)]
    df = spark.createDataFrame(rows, SCHEMA + ", lang string, rep int")
    got = [sorted(map(str, near_dedup.deduplicate(df.repartition(n)).collect())) for n in (1, 3, 7)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 2


def test_pruning_keeps_the_threshold():
    for n in (32, 64, 96, 128):
        least = near_dedup.least_matches(n, 0.85, 1e-9)
        assert 0 < least < 0.85 * n
        assert near_dedup.least_matches(n, 0.85, 1e-2) > least


def repeats():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 4))) for _ in range(30)]
    rows = []
    for i in range(100):
        kind = rng.random()
        if kind < 0.2 and rows:
            text = rng.choice(rows)[1] or ""
            at = rng.randint(0, len(text))
            text = text[:at] + rng.choice(words) + text[at:]
        elif kind < 0.3:
            text = "a" * rng.randint(0, 80)
        else:
            text = None if kind < 0.35 else " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("group", [1, 50_000])
def test_repeats_against_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rows = repeats()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA + ", spans string")
    assert {r[0]: tuple(r)[1:] for r in suffix_dedup.remove_repeats(df, width=20, gram=6).collect()} == without_repeats(rows, 20)


@pytest.mark.parametrize("group", [1, 20, 512])
def test_repeats_at_full_width(spark, monkeypatch, group):
    """Passages of more and less than 100 bytes in common, in texts of up to 40,000 bytes, and periodic texts."""
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(n)) for n in (12, 18, 25, 60, 200)]
    rows = []
    for i in range(80):
        parts = [word() for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(passages))
        rows.append((i, " ".join(parts)))
    rows += [(100, "ab" * 300), (101, "x" * 99), (102, "x" * 100), (103, "x" * 101), (104, " ".join(word() for _ in range(6_000)) + passages[3]), (105, None), (106, rows[3][1])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r[0]: tuple(r)[1:] for r in suffix_dedup.remove_repeats(df).collect()} == without_repeats(rows, 100)


def test_lengths_that_dont_fit_are_refused(spark):
    df = spark.createDataFrame([(1, "a")], SCHEMA)
    for width, gram in ((400, 20), (100, 101), (100, 0)):
        with pytest.raises(ValueError, match="grams"):
            suffix_dedup.remove_repeats(df, width=width, gram=gram)


def test_repeats_of_odd_rows(spark):
    text = "the quick brown fox jumps over the lazy dog again and again"
    df = spark.createDataFrame([(3, text), (3, text), (9, text), (None, text), (1, "short")], SCHEMA)
    got = sorted((r.doc_id or 0, r.n_removed) for r in suffix_dedup.remove_repeats(df, width=20, gram=6).collect())
    assert got == [(0, 0), (1, 0), (3, 0), (3, 0), (9, len(text))]
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0
    kept = suffix_dedup.remove_repeats(df, width=20, gram=6, with_text=True).where("doc_id = 3").first().kept
    assert kept.decode() == text


def test_contained_items(spark):
    rng = random.Random(3)
    word = lambda: f"w{rng.randint(0, 9999)}"
    items = [(i, " ".join(word() for _ in range(rng.randint(3, 60)))) for i in range(30)] + [(90, None), (91, ""), (92, "two words")]
    docs = []
    for i in range(60):
        words = [word() for _ in range(rng.randint(0, 300))]
        if i % 2:
            piece = (items[rng.randrange(30)][1]).split()
            for _ in range(rng.randint(0, 3)):
                piece[rng.randrange(len(piece))] = word()
            at = rng.randint(0, len(words))
            words[at:at] = piece
        docs.append((i, " ".join(words)))
    docs += [(100, None), (101, "Two  WORDS"), (102, ""), (None, items[0][1])]
    want = set()
    for j, item in items:
        s, k = shingle_set(item), min(5, len((item or "").split())) or 5  # an item of fewer words is looked up among the shingles of as many
        want |= {(i, j) for i, d in docs if s and len(s & shingle_set(d, k)) >= 0.8 * len(s)}
    d, b = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    for block in (40, 1 << 20):
        got = contained_items(d, b, block=block)
        assert {(r.doc_id, r.item_id) for r in got.collect()} == want
        kept = decontaminate(d, b, block=block).collect()
        assert sorted(str(r.doc_id) for r in kept) == sorted(str(i) for i, _ in docs if i not in {x for x, _ in want})
    assert contained_items(d, b.limit(0)).count() == 0 and decontaminate(d, b.limit(0)).count() == len(docs)


def test_items_in_any_case(spark):
    words = "La canción de Émile más allá del corazón Straße über öffentliche Größe Ωμέγα ΟΔΟΣ привет мир".split()
    item = " ".join(words)
    docs = [(1, item), (2, "VORHER " + item.upper() + " NACHHER"), (3, item.lower()), (4, item.swapcase()), (5, " ".join(words[::-1]).upper())]
    d, b = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([(7, item)], "item_id long, text string")
    assert sorted((r.doc_id, r.n_shared, r.n_item) for r in contained_items(d, b).collect()) == [(i, 12, 12) for i in (1, 2, 3, 4)]
    assert [tuple(r) for r in decontaminate(d, b).collect()] == docs[4:]
    raw = spark.sql("SELECT 9L AS doc_id, CAST(concat(X'FF20C3C9', CAST(' b c d e É' AS BINARY)) AS STRING) AS text")
    assert contained_items(raw, b).count() == 0 and decontaminate(raw, b).count() == 1


def test_each_round_of_components_is_forgotten(spark, monkeypatch):
    from sedimenta.llm import components
    from sedimenta.llm.store import Scratch

    calls = []
    monkeypatch.setattr(components, "settle", calls.append, raising=False)
    chain = spark.createDataFrame([(i + 1, i) for i in range(40)], "u long, v long")
    assert {(r.u, r.v) for r in components.roots(Scratch(spark, "chain"), chain).collect()} == {(i, 0) for i in range(1, 41)}
    assert len(calls) >= 2
