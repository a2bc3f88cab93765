"""Short benchmark items inside long texts, and main texts of the given pages, against plain re-statements."""

import html
import os
import random
import re

import pytest

from sedimenta.llm import html_extract as H
from sedimenta.llm.decontam import contained_items, decontaminate


def grams(text, k, own=False):
    words = (text or "").casefold().split()
    if own and len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def contained(docs, items, threshold=0.8, k=5):
    by = {}
    for i, t in items:
        if i is not None:
            by.setdefault(i, set()).update(grams(t, k, own=True))
    out = set()
    for d, t in docs:
        held = set().union(*(grams(t, n) for n in range(1, k + 1)))
        out |= {(d, i, len(s & held), len(s)) for i, s in by.items() if s and len(s & held) >= max(1, threshold * len(s))}
    return out


@pytest.mark.parametrize("block", [4, 1 << 20])
def test_short_items_are_found_inside_texts(spark, block):
    rng = random.Random(3)
    words = ["Paris", "ÉCLAIR", "straße", "what", "is", "the", "capital", "of", "France", "yes"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(80)] + [(90, None), (91, ""), (92, "what is the capital of France"), (93, "STRASSE"), (93, "STRASSE")]
    items = [(1, "What is the capital"), (2, "éclair"), (3, "STRASSE"), (4, "of france"), (5, "what is the capital of France"), (6, "nowhere at all"), (7, None), (8, ""), (9, "yes"), (9, "the capital of France is Paris"), (None, "is")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = contained(docs, items)
    assert {w[1] for w in want} >= {1, 2, 3, 4, 5}
    got = contained_items(d, b, block=block).collect()
    assert {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got} == want and len(got) == len(want) + sum(w[0] == 93 for w in want)
    kept = decontaminate(d, b, block=block).collect()
    assert {r.doc_id for r in kept} == {i for i, _ in docs} - {w[0] for w in want}


PAGES = "/root/testdata/sf0.01/pages.parquet"


def article(source):
    """The text of the page's <article>, by plain patterns."""
    inner = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    inner = re.sub(r"<!--.*?-->", "", inner, flags=re.S)
    inner = re.sub(r"</?(?:b|a|i|em|strong|span)\b[^>]*>", "", inner)
    blocks = re.split(r"</?(?:p|h1|h2|h3|br|div|ul|li|section|aside|table|tr|td|figure|blockquote)\b[^>]*>", inner)
    return " ".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)


@pytest.mark.skipif(not os.path.exists(PAGES), reason="no test tables")
def test_given_pages_give_their_articles(spark):
    pages = spark.read.parquet(PAGES)
    got = {r.page_id: r.text for r in H.extract_main_text(pages).collect()}
    want = {r.page_id: article(r.html) for r in pages.collect()}
    assert got == want


def test_no_element_is_dropped_unseen(spark):
    model = H.fit(spark)
    prose = "Here is a paragraph of the article, with enough words to be prose."
    page = f"<body><nav><a href=/>Home</a><a href=/b>More</a></nav><article><h1>Title</h1><p>{prose}</p><p>We know that <math><mi>E</mi><mo>=</mo><mi>m</mi></math> holds, as all of us have read.</p><object><p>{prose} Two.</p></object><noscript><p>{prose} Three.</p></noscript><canvas>{prose} Four.</canvas><script>no()</script><style>p{{}}</style></article><form><select><option>one</option></select><button>go</button></form><footer>c</footer>"
    text = H.main_texts([page], model)[0]
    assert text == f"Title {prose} We know that E=m holds, as all of us have read. {prose} Two. {prose} Three. {prose} Four."
    assert H.main_texts(["Plain text,  &lt;without&gt; tags", "", " \n"], model) == ["Plain text, <without> tags", "", ""]
