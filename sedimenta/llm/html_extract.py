"""Main text of web pages, by gradient-boosted trees over the nodes of the DOM.

Each node is described by its tag, the tokens of its class, id and role, its depth, its siblings, and
the text, links and tags of its subtree. A boosted ensemble, fitted on generated pages whose nodes are
labelled, gives each node a probability of being main content. Decoding is hierarchical: a dynamic
program over the tree picks the best labelling in which nothing inside a dropped subtree is kept and
content starts at one node and goes down from there.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.store import Scratch

#: Generated pages to fit on, trees, their depth, and what leaving content below a content node costs in the decoding.
PAGES, TREES, DEPTH, LEAVE = 400, 20, 4, 1.0

# Kinds of HTML elements, and words of class, id and role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe textarea".split())
BLOCK = frozenset("address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
KEEPS = {"li": frozenset(("ul", "ol", "menu")), "dd": frozenset(("dl",)), "dt": frozenset(("dl",)), "tr": frozenset(("table",)), "td": frozenset(("tr", "table")), "th": frozenset(("tr", "table")), "option": frozenset(("select",))}
GOOD = frozenset("article content main post entry story text body page blog hentry prose column".split())
BAD = frozenset(
    "nav navbar navigation menu header masthead footer foot sidebar side aside rail ad ads advert advertisement advertorial sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "alert popup modal overlay comment comments disqus reply replies respond discussion share sharing social related recommended recommendations more widget form login signin signup subscribe "
    "newsletter search breadcrumb breadcrumbs copyright legal tags meta pagination pager skip toolbar tracking complementary contentinfo".split()
)
_TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']*+(?:"[^"]*+"|'[^']*+')?)*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<[!?][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_TAGS = ("p", "a", "li", "ul", "div", "section", "article", "main", "nav", "aside", "header", "footer", "form", "table", "td", "h1", "h2", "blockquote", "figure")
_NUMBERS = (
    "depth", "subtree_text", "own_text", "link_share", "text_per_tag", "punctuation", "children", "sibling_place", "same_siblings", "page_share", "place", "good_words", "bad_words",
    "good_above", "bad_above", "good_below", "bad_below", "sibling_text", "words_per_text", "paragraphs_below", "headings_below", "inputs_below",
)
FEATURES = (*_NUMBERS, *(f"tag_{t}" for t in _TAGS))


class Page:
    """The nodes of a page in page order, and its texts: (node, text, whether a block begins before it)."""

    def __init__(self, html: str):
        self.tag: list[str] = ["#root"]
        self.parent: list[int] = [-1]
        self.depth: list[int] = [0]
        self.words: list[tuple[int, int]] = [(0, 0)]
        self.marks: list[str] = [""]
        self.texts: list[tuple[int, str, bool]] = []
        stack, open_tags, edge, at, end = [0], Counter(), True, 0, len(html)

        def close(to: int) -> None:
            while len(stack) > to:
                open_tags[self.tag[stack.pop()]] -= 1

        while at < end:
            m = _TAG.search(html, at)
            if m is None:
                self.texts.append((stack[-1], html[at:], edge))
                break
            if m.start() > at:
                self.texts.append((stack[-1], html[at : m.start()], edge))
                edge = False
            at = m.end()
            name = m[2] or m[5]
            if name is None:
                continue
            name, slash, attributes = name.lower(), m[1] or m[4], m[3] or m[6] or ""
            edge = edge or name in BLOCK
            if slash:
                if open_tags[name] > 0:
                    i = len(stack) - 1
                    while self.tag[stack[i]] != name:
                        i -= 1
                    close(i)
                continue
            if name in CLOSES_P and open_tags["p"] > 0:
                i = len(stack) - 1
                while i and self.tag[stack[i]] not in ("p", "td", "th", "table", "button"):
                    i -= 1
                if self.tag[stack[i]] == "p":
                    close(i)
            elif name in CLOSES and any(open_tags[t] > 0 for t in CLOSES[name]):
                i, found = len(stack) - 1, 0
                while i and self.tag[stack[i]] not in KEEPS[name]:
                    if self.tag[stack[i]] in CLOSES[name]:
                        found = i
                    i -= 1
                if found:
                    close(found)
            self.tag.append(name)
            self.parent.append(stack[-1])
            self.depth.append(len(stack))
            marks = " ".join(x for a in _ATTRIBUTE.finditer(attributes) for x in a.groups()[1:] if x) if attributes else ""
            parts = {x.lower() for x in _PART.findall(marks)} if marks else ()
            self.words.append((sum(x in GOOD for x in parts), sum(x in BAD for x in parts)))
            self.marks.append(marks)
            if name in RAW:
                stop = re.compile(f"</{re.escape(name)}", re.I).search(html, at)
                at = stop.start() if stop else end
                if stop:
                    at = html.find(">", at) + 1 or end
            elif name not in VOID and not attributes.endswith("/"):
                stack.append(len(self.tag) - 1)
                open_tags[name] += 1


def _down(by_depth: list[np.ndarray], parent: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Of each node, the sum of `own` over its ancestors."""
    out = np.zeros(len(own))
    for at in by_depth[1:]:
        out[at] = out[parent[at]] + own[parent[at]]
    return out


def _up(by_depth: list[np.ndarray], parent: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Of each node, the sum of `own` over its subtree."""
    out = own.astype(float).copy()
    for at in by_depth[:0:-1]:
        np.add.at(out, parent[at], out[at])
    return out


class Forest:
    """Several pages at once, as arrays; parents point into the same arrays."""

    def __init__(self, pages: list[Page]):
        self.pages = pages
        size = np.array([len(p.tag) for p in pages])
        self.base = np.cumsum(size) - size
        self.page = np.repeat(np.arange(len(pages)), size)
        parent = np.concatenate([np.array(p.parent) for p in pages])
        self.parent = np.where(parent < 0, -1, parent + self.base[self.page])
        self.tag = np.array([t for p in pages for t in p.tag], object)
        self.depth = np.concatenate([np.array(p.depth) for p in pages])
        order = np.argsort(self.depth, kind="stable")
        self.by_depth = np.split(order, np.searchsorted(self.depth[order], np.arange(1, self.depth.max() + 1)))
        self.text = np.zeros(len(parent))
        pieces, marks = np.zeros(len(parent)), np.zeros(len(parent))
        words = np.zeros(len(parent))
        for p, base in zip(pages, self.base, strict=True):
            for node, text, _ in p.texts:
                n = len(text.strip())
                if n:
                    self.text[base + node] += n
                    pieces[base + node] += 1
                    marks[base + node] += text.count(",") + text.count(".") + text.count(";")
                    words[base + node] += text.count(" ") + 1
        self.pieces, self.punctuation, self.word_count = pieces, marks, words

    def features(self) -> np.ndarray:
        """A row of FEATURES for each node."""
        up, down = (lambda x: _up(self.by_depth, self.parent, x)), (lambda x: _down(self.by_depth, self.parent, x))
        n = len(self.parent)
        up_at = np.where(self.parent < 0, np.arange(n), self.parent)  # a page's root is its own parent here
        one = np.ones(n)
        has = {t: (self.tag == t).astype(float) for t in {*_TAGS, "h3", "h4", "input", "button", "select"}}
        text, tags, marks, pieces, words = up(self.text), up(one), up(self.punctuation), up(self.pieces), up(self.word_count)
        in_link = has["a"] + down(has["a"]) > 0
        links = up(self.text * in_link)
        whole = text[self.base][self.page]
        good, bad = (np.array([w[i] for p in self.pages for w in p.words], float) for i in (0, 1))
        good = good + has["article"] + has["main"]
        bad = bad + has["nav"] + has["footer"] + has["aside"] + has["header"] * 0.5 + has["form"]
        children = np.bincount(self.parent[self.parent >= 0], minlength=n).astype(float)
        child_text = np.zeros(n)
        np.add.at(child_text, up_at, np.where(self.parent >= 0, text, 0))
        order = np.lexsort((np.arange(n), up_at))
        first = np.searchsorted(up_at[order], up_at)
        rank = np.empty(n)
        rank[order] = np.arange(n)
        key = np.array([hash_tag(t) for t in self.tag]) + up_at * 1_000_003
        _, inverse, same = np.unique(key, return_inverse=True, return_counts=True)
        others = np.maximum(children[up_at] - 1, 1)
        numbers = [
            self.depth, np.log1p(text), np.log1p(self.text), links / (text + 1), text / tags, marks / (text + 1), np.log1p(children), (rank - first) / np.maximum(children[up_at], 1), np.log1p(same[inverse]),
            text / (whole + 1), (np.arange(n) - self.base[self.page]) / np.maximum(np.bincount(self.page)[self.page], 1), good, bad, down(good), down(bad), up(good) - good, up(bad) - bad,
            np.log1p(np.maximum(child_text[up_at] - text, 0) / others), words / np.maximum(pieces, 1), np.log1p(up(has["p"]) - has["p"]), up(has["h1"] + has["h2"] + has["h3"] + has["h4"]), up(has["input"] + has["button"] + has["select"]),
        ]
        return np.stack([*numbers, *(has[t] for t in _TAGS)], axis=1)

    def decode(self, odds: np.ndarray, leave: float = LEAVE) -> np.ndarray:
        """Whether each node's own text is kept: the labelling of the largest sum of log-odds of texts.

        A node passes (it only holds others), is content or is dropped; below content there is content or,
        at a cost, a dropped subtree; below a dropped node all is dropped.
        """
        weight = odds * np.log1p(self.text)
        through, inside, out = np.where(self.text > 0, -np.maximum(weight, 0) - 1e-3, 0.0), weight.copy(), -weight
        for at in self.by_depth[:0:-1]:
            up = self.parent[at]
            np.add.at(through, up, np.maximum(np.maximum(through[at], inside[at] - leave / 2), out[at]))
            np.add.at(inside, up, np.maximum(inside[at], out[at] - leave))
            np.add.at(out, up, out[at])
        state = np.zeros(len(odds), np.int8)  # 0 passes, 1 content, 2 dropped
        for at in self.by_depth:
            above = np.where(self.parent[at] < 0, 0, state[np.maximum(self.parent[at], 0)])
            free = np.where(through[at] >= np.maximum(inside[at] - leave / 2, out[at]), 0, np.where(inside[at] - leave / 2 >= out[at], 1, 2))
            state[at] = np.where(above == 0, free, np.where(above == 2, 2, np.where(inside[at] >= out[at] - leave, 1, 2)))
        return state == 1

    def extract(self, kept: np.ndarray) -> list[str]:
        """Each page's kept texts: references decoded, one space for white space, blocks joined by a space."""
        out = []
        for page, base in zip(self.pages, self.base, strict=True):
            blocks: list[list[str]] = [[]]
            cut = False
            for node, text, edge in page.texts:
                cut = cut or edge
                if kept[base + node] or len(page.tag) == 1:  # a page without any element is its text
                    if cut:
                        blocks.append([])
                        cut = False
                    blocks[-1].append(text)
                else:
                    cut = True
            joined = (" ".join(entities.unescape("".join(b)).split()) for b in blocks if b)
            out.append(" ".join(b for b in joined if b))
        return out


def hash_tag(tag: str) -> int:
    return sum(ord(c) * 31**i for i, c in enumerate(tag[:8])) % 1_000_003


class TreeEnsemble:
    """Boosted trees as arrays; the log-odds of rows in a few vector steps."""

    def __init__(self, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, right: np.ndarray, value: np.ndarray, weight: np.ndarray):
        self.feature, self.threshold, self.left, self.right, self.value, self.weight = feature, threshold, left, right, value, weight

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for t, w in enumerate(self.weight):
            at = np.zeros(len(x), np.int64)
            for _ in range(64):
                f = self.feature[t, at]
                inner = f >= 0
                if not inner.any():
                    break
                go = x[rows, np.maximum(f, 0)] <= self.threshold[t, at]
                at = np.where(inner, np.where(go, self.left[t, at], self.right[t, at]), at)
            total += w * self.value[t, at]
        return 2 * total


# ---- generated pages ---------------------------------------------------------------------------


def _sentence(rng: random.Random, most: int = 18) -> str:
    words = ["".join(rng.choice("aeioubcdfghlmnprstv") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(2, most))]
    return (" ".join(words)).capitalize() + rng.choice(".....!?,")


def _prose(rng: random.Random, most: int = 6) -> str:
    return " ".join(_sentence(rng) for _ in range(rng.randint(1, most)))


def _links(rng: random.Random, n: int) -> str:
    return "<ul>" + "".join(f'<li><a href="/{i}">{_sentence(rng, 3)[:-1]}</a></li>' for i in range(n)) + "</ul>"


def _boilerplate(rng: random.Random, kind: str) -> str:
    name = lambda *names: rng.choice(("class", "id")) + f'="{rng.choice(names)}"'
    words, links = _prose(rng, 2), _links(rng, rng.randint(2, 8))
    paragraph = rng.choice((words, f"<p>{words}</p>"))
    forms = {
        "menu": (f"<nav>{links}</nav>", f"<div {name('menu', 'navbar', 'top-menu', 'nav')}>{links}</div>", f"<nav {name('site-nav', 'x1')}>{links}</nav>"),
        "header": (f"<header><a href='/'>{words}</a>{links}</header>", f"<div {name('header', 'masthead', 'page-header')}>{paragraph}</div>"),
        "footer": (f"<footer>{paragraph}</footer>", f"<footer>&copy; {words}</footer>", f"<div {name('footer', 'site-footer', 'copyright')}>{paragraph}{links}</div>"),
        "sidebar": (f"<aside>{paragraph}{links}</aside>", f"<div {name('sidebar', 'right-rail', 'widget', 'sidebar-left')}><h3>{_sentence(rng, 3)}</h3>{links}{paragraph}</div>"),
        "ad": (f"<div {name('ad', 'ads', 'advert', 'ad-slot', 'banner', 'sponsored')}>{paragraph}</div>", f"<aside {name('ad', 'promo')}>{paragraph}</aside>", f"<ins class='ads'>{words}</ins>"),
        "notice": (f"<div {name('cookie-notice', 'notice', 'cookie-banner', 'alert', 'gdpr-consent', 'popup')}>{paragraph}<button>{_sentence(rng, 2)}</button></div>", f"<div role='alert'>{paragraph}</div>"),
        "form": (f"<form action='/s'><label>{_sentence(rng, 3)}</label><input name='q'><button>{_sentence(rng, 2)}</button>{paragraph}</form>", f"<form><select><option>{_sentence(rng, 3)}</option><option>{words}</option></select><button>ok</button></form>", f"<div {name('newsletter', 'login', 'subscribe')}>{paragraph}<form><input><button>ok</button></form></div>"),
        "comments": (f"<section {name('comments', 'discussion')}><h2>{_sentence(rng, 3)}</h2>" + "".join(f"<div class='comment'><b>{_sentence(rng, 2)}</b><p>{_prose(rng)}</p></div>" for _ in range(rng.randint(1, 6))) + "</section>", f"<div id='comments'><ol>" + "".join(f"<li class='comment'>{_prose(rng)}</li>" for _ in range(rng.randint(1, 6))) + "</ol></div>"),
        "related": (f"<div {name('related', 'recommended', 'more-stories')}><h3>{_sentence(rng, 3)}</h3>{links}</div>", f"<section {name('related-posts', 'share', 'social-links')}>{links}</section>"),
    }
    return rng.choice(forms[kind])


def generated_page(rng: random.Random) -> str:
    """A page whose main content is marked by a data-main attribute and boilerplate inside it by data-out."""
    p = lambda inner: f"<p>{inner}" + ("</p>" if rng.random() < 0.9 else "")
    blocks = [f"<h1>{_sentence(rng, 9)[:-1]}</h1>"] if rng.random() < 0.85 else []
    for _ in range(rng.choice((1, 2, 3, 5, 8, 13))):
        kind = rng.random()
        inline = _prose(rng) if rng.random() < 0.7 else f"{_prose(rng, 2)} <a href='/x'>{_sentence(rng, 4)}</a> <b>{_sentence(rng, 4)}</b> {_prose(rng, 2)}"
        if kind < 0.72:
            blocks.append(p(inline if rng.random() < 0.85 else _sentence(rng, 6)))
        elif kind < 0.76:
            blocks.append(f"<p><b>{_prose(rng, 3)}<br>")
        elif kind < 0.82:
            blocks.append(f"<h2>{_sentence(rng, 6)}</h2>")
        elif kind < 0.87:
            blocks.append("<ul>" + "".join(f"<li>{_sentence(rng)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
        elif kind < 0.9:
            blocks.append(f"<blockquote><p>{_prose(rng)}</p></blockquote>")
        elif kind < 0.93:
            blocks.append(f"<figure><img src='/i.png'><figcaption>{_sentence(rng)}</figcaption></figure>")
        elif kind < 0.94:
            formula = "<math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></math>"
            blocks.append(rng.choice((p(f"{_sentence(rng)} {formula} {inline}"), f"<object data='/x.pdf'>{p(inline)}</object>", f"<noscript>{p(inline)}</noscript>", f"<figure><svg><title>{_sentence(rng, 4)}</title><text>{_sentence(rng, 3)}</text></svg><figcaption>{_sentence(rng)}</figcaption></figure>", f"<canvas>{_sentence(rng)}</canvas>")))
        elif kind < 0.96:
            blocks.append("<table>" + "".join(f"<tr><td>{_sentence(rng, 4)}</td><td>{_sentence(rng, 4)}</td></tr>" for _ in range(rng.randint(2, 4))) + "</table>")
        else:
            blocks.append(f"<div data-out>{_boilerplate(rng, rng.choice(('ad', 'related', 'form', 'notice')))}</div>")
    root = rng.choice(("<article {}>{}</article>", "<article {}>{}</article>", "<article {} class='post'>{}</article>", "<main {}>{}</main>", "<div {} id='content'>{}</div>", "<div {} class='entry-content'>{}</div>", "<div {} class='post-body text'>{}</div>", "<section {} class='story'>{}</section>", "<div {} class='c12'>{}</div>", "<div {}>{}</div>"))
    main = root.format("data-main", "".join(blocks))
    if rng.random() < 0.2:
        main = f"<div class='{rng.choice(('wrap', 'container', 'main', 'row'))}'>{main}{_boilerplate(rng, 'sidebar') if rng.random() < 0.5 else ''}</div>"
    before = [k for k in ("header", "menu", "notice", "ad", "form", "sidebar") if rng.random() < (0.7 if k == "menu" else 0.35)]
    after = [k for k in ("related", "ad", "comments", "sidebar", "form", "notice", "footer") if rng.random() < (0.8 if k == "footer" else 0.3)]
    parts = [_boilerplate(rng, k) for k in before], [_boilerplate(rng, k) for k in after]
    head = f"<head><meta charset='utf-8'><title>{_sentence(rng, 6)}</title><style>p{{margin:0}}</style><script>var a='</p>';</script></head>" if rng.random() < 0.9 else ""
    return f"<!DOCTYPE html><html lang='en'>{head}<body>{''.join(parts[0])}{main}{''.join(parts[1])}" + ("</body></html>" if rng.random() < 0.9 else "")


def labelled_forest(pages: int, seed: int = 11) -> tuple[Forest, np.ndarray]:
    """Generated pages and whether each node is main content."""
    rng = random.Random(seed)
    parsed, labels = [], []
    for _ in range(pages):
        source = generated_page(rng)
        flags = [(m[2] or m[5] or "", m[3] or m[6] or "") for m in _TAG.finditer(source)]
        page = Page(re.sub(r" ?data-(main|out)", lambda m: f" role='z{m[1]}z'", source))
        label = np.zeros(len(page.tag))
        for i in range(1, len(page.tag)):
            label[i] = 1 if "zmainz" in page.marks[i] else 0 if "zoutz" in page.marks[i] else label[page.parent[i]]
        assert flags
        parsed.append(page)
        labels.append(label)
    return Forest(parsed), np.concatenate(labels)


_FITTED: dict[tuple, TreeEnsemble] = {}


def fit(spark: SparkSession, pages: int = PAGES, trees: int = TREES, depth: int = DEPTH) -> TreeEnsemble:
    """The ensemble, fitted on `pages` generated pages; once per application."""
    key = (spark.sparkContext.applicationId, pages, trees, depth)
    if key in _FITTED:
        return _FITTED[key]
    forest, label = labelled_forest(pages)
    x = forest.features()
    has_text = _up(forest.by_depth, forest.parent, forest.text) > 0
    rows = [(float(y), r.tolist()) for y, r in zip(label[has_text], x[has_text], strict=True)]
    scratch = Scratch(spark, "html")
    train = scratch.save(spark.createDataFrame(rows, "label double, x array<double>").coalesce(2)).select("label", array_to_vector("x").alias("features")).cache()
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=5, maxBins=64).fit(train)
    train.unpersist()
    path = f"{scratch.root}/model"
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").select("treeID", "id", "prediction", "leftChild", "rightChild", "split.featureIndex", F.col("split.leftCategoriesOrThreshold").alias("cut")).collect()
    shape = (trees, max(r.id for r in nodes) + 1)
    feature, left, right = np.full(shape, -1), np.zeros(shape, np.int64), np.zeros(shape, np.int64)
    threshold, value = np.zeros(shape), np.zeros(shape)
    for r in nodes:
        value[r.treeID, r.id] = r.prediction
        if r.leftChild >= 0:
            feature[r.treeID, r.id], threshold[r.treeID, r.id], left[r.treeID, r.id], right[r.treeID, r.id] = r.featureIndex, r.cut[0], r.leftChild, r.rightChild
    _FITTED.clear()
    _FITTED[key] = TreeEnsemble(feature, threshold, left, right, value, np.array(model.treeWeights))
    return _FITTED[key]


def main_texts(sources: list[str], model: TreeEnsemble) -> list[str]:
    """The main text of each page."""
    forest = Forest([Page(s) for s in sources])
    return forest.extract(forest.decode(model.log_odds(forest.features())))


def extract_main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", to: str = "text") -> DataFrame:
    """(page_id, url, text string, n_chars long), a row for every input row.

    text is the page's main content: character references decoded, white space inside a block one
    space, blocks joined in page order by one space, nothing capped; empty where a page has none; a page without
    any element is its text. Only scripts, styles, templates, frames and text areas are left out unseen. Null
    and empty pages give empty texts; null urls and ids stay; repeated rows are each extracted; other
    columns are left out; an empty table gives an empty result. n_chars counts code points.
    """
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast(fit(spark))
    narrow = pages.select(F.col(page_id), F.col(url), F.coalesce(F.col(html), F.lit("")).alias("__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for batch in (whole.slice(i, 64) for i in range(0, whole.num_rows, 64)):
                texts = main_texts(batch.column(2).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [page_id, url, to, "n_chars"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (page_id, url)]
    return narrow.mapInArrow(run, f"`{page_id}` {kinds[0]}, `{url}` {kinds[1]}, `{to}` string, n_chars long")
