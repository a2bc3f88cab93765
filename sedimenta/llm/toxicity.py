"""Toxicity scores from a lexicon that is learned from labels and matched through edit automata.

The lexicon (whole words, and stems that start words) is chosen by its odds in a bounded sample of
labelled texts and kept as a trie. A token of a text becomes a Levenshtein automaton, simulated
bit-parallel; walking the trie with it finds the terms within the allowed edits. Each hit gets a score
from its context window: other hits nearby and second-person words raise it, quotation marks and
verbs of reporting lower it, so that quoting an insult weighs less than using it. A logistic
regression over per-text sums of these makes the score.

Texts that were copied often are no more evidence than one: each labelled text weighs as much as its share
of its near copies, and none is left out.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from sedimenta.llm.store import Scratch, settle
from sedimenta.llm.textbytes import lean, mix, shingle_sets

#: Labelled texts that the model is fitted on at most (those of the least hash), tokens cached in a worker.
SAMPLE, CACHE = 12_000, 1 << 17
#: Least shingle hashes by which the weight of a text among its near copies is told.
SKETCH = 8
#: Tokens on either side of a hit that are its context; stem lengths; shortest term that may be misspelled.
WINDOW, STEMS, FUZZY_FROM = 8, (4, 5, 6, 7, 8), 5
# Look-alike characters, cues in the four languages of the tables, and a base lexicon.
LOOK_ALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
REPORTING = frozenset("said says say wrote quoted quote called calls word term dit dite écrit mot terme sagte sagt schrieb nannte wort dijo dice escribió llamó palabra".split())
ADDRESSING = frozenset("you your yours youre u tu toi vous du dich dein deine ihr usted ustedes tú eres".split())
BASE_LEXICON = ("idiot", "moron", "stupid", "imbecile", "worthless", "pathetic", "disgusting", "scum", "loser", "trash", "idiota", "estúpido", "imbécil", "abruti", "dummkopf", "abschaum")
FEATURES = ("exact_words", "misspelled_words", "exact_stems", "misspelled_stems", "distinct_terms", "context_sum", "context_max", "per_hundred", "quoted")

_TOKEN = re.compile(r"\w(?:[\w@$!*]*\w)?")
_QUOTES = {"“": 1, "«": 1, "„": 1, "”": -1, "»": -1}
_SWAP = str.maketrans(LOOK_ALIKE)


class Lexicon:
    """Terms as a trie: {character: node}, with "" -> (term, is_stem, weight) at a term's end."""

    def __init__(self, terms: list[tuple[str, bool, float]], edits: int = 1):
        self.trie: dict = {}
        self.edits = edits
        self.heads: set[str] = set()
        self.tails: set[str] = set()
        self.inner: set[str] = set()
        for term, stem, weight in terms:
            node = self.trie
            for ch in term:
                node = node.setdefault(ch, {})
            node.setdefault("", []).append((term, stem, weight))
            if len(term) >= FUZZY_FROM:
                half = len(term) // 2
                self.heads.add(term[:half])
                (self.inner if stem else self.tails).add(term[half:])
        self.head_sizes, self.tail_sizes, self.inner_sizes = (sorted({len(x) for x in s}) for s in (self.heads, self.tails, self.inner))

    def _may_be_misspelled(self, token: str) -> bool:
        """With one edit, one half of the term is whole: the first at the token's start, or the second at its end (of a stem: next to its place)."""
        if self.edits != 1:
            return True
        if any(token[:n] in self.heads for n in self.head_sizes) or any(token[-n:] in self.tails for n in self.tail_sizes):
            return True
        return any(token[i : i + n] in self.inner for n in self.inner_sizes for i in range(n - 2, n + 2) if i >= 0)

    def find(self, token: str) -> tuple[str, bool, float, int] | None:
        """(term, is_stem, weight, edits) of the closest term, the longest of equals; None: no term."""
        plain = token.isalpha()
        text = token if plain else token.translate(_SWAP)
        node, best = self.trie, None
        for ch in text:  # exact: no edits at all
            node = node.get(ch)
            if node is None:
                break
            for term, stem, weight in node.get("", ()):
                if stem or len(term) == len(text):
                    best = (term, stem, weight, int(not plain))
        if best is not None or len(text) < FUZZY_FROM - self.edits or ("*" not in text and not self._may_be_misspelled(text)):
            return best
        size, masks = len(text), {}
        for i, ch in enumerate(text):
            masks[ch] = masks.get(ch, 0) | 1 << i
        if wild := masks.pop("*", 0):
            masks["*"] = wild
        found: list[tuple[int, int, str, bool, float]] = []
        stack = [(self.trie, tuple((1 << (e + 1)) - 1 for e in range(self.edits + 1)))]
        full = (1 << (size + 1)) - 1
        while stack:
            node, state = stack.pop()
            for ch, child in node.items():
                if ch == "":
                    for term, stem, weight in child:
                        if len(term) >= FUZZY_FROM or self.edits == 0:
                            for e, bits in enumerate(state):
                                if bits if stem else bits >> size & 1:
                                    found.append((e, -len(term), term, stem, weight))
                                    break
                    continue
                hit, after, below, before = masks.get(ch, 0) | wild, [], 0, 0
                for bits in state:
                    new = ((bits & hit) << 1 | before | before << 1 | below << 1) & full
                    after.append(new)
                    before, below = bits, new
                if any(after):
                    stack.append((child, tuple(after)))
        if not found:
            return None
        edits, _, term, stem, weight = min(found)
        return term, stem, weight, max(1, edits)


class _Known(dict):
    """Tokens and what the lexicon finds for them, in bounded room."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, token: str):
        if len(self) >= CACHE:
            self.clear()
        found = self.lexicon.find(token)
        if len(token) <= 48:
            self[token] = found
        return found


def text_features(text: str, known: _Known) -> list[float]:
    """The values of FEATURES for one text."""
    low = text.lower()
    tokens = _TOKEN.findall(low)
    hits = [(i, hit) for i, hit in enumerate(map(known.__getitem__, tokens)) if hit is not None]
    if not hits:
        return [0.0] * len(FEATURES)
    out = [0.0] * len(FEATURES)
    places = {i for i, _ in hits}
    quoted = _inside_quotes(low, places)
    for i, (_, stem, weight, edits) in hits:
        out[2 * stem + (edits > 0)] += 1
        near = range(max(0, i - WINDOW), min(len(tokens), i + WINDOW + 1))
        company = sum(j in places for j in near) - 1
        score = weight * (0.6 if edits else 1.0) * (1 + 0.5 * min(3, company))
        if any(tokens[j] in ADDRESSING for j in near):
            score *= 1.5
        if i in quoted:
            score *= 0.3 if any(tokens[j] in REPORTING for j in near) else 0.6
            out[8] += 1
        out[5] += score
        out[6] = max(out[6], score)
    out[4] = len({hit[0] for _, hit in hits})
    out[7] = 100.0 * len(hits) / len(tokens)
    return [math.log1p(x) for x in out]


def _inside_quotes(text: str, places: set[int]) -> set[int]:
    """Which of the tokens at these places stand between quotation marks of one line."""
    out, depth, straight, at = set(), 0, False, 0
    for i, m in enumerate(_TOKEN.finditer(text)):
        for ch in text[at : m.start()]:
            if ch == "\n":
                depth, straight = 0, False
            elif ch == '"':
                straight = not straight
            else:
                depth = max(0, depth + _QUOTES.get(ch, 0))
        at = m.end()
        if i in places and (depth or straight) and ('"' if straight else "") in text[at : (text.find("\n", at) + 1 or len(text) + 1) - 1]:
            out.add(i)
    return out


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows whose labels are never learned: crc32 of the id as text is divisible by 5."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, sample: int) -> DataFrame:
    """(text, label double, weight double) of at most `sample` labelled rows that aren't held out; the ids are at most 16 * sample bytes of broadcast.

    The weight is the mean, over SKETCH hash functions, of 1 / the number of rows with the same least hash of
    five-word shingles: n copies weigh 1 / n each, texts with one sentence in common nearly 1. Texts without
    words have one sketch.
    """
    id_kind = docs.schema[doc_id].dataType.simpleString()
    odd = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, h, at in shingle_sets(batch.column(1), 5):
                least = np.zeros((hi - lo, SKETCH), np.int64)
                some = np.diff(at) > 0
                for j in range(SKETCH if some.any() else 0):
                    least[some, j] = np.minimum.reduceat(mix(h * odd[j]), at[:-1][some]).view(np.int64)
                sketch = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * SKETCH, pa.int32()), pa.array(least.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, sketch], ["__id", "text", "label", "sketch"])

    named = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).where(~held_out(doc_id))
    named = named.groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).cast("double").alias("label"))
    named = named.orderBy(F.xxhash64("__id"), "__id").limit(sample)
    found = docs.select(F.col(doc_id).alias("__id"), F.coalesce(text, F.lit("")).alias("text")).join(F.broadcast(named), "__id").select("__id", "text", "label")
    scratch = Scratch(docs.sparkSession, "toxicity")
    found = scratch.save(found.mapInArrow(lean(run), f"__id {id_kind}, text string, label double, sketch array<long>").withColumn("row", F.monotonically_increasing_id()))
    each = found.select("row", F.posexplode("sketch").alias("place", "least"))
    shared = each.groupBy("place", "least").agg((1 / F.count("*")).alias("share"))
    weights = each.join(shared, ["place", "least"]).groupBy("row").agg(F.avg("share").alias("weight"))
    return scratch.save(found.join(weights, "row").select("text", "label", "weight"))


def learn_lexicon(train: DataFrame, least_odds: float = 1.8, least_evidence: float = 30.0) -> list[tuple[str, bool, float]]:
    """(term, is_stem, weight): the words and stems whose share of toxic texts is exp(least_odds) times that of others,
    if that is no chance: the log-likelihood ratio must be least_evidence (30: one in 10**7) at least.

    Each task counts in how many of its texts a term occurs, by their weights, and hands on its counts, not its
    tokens. Terms of toxic texts that weigh 3 together are the candidates; all of them are counted in the
    others. Their number is bounded by the training rows.
    """

    def counts(wanted: float, only: set[str] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: Counter = Counter()
            for batch in batches:
                for text, label, weight in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    if label == wanted:
                        words = {w for w in _TOKEN.findall(text.lower()) if w.isalpha() and len(w) > 2}
                        found = {w + "$" for w in words}
                        for n in STEMS:
                            found.update(w[:n] for w in words if len(w) > n)
                        for term in found if only is None else found & only:
                            total[term] += weight
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.float64())], ["term", "n"])

        return train.select("text", "label", "weight").mapInArrow(lean(run), "term string, n double").groupBy("term").agg(F.round(F.sum("n"), 9).alias("n"))

    size = train.agg(F.sum(F.col("label") * F.col("weight")).alias("bad"), F.sum((1 - F.col("label")) * F.col("weight")).alias("good")).first()
    if not size.bad or not size.good:
        return [(t, False, 1.0) for t in BASE_LEXICON]
    bad = {r.term: r.n for r in counts(1.0, None).where("n >= 3").collect()}
    good = {r.term: r.n for r in counts(0.0, set(bad)).collect()}
    rows = []
    for term, b in bad.items():
        g = good.get(term, 0.0)
        odds = math.log((b + 0.5) / (size.bad + 1) / ((g + 0.5) / (size.good + 1)))
        # 2 * sum of observed * log(observed / expected) over the four cells of (term, class)
        seen, every = b + g, size.bad + size.good
        cells = ((b, seen * size.bad), (g, seen * size.good), (size.bad - b, (every - seen) * size.bad), (size.good - g, (every - seen) * size.good))
        evidence = sum(2 * o * math.log(o * every / e) for o, e in cells if o > 1e-9 and e > 1e-9)
        if odds >= least_odds and evidence >= least_evidence:
            rows.append((-b, len(term), term, odds))
    chosen: list[tuple[str, bool, float]] = []
    stems: set[str] = set()
    for _, _, marked, odds in sorted(rows):
        term, stem = marked.removesuffix("$"), not marked.endswith("$")
        if not any(term[:n] in stems for n in range(1, len(term) + 1)):
            chosen.append((term, stem, min(1.0, odds / 5)))
            stems.update([term] * stem)
    # a whole word of the language stands for itself, not for all that starts like it
    words = {t[:n] for t, s, _ in chosen if not s for n in range(1, len(t) + 1)}
    return [(t, s, w) for t, s, w in chosen if not (s and t in words)] or [(t, False, 1.0) for t in BASE_LEXICON]


_CACHES: dict[str, _Known] = {}


def with_features(df: DataFrame, text: str, lexicon: list[tuple[str, bool, float]]) -> DataFrame:
    """df and a column __f of the values of FEATURES."""
    shared, key, at = df.sparkSession.sparkContext.broadcast(lexicon), uuid.uuid4().hex, df.columns.index(text)
    names = [*df.columns, "__f"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _CACHES.get(key)
        if known is None:
            _CACHES.clear()
            known = _CACHES[key] = _Known(Lexicon(shared.value))
        for batch in batches:
            f = [text_features(x.as_py() or "", known) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(f, pa.list_(pa.float64()))], names)

    return df.mapInArrow(lean(run), StructType([*df.schema.fields, StructField("__f", ArrayType(DoubleType()))]))


class ToxicityModel:
    """A lexicon and the weights of FEATURES."""

    def __init__(self, lexicon: list[tuple[str, bool, float]], weights: np.ndarray, bias: float):
        self.lexicon, self.weights, self.bias = lexicon, weights, bias

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> ToxicityModel:
        train = training_rows(docs, labels, doc_id, text, label, sample)
        lexicon = learn_lexicon(train)
        settle(docs.sparkSession)
        classes = {r.label for r in train.select("label").distinct().collect()}
        if classes != {0.0, 1.0}:  # nothing to learn from: a hit decides
            return cls(lexicon, np.eye(len(FEATURES))[5] * 4.0, -2.0)
        rows = with_features(train, "text", lexicon).select("label", "weight", array_to_vector("__f").alias("features")).cache()
        try:
            fitted = LogisticRegression(maxIter=50, regParam=1e-3, weightCol="weight").fit(rows)
        finally:
            rows.unpersist()
        settle(docs.sparkSession)
        return cls(lexicon, np.array(fitted.coefficients), float(fitted.intercept))

    def score(self, df: DataFrame, text: str = "text", to: str = "score") -> DataFrame:
        """df and its scores from 0 to 1; null and empty texts have no hits and the score of that."""
        named = with_features(df, text, self.lexicon)
        total = F.lit(self.bias)
        for i, w in enumerate(self.weights.tolist()):
            total = total + F.col("__f")[i] * F.lit(w)
        return named.withColumn(to, 1 / (1 + F.exp(-total))).drop("__f")


def score_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out boolean, score double, predicted int), a row for every input row.

    Terms of five letters and more are found with one edit (a letter more, less or other), shorter ones as they
    are. Labels are learned from at most `sample` rows that aren't held out; labels other than 0 and 1 and
    null ids in them are ignored, of repeated labels of an id the higher counts. Without labels of both
    classes a base lexicon decides. Nothing but the text goes into a score. Null and empty texts are
    scored as texts without hits; a null id is not held out. Texts of any length are read whole;
    repeated rows get equal scores; other columns are left out.
    """
    model = ToxicityModel.fit(docs, labels, doc_id, text, label, sample)
    out = model.score(docs.select(F.col(doc_id), F.col(text).alias("__text")), "__text").withColumn("held_out", F.coalesce(held_out(doc_id), F.lit(False)))
    return out.select(doc_id, "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE, least: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, whose score is below `least`.

    Null and empty texts are scored as texts without hits and stay; repeated rows are judged alike; other columns
    may have any names but __score and __f; an empty table stays empty. Labels as for score_toxicity.
    """
    model = ToxicityModel.fit(docs, labels, doc_id, text, label, sample)
    return model.score(docs, text, "__score").where(F.col("__score") < least).drop("__score")

