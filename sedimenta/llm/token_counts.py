"""Exact token counts of whole texts from a two-tier table of pre-token lengths.

A tokenizer never merges across its pre-tokens, so a text's count is the sum of the counts of its
pre-tokens. Tier one is a compact table of the most frequent pre-tokens, broadcast once; tier two is
a bounded cache in each Python worker, filled by encoding what tier one misses. No pre-token is
shuffled: only a bounded summary of each task takes part in choosing tier one.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of tier one, of a task's summary, of a worker's cache; the longest pre-token that is kept.
FREQUENT, SUMMARY, CACHE, LONGEST = 1 << 15, 4096, 1 << 18, 48
_SPACE = "▁"


class _Pieces:
    """A sentencepiece model: pre-tokens are runs of word-start marks with what follows them."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        lead, plain = (self.model.encode(x, out_type=str) for x in ("a", "a  a"))
        crossing = re.compile(f"[^{_SPACE}]{_SPACE}")
        # Splitting is exact only for models that add one leading mark, keep every space and have no piece across a mark.
        self.splits = "".join(lead) == f"{_SPACE}a" and "".join(plain) == f"{_SPACE}a{_SPACE}{_SPACE}a" and not any(map(crossing.search, pieces))
        self.splits = self.splits and "".join(self.model.encode("ﬁ 　Ａ", out_type=str)) == f"{_SPACE}ﬁ 　Ａ"

    def split(self, text: str) -> list[str] | None:
        """The text's pre-tokens without their first mark; None: encode the text whole."""
        if not self.splits:
            return None
        text = text.replace(_SPACE, " ")
        if "  " not in text and text[:1] != " ":
            return text.split(" ") if text[-1:] != " " else [*text[:-1].split(" "), ""]
        return [x[1:] for x in re.findall(" +[^ ]*", " " + text)]

    def length(self, token: str) -> int:
        return len(self.model.encode(token, num_threads=1)) if token else 1

    def whole(self, text: str) -> int:
        return len(self.model.encode(text, num_threads=1))


class _Vocabulary:
    """A tokenizers file; a text that holds an added token is encoded whole, as the library would."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        added = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.before, self.normal = self.model.pre_tokenizer, self.model.normalizer

    def split(self, text: str) -> list[str] | None:
        if self.before is None or self.added and self.added.search(text):
            return None
        if self.normal is not None:
            text = self.normal.normalize_str(text)
        return [x for x, _ in self.before.pre_tokenize_str(text)]

    def length(self, token: str) -> int:
        return len(self.model.model.tokenize(token))

    def whole(self, text: str) -> int:
        return len(self.model.encode(text, add_special_tokens=False))


_LOADED: dict[str, object] = {}


def load(path: str):
    """The tokenizer of a file, once per worker."""
    if path not in _LOADED:
        _LOADED[path] = _Pieces(path) if path.endswith(".model") else _Vocabulary(path)
    return _LOADED[path]


def _summaries(path: str, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each task's most frequent pre-tokens by lossy counting, in bounded memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, seen, floor = load(path), Counter(), 0
        for batch in batches:
            for text in batch.column(0):
                seen.update(tokenizer.split(text.as_py()) or ())
                if len(seen) > 64 * size:
                    floor += 1
                    seen = Counter({t: n for t, n in seen.items() if n > floor})
        top = [(t, n) for t, n in seen.most_common(size) if n > 1 and len(t) <= LONGEST]
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["token", "n"])

    return run


def frequent_lengths(texts: DataFrame, path: str, frequent: int = FREQUENT, summary: int = SUMMARY) -> tuple[bytes, bytes]:
    """Tier one: (pre-tokens joined by NUL, their lengths), at most `frequent` entries of LONGEST characters.

    A broadcast of it is below frequent * (4 * LONGEST + 2) bytes at any size of the corpus. Which
    pre-tokens it holds changes the speed, never a count.
    """
    named = texts.select(F.col(texts.columns[0]).alias("text")).where("text IS NOT NULL")
    top = named.mapInArrow(_summaries(path, summary), "token string, n long").groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(frequent)
    tokens = [r.token for r in top.collect() if "\0" not in r.token]
    tokenizer = load(path)
    return "\0".join(tokens).encode(), np.minimum([tokenizer.length(t) for t in tokens] or [0], 65535).astype(np.uint16).tobytes()


class _Misses(dict):
    """Lengths by pre-token: tier one, and behind it a bounded cache of what was encoded here."""

    def __init__(self, known: dict, tokenizer, room: int):
        super().__init__(known)
        self.tokenizer, self.most = tokenizer, len(known) + room
        self.known = known

    def __missing__(self, token: str) -> int:
        n = self.tokenizer.length(token)
        if len(token) <= LONGEST:
            if len(self) >= self.most:
                self.clear()
                self.update(self.known)
            self[token] = n
        return n


_TIERS: dict[str, _Misses] = {}


def count_tokens(
    df: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 4096,
    frequent: int = FREQUENT,
    summary: int = SUMMARY,
    cache: int = CACHE,
) -> DataFrame:
    """(id, n_bytes long, n_tokens long, over_limit boolean), a row for every input row.

    tokenizer: path of a .model (sentencepiece) or .json (tokenizers) file, readable on every node.
    No begin, end or added special tokens, no truncation. Null and empty texts have 0 bytes and 0
    tokens; null ids and repeated rows stay as they are; other columns of df are left out, whatever
    their names; an empty table gives an empty result. Texts of any length are counted whole.
    """
    spark = df.sparkSession
    texts = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    table = spark.sparkContext.broadcast(frequent_lengths(texts.select("__text"), tokenizer, frequent, summary))
    key = f"{tokenizer} {uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = load(tokenizer)
        if key not in _TIERS:
            _TIERS.clear()
            joined, sizes = table.value
            known = dict(zip(joined.decode().split("\0"), np.frombuffer(sizes, np.uint16).tolist(), strict=True))
            known.pop("", None)
            _TIERS[key] = _Misses(known, library, cache)
        find = _TIERS[key].__getitem__
        for batch in batches:
            n_bytes, n_tokens = [], []
            for text in batch.column(1):
                raw = text.as_py()
                parts = library.split(raw) if raw else []
                n_bytes.append(text.as_buffer().size)
                n_tokens.append(library.whole(raw) if parts is None else sum(map(find, parts)))
            size, count = pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, count], [id_col, "n_bytes", "n_tokens"])

    kind = texts.schema[id_col].dataType.simpleString()
    counted = texts.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
