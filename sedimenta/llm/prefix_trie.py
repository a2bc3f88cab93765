"""A trie over the turns of conversations, as a table of its nodes.

A node is a distinct sequence of first turns. Each turn becomes a digest when its text is read, so texts
are never shuffled. The digests of a conversation are chained, every prefix becomes a row, and rows group
by (depth, digest) to nodes. Sums over subtrees explode each node to its ancestors. Nothing grows with the
square of a conversation's length: chains are cut into segments of SEGMENT turns, which are chained in turn,
and a node explodes only to the ancestors of its block of FAN depths; the tops of blocks explode to the
tops above them, and so on, a level for each power of FAN.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.store import Scratch
from sedimenta.operators.ordered import numbered

FAN = 16
SEGMENT = FAN * FAN
#: Bytes of a digest that are kept.
WIDTH = 16
#: The digest of no turns: the root, and where each segment starts.
ROOT = bytes(WIDTH)
#: Characters of a turn's text by which turns of one number are ordered before their digests are.
HEAD = 40
#: Ids are joined to pieces of about so many characters before they are hashed.
PIECE = 65_536


def turn_digest(role: str, text: str) -> F.Column:
    """The digest of a turn; null counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)), 1, WIDTH)


def _joined(one: F.Column, two: F.Column) -> F.Column:
    return F.substring(F.unhex(F.sha2(F.concat(one, two), 256)), 1, WIDTH)


def ordered_turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str, scratch: Scratch) -> DataFrame:
    """(conv, place from 1, turns, digest, n_bytes): the turns of each conversation in order, without their texts.

    Null turns come first; turns of one number are ordered by role, the first characters of the text and the digest.
    Rows without a conversation are left out. A conversation may hold any share of the rows: rows are dealt out
    by ranges of (conversation, turn), not by conversation.
    """
    empty = F.lit("")
    rows = scratch.save(
        conversations.where(F.col(conv).isNotNull()).select(
            F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, empty).alias("role"), F.left(F.coalesce(text, empty), F.lit(HEAD)).alias("head"), turn_digest(role, text).alias("digest"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes")
        )
    )
    at = numbered(rows, "conv", F.asc_nulls_first("turn"), "role", "head", "digest", to="at").select("conv", "at", "digest", "n_bytes")
    first = at.groupBy("conv").agg(F.min("at").alias("first"), F.count("*").alias("turns"))
    return at.join(first, "conv").select("conv", (F.col("at") - F.col("first") + 1).alias("place"), "turns", "digest", "n_bytes")


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv, depth, digest) sorted by conversation and depth, a segment of each at least: (conv, depth, chain).

    The chain starts anew with each segment.
    """
    conv, key = None, ROOT
    for batch in batches:
        out = []
        for c, d, digest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if c != conv or (d - 1) % SEGMENT == 0:
                conv, key = c, ROOT
            key = hashlib.sha256(key + digest).digest()[:WIDTH]
            out.append(key)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["conv", "depth", "chain"])


def _climbed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv, depth, key, start, ups) in order: ups[j] gets the keys from the last depth below that FAN**(j + 1) divides, to the row's own.

    Only where FAN**j divides the depth. start: the key that the segment begins at; what ups has above the levels of a segment is kept.
    """
    conv, stacks, last = None, [], ROOT
    for batch in batches:
        out = []
        for c, d, key, start, above in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if c != conv or (d - 1) % SEGMENT == 0:
                conv, last, stacks = c, start, [[], [start]]
            if (d - 1) % FAN == 0:
                stacks[0] = [last]
            stacks[0].append(key)
            last = key
            ups = [list(stacks[0])]
            if d % FAN == 0:
                stacks[1].append(key)
                ups.append(list(stacks[1]))
            out.append(ups + (above or []))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(out, pa.list_(pa.list_(pa.binary())))], ["conv", "depth", "key", "ups"])


def _prefixes(scratch: Scratch, turns: DataFrame, longest: int) -> DataFrame:
    """(conv, depth, key, ups) of every prefix but the empty one. turns: (conv, depth, digest)."""
    segment = F.floor((F.col("depth") - 1) / SEGMENT).alias("segment")
    dealt = turns.select("conv", "depth", "digest", segment).repartition("conv", "segment").sortWithinPartitions("conv", "depth").select("conv", "depth", "digest")
    chains = dealt.mapInArrow(_chained, "conv long, depth long, chain binary").withColumn("segment", segment)
    above = F.lit(None).cast("array<array<binary>>").alias("above")
    if longest <= SEGMENT:  # one segment each: it starts at the root
        keys = chains.select("conv", "depth", F.col("chain").alias("key"), F.lit(ROOT).alias("start"), above)
        return scratch.save(keys.mapInArrow(_climbed, "conv long, depth long, key binary, ups array<array<binary>>"))
    chains = scratch.save(chains)
    full = chains.where(F.col("depth") % SEGMENT == 0)
    tops = _prefixes(scratch, full.select("conv", (F.col("depth") / SEGMENT).cast("long").alias("depth"), F.col("chain").alias("digest")), longest // SEGMENT)
    starts = tops.select("conv", F.col("depth").alias("segment"), F.col("key").alias("start"))
    ends = tops.select("conv", (F.col("depth") * SEGMENT).alias("depth"), F.col("key").alias("end"), F.col("ups").alias("above"))
    keys = chains.join(starts, ["conv", "segment"], "left").join(ends, ["conv", "depth"], "left")
    key = F.when(F.col("end").isNotNull(), F.col("end")).when(F.col("segment") > 0, _joined(F.col("start"), F.col("chain"))).otherwise(F.col("chain"))
    keys = keys.select("conv", "segment", "depth", key.alias("key"), F.coalesce("start", F.lit(ROOT)).alias("start"), "above")
    keys = keys.repartition("conv", "segment").sortWithinPartitions("conv", "depth").select("conv", "depth", "key", "start", "above")
    return scratch.save(keys.mapInArrow(_climbed, "conv long, depth long, key binary, ups array<array<binary>>"))


def _explode(items: DataFrame, ups: F.Column, step: int) -> DataFrame:
    """(depth, key, leaves, saved) summed over the ancestors in ups, which lie step depths apart and end with the item itself."""
    up = items.select("depth", "leaves", "saved", F.size(ups).alias("_n"), F.posexplode(ups).alias("_i", "key"))
    return up.groupBy((F.col("depth") - (F.col("_n") - 1 - F.col("_i")) * step).alias("depth"), "key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _subtrees(scratch: Scratch, items: DataFrame, level: int, deepest: int) -> DataFrame:
    """(depth, key, leaves, saved): sums of items (depth, key, ups, leaves, saved) over subtrees; depths are multiples of FAN**level."""
    step, block = FAN**level, FAN ** (level + 1)
    at_top = F.col("depth") % block == 0
    local = _explode(items, F.when(at_top, F.array("key")).otherwise(F.col("ups")[level]), step)
    if deepest < block:
        return local
    local = scratch.save(local)
    tops = items.where(at_top).select("depth", "key", "ups").join(local, ["depth", "key"])
    full = scratch.save(_subtrees(scratch, tops, level + 1, deepest))
    below = items.where(at_top & (F.col("depth") > 0)).select("depth", "key", "ups").join(full, ["depth", "key"])
    between = F.slice(F.col("ups")[level], 2, F.greatest(F.size(F.col("ups")[level]) - 2, F.lit(0)))  # without the top above and itself
    spread = _explode(below.withColumn("depth", F.col("depth") - step), between, step)
    rest = local.where(~at_top).unionByName(spread).groupBy("depth", "key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return full.select("depth", "key", "leaves", "saved").unionByName(rest)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (key, conv) to (key, first conv, conv ids joined by commas), pieces of about PIECE characters."""
    key, ids, size = None, [], 0

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], ["key", "conv", "ids"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and (k != key or size > PIECE):
                held.append(piece())
                ids, size = [], 0
            key = k
            ids.append(c)
            size += len(str(c)) + 1
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if ids:
        yield piece()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces (key, conv, ids) to (key, ends_sha256); one running hash, whatever the number of pieces."""
    key, h = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if k == key:
                h.update(b"," + ids.encode())
                continue
            if h is not None:
                done.append((key, h.hexdigest()))
            key, h = k, hashlib.sha256(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])], ["key", "ends_sha256"])
    if h is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([h.hexdigest()])], ["key", "ends_sha256"])


def conversation_trie(turns: DataFrame, conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """The nodes of the trie of all conversations.

    turns: (conv long, depth long from 1 without gaps, digest binary, n_bytes long), a row for each turn;
    conversations: (conv long, turns long), a row for each, those without turns too. A node has conv_id, the
    smallest member; depth; parent_conv_id (null for the root); n_convs; n_children; n_leaves and saved_tokens,
    summed over its subtree; ends_sha256, the hash of the ids of the conversations that end there. An empty
    table of conversations has no nodes, not even a root.
    """
    conversations = scratch.save(conversations)
    longest = conversations.agg(F.max("turns")).first()[0] or 0
    keyed = _prefixes(scratch, turns.select("conv", "depth", "digest"), longest)
    prefixes = keyed.join(turns.select("conv", "depth", "n_bytes"), ["conv", "depth"]).join(conversations, "conv")
    root = conversations.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("key"), F.array(F.array(F.lit(ROOT))).alias("ups"), F.lit(0).cast("long").alias("n_bytes"), "turns")
    prefixes = scratch.save(prefixes.select(*root.columns).unionByName(root))
    nodes = prefixes.groupBy("depth", "key").agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.first("n_bytes").alias("n_bytes"), F.first("ups").alias("ups"))
    levels = F.transform(F.sequence(F.lit(0), F.lit(16)), lambda j: F.when(F.col("depth") == 0, F.array(F.lit(ROOT))).otherwise(F.get("ups", j)))  # the root is a top of all levels
    parent = F.when(F.col("depth") > 0, F.element_at(F.slice(F.col("ups")[0], -2, 1), 1))
    nodes = scratch.save(nodes.select("depth", "key", "conv_id", "n_convs", "n_bytes", parent.alias("parent"), levels.alias("ups")))
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = scratch.save(nodes.join(kids, ["depth", "key"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    items = nodes.select("depth", "key", "ups", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    sums = _subtrees(scratch, items, 0, longest)
    ends = prefixes.where("depth = turns").select("key", "conv")
    pieces = ends.repartitionByRange("key", "conv").sortWithinPartitions("key", "conv").mapInArrow(_pieces, "key binary, conv long, ids string")
    hashes = pieces.repartition("key").sortWithinPartitions("key", "conv").mapInArrow(_hashed, "key binary, ends_sha256 string")
    above = nodes.select(F.col("depth").alias("_depth"), F.col("key").alias("_key"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.drop("ups").join(above, (F.col("depth") - 1 == F.col("_depth")) & (F.col("parent") == F.col("_key")), "left")
    out = out.join(sums.select("depth", "key", "leaves", "saved"), ["depth", "key"]).join(scratch.save(hashes), "key", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")
    )


def branched_turns(turns: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) of conversations that begin like another one.

    turns: those of ordered_turns(). Conversation c takes over the first h turns of conversation c - c % family,
    with h = crc32(c as text) % most, and goes on with its own turns after its first h.
    """
    own = turns.groupBy("conv").agg(F.max("turns").alias("own"))
    known = own.select("conv", "own", (F.crc32(F.col("conv").cast("string").cast("binary")) % most).alias("h"), (F.col("conv") - F.col("conv") % family).alias("base"))
    known = known.join(own.select(F.col("conv").alias("base"), F.col("own").alias("_there")), "base", "left")
    known = known.select("conv", "h", "base", F.least("h", F.coalesce("_there", F.lit(0))).alias("taken"), (F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("rest"))
    heads = turns.where(F.col("place") < most).select(F.col("conv").alias("base"), F.col("place").alias("depth"), "digest", "n_bytes")
    heads = known.join(heads, "base").where(F.col("depth") <= F.col("taken")).select("conv", "depth", "digest", "n_bytes")
    tails = turns.join(known, "conv").where(F.col("place") > F.col("h")).select("conv", (F.col("taken") + F.col("place") - F.col("h")).alias("depth"), "digest", "n_bytes")
    return heads.unionByName(tails), known.select("conv", (F.col("taken") + F.col("rest")).alias("turns"))
