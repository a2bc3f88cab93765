"""Temporal URL lists: every capture is judged by the list entries that were active when it was fetched.

A list is a log of dated additions and removals. Its entries become disjoint validity intervals; a
capture is looked up under every key that could list it (its host, the parent domains, and its
host with each leading part of the path) and the as-of join keeps the latest interval that began by the
fetch time and hasn't ended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Intervals of a list that are broadcast at most (about 100 bytes each); a longer list is shuffled.
BROADCAST_ROWS, SALTS = 100_000, 16


def host_of(url: Column) -> Column:
    """Lower-case host without user, port, final dots; null where the url has none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"(:\d*)?$", "")
    return F.nullif(F.lower(F.regexp_replace(host, r"\.+$", "")), F.lit(""))


def path_of(url: Column) -> Column:
    """The path without query, fragment and outer slashes."""
    return F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^?#]*)", 1), r"^/+|/+$", "")


def lookup_keys(host: Column, path: Column) -> Column:
    """Each key that may list a url: domains by 'example.com', path prefixes by 'host/part'."""
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.split(path, "/")
    prefixes = F.when(path == "", F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/"))))
    return F.array_distinct(F.concat(domains, prefixes))


def validity(entries: DataFrame) -> DataFrame:
    """(list, key, valid_from, valid_to): the disjoint intervals in which each entry is active.

    entries: (list, entry, action 'add' or 'remove', since). Of several actions of one moment the removal
    counts; repeated additions are one; removals of what isn't there do nothing; an open end is null.
    Rows with a null entry, date or another action are ignored. Keys are trimmed; their host, up to the
    first slash, is lower-cased, and their path keeps its case, as that of a capture does.
    """
    # 'remove' is after 'add' by name, so the greatest action of a moment is the one that counts
    log = entries.where(F.col("entry").isNotNull() & F.col("since").isNotNull() & F.col("action").isin("add", "remove"))
    host = F.substring_index(F.trim("entry"), "/", 1)
    key = F.concat(F.lower(host), F.substr(F.trim("entry"), F.char_length(host) + 1))
    log = log.groupBy("list", key.alias("key"), "since").agg(F.max("action").alias("action"))
    by = Window.partitionBy("list", "key").orderBy("since")
    changes = log.withColumn("before", F.lag("action").over(by)).where("NOT action <=> before")
    closed = changes.withColumn("valid_to", F.lead("since").over(by)).where("action = 'add'")
    return closed.select("list", "key", F.col("since").alias("valid_from"), "valid_to")


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched_at: str = "fetched_at", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """captures, all columns, with blocked boolean, n_entries long (active entries that match), blocked_by string
    (the longest matching key, then the first by name) and blocked_since (its valid_from).

    A url is matched by its host, by each parent domain and by its path prefixes of whole parts. An
    interval holds from valid_from up to but without valid_to. Null or hostless urls and null fetch times
    match nothing. Repeated rows are each judged; an empty list blocks nothing. Columns of captures may
    have any name but those four.
    """
    spans = validity(entries)
    asked = captures.select(F.col(url).alias("__url"), F.col(fetched_at).alias("__at")).where("__url IS NOT NULL AND __at IS NOT NULL").distinct()
    asked = asked.select("__url", "__at", F.explode(lookup_keys(host_of(F.col("__url")), path_of(F.col("__url")))).alias("key"))
    if spans.limit(broadcast_rows + 1).count() <= broadcast_rows:
        found = asked.join(F.broadcast(spans), "key")
    else:  # a host may hold a third of the captures: deal its rows over SALTS partitions
        dealt = spans.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        found = asked.withColumn("salt", F.pmod(F.xxhash64("__url", "__at"), F.lit(SALTS)).cast("int")).join(dealt, ["key", "salt"])
    active = found.where("valid_from <= __at AND (valid_to IS NULL OR __at < valid_to)")
    best = F.min_by(F.struct("key", "valid_from"), F.struct(-F.length("key"), F.col("key"), F.col("valid_from")))
    hits = active.groupBy("__url", "__at").agg(F.count("*").alias("n"), best.alias("best"))
    out = captures.join(hits, (captures[url] == hits["__url"]) & (captures[fetched_at] == hits["__at"]), "left")
    return out.select(
        *[captures[c] for c in captures.columns],
        F.col("n").isNotNull().alias("blocked"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_entries"),
        F.col("best.key").alias("blocked_by"),
        F.col("best.valid_from").alias("blocked_since"),
    )
