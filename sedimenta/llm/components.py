"""Connected components by alternating large-star and small-star rounds, all in joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.store import Scratch, settle


def _print(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
    return row.n, row.h or 0


def roots(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(u, v): the least node v of the component of each node u that isn't the least itself. edges: (u, v).

    No node's neighbours are gathered; a node with many is a skewed join key, which adaptive execution splits.
    The driver forgets each round before the next, so its memory doesn't grow with the rounds.
    """
    now = scratch.save(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _print(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = scratch.save(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        after = _print(new)
        settle(scratch.spark)
        now, same, before = new, after == before, after
        if same:
            break
    return now


def connected(scratch: Scratch, labels: DataFrame, edges: DataFrame) -> DataFrame:
    """labels (rep, comp) after the components that edges (a, b) join have become one, named by the least."""
    at = labels.select(F.col("rep").alias("a"), F.col("comp").alias("u"))
    to = labels.select(F.col("rep").alias("b"), F.col("comp").alias("v"))
    new = roots(scratch, edges.join(at, "a").join(to, "b").select("u", "v"))
    moved = new.select(F.col("u").alias("comp"), F.col("v").alias("root"))
    return scratch.save(labels.join(moved, "comp", "left").select("rep", F.coalesce("root", "comp").alias("comp")))
