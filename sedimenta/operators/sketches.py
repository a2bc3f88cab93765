"""Sketches of key sets, written once for each snapshot and merged later: distinct counts and overlaps without a rescan.

Theta sketches with 2^bits nominal entries: sets of up to that many keys are counted exactly, larger ones with a relative
standard error of 2^(-bits / 2); an overlap's error is relative to the union of its two sets. A sketch has at most
16 * 2^bits bytes or so, whatever the set. The same keys give the same estimates, however rows and snapshots are cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 12


def key_sketches(df: DataFrame, by: Sequence[str], key: str | Column, bits: int = BITS) -> DataFrame:
    """(by..., rows, keys): a sketch of the keys of each group, built map-side and merged after one shuffle of sketches. Null keys don't count; groups without keys have a sketch of none."""
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.theta_sketch_agg(key, bits).alias("keys"))


def keep(sketches: DataFrame, root: str, snapshot: str) -> None:
    """Write one snapshot's sketches below root; fails if that snapshot has been kept before."""
    sketches.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/snapshot={snapshot}")


def kept(spark: SparkSession, root: str) -> DataFrame:
    """All sketches below root, with their snapshot; filters on it prune folders."""
    return spark.read.option("basePath", root).parquet(root)


def merged(sketches: DataFrame, by: Sequence[str], bits: int = BITS) -> DataFrame:
    """(by..., rows, keys): sketches of the unions over what isn't named in by."""
    return sketches.groupBy(*by).agg(F.sum("rows").alias("rows"), F.theta_union_agg("keys", bits).alias("keys"))


def distinct(keys: str | Column = "keys") -> Column:
    """The estimated number of keys of a sketch."""
    return F.theta_sketch_estimate(keys)


def overlaps(sketches: DataFrame, name: str, bits: int = BITS) -> DataFrame:
    """(a, b, keys_a, keys_b, shared, only_a, only_b, error) for pairs a < b of named sketches, as estimates. error: the standard error of `shared`, in keys.

    Sketches are few (one for each source or snapshot, a row each): their pairs come from an equi-join on a constant
    bucket of the names, never from rows of the corpus.
    """
    one = sketches.select(F.col(name).alias("a"), F.col("keys").alias("ka"), F.lit(0).alias("__all"))
    two = sketches.select(F.col(name).alias("b"), F.col("keys").alias("kb"), F.lit(0).alias("__all"))
    pairs = one.join(two, "__all").where("a < b")
    union = F.theta_sketch_estimate(F.theta_union("ka", "kb", bits))
    return pairs.select(
        "a",
        "b",
        distinct("ka").alias("keys_a"),
        distinct("kb").alias("keys_b"),
        F.theta_sketch_estimate(F.theta_intersection("ka", "kb")).alias("shared"),
        F.theta_sketch_estimate(F.theta_difference("ka", "kb")).alias("only_a"),
        F.theta_sketch_estimate(F.theta_difference("kb", "ka")).alias("only_b"),
        F.when(union > 2**bits, union / 2 ** (bits / 2)).otherwise(0.0).alias("error"),
    )
