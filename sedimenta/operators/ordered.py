"""Row numbers and order statistics of whole tables, without a window over one partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.session import durable

#: monotonically_increasing_id() is the partition times 2**33 plus the place in it.
PLACE_BITS = 33


def _offsets(parts: DataFrame) -> DataFrame:
    """(_part, _before): the rows of all earlier partitions, from a row (_part) for each row. One row for each partition is added up."""
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    return sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))


def numbered_in_place(df: DataFrame, to: str = "row_number") -> DataFrame:
    """df with the place (from 1) of each row in the order in which its partitions hold them, as a scan of one file does.

    Rows stay where they are: one pass counts the partitions, a second adds each row's place to what came before.
    df must give the same partitions each time, as scans and narrow steps do; save a shuffled one first.
    """
    laid = F.monotonically_increasing_id()
    before = _offsets(df.select(F.shiftright(laid, PLACE_BITS).alias("_part")))
    rows = df.withColumn("_laid", laid).withColumn("_part", F.shiftright("_laid", PLACE_BITS))
    place = F.col("_before") + F.col("_laid").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) + 1
    return rows.join(F.broadcast(before), "_part").select(*[F.col(f"`{c}`") for c in df.columns], place.alias(to))


def numbered(df: DataFrame, *order: str | Column, to: str = "row_number") -> DataFrame:
    """df with the place (from 1) of each row in the given order of all rows.

    Rows are dealt out by ranges of the order and sorted there; only one count for each partition is added up.
    Name columns that make the order strict: rows equal in all of them are numbered as they happen to lie, so that
    however many there are, they needn't share a partition. Nulls come where the order says. An empty table stays empty.
    """
    order = (*order, "_salt")
    placed = df.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = durable(placed.drop("_salt").withColumn("_laid", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_laid", PLACE_BITS))
    place = F.col("_before") + F.col("_laid").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) + 1
    return placed.join(F.broadcast(_offsets(placed)), "_part").select(*[F.col(f"`{c}`") for c in df.columns], place.alias(to))


def quantiles(df: DataFrame, keys: Sequence[str], value: str, q: float) -> DataFrame:
    """(keys..., quantile double): the linearly interpolated quantile of the filled values of each group, exactly.

    Values are dealt out by ranges of (keys, value) and numbered; the one or two values next to the quantile's
    place are picked by number. No group is held anywhere, whatever its size. Groups without a filled value have none.
    """
    if not 0 <= q <= 1:
        raise ValueError("a quantile lies between 0 and 1")
    rows = df.where(F.col(f"`{value}`").isNotNull()).select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], F.col(f"`{value}`").cast("double").alias("_v"))
    names = [f"_k{i}" for i in range(len(keys))]
    at = numbered(rows, *names, "_v", to="_at")
    spans = at.groupBy(*names).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    spot = (F.col("_n") - 1) * F.lit(float(q))
    spans = spans.withColumns({"_lo": F.col("_first") + F.floor(spot), "_hi": F.col("_first") + F.ceil(spot), "_part": spot - F.floor(spot)})
    picks = spans.select(*names, "_part", F.explode(F.array_distinct(F.array("_lo", "_hi"))).alias("_at"), F.col("_lo"))
    found = at.select("_at", "_v").join(picks, "_at")  # a place is a key: no group meets in one task
    low, high = F.max(F.when(F.col("_at") == F.col("_lo"), F.col("_v"))), F.max(F.when(F.col("_at") != F.col("_lo"), F.col("_v")))
    return found.groupBy(*names).agg((low + F.max("_part") * (F.coalesce(high, low) - low)).alias("quantile")).select(*[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], "quantile")
