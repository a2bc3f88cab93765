"""Observations that arrive as a stream: late-data handling, deduplication, and episodes kept up to date."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sedimenta.operators.episodes import KEY, episodes


def windowed_counts(events: DataFrame, time: str, keys: Sequence[str], width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Rows of each window and key; data later than the watermark is dropped from state."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), *keys, "n")


def deduplicated(events: DataFrame, keys: Sequence[str], time: str, late: str = "2 days") -> DataFrame:
    """The first row of each key within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def follow_episodes(observations: DataFrame, store: str, checkpoint: str, start: str, end: str, publish: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Append each micro-batch to a Parquet store and publish the episodes of the permits it touches.

    An observation that is already in the store is not added again, so a replayed batch changes nothing. Only the
    touched permits are read back and rebuilt: the store is joined with the batch's keys, not recomputed whole.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates([*KEY, "observed_date"])
        try:
            have = spark.read.schema(batch.schema).parquet(store)
            new = new.join(have.select(*KEY, "observed_date"), [*KEY, "observed_date"], "left_anti")
        except Exception as missing:  # the store doesn't exist before the first batch
            if "PATH_NOT_FOUND" not in str(missing):
                raise
        new.write.mode("append").parquet(store)
        touched = batch.select(*KEY).distinct()
        whole = spark.read.schema(batch.schema).parquet(store).join(touched, list(KEY), "left_semi")
        publish(episodes(whole, start, end), number)

    return observations.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
