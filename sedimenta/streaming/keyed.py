"""Episodes kept in keyed state: each permit's observed days as runs of equal observations, brought up to date by every micro-batch.

Permits are handled in buckets, so that the cost of a group is not paid for each permit.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import date
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from sedimenta.operators.episodes import KEY, STATE, episodes_of_runs

#: What an observation says beside its permit and day, in the order in which ties of a day are settled.
PAYLOAD = (*STATE, "source_closure_date", "source_closure_date_quality")
#: Runs as Python gives them: days count from the start of the window, dates are text.
RUNS = ", ".join([*(f"{c} string" for c in KEY), "first_day int", "last_day int", "n long", *(f"{c} string" for c in PAYLOAD)])
#: Groups of permits by hash. What Spark and Python hand each other costs milliseconds a group, whatever it holds. A checkpoint stays with the number that it was begun with.
BUCKETS = 2048
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: State in RocksDB, of which a micro-batch saves what it changed, not a copy of the whole.
STORE = {PROVIDER: ROCKS, "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def unpack(seen: bytes, runs: str) -> dict[int, tuple]:
    """{day: payload} of a bitmap of days and the run lengths of their payloads."""
    days = np.flatnonzero(np.unpackbits(np.frombuffer(seen, np.uint8)))
    return dict(zip(days.tolist(), (p for n, payload in json.loads(runs) for p in [tuple(payload)] * n)))


def runs_of(days: dict[int, tuple]) -> list[list]:
    """[first day, last day, number of days, payload] of each run of equal payloads, in the order of days."""
    out: list[list] = []
    for day in sorted(days):
        if out and out[-1][3] == days[day]:
            out[-1][1], out[-1][2] = day, out[-1][2] + 1
        else:
            out.append([day, day, 1, days[day]])
    return out


def pack(days: dict[int, tuple]) -> tuple[bytes, str]:
    seen = np.zeros(max(days) + 1, np.uint8)
    seen[list(days)] = 1
    return np.packbits(seen).tobytes(), json.dumps([[n, payload] for _, _, n, payload in runs_of(days)], ensure_ascii=False)


def _rank(payload: tuple) -> tuple:
    return tuple((v is not None, v or "") for v in payload)


class RunState(StatefulProcessor):
    """For each bucket of permits one state row a permit: the days seen as bits, and the runs of equal observations among them.

    A day that comes again with the same observation changes nothing; with another one, the least of both counts
    (null first), so no order of arrival matters. A permit's row is at most as long as the window has days; only the rows of
    permits that a batch names are read, and only changed ones written. Once the watermark reaches `closing` (milliseconds)
    a timer drops the bucket; what comes for it then is ignored.
    """

    #: Reading rows of a bucket in their order costs a tenth of asking for one by its permit.
    ahead = 10

    def __init__(self, span: int, closing: int):
        self.span, self.closing = span, closing

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getMapState("runs", ", ".join(f"{c} string" for c in KEY), "seen binary, runs string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if timerValues.getCurrentWatermarkInMs() >= self.closing:
            return
        told: dict[tuple, dict[int, tuple]] = {}
        for part in rows:
            part = part[part["day"].between(0, self.span - 1)]
            columns = [[None if v is None or v != v else v for v in part[c]] for c in PAYLOAD]
            for permit, day, payload in zip(zip(*(part[c] for c in KEY)), part["day"].tolist(), zip(*columns)):
                days = told.setdefault(permit, {})
                if day not in days or _rank(payload) < _rank(days[day]):
                    days[day] = payload
        if not told:
            return
        known, kept = self.rows_of(told)
        out: list[tuple] = []
        for permit, new in told.items():
            days = unpack(*kept[permit]) if kept.get(permit) else {}
            changed = {day: payload for day, payload in new.items() if day not in days or _rank(payload) < _rank(days[day])}
            if changed:
                days |= changed
                self.state.updateValue(permit, pack(days))
                out += [(*permit, a, b, n, *payload) for a, b, n, payload in runs_of(days)]
        if not known:
            self.handle.registerTimer(self.closing)
        if out:
            yield _frame(out)

    def rows_of(self, permits: dict) -> tuple[bool, dict[tuple, tuple]]:
        """Whether the bucket has rows, and those of the permits: from a walk over the bucket, unless it holds far more than these."""
        most = self.ahead * len(permits)
        walked = list(islice(self.state.iterator(), most))
        found = {permit: row for permit, row in walked if permit in permits}
        if len(walked) == most:
            found |= {permit: self.state.getValue(permit) for permit in permits if permit not in found}
        return bool(walked), found

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        yield _frame([])

    def close(self) -> None:
        pass


def _frame(runs: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(runs, columns=[*KEY, "first_day", "last_day", "n", *PAYLOAD], dtype=object).astype({"first_day": "int32", "last_day": "int32", "n": "int64"})


def once_a_batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Observations that an Arrow batch repeats are sent on once, so that a permit with a third of all rows is thinned before the shuffle."""
    for part in parts:
        yield from pa.Table.from_batches([part]).group_by(part.schema.names, use_threads=False).aggregate([]).to_batches()


def keyed_runs(observations: DataFrame, start: str, end: str, keep_days: int = 30) -> DataFrame:
    """The runs of equal observations of each permit that a micro-batch changes: keys, first_date, last_date, n and the payload.

    observations: a stream with the columns of episodes(); others are dropped. All runs of a changed permit come, so they
    replace the earlier ones. Any order and any repetition of the batches gives the same runs. Observations outside the
    window, without a date, or without a key are left out (observation_counters() counts them). A permit's state is
    dropped once an observation lies keep_days after the end of the window; until then nothing is late.
    """
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    if last < first or first <= date(1970, 1, 1):
        raise ValueError("the window must end after it starts, and start after 1970-01-01")
    closing = (first - date(1970, 1, 1)).days * 86_400_000
    columns = [*KEY, "observed_date", *PAYLOAD]
    thin = observations.select(*columns).mapInArrow(once_a_batch, observations.select(*columns).schema)
    # the watermark trails by the whole window, so it reaches the first day only keep_days after the last
    timed = thin.withColumn("__at", F.col("observed_date").cast("timestamp")).withWatermark("__at", f"{(last - first).days + keep_days} days")
    begin = F.to_date(F.lit(start))
    dealt = timed.where(" AND ".join(f"{c} IS NOT NULL" for c in KEY)).select(
        F.pmod(F.xxhash64(*KEY), F.lit(BUCKETS)).alias("bucket"), *KEY, F.coalesce(F.datediff("observed_date", begin), F.lit(-1)).alias("day"), *[F.col(c).cast("string").alias(c) for c in PAYLOAD], "__at"
    )
    runs = dealt.groupBy("bucket").transformWithStateInPandas(RunState((last - first).days + 1, closing), RUNS, "Update", "EventTime")
    return runs.select(*KEY, F.date_add(begin, F.col("first_day")).alias("first_date"), F.date_add(begin, F.col("last_day")).alias("last_date"), "n", *[F.to_date(c).alias(c) if c == "source_closure_date" else F.col(c) for c in PAYLOAD])


def follow_keyed_episodes(observations: DataFrame, checkpoint: str, start: str, end: str, publish: Callable[[DataFrame, int], None], keep_days: int = 30) -> StreamingQuery:
    """Publish, after each micro-batch, all episodes of the permits that it changed; nothing is read back but their state.

    State lives in RocksDB and is saved below `checkpoint`, a folder that driver and executors share.
    """
    spark = observations.sparkSession

    def step(batch: DataFrame, number: int) -> None:
        publish(episodes_of_runs(batch, start, end), number)

    before = {name: spark.conf.get(name, None) for name in STORE}
    for name, value in STORE.items():
        spark.conf.set(name, value)  # a query keeps the settings that it starts with
    try:
        return keyed_runs(observations, start, end, keep_days).writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def publisher(folder: str) -> Callable[[DataFrame, int], None]:
    """Keeps each batch's episodes below folder/batch=N; a batch that runs again replaces its own."""
    return lambda df, number: df.write.mode("overwrite").parquet(f"{folder}/batch={number}")


def published(spark: SparkSession, folder: str) -> DataFrame:
    """The episodes that hold now: those of the last batch that changed their permit. One shuffle by permit."""
    kept = spark.read.parquet(folder)
    return kept.withColumn("__last", F.max("batch").over(Window.partitionBy(*KEY))).where("batch = __last").drop("batch", "__last")
