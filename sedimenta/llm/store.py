"""Where intermediate results of the iterative operators live.

They are written to the shared folder named by spark.checkpoint.dir, which survives the loss of
any executor, and read back, which also cuts lineage. Results are lazy and read them, so they stay
until their owner deletes them: what is called within `with temporary(spark):` has its tables deleted
at the end of the block, and nobody else's.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from sedimenta.session import shared_dir

_owner: ContextVar[list[Scratch] | None] = ContextVar("owner of new scratch tables", default=None)


class Scratch:
    """A folder of Parquet tables of one operator run."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        if (mine := _owner.get()) is not None:
            mine.append(self)

    def save(self, df: DataFrame, codec: str = "zstd") -> DataFrame:
        """Write df once and return what was written."""
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, df: DataFrame | None = None) -> None:
        """Delete one table that save() returned, or the whole folder."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root if df is None else df._scratch_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(spark: SparkSession) -> None:
    """Let Spark forget the jobs that are done: it deletes their shuffle files and broadcasts once nothing on the driver refers to them.

    Left to itself the driver collects its garbage only when its heap is full. Iterative operators call this after each round.
    """
    gc.collect()  # plans that Python objects still name
    spark._jvm.System.gc()


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end of the block, the tables of the operators called in it; their results must have been written by then."""
    mine: list[Scratch] = []
    token = _owner.set(mine)
    try:
        yield
    finally:
        _owner.reset(token)
        for scratch in mine:
            scratch.drop()
        settle(spark)
