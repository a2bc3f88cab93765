"""Session defaults shared by scripts, tests and the bench."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "sedimenta", cores: str | int = "*", shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A local session with UTC, ANSI and adaptive execution on; on a cluster, pass your own session instead."""
    builder = SparkSession.builder.appName(app).master(f"local[{cores}]")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where it is unset and Spark runs on this machine alone, as in tests, a new local folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="sedimenta-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared folder, so that a lost executor changes nothing of it."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, as spark-submit --py-files would."""
    context = spark.sparkContext
    if getattr(context, "_sedimenta_shipped", False):
        return
    package = Path(__file__).resolve().parent
    if package.is_dir():  # not when the package itself was imported from such an archive
        folder = tempfile.mkdtemp(prefix="sedimenta-")
        shutil.copytree(package, f"{folder}/src/{package.name}", ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", f"{folder}/src"))
    context._sedimenta_shipped = True
