"""Builds: plans, content-addressed names, atomic commits, manifests and independent checks."""

from __future__ import annotations

import hashlib
import json
import os
import platform
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import UTC, datetime
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.operators.contract import Contract


class BuildError(RuntimeError):
    """A build can't be made or doesn't check out."""


def canonical_json(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def build_id(contract: Contract, writer: Mapping[str, object], inputs: Sequence[str]) -> str:
    """16 hex digits of the contract, the writer's settings and the digests of the inputs, in order."""
    return hashlib.sha256(canonical_json({"contract": contract.to_json(), "writer": dict(writer), "inputs": list(inputs)}).encode()).hexdigest()[:16]


def content_hash(df: DataFrame) -> str:
    """A digest of the rows in any order, repeated rows included: exclusive ors and sums of two 64-bit hashes of each row, and the count.

    Nulls are told from every text, and a value from the same value in the next column.
    """
    cells = [c for name in df.columns for c in (F.col(f"`{name}`").isNull(), F.col(f"`{name}`").cast("string"))]
    hashes = [F.xxhash64(F.lit(seed), *cells) for seed in (0, 1)]
    row = df.agg(F.count("*"), *[f for h in hashes for f in (F.bit_xor(h), F.sum(h.cast("decimal(38,0)")))]).first()
    return hashlib.sha256("|".join(map(str, (df.columns, *row))).encode()).hexdigest()


def file_digest(path: str | Path) -> tuple[int, str]:
    """(bytes, sha256) of a local file."""
    with open(path, "rb") as f:
        return os.fstat(f.fileno()).st_size, hashlib.file_digest(f, "sha256").hexdigest()


#: Settings of the Parquet writer that a build pins.
WRITER = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9", "parquet.writer.version": "v2"}


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_parquet(df: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """A Parquet folder with the pinned settings; fails if the path exists."""
    writer = df.write.mode("errorifexists").options(**WRITER)
    (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).parquet(path)


def commit(spark: SparkSession, df: DataFrame, root: str, name: str, write: Callable[[DataFrame, str], None] = write_parquet) -> str:
    """Write into root/.tmp and rename to root/name; an existing build is never replaced, a failed one is removed.

    A claim file, made only where there is none, keeps a second writer of the name out until the first is done; a
    writer that dies leaves it behind, and the error names it.
    """
    root = root.rstrip("/")
    final, claim, staging = f"{root}/{name}", f"{root}/.tmp/{name}.claim", f"{root}/.tmp/{name}-{uuid.uuid4().hex}"
    fs, target = _fs(spark, final)
    held, source = _fs(spark, claim)[1], _fs(spark, staging)[1]
    if fs.exists(target):
        raise BuildError(f"build {name} exists")
    try:
        fs.create(held, False).close()
    except Py4JJavaError as taken:
        if not fs.exists(held):
            raise
        raise BuildError(f"build {name} is being written; if its writer is gone, delete {claim}") from taken
    try:
        if fs.exists(target):
            raise BuildError(f"build {name} exists")
        write(df, staging)
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise BuildError(f"build {name} can't be renamed")
    except Exception:
        fs.delete(source, True)
        raise
    finally:
        fs.delete(held, False)
    return final


def plan(df: DataFrame, contract: Contract, root: str, inputs: Sequence[str]) -> dict:
    """What a build would do: its name, place, columns and physical plan. Reads no data."""
    name = build_id(contract, WRITER, inputs)
    return {
        "build_id": name,
        "path": f"{root.rstrip('/')}/{name}",
        "columns": [c.name for c in contract.columns],
        "shape_errors": contract.shape_errors(df),
        "writer": dict(WRITER),
        "plan": df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted"),
    }


def materialise(spark: SparkSession, df: DataFrame, contract: Contract, root: str, inputs: Sequence[str], revision: str | None = None) -> dict:
    """Check the contract, write, and return the manifest with counts, the content's digest, and the revision of the code if it's given."""
    contract.require(df)
    name = build_id(contract, WRITER, inputs)
    path = commit(spark, df, root, name)
    written = spark.read.parquet(path)
    return {"build_id": name, "path": path, "contract": contract.name, "rows": written.count(), "content": content_hash(written), "inputs": list(inputs), "made_at": datetime.now(UTC).isoformat(timespec="seconds"), "python": platform.python_version(), "commit": revision}


def verify(spark: SparkSession, manifest: Mapping, contract: Contract) -> dict:
    """Read a build anew and hold it against its manifest and contract; raises BuildError."""
    df = spark.read.parquet(manifest["path"])
    wrong = []
    if df.count() != manifest["rows"]:
        wrong.append("row count")
    if content_hash(df) != manifest["content"]:
        wrong.append("content")
    if [c for c in df.columns] != [c.name for c in contract.columns]:
        wrong.append("columns")
    if build_id(contract, WRITER, manifest["inputs"]) != manifest["build_id"]:
        wrong.append("build id")
    if wrong:
        raise BuildError("build doesn't match its manifest: " + ", ".join(wrong))
    contract.require(df)
    return {"status": "PASS", "rows": manifest["rows"]}


def verify_cells(cells: DataFrame, source_rows: int, released: int, k: int = 10, n: str = "cell_count") -> DataFrame:
    """(below_k, cells, rows, rows_match): no cell under k, and rows that add up."""
    out = cells.agg(F.count_if(F.col(n) < k).alias("below_k"), F.count("*").alias("cells"), F.coalesce(F.sum(n), F.lit(0)).alias("rows"))
    return out.withColumn("rows_match", (F.col("rows") == F.lit(released)) & (F.col("rows") <= F.lit(source_rows)))


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """(rows_a, rows_b, only_a, only_b): a multiset comparison of two frames of equal columns, for release packages."""
    keys = a.columns
    x, y = (df.groupBy(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00")).alias(c) for c in keys]).agg(F.count("*").alias("n")) for df in (a, b.select(*keys)))
    both = x.withColumnRenamed("n", "na").join(y.withColumnRenamed("n", "nb"), keys, "full_outer").na.fill(0, ["na", "nb"])
    return both.agg(
        F.coalesce(F.sum("na"), F.lit(0)).alias("rows_a"),
        F.coalesce(F.sum("nb"), F.lit(0)).alias("rows_b"),
        F.coalesce(F.sum(F.greatest(F.col("na") - F.col("nb"), F.lit(0))), F.lit(0)).alias("only_a"),
        F.coalesce(F.sum(F.greatest(F.col("nb") - F.col("na"), F.lit(0))), F.lit(0)).alias("only_b"),
    )


def contained(path: str | Path, root: str | Path) -> Path:
    """The resolved path; raises BuildError if it isn't inside root."""
    p, r = Path(path).resolve(), Path(root).resolve()
    if not p.is_relative_to(r) or p == r:
        raise BuildError("the path is outside its root")
    return p


def package(folder: str | Path, texts: Mapping[str, str], allowed: Sequence[str]) -> dict[str, tuple[int, str]]:
    """Write the text files of a release and return the digests of all its files; raises BuildError if a file isn't on the list."""
    root = Path(folder)
    root.mkdir(parents=True, exist_ok=True)
    for name, text in texts.items():
        target = contained(root / name, root)
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(text, encoding="utf-8", newline="\n")
    files = {p.relative_to(root).as_posix(): file_digest(p) for p in sorted(root.rglob("*")) if p.is_file()}
    extra = sorted(set(files) - set(allowed))
    if extra:
        raise BuildError(f"files that aren't part of the package: {extra}")
    return files


def data_dictionary(contract: Contract) -> str:
    """A Markdown table of a contract's columns."""
    rows = [f"| {c.name} | {c.kind} | {'yes' if c.nullable else 'no'} | {', '.join(c.allowed)} |" for c in contract.columns]
    return "\n".join([f"# {contract.name}", "", "| column | type | nullable | values |", "|---|---|---|---|", *rows, ""])


class Progress:
    """Counts of named steps, handed to a callback; never a value of a row."""

    def __init__(self, callback: Callable[[dict], None] | None = None):
        self.callback, self.done = callback, 0

    def step(self, name: str, rows: int, expected: int | None = None) -> dict:
        self.done += rows
        event = {"step": name, "rows": rows, "total": self.done, "percent": None if not expected else round(100 * self.done / expected, 1)}
        if self.callback:
            self.callback(event)
        return event
