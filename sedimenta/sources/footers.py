"""Footers of Parquet files as a table, and checks of a written build that read nothing but footers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A row for each column of each row group.
FOOTER = (
    "path string, file_bytes long, created_by string, row_groups int, columns string, contracts string, row_group int, rows long, group_bytes long, column string, "
    "physical_type string, codec string, stored_bytes long, plain_bytes long, nulls long, least string, greatest string"
)


def _open(uri: str):
    """The file of a uri, for random reads: only the footer is fetched."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def _contracts(schema) -> str:
    """The names of the contracts that the columns' metadata carry, sorted and joined by commas."""
    import json

    text = (schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    fields = json.loads(text)["fields"] if text else []
    return ",".join(sorted({f["metadata"]["contract"] for f in fields if "contract" in f.get("metadata", {})}))


def _text(value: object) -> str | None:
    return None if value is None else value.decode("utf-8", "replace") if isinstance(value, bytes) else str(value)


def _rows(uri: str, size: int) -> Iterator[tuple]:
    import pyarrow.parquet as pq

    with _open(uri) as stream:
        file = pq.ParquetFile(stream)
        meta, schema = file.metadata, file.schema_arrow
        names = ",".join(schema.names)
        head = (uri, size, meta.created_by, meta.num_row_groups, names, _contracts(schema))
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            for c in range(group.num_columns):
                column, s = group.column(c), group.column(c).statistics
                bounds = (s.min, s.max) if s is not None and s.has_min_max else (None, None)
                nulls = s.null_count if s is not None and s.has_null_count else None
                yield (*head, g, group.num_rows, group.total_byte_size, column.path_in_schema, column.physical_type, column.compression, column.total_compressed_size, column.total_uncompressed_size, nulls, *map(_text, bounds))
        if not meta.num_row_groups:
            yield (*head, *[None] * 11)


def parquet_footers(spark: SparkSession, path: str, tasks: int = 0) -> DataFrame:
    """The footers of all Parquet files below a path, read by tasks: a row for each column of each row group (see FOOTER).

    Files without row groups have one row whose row_group is null; a folder without files gives no rows. Files are
    listed by Spark without their content and dealt out by name; `tasks` sets how many tasks read (default: the
    session's shuffle partitions). The store must be one that pyarrow opens. least and greatest are texts of the
    statistics and may be cut or missing for long strings, as the writer decides.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path).select("path", "length")
    found = found.repartition(tasks, "path") if tasks else found.repartition("path")
    names = [c.split()[0] for c in FOOTER.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, size in zip(batch["path"], batch["length"], strict=True):
                yield pd.DataFrame(list(_rows(uri, size)), columns=names).astype(dict.fromkeys(("row_group", "rows", "group_bytes", "stored_bytes", "plain_bytes", "nulls"), "Int64"))

    return found.mapInPandas(read, FOOTER)


def column_facts(footers: DataFrame) -> DataFrame:
    """(column, row_groups, rows, nulls, stored_bytes, plain_bytes) over all files. nulls is null if a row group doesn't tell."""
    told = F.when(F.count_if(F.col("nulls").isNull()) == 0, F.sum("nulls"))
    return footers.where("row_group IS NOT NULL").groupBy("column").agg(F.count("*").alias("row_groups"), F.sum("rows").alias("rows"), told.alias("nulls"), F.sum("stored_bytes").alias("stored_bytes"), F.sum("plain_bytes").alias("plain_bytes"))


def build_faults(footers: DataFrame, columns: Sequence[str], contract: str, codec: str, rows: int, most_rows: int, required: Sequence[str] = ()) -> DataFrame:
    """(check, violations): what the footers of a build say against its contract, in one aggregate.

    Files with other columns or another contract's metadata, column chunks of another codec, row groups of over most_rows
    rows, nulls in required columns (counted; chunks that don't tell count as one), rows too many or too few, and 1 if there are no files.
    """
    lead = F.col("column") == columns[0]
    unlike = footers.groupBy("path").agg(F.first("columns").alias("c"), F.first("contracts").alias("k"))
    files = unlike.agg(F.count("*").alias("files"), F.count_if(F.col("c") != ",".join(columns)).alias("columns"), F.count_if(F.col("k") != contract).alias("contract"))
    chunks = footers.agg(
        F.count_if(F.col("codec") != codec).alias("codec"),
        F.count_if(lead & (F.col("rows") > most_rows)).alias("row_groups"),
        F.coalesce(F.sum(F.when(F.col("column").isin(*required), F.coalesce("nulls", F.lit(1)))), F.lit(0)).alias("nulls"),
        F.abs(F.coalesce(F.sum(F.when(lead, F.col("rows"))), F.lit(0)) - rows).alias("rows"),
    )
    one = files.crossJoin(F.broadcast(chunks))  # one row each
    checks = {"no files": (F.col("files") == 0).cast("long"), "columns": F.col("columns"), "contract": F.col("contract"), "codec": F.col("codec"), "row groups": F.col("row_groups"), "nulls": F.col("nulls"), "rows": F.col("rows")}
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), c.cast("long").alias("violations")) for n, c in checks.items()])))
