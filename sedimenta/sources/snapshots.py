"""Strict readers of snapshots: delimited text and pages of JSON. What doesn't fit raises; nothing is guessed silently."""

from __future__ import annotations

import codecs
import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sedimenta.operators.ordered import numbered_in_place

#: Encodings that are tried on the head of a file, after a byte-order mark.
ENCODINGS = ("utf-8", "cp949", "euc-kr")
HEAD = 1 << 20
_JVM_NAMES = {"cp949": "x-windows-949", "euc-kr": "EUC-KR", "utf-8": "UTF-8", "utf-8-sig": "UTF-8"}


class SourceError(ValueError):
    """A source doesn't have the shape it must have."""


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The path itself if it is a file, else the files below it that Spark would read, by name."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.getFileStatus(p).isDirectory():
        return [path]
    found = [(f.getPath().getName(), f) for f in fs.listStatus(p)]
    return [f.getPath().toString() for name, f in sorted(found, key=lambda x: x[0]) if f.isFile() and name[0] not in "_." and f.getLen()]


def head_bytes(spark: SparkSession, path: str, size: int = HEAD) -> bytes:
    """The first bytes of a file in any store that Spark reads, or of the first file of a folder; none where there is none."""
    jvm = spark._jvm
    files = data_files(spark, path)
    if not files:
        return b""
    p = jvm.org.apache.hadoop.fs.Path(files[0])
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.open(p)
    try:
        n = min(size, fs.getFileStatus(p).getLen())
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, int(n))) if n else b""
    finally:
        stream.close()


def detect_encoding(head: bytes) -> tuple[str, bool]:
    """(encoding, whether it is an ambiguous legacy one), from a byte-order mark or the first encoding that decodes the head."""
    if head.startswith(codecs.BOM_UTF8):
        return "utf-8-sig", False
    for name in ENCODINGS:
        decoder = codecs.getincrementaldecoder(name)("strict")
        try:
            decoder.decode(head, final=len(head) < HEAD)
        except UnicodeDecodeError:
            continue
        return name, name != "utf-8"
    raise SourceError("no known encoding decodes the file")


def sniff_delimiter(text: str, choices: str = ",\t|;") -> str:
    """The delimiter of a head of text; the most frequent in its first line if the sniffer can't tell."""
    try:
        return csv.Sniffer().sniff(text, delimiters=choices).delimiter
    except csv.Error:
        line = text.split("\n", 1)[0]
        return max(choices, key=lambda d: (line.count(d), -choices.index(d)))


def read_header(spark: SparkSession, path: str, encoding: str, delimiter: str) -> list[str]:
    head = codecs.getincrementaldecoder(encoding)("strict").decode(head_bytes(spark, path), final=False)
    return next(csv.reader(head.splitlines(keepends=True), delimiter=delimiter), [])


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, encoding: str | None = None, delimiter: str | None = None) -> DataFrame:
    """All columns as text; empty values stay empty. Rows of another width and undecodable bytes raise.

    columns: the exact set of the header's names, in any order; None takes the header as it is. Repeated names raise.
    path: a file, or a folder of files with one header, which are read by a task each; a file whose header differs raises.
    """
    head = head_bytes(spark, path)
    encoding = encoding or detect_encoding(head)[0]
    text = codecs.getincrementaldecoder(encoding)("strict").decode(head, final=False)
    delimiter = delimiter or sniff_delimiter(text)
    header = next(csv.reader(text.splitlines(keepends=True), delimiter=delimiter), [])
    if len(set(header)) != len(header):
        raise SourceError("the header repeats a name")
    if columns is not None and set(header) != set(columns):
        raise SourceError(f"the header lacks {sorted(set(columns) - set(header))} and has {sorted(set(header) - set(columns))} too many")
    if encoding not in ("utf-8", "utf-8-sig"):
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    schema = StructType([StructField(c, StringType()) for c in header])
    options = {"header": "true", "sep": delimiter, "quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST", "enforceSchema": "false", "encoding": _JVM_NAMES[encoding], "nullValue": "\u0000", "emptyValue": ""}
    df = spark.read.schema(schema).options(**options).csv(path)
    whole = [F.when(F.col(f"`{c}`").contains("�"), F.raise_error(F.lit("undecodable bytes")).cast("string")).otherwise(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) for c in header]
    return df.select(*whole)


def with_row_number(df: DataFrame, name: str = "source_row_number") -> DataFrame:
    """1-based numbers in the order of the file; for frames of one file, whose partitions are in its order."""
    return numbered_in_place(df, to=name)


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with a header, nulls as empty values and \\n; one file only if asked, for small results."""
    (df.coalesce(1) if single else df).write.option("header", "true").option("nullValue", "").option("emptyValue", "").option("lineSep", "\n").csv(path)


def json_items(pages: DataFrame, column: str, item: str, path: str = "$.response.body.items.item") -> DataFrame:
    """A row for each item of pages whose items are an array, one object or null; another shape raises.

    item: the DDL of an item's fields. Columns of pages other than the JSON stay.
    """
    raw = F.get_json_object(column, path)
    first = F.substring(F.ltrim(raw), 1, 1)
    array = F.when(raw.isNull(), F.lit("[]")).when(first == "[", raw).when(first == "{", F.concat(F.lit("["), raw, F.lit("]"))).otherwise(F.raise_error(F.lit("items are neither an array nor an object")).cast("string"))
    rest = [c for c in pages.columns if c != column]
    return pages.select(*rest, F.inline(F.from_json(array, f"array<struct<{_ddl_to_struct(item)}>>", {"mode": "FAILFAST"})))


def _ddl_to_struct(ddl: str) -> str:
    return ",".join(f"`{name}`:{kind}" for name, kind in (part.split() for part in ddl.split(",")))


def read_json_pages(spark: SparkSession, path: str, item: str) -> DataFrame:
    """Items of all page files below a path, one file per record, with the file they come from."""
    pages = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("value"), F.input_file_name().alias("source_file"))
    return json_items(pages, "value", item)


def page_totals(pages: DataFrame, column: str) -> DataFrame:
    """(pages, rows, least_total, most_total): what an API announces against what its pages hold."""
    total = F.get_json_object(column, "$.response.body.totalCount").cast("long")
    raw = F.get_json_object(column, "$.response.body.items.item")
    n = F.when(raw.isNull(), 0).when(F.substring(F.ltrim(raw), 1, 1) == "{", 1).otherwise(F.json_array_length(raw))
    return pages.agg(F.count("*").alias("pages"), F.coalesce(F.sum(n), F.lit(0)).alias("rows"), F.min(total).alias("least_total"), F.max(total).alias("most_total"))


def page_counts(pages: DataFrame, column: str) -> DataFrame:
    """pages, and what each announces and holds: result_code string, total_count long, page_rows long.

    The typed result of a probe of one page, too. Pages that aren't JSON, or have no total, have a null total.
    """
    raw = F.get_json_object(column, "$.response.body.items.item")
    rows = F.when(raw.isNull(), 0).when(F.substring(F.ltrim(raw), 1, 1) == "{", 1).otherwise(F.json_array_length(raw))
    total = F.expr(f"try_cast(get_json_object(`{column}`, '$.response.body.totalCount') AS BIGINT)")
    return pages.select("*", F.get_json_object(column, "$.response.header.resultCode").alias("result_code"), total.alias("total_count"), rows.cast("long").alias("page_rows"))


def require_whole(pages: DataFrame, column: str, task: Sequence[str], page: str = "page", most_pages: int | None = None) -> DataFrame:
    """(task columns, pages, rows, total): a row for each task; raises SourceError if any task's pages aren't whole.

    Whole: pages are numbered from 1 without gaps or repeats, no more than most_pages; all announce the same
    total; their rows add up to it.
    """
    counts = page_counts(pages, column).groupBy(*task).agg(
        F.count("*").alias("pages"), F.sum("page_rows").alias("rows"), F.max("total_count").alias("total"),
        (F.min("total_count") == F.max("total_count")).alias("steady"), F.count("total_count").alias("announced"),
        ((F.min(page) == 1) & (F.max(page) == F.count("*")) & (F.count_distinct(page) == F.count("*"))).alias("numbered"),
    )
    whole = F.col("steady") & (F.col("announced") == F.col("pages")) & F.col("numbered") & (F.col("rows") == F.col("total"))
    if most_pages is not None:
        whole = whole & (F.col("pages") <= most_pages)
    broken = counts.where(~F.coalesce(whole, F.lit(False))).limit(5).collect()
    if broken:
        raise SourceError("pages aren't whole: " + "; ".join(str(tuple(r)) for r in broken))
    return counts.select(*task, "pages", "rows", "total")


def parquet_facts(spark: SparkSession, path: str) -> dict:
    """Rows and columns of a Parquet path; the count reads footers, not columns."""
    df = spark.read.parquet(path)
    return {"rows": df.count(), "columns": df.dtypes}


def head_rows(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first n rows by an explicit order."""
    return df.orderBy(*order).limit(n)


def concat_sources(frames: dict[str, DataFrame], name: str = "source_key") -> DataFrame:
    """Frames of equal columns one after the other, with the name of each; raises SourceError if columns differ."""
    out: DataFrame | None = None
    for key, df in frames.items():
        if out is not None and set(out.columns) != {*df.columns, name}:
            raise SourceError("the sources have different columns")
        named = df.withColumn(name, F.lit(key))
        out = named if out is None else out.unionByName(named)
    return out


def reference_domain(df: DataFrame, number: str, code: str, change: str, new: str = "NEW", deleted: str = "DELETED") -> DataFrame:
    """(active, numeric, aggregate, added, removed) of a reference list; raises SourceError if its numbering has gaps.

    Codes of digits are numeric, others aggregates; deleted codes aren't active.
    """
    row = df.agg(F.count("*").alias("n"), F.min(number).alias("a"), F.max(number).alias("b"), F.count_distinct(number).alias("d")).first()
    if row.n and (row.a != 1 or row.b != row.n or row.d != row.n):
        raise SourceError("the numbering isn't contiguous")
    active = ~F.coalesce(F.col(change) == deleted, F.lit(False))
    digits = F.col(code).rlike("^[0-9]+$")
    return df.agg(
        F.count_if(active).alias("active"), F.count_if(active & digits).alias("numeric"), F.count_if(active & ~digits).alias("aggregate"), F.count_if(F.col(change) == new).alias("added"), F.count_if(~active).alias("removed")
    )


def reference_codes(df: DataFrame, code: str, change: str, new: str = "NEW", deleted: str = "DELETED") -> DataFrame:
    """(code, active boolean, numeric boolean, added boolean): the codes of a reference list that reference_domain() counts."""
    active = ~F.coalesce(F.col(change) == deleted, F.lit(False))
    return df.select(F.col(code).alias("code"), active.alias("active"), F.coalesce(F.col(code).rlike("^[0-9]+$"), F.lit(False)).alias("numeric"), F.coalesce(F.col(change) == new, F.lit(False)).alias("added"))
