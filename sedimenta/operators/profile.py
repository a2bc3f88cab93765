"""Profiles and data-quality audits. A frame is scanned once: all counters of an audit are one aggregate."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.functions import scalars as S


class DuplicateKeyError(ValueError):
    """A key that must be unique isn't. The key itself is never part of the message."""


def _long(df: DataFrame, columns: Sequence[str], measures: dict[str, str], label: str = "column_name") -> DataFrame:
    """One aggregated row -> a row for each column with its measures."""
    rows = [F.struct(F.lit(c).alias(label), *[F.col(f"{c}\x1f{m}").cast(t).alias(m) for m, t in measures.items()]) for c in columns]
    return df.select(F.inline(F.array(*rows)))


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, nulls, empty and white-space-only values, what is left, shares and raw lengths of each text column."""
    columns = list(columns or df.columns)
    aggs: list[Column] = []
    for c in columns:
        v = F.col(c).cast("string")
        empty, spaces = v == "", (v != "") & (S.trim(v) == "")
        aggs += [
            F.count("*").alias(f"{c}\x1frow_count"),
            F.count_if(v.isNull()).alias(f"{c}\x1fnull_count"),
            F.count_if(empty).alias(f"{c}\x1fblank_count"),
            F.count_if(spaces).alias(f"{c}\x1fwhitespace_count"),
            F.count_if(S.trim(v) != "").alias(f"{c}\x1ffilled_count"),
            F.round(100.0 * F.count_if(v.isNull() | (S.trim(v) == "")) / F.nullif(F.count("*"), F.lit(0)), 4).alias(f"{c}\x1fblank_percent"),
            F.min(F.length(v)).alias(f"{c}\x1fmin_length"),
            F.max(F.length(v)).alias(f"{c}\x1fmax_length"),
        ]
    kinds = {m: "long" for m in ("row_count", "null_count", "blank_count", "whitespace_count", "filled_count")} | {"blank_percent": "double", "min_length": "long", "max_length": "long"}
    return _long(df.agg(*aggs), columns, kinds)


def capped_distinct(df: DataFrame, columns: Sequence[str], cap: int) -> DataFrame:
    """Distinct non-null values of each column up to a cap, and whether the number is exact.

    A task keeps at most cap + 1 values of a column and passes those on; sets merge the same way, so memory is
    columns times cap and what is shuffled tasks times that, whatever the table holds. An empty table counts 0.
    """
    columns = list(columns)

    def first_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[set] = [set() for _ in columns]
        for batch in batches:
            for have, values in zip(kept, batch.columns, strict=True):
                if len(have) <= cap:
                    for v in pc.unique(values).to_pylist():
                        if v is not None and len(have) <= cap:
                            have.add(v)
        at = [i for i, have in enumerate(kept) for _ in have]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([v for have in kept for v in have], pa.string())], ["at", "v"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, set] = {}
        for batch in batches:
            for i, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                have = kept.setdefault(i, set())
                if len(have) <= cap:
                    have.add(v)
        yield pa.RecordBatch.from_arrays([pa.array(list(kept), pa.int32()), pa.array([len(have) for have in kept.values()], pa.int64())], ["at", "n"])

    text = df.select(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(columns)])
    sets = text.mapInArrow(first_values, "at int, v string").repartition("at").mapInArrow(merged, "at int, n long")
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "at int, column_name string")
    n = F.coalesce("n", F.lit(0).cast("long"))
    return F.broadcast(names).join(sets, "at", "left").select("column_name", F.least(n, F.lit(cap).cast("long")).alias("distinct_count"), (n <= cap).alias("is_exact"))


def approximate_distinct(df: DataFrame, columns: Sequence[str], error: float = 0.02) -> DataFrame:
    """A sketch of the distinct values of each column, for columns too large to count exactly."""
    counted = df.agg(*[F.approx_count_distinct(c, error).alias(c) for c in columns])
    return counted.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("distinct_estimate")) for c in columns])))


def numeric_probe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many values of each column are finite numbers, and their extremes."""
    aggs = [f(S.parse_float(F.col(c).cast("string"))).alias(f"{c}\x1f{m}") for c in columns for m, f in (("numeric_count", F.count), ("numeric_min", F.min), ("numeric_max", F.max))]
    return _long(df.agg(*aggs), columns, {"numeric_count": "long", "numeric_min": "double", "numeric_max": "double"})


def date_probe(df: DataFrame, column: str, formats: Sequence[str] = S.DATE_FORMATS) -> DataFrame:
    """Values and extremes for each date format; the format is null for filled values that fit none."""
    v = F.col(column)
    named = df.where(~S.is_blank(v)).select(S.date_format_id(v, formats).alias("format"), S.parse_date(v, formats).alias("d"))
    return named.groupBy("format").agg(F.count("*").alias("n"), F.min("d").alias("first_date"), F.max("d").alias("last_date"))


def top_values(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The n most frequent values, ties by value; meant for columns of few values only."""
    counted = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).where("value IS NOT NULL")
    return counted.orderBy(F.desc("n"), "value").limit(n).withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "value")).cast("long"))


def filled_columns(df: DataFrame, source: Column, columns: list[str]) -> DataFrame:
    """(source, column_name): the columns that hold anything but nulls and blanks in each source; one aggregate for all columns."""
    held = df.groupBy(source.alias("source")).agg(*[F.bool_or(~S.is_blank(F.col(c).cast("string"))).alias(c) for c in columns])
    return held.select("source", F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("__held")) for c in columns]))).where("__held").drop("__held")


def column_sets(profiles: DataFrame, source: str = "source", column: str = "column_name") -> DataFrame:
    """For each column name: in how many sources it is, whether in all, and the only source that has it."""
    total = profiles.agg(F.count_distinct(source).alias("total"))
    by = profiles.groupBy(column).agg(F.count_distinct(source).alias("sources"), F.min(source).alias("first_source"))
    return by.crossJoin(total).select(column, F.col("sources").cast("long"), (F.col("sources") == F.col("total")).alias("in_all"), F.when(F.col("sources") == 1, F.col("first_source")).alias("only_in"))


def duplicate_summary(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """For each named key: filled rows, distinct values, values that repeat, rows beyond the first, greatest multiplicity.

    Values are counted with map-side combining; the second step reads one row for each value.
    """
    out: DataFrame | None = None
    for name, key in keys.items():
        groups = df.select(key.alias("k")).where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"))
        one = groups.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("populated_rows"),
            F.count("*").alias("distinct_values"),
            F.count_if(F.col("n") > 1).alias("duplicated_values"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_beyond_first"),
            F.coalesce(F.max("n"), F.lit(0)).alias("max_multiplicity"),
        ).select(F.lit(name).alias("key_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def snapshot_audit(df: DataFrame, retrieved_on: str, closed_label: str, columns: dict[str, str] | None = None) -> DataFrame:
    """Contradictions and gaps of a snapshot, one aggregate over one scan; no value of a row leaves it.

    columns maps the roles authority, management, permit_date, closure_date, status_name, business_name,
    phone, road_address, lot_address, x and y to the names of text columns.
    """
    names = {r: (columns or {}).get(r, r) for r in ("authority", "management", "permit_date", "closure_date", "status_name", "business_name", "phone", "road_address", "lot_address", "x", "y")}
    c = {r: F.col(n) for r, n in names.items()}
    blank = {r: S.is_blank(v) for r, v in c.items()}
    permit, closure, day = S.parse_date(c["permit_date"]), S.parse_date(c["closure_date"]), F.to_date(F.lit(retrieved_on))
    closed = F.coalesce(S.trim(c["status_name"]) == closed_label, F.lit(False))
    x, y = S.parse_float(c["x"]), S.parse_float(c["y"])
    both = ~blank["x"] & ~blank["y"]
    counters = {
        "rows": F.lit(True),
        "authority_blank": blank["authority"],
        "management_blank": blank["management"],
        "permit_blank": blank["permit_date"],
        "permit_unparseable": ~blank["permit_date"] & permit.isNull(),
        "permit_after_retrieval": permit > day,
        "closure_blank": blank["closure_date"],
        "closure_unparseable": ~blank["closure_date"] & closure.isNull(),
        "closure_before_permit": closure < permit,
        "closure_after_retrieval": closure > day,
        "closed_label": closed,
        "closed_label_without_closure": closed & blank["closure_date"],
        "other_label_with_closure": ~closed & ~blank["closure_date"],
        "business_name_filled": ~blank["business_name"],
        "phone_filled": ~blank["phone"],
        "road_address_filled": ~blank["road_address"],
        "lot_address_filled": ~blank["lot_address"],
        "coordinates_both": both,
        "coordinates_none": blank["x"] & blank["y"],
        "coordinates_one": blank["x"] != blank["y"],
        "coordinates_unparseable": both & (x.isNull() | y.isNull()),
        "coordinates_zero": both & (x == 0) & (y == 0),
        "coordinates_negative": both & x.isNotNull() & y.isNotNull() & ((x < 0) | (y < 0)),
    }
    out = df.agg(*[F.count_if(F.coalesce(v, F.lit(False))).alias(n) for n, v in counters.items()])
    return out.withColumn("closure_date_sufficient", F.when((F.col("closed_label_without_closure") > 0) | (F.col("other_label_with_closure") > 0), "FALSE").otherwise("NOT_FALSIFIED"))


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Present and missing values of each column and the share present, to two digits."""
    counted = df.agg(F.count("*").alias("__all"), *[F.count(F.col(c)).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("present"), (F.col("__all") - F.col(c)).alias("missing"), F.round(100.0 * F.col(c) / F.nullif(F.col("__all"), F.lit(0)), 2).alias("present_percent")) for c in columns]
    return counted.select(F.inline(F.array(*rows)))


def value_combinations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of each combination of trimmed values; null counts as empty."""
    return df.select(*[F.coalesce(S.trim(F.col(c)), F.lit("")).alias(c) for c in columns]).groupBy(*columns).agg(F.count("*").alias("n"))


def uniqueness(df: DataFrame, *keys: Column) -> DataFrame:
    """(duplicate_keys, duplicate_rows) of a composite key."""
    named = df.select(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    groups = named.groupBy(*named.columns).agg(F.count("*").alias("n"))
    return groups.agg(F.count_if(F.col("n") > 1).alias("duplicate_keys"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows"))


def require_unique(df: DataFrame, *keys: Column) -> DataFrame:
    """df itself; raises DuplicateKeyError, without the key, if a key repeats."""
    named = df.select(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    if named.groupBy(*named.columns).count().where("count > 1").limit(1).count():
        raise DuplicateKeyError("a key that must be unique occurs more than once")
    return df


def transform_quality(df: DataFrame, dates: Sequence[str], numbers: Sequence[str], required: Sequence[str]) -> DataFrame:
    """Counters of a dry run of the transform: date qualities, bad numbers and blank required values; nothing is written."""
    aggs = [F.count("*").alias("row_count")]
    for c in dates:
        q = S.date_quality(F.col(c))
        aggs += [F.count_if(q == k).alias(f"{c}_{k.lower()}") for k in ("VALID", "MISSING", "INVALID")]
    aggs += [F.count_if(S.float_is_bad(F.col(c))).alias(f"{c}_bad") for c in numbers]
    aggs += [F.count_if(S.is_blank(F.col(c))).alias(f"{c}_blank") for c in required]
    return df.agg(*aggs)


def key_overlap(df: DataFrame, source: str, key: Column, context: Column) -> DataFrame:
    """Keys in more than one source, and among them those with one and with several contexts."""
    by = df.select(F.col(source).alias("s"), key.alias("k"), context.alias("c")).where("k IS NOT NULL").groupBy("k").agg(F.count_distinct("s").alias("sources"), F.count_distinct("c").alias("contexts"))
    several = F.col("sources") > 1
    return by.agg(F.count("*").alias("keys"), F.count_if(several).alias("shared_keys"), F.count_if(several & (F.col("contexts") <= 1)).alias("same_context"), F.count_if(several & (F.col("contexts") > 1)).alias("conflicting_context"))
