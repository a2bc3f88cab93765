"""Numbers, quantiles and capped sets against plain Python, with ties, nulls, hot values and several partitions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.operators.ordered import numbered, numbered_in_place, quantiles
from sedimenta.operators.profile import capped_distinct
from sedimenta.operators.windows import quantile_rows


def table(spark, n=700):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, 0.0, 0.0, 0.0, rng.random(), -rng.random()]), i) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, v double, i long").repartition(7)


def test_numbers_follow_the_order(spark):
    rows, df = table(spark)
    got = numbered(df, F.asc_nulls_first("k"), F.desc_nulls_last("v"), to="n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, len(rows) + 1))
    assert [(r.k, r.v) for r in got] == [r[:2] for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is None, -(r[1] or 0)))]
    assert numbered(df.limit(0), "k").count() == 0


def test_equal_rows_are_spread(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        same = numbered(spark.range(0, 4000, 1, 8).select(F.lit(1).alias("v")), "v")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.row_number for r in same.collect()) == list(range(1, 4001))
    assert max(r.n for r in same.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()) < 2500


def test_numbers_in_place(spark, tmp_path):
    (tmp_path / "lines").write_text("".join(f"line {i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        lines = spark.read.text(str(tmp_path / "lines"))
        assert lines.rdd.getNumPartitions() > 3
        got = numbered_in_place(lines, "n").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.n, r.value) for r in got) == [(i + 1, f"line {i}") for i in range(5000)]


@pytest.mark.parametrize("q", [0, 0.3, 0.5, 0.9, 1])
def test_quantiles(spark, q):
    rows, df = table(spark)
    got = {r.k: r.quantile for r in quantiles(df, ["k"], "v", q).collect()}
    want = {k: np.quantile([r[1] for r in rows if r[0] == k and r[1] is not None], q) for k in ("a", "b", None)}
    assert got == pytest.approx(want)
    assert quantiles(df.where("v IS NULL"), ["k"], "v", q).count() == 0


def test_nearest_rows_of_few(spark):
    one = spark.createDataFrame([("x", 3)], "code string, total long")
    assert [tuple(r) for r in quantile_rows(one, "total", "code").collect()] == [("q10", "x", 3)]
    assert quantile_rows(one.limit(0), "total", "code").count() == 0


@pytest.mark.parametrize("cap", [1, 3, 4, 500])
def test_capped_sets(spark, cap):
    _, df = table(spark)
    df = df.withColumn("a.b", F.col("i") % 3).withColumn("none", F.lit(None).cast("string"))
    want = {"k": 2, "v": df.select("v").where("v IS NOT NULL").distinct().count(), "i": 700, "a.b": 3, "none": 0}
    got = {r.column_name: (r.distinct_count, r.is_exact) for r in capped_distinct(df, list(want), cap).collect()}
    assert got == {c: (min(n, cap), n <= cap) for c, n in want.items()}
    assert {tuple(r) for r in capped_distinct(df.limit(0), ["k", "i"], cap).collect()} == {("k", 0, True), ("i", 0, True)}
