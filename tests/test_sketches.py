"""Sketches kept by snapshot: exact while small, within their error when large, and alike however they are cut."""

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import sketches as K


def estimates(df):
    return {tuple(r)[:2]: r for r in df.collect()}


def test_small_sets_are_exact(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 2), ("b", None), ("c", None)], "s string, k int")
    found = {r.s: (r.rows, r.n) for r in K.key_sketches(rows, ["s"], "k").select("s", "rows", K.distinct().alias("n")).collect()}
    assert found == {"a": (3, 2), "b": (2, 1), "c": (1, 0)}
    pair = estimates(K.overlaps(K.key_sketches(rows, ["s"], "k"), "s"))[("a", "b")]
    assert (pair.shared, pair.only_a, pair.only_b, pair.error) == (1, 1, 0, 0)
    assert K.overlaps(K.key_sketches(rows.limit(0), ["s"], "k"), "s").count() == 0


def test_kept_snapshots_merge_to_the_whole(spark, tmp_path):
    rows = spark.range(60000).select((F.col("id") % 12).cast("string").alias("day"), F.when(F.col("id") < 40000, "a").otherwise("b").alias("s"), (F.col("id") % 50000).alias("k"))
    root = f"file://{tmp_path}/kept"
    for day in range(12):
        K.keep(K.key_sketches(rows.where(f"day = '{day}'"), ["s"], "k"), root, f"d{day}")
    with pytest.raises(Exception, match="(?i)exists"):
        K.keep(K.key_sketches(rows, ["s"], "k"), root, "d0")
    assert K.kept(spark, root).count() == 24
    parts, whole = (estimates(K.overlaps(x, "s"))[("a", "b")] for x in (K.merged(K.kept(spark, root), ["s"]), K.key_sketches(rows.repartition(7), ["s"], "k")))
    for pair in (parts, whole):
        assert abs(pair.keys_a - 40000) < 4 * 40000 / 64 and abs(pair.keys_b - 20000) < 4 * 20000 / 64
        assert pair.error == pytest.approx(50000 / 64, rel=0.07) and abs(pair.shared - 10000) < 4 * pair.error
    few = K.merged(K.kept(spark, root).where("snapshot = 'd3'"), ["s"]).agg(F.sum("rows")).first()[0]
    assert few == 5000
