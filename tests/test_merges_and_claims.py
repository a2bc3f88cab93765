"""Merged summaries that check themselves while they are computed, digests of rows, and two writers of one build."""

import pytest

from sedimenta.operators import build as B
from sedimenta.operators import joins as J


def frame(spark, rows, column):
    return spark.createDataFrame(rows, f"k string, {column} int")


def test_merge_summaries(spark):
    a, b, c = frame(spark, [("x", 1), ("y", None)], "n"), frame(spark, [("y", 3), ("x", 2)], "m"), spark.createDataFrame([("x",), ("y",)], "k string")
    merged = J.merge_summaries("k", a, b, c)
    assert merged.columns == ["k", "n", "m"] and sorted(map(tuple, merged.collect()), key=str) == [("x", 1, 2), ("y", None, 3)]
    assert J.merge_summaries("k", a.limit(0), b.limit(0)).count() == 0
    for bad in ([("x", 1)], [("x", 1), ("z", 2)], [("x", 1), ("y", 2), ("z", 3)], [("x", 1), ("y", 2), ("y", 2)], [("x", 1), (None, 2)]):
        with pytest.raises(Exception, match="a key of the summaries"):
            J.merge_summaries("k", a, frame(spark, bad, "m")).collect()
        with pytest.raises(Exception, match="a key of the summaries"):
            J.merge_summaries("k", frame(spark, bad, "m"), a).count()
    with pytest.raises(Exception, match="a key of the summaries"):
        J.merge_summaries("k", frame(spark, [("x", 1), (None, 2)], "n"), frame(spark, [("x", 1), (None, 2)], "m")).collect()


def test_digest_tells_nulls_and_columns(spark):
    of = lambda *rows: B.content_hash(spark.createDataFrame(rows, "a string, b string"))
    some = [of((None, "x")), of(("", "x")), of(("\x00", "x")), of(("x", None)), of(("x", "")), of(("x", "x")), of(("x", "x"), ("x", "x")), of(("ab", "c")), of(("a", "bc"))]
    assert len(set(some)) == len(some)
    assert of(("p", None), ("q", "r"), ("p", None)) == of(("q", "r"), ("p", None), ("p", None))


def test_one_writer_at_a_time(spark, tmp_path):
    root, df = f"file://{tmp_path}/builds", spark.range(3)
    seen = []

    def slow(rows, path):
        with pytest.raises(B.BuildError, match="being written"):
            B.commit(spark, rows, root, "one")
        seen.append(path)
        B.write_parquet(rows, path)

    assert spark.read.parquet(B.commit(spark, df, root, "one", slow)).count() == 3 and len(seen) == 1
    with pytest.raises(B.BuildError, match="exists"):
        B.commit(spark, df, root, "one")

    def fails(rows, path):
        B.write_parquet(rows, path)
        raise OSError("no room")

    with pytest.raises(OSError):
        B.commit(spark, df, root, "two", fails)
    assert spark.read.parquet(B.commit(spark, df, root, "two")).count() == 3  # neither claim nor leftovers are in the way
    assert not [p for p in (tmp_path / "builds" / ".tmp").iterdir() if not p.name.endswith(".crc")]
