"""Observation dates over the spans of a frame."""

from datetime import date

from pyspark.sql import functions as F

from sedimenta.operators import calendar as K
from sedimenta.operators import profile as P


def test_dates_of_spans(spark):
    rows = spark.createDataFrame([("a", date(2026, 1, 31)), ("a", date(2026, 3, 31)), ("a", None), ("b", date(2026, 5, 5)), ("c", None)], "k string, d date")
    found = K.spans(rows, ["k"], "d")
    assert sorted(map(tuple, found.collect())) == [("a", date(2026, 1, 31), date(2026, 3, 31)), ("b", date(2026, 5, 5), date(2026, 5, 5))]
    assert sorted(map(tuple, K.monthly_of(found, ["k"]).collect())) == [("a", date(2026, 1, 31)), ("a", date(2026, 2, 28)), ("a", date(2026, 3, 31)), ("b", date(2026, 5, 5))]
    assert [r.observed_date.day for r in K.stepped_of(found.where("k = 'a'"), 30).orderBy("observed_date").collect()] == [31, 2, 31]
    cost = {(r.k, r.scenario): r for r in K.scenarios_of(found, "2026-02-15", {"before": (1, 2), "after": (10, 20)}, ["k"]).collect()}
    assert (cost["a", "MONTHLY"].dates, cost["a", "MONTHLY"].dates_before, cost["a", "MONTHLY"].max_gap_days, cost["a", "MONTHLY"].requests_most) == (3, 1, 31, 42)
    assert (cost["b", "DAILY"].dates, cost["b", "DAILY"].max_gap_days, cost["b", "ENDPOINTS"].dates) == (1, 0, 1)
    assert (cost["a", "DAILY"].dates, cost["a", "DAILY"].max_gap_days) == (60, 1)
    assert K.monthly_dates(spark, "2026-03-01", "2026-01-01").count() == 0
    assert K.monthly_of(K.spans(rows.limit(0), ["k"], "d"), ["k"]).count() == 0


def test_filled_columns(spark):
    rows = spark.createDataFrame([("s", " ", 1), ("s", None, 2), ("t", "x", None)], "src string, a string, b int")
    assert sorted(map(tuple, P.filled_columns(rows, F.col("src"), ["a", "b"]).collect())) == [("s", "b"), ("t", "a")]
