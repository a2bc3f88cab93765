import datetime

from pyspark.sql import functions as F

from sedimenta.functions import scalars as S


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("x")).first().x


def test_trim_takes_unicode_space_and_separators(spark):
    assert one(spark, "　\x1f a  b\t", S.trim) == "a  b"
    assert one(spark, " 　", S.text_or_null) is None


def test_dates(spark):
    day = datetime.date(2020, 1, 3)
    for text in ("20200103", "2020-01-03", "2020/1/3", " 2020-1-3 "):
        assert one(spark, text, S.parse_date) == day
    for text in ("202011", "not-a-date", "2020-02-30", "20200230", "2020.01.03"):
        assert one(spark, text, S.parse_date) is None
        assert one(spark, text, S.date_quality) == "INVALID"
    assert one(spark, "   ", S.date_quality) == "MISSING"
    assert one(spark, None, S.date_quality) == "MISSING"
    assert one(spark, "2020/01/03", lambda c: S.date_quality(c, (S.COMPACT, S.DASHED))) == "INVALID"


def test_floats(spark):
    assert one(spark, " -1.25 ", S.parse_float) == -1.25
    assert one(spark, "1e3", S.parse_float) == 1000
    for text in ("not-a-coordinate", "NaN", "Infinity", "1_000", "1d", "1.5f", "１２", "1e999"):
        assert one(spark, text, S.parse_float) is None
        assert one(spark, text, S.float_is_bad)
    assert not one(spark, " ", S.float_is_bad)


def test_instants(spark):
    assert one(spark, "2026-09-06T16:00:00Z", lambda c: S.local_date(S.parse_instant(c))) == datetime.date(2026, 9, 7)
    assert one(spark, "2026-09-06T16:00:00", S.parse_instant) is None


def test_urls(spark):
    assert one(spark, "https://h/p?serviceKey=a&x=1#f", S.redact_url) == "https://h/p?serviceKey=REDACTED&x=1#f"
    assert one(spark, "https://u:p@h/", S.redact_url) is None
    allowed = lambda c: S.url_allowed(c, ["h.kr"])
    assert one(spark, "https://h.kr/a", allowed)
    for url in ("http://h.kr/a", "https://x.kr/a", "https://u@h.kr/a", "https://h.kr/error.html", "https://h.kr/error/1", None):
        assert not one(spark, url, allowed)


def test_keys_and_hashes(spark):
    df = spark.createDataFrame([(" a ", "b"), ("ab", ""), (None, "x")], "p string, q string")
    rows = df.select(S.composite_key(F.col("p"), F.col("q")).alias("k"), S.row_hash(F.col("p"), F.col("q")).alias("h")).collect()
    assert [r.k for r in rows] == ["a\x1fb", None, None]
    assert len({r.h for r in rows}) == 3
    assert S.name_hints(["permit_date", "좌표정보(X)", "x"])["coordinate"] == ["좌표정보(X)"]
    assert one(spark, 5, lambda c: S.percent(c, F.lit(0)), "int") is None
