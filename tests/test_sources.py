import io

import pytest

from sedimenta.operators.episodes import episodes
from sedimenta.sources import landing as L
from sedimenta.sources import snapshots as S
from sedimenta.sources.history import PagedHistory
from sedimenta.streaming.ingest import follow_episodes, windowed_counts


def put(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return f"file://{path}"


def test_csv_is_strict(spark, tmp_path):
    path = put(tmp_path / "a.csv", '이름,주소\n"가 ""나""",\n다,"x\ny"\n', "cp949")
    assert S.detect_encoding("가나".encode("cp949")) == ("cp949", True)
    assert S.detect_encoding(b"\xef\xbb\xbfa") == ("utf-8-sig", False)
    rows = S.read_csv(spark, path, ["이름", "주소"]).collect()
    assert [tuple(r) for r in rows] == [('가 "나"', ""), ("다", "x\ny")]
    with pytest.raises(S.SourceError):
        S.read_csv(spark, path, ["이름"])
    with pytest.raises(S.SourceError):
        S.read_csv(spark, put(tmp_path / "d.csv", "a,a\n1,2\n"))
    with pytest.raises(Exception, match="(?i)malformed"):
        S.read_csv(spark, put(tmp_path / "r.csv", "a,b\n1,2\n3\n")).collect()
    numbered = S.with_row_number(S.read_csv(spark, put(tmp_path / "n.csv", "a;b\n1;2\n3;4\n"))).collect()
    assert [(r.a, r.source_row_number) for r in numbered] == [("1", 1), ("3", 2)]


def test_json_pages(spark, tmp_path):
    body = '{"response":{"body":{"totalCount":3,"items":{"item":%s}}}}'
    pages = spark.createDataFrame([(body % '[{"id":"1"},{"id":"2"}]',), (body % '{"id":"3"}',), (body % "null",)], "body string")
    assert sorted(r.id for r in S.json_items(pages, "body", "id string").collect()) == ["1", "2", "3"]
    t = S.page_totals(pages, "body").first()
    assert (t.pages, t.rows, t.least_total) == (3, 3, 3)
    with pytest.raises(Exception, match="neither"):
        S.json_items(spark.createDataFrame([(body % '"x"',)], "body string"), "body", "id string").collect()
    folder = tmp_path / "h" / "cafes" / "20260101" / "3000000"
    folder.mkdir(parents=True)
    for n in (1, 2):
        (folder / f"page-{n}.json").write_text(body % f'{{"id":"{n}"}}')
    spark.dataSource.register(PagedHistory)
    read = spark.read.format("paged_history").option("root", str(tmp_path / "h")).load()
    assert sorted((r.source_key, r.page) for r in read.collect()) == [("cafes", 1), ("cafes", 2)]


def test_landing(tmp_path):
    assert L.land(io.BytesIO(b"abc"), tmp_path / "f", 3)["bytes"] == 3
    for data, options in ((b"", {}), (b"abc", {"expected_length": 4}), (b"abc", {"most": 2}), (b"<html>", {})):
        with pytest.raises(L.LandingError):
            L.land(io.BytesIO(data), tmp_path / "g", **options)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["f"]
    with pytest.raises(L.LandingError):
        L.require_room(tmp_path, 10, 5, free=lambda p: 14)
    waits, tries = [], []

    def flaky(n):
        tries.append(n)
        if n < 3:
            raise OSError
        return n

    assert L.with_retries(flaky, sleep=waits.append) == 3 and waits == [0.5, 1.0]
    made = []
    tasks = [{"n": i} for i in range(4)]
    assert L.run_resumable(tasks, lambda t: t["n"] == 0, made.append)["left"] == 3 and not made
    assert L.run_resumable(tasks, lambda t: t["n"] == 0, made.append, execute=True, most=2) == {"planned": 4, "skipped": 1, "made": 2, "left": 1, "executed": True}


def test_streams(spark, tmp_path):
    from tests.test_operators import D_, obs

    inbox = f"file://{tmp_path}/in"
    first = obs(spark, [("1", D_(2026, 1, 1), "01", None), ("2", D_(2026, 1, 1), "01", None)])
    first.coalesce(1).write.parquet(inbox)
    got = {}
    publish = lambda df, n: got.update({(r.management_number, r.episode_number): r.observation_count for r in df.collect()})

    def run():
        stream = spark.readStream.schema(first.schema).parquet(inbox)
        follow_episodes(stream, f"file://{tmp_path}/store", f"file://{tmp_path}/cp", "2026-01-01", "2026-12-31", publish).awaitTermination(120)

    run()
    second = obs(spark, [("1", D_(2026, 1, 2), "01", None), ("1", D_(2026, 1, 3), "03", None), ("1", D_(2026, 1, 1), "01", None)])
    second.coalesce(1).write.mode("append").parquet(inbox)
    run()
    assert got == {("1", 1): 2, ("1", 2): 1, ("2", 1): 1}
    everything = spark.read.parquet(f"file://{tmp_path}/store")
    assert episodes(everything, "2026-01-01", "2026-12-31").count() == 3
    events = spark.readStream.schema(first.schema).parquet(inbox)
    query = windowed_counts(events.withColumn("t", events.observed_date.cast("timestamp")), "t", ["management_number"]).writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert spark.sql("SELECT sum(n) AS n FROM counts").first().n == 5


def test_pages_of_a_task_must_be_whole(spark):
    body = '{"response":{"header":{"resultCode":"00"},"body":{"totalCount":%s,"items":{"item":%s}}}}'
    good = [("a", 1, body % (3, '[{"id":"1"},{"id":"2"}]')), ("a", 2, body % (3, '{"id":"3"}')), ("b", 1, body % (0, "null"))]
    schema = "task string, page int, body string"
    found = S.require_whole(spark.createDataFrame(good, schema), "body", ["task"], most_pages=2)
    assert sorted(map(tuple, found.collect())) == [("a", 2, 3, 3), ("b", 1, 0, 0)]
    probe = S.page_counts(spark.createDataFrame([("a", 1, body % (3, '[{"id":"1"}]')), ("a", 1, "no json")], schema), "body").collect()
    assert [(r.result_code, r.total_count, r.page_rows) for r in probe] == [("00", 3, 1), (None, None, 0)]
    bad = [
        good[:1],  # rows are missing
        [good[0], ("a", 2, body % (4, '{"id":"3"}'))],  # the total changes
        [good[0], ("a", 3, good[1][2])],  # a page is missing
        [("c", 1, "no json")],
    ]
    for rows in bad:
        with pytest.raises(S.SourceError, match="whole"):
            S.require_whole(spark.createDataFrame(rows, schema), "body", ["task"])
    with pytest.raises(S.SourceError, match="whole"):
        S.require_whole(spark.createDataFrame(good, schema), "body", ["task"], most_pages=1)


def test_reference_codes(spark):
    df = spark.createDataFrame([("11", "NEW"), ("12", None), ("X", "DELETED"), (None, None)], "code string, change string")
    assert [tuple(r) for r in S.reference_codes(df, "code", "change").collect()] == [("11", True, True, True), ("12", True, True, False), ("X", False, False, False), (None, True, False, False)]
