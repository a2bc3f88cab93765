"""The paged source: planned from first pages, pruned by filters, strict about totals, and as a stream."""

import json

import pytest
from pyspark.sql import functions as F

from sedimenta.sources.history import PagedHistory
from sedimenta.sources.pages import PageError, land_pages, paged, parse_page

TASK = ["source_key", "base_date", "authority_code"]


class Counting:
    """A fetcher that notes what it was asked for."""

    def __init__(self, options):
        self.root, self.log = options["pages"], options["log"]

    def tasks(self):
        return [(s, d, a) for s in ("bars", "cafes") for d in ("20260101", "20260201", "20260301") for a in ("1", "2")]

    def fetch(self, source, date, authority, page):
        with open(self.log, "a") as log:
            log.write(f"{source} {date} {authority} {page}\n")
        total = int(authority) * 3
        ids = [{"id": f"{source}-{date}-{authority}-{i}"} for i in range(total)][(page - 1) * 2 : page * 2]
        return json.dumps({"response": {"body": {"pageNo": page, "numOfRows": 2, "totalCount": total, "items": {"item": ids}}}})


@pytest.fixture
def source(spark):
    spark.dataSource.register(PagedHistory)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def rows(spark, n=130):
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, "bars").otherwise("cafes").alias("source_key"), F.concat(F.lit("2026010"), (F.col("id") % 4 + 1).cast("string")).alias("base_date"), (F.col("id") % 2).cast("string").alias("authority_code"), "id")


def landed(spark, folder, size=7):
    land_pages(paged(rows(spark), TASK, "id", F.struct("id"), size), str(folder))
    return spark.read.format("paged_history").option("root", str(folder))


def ids(pages):
    return sorted(i["id"] for r in pages.collect() for i in json.loads(r.body)["response"]["body"]["items"]["item"])


def test_reads_what_was_landed(source, tmp_path):
    pages = landed(source, tmp_path / "a").load()
    assert ids(pages) == list(range(130))
    assert ids(landed(source, f"file://{tmp_path}/b").load().where("source_key = 'bars' AND base_date > '20260102'")) == [r.id for r in rows(source).where("source_key = 'bars' AND base_date > '20260102'").orderBy("id").collect()]


def test_filters_prune_before_fetching(source, tmp_path):
    log = tmp_path / "log"
    read = source.read.format("paged_history").option("fetcher", "tests.test_history:Counting").option("pages", "x").option("log", str(log)).load()
    got = read.where("source_key = 'cafes' AND base_date IN ('20260201', '20260301') AND authority_code <> '1'").collect()
    assert sorted((r.base_date, r.page) for r in got) == [(d, p) for d in ("20260201", "20260301") for p in (1, 2, 3)]
    asked = {tuple(line.split()) for line in log.read_text().splitlines()}
    assert {a[:2] for a in asked} == {("cafes", "20260201"), ("cafes", "20260301")}  # <> isn't pushed: its first pages are planned


def test_changes_fail_the_read(source, tmp_path):
    reader = landed(source, tmp_path / "h", 5)
    one = next((tmp_path / "h").glob("cafes/*/*/page-2.json"))
    good = json.loads(one.read_text())
    for change, message in (({"totalCount": 999}, "total went"), ({"items": {"item": [{"id": 1}]}}, "items instead"), ({"pageNo": 9}, "says that it is page")):
        bad = {"response": {"body": good["response"]["body"] | change}}
        one.write_text(json.dumps(bad))
        with pytest.raises(Exception, match=message):
            reader.load().collect()
    one.unlink()
    with pytest.raises(Exception, match="page-2"):
        reader.load().collect()
    one.write_text(json.dumps(good))
    assert reader.load().count() > 20
    with pytest.raises(Exception, match="more than 1"):
        reader.option("most_pages", "1").load().collect()


def test_page_shapes():
    body = lambda **b: json.dumps({"response": {"body": {"totalCount": 1, "numOfRows": 10} | b}})
    assert parse_page(body(items={"item": {"id": 1}})).rows == 1 and parse_page(body(items=None)).rows == 0 and parse_page(body(items="")).rows == 0
    for bad in ("[]", "{}", "nonsense", body(totalCount=-1), body(totalCount="many"), body(items={"item": 3})):
        with pytest.raises(PageError):
            parse_page(bad)
    with pytest.raises(PageError, match="answered 30"):
        parse_page(json.dumps({"response": {"header": {"resultCode": "30"}, "body": {}}}).replace("{}", '{"totalCount": 1, "numOfRows": 1}'))


def test_stream_by_observation_date(source, tmp_path):
    folder = tmp_path / "h"
    pages = paged(rows(source), TASK, "id", F.struct("id"), 7).cache()
    land_pages(pages.where("base_date <= '20260102'"), str(folder))

    def run():
        query = source.readStream.format("paged_history").option("root", str(folder)).load().writeStream.format("json").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination(120)
        assert query.exception() is None
        return ids(source.read.schema("body string").json(str(tmp_path / "out")))

    assert run() == [r.id for r in rows(source).where("base_date <= '20260102'").orderBy("id").collect()]
    land_pages(pages.where("base_date > '20260102'"), str(folder))
    assert run() == list(range(130))  # the first dates aren't read again


def test_partitions_grow_slower_than_pages(source, tmp_path):
    """A task of Spark reads many pages, in order, and each page is still held against its plan."""
    read = landed(source, tmp_path / "h", 1)
    few, many = (read.option("pages_a_partition", n).load() for n in (1, 256))
    assert few.rdd.getNumPartitions() == 130 and many.rdd.getNumPartitions() == 44  # three pages each
    assert ids(few) == ids(many) == list(range(130))
    (next((tmp_path / "h").glob("cafes/*/*/page-3.json"))).write_text('{"response": {"body": {"pageNo": 3, "numOfRows": 1, "totalCount": 9999, "items": {"item": [{"id": 1}]}}}}')
    with pytest.raises(Exception, match="page 3: the total went"):
        many.collect()
