"""Every query with an oracle, on the smallest tables, against DuckDB."""

import datetime
import os

import duckdb
import pytest

from sedimenta.plans.catalog import QUERIES, SQL, flagship

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages")
#: Queries whose oracle takes as given that the smallest tables are large enough; or that only the driver's scale exercises.
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    want = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    at = [want.columns.index(c) for c in df.columns]
    assert sorted(tuple(map(plain, r)) for r in df.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())


def test_flagship_has_rows(spark):
    assert flagship(spark, FOLDER).count() > 0
