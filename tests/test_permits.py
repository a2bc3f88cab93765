"""Source rows to parent, sidecar and episodes, and their contracts."""

import datetime

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import permits as P
from sedimenta.operators.contract import Contract, ContractError
from sedimenta.operators.episodes import episodes

DIGEST = "0a" * 32
AT = P.Lineage("bakeries", DIGEST, "2026-09-07T10:30:00+09:00")
WHOLE = {"개방자치단체코드": " 0300000 ", "관리번호": "0300-1", "인허가일자": "20200131", "폐업일자": "", "영업상태코드": "01", "좌표정보(X)": "200000.5", "좌표정보(Y)": "500000", "전화번호": "02-1", "사업장명": "　Bread ", "소재지우편번호": "00123"}


def source(spark, *rows, **more):
    names = ("source_row_number", *P.SOURCE_COLUMNS)
    kinds = ", ".join(f"`{n}` {'bigint' if n == 'source_row_number' else 'string'}" for n in names)
    data = [tuple({"source_row_number": i, **WHOLE, **r}.get(n) for n in names) for i, r in enumerate(rows, 1)]
    return spark.createDataFrame(data, kinds)


def test_a_row_of_39_columns_becomes_one_of_26(spark):
    parent = P.parent_rows(source(spark, {}), AT)
    assert len(P.SOURCE_COLUMNS) == len(set(P.SOURCE_COLUMNS)) == 39 and len(parent.columns) == 26
    row = P.PARENT.require(parent).first()
    assert (row.source_key, row.authority_code, row.management_number, row.business_name, row.lot_postal_code) == ("bakeries", "0300000", "0300-1", "Bread", "00123")
    assert (row.permit_date, row.permit_date_quality, row.closure_date, row.closure_date_quality) == (datetime.date(2020, 1, 31), "VALID", None, "MISSING")
    assert (row.source_coordinate_x, row.source_coordinate_y, row.source_artifact_sha256) == (200000.5, 500000.0, DIGEST)
    assert parent.select(F.unix_timestamp("source_retrieved_at_utc")).first()[0] == int(datetime.datetime(2026, 9, 7, 1, 30, tzinfo=datetime.timezone.utc).timestamp())


def test_odd_values(spark):
    rows = P.parent_rows(source(spark, {"인허가일자": "2020-02-30", "폐업일자": None}, {"인허가일자": " 2020/1/2 ", "영업상태명": "   "}), AT).orderBy("source_row_number").collect()
    assert [(r.permit_date, r.permit_date_quality) for r in rows] == [(None, "INVALID"), (datetime.date(2020, 1, 2), "VALID")]
    assert rows[1].source_status_name is None
    assert P.parent_rows(source(spark), AT).count() == 0


@pytest.mark.parametrize("damage, why", [({"관리번호": " "}, "management_number is blank"), ({"개방자치단체코드": None}, "authority_code is blank"), ({"좌표정보(X)": "east"}, "source_coordinate_x"), ({"좌표정보(Y)": "inf"}, "source_coordinate_y")])
def test_what_the_parent_cannot_hold(spark, damage, why):
    df = source(spark, {}, damage)
    with pytest.raises(Exception, match=why):
        P.parent_rows(df, AT).collect()
    assert [r.source_row_number for r in P.parent_rows(df, AT, faulty="drop").collect()] == [1]
    assert P.parent_rows(df, AT, faulty="null").count() == 2
    (bad,) = P.rejected_rows(df).collect()
    assert bad.source_row_number == 2 and len(bad.reasons) == 1 and why in bad.reasons[0]


def test_shape_and_lineage(spark):
    df = source(spark, {})
    for wrong in (df.drop("홈페이지"), df.withColumn("more", F.lit(1)), df.drop("source_row_number")):
        with pytest.raises(P.PermitError, match="missing"):
            P.parent_rows(wrong, AT)
    P.parent_rows(df.select(*reversed(df.columns)), AT)
    for lineage in (P.Lineage("bakeries", "A" * 64, AT.retrieved_at), P.Lineage("bakeries", DIGEST, "2026-09-07T10:30:00"), P.Lineage("bakeries", DIGEST, "yesterday"), P.Lineage("bakeries", DIGEST, datetime.datetime(2026, 9, 7))):
        with pytest.raises(P.PermitError):
            P.parent_rows(df, lineage)
    with pytest.raises(Exception, match="below 1"):
        P.parent_rows(df.withColumn("source_row_number", F.lit(0)), AT).collect()
    with pytest.raises(Exception, match="lineage is incomplete"):
        P.parent_rows(df, P.Lineage("bakeries", F.lit("00"), AT.retrieved_at)).collect()


def test_repeated_numbers_raise(spark):
    once = P.parent_rows(source(spark, {}, {"관리번호": "0300-2"}), AT)
    assert P.require_one_each(once).count() == 2
    assert P.require_one_each(P.parent_rows(source(spark), AT)).count() == 0
    with pytest.raises(Exception, match="repeated management number"):
        P.require_one_each(P.parent_rows(source(spark, {}, {"관리번호": " 0300-1"}), AT)).collect()


def test_sidecar_and_episodes_keep_their_contracts(spark):
    parent = P.parent_rows(source(spark, {}, {"관리번호": "2", "좌표정보(X)": "", "좌표정보(Y)": ""}), AT)
    side = P.SIDECAR.require(P.sidecar_rows(parent, "b1"))
    assert len(side.columns) == 7 and [r.coordinate_quality for r in side.orderBy("source_row_number").collect()] == ["TRANSFORMED", "MISSING_SOURCE_COORDINATES"]
    day = datetime.date(2026, 1, 1)
    seen = spark.createDataFrame([("bakeries", "1", day, "01", None, None, None, None, "MISSING"), ("bakeries", "1", day + datetime.timedelta(9), "03", None, None, None, day, "VALID")],
        "source_key string, management_number string, observed_date date, source_status_code string, source_status_name string, source_detail_status_code string, source_detail_status_name string, source_closure_date date, source_closure_date_quality string")
    runs = P.EPISODE.require(P.conform(episodes(seen, "2026-01-01", "2026-12-31"), P.EPISODE))
    assert len(runs.columns) == 23 and runs.count() == 2
    with pytest.raises(ContractError):
        P.EPISODE.require(runs.withColumn("observation_count", F.lit(0)))
    with pytest.raises(ContractError):
        P.SIDECAR.require(side.withColumn("wgs84_latitude", F.lit(3.0)))
    with pytest.raises(ContractError, match="missing"):
        P.conform(side.drop("management_number"), P.SIDECAR)
    for contract in (P.PARENT, P.SIDECAR, P.EPISODE):
        assert Contract.from_json(contract.to_json()) == contract
