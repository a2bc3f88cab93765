import datetime
import random

import pytest
from pyspark.sql import functions as F

from sedimenta.operators import build as B
from sedimenta.operators import calendar as K
from sedimenta.operators import cells as C
from sedimenta.operators import contract as T
from sedimenta.operators import diff as D
from sedimenta.operators import episodes as E
from sedimenta.operators import geo as G
from sedimenta.operators import joins as J
from sedimenta.operators import profile as P
from sedimenta.operators import windows as W

D_ = datetime.date
OBS = "source_key string, management_number string, observed_date date, source_status_code string, source_status_name string, source_detail_status_code string, source_detail_status_name string, source_closure_date date, source_closure_date_quality string"


def obs(spark, rows):
    return spark.createDataFrame([("s", m, d, c, None, None, None, x, "VALID" if x else "MISSING") for m, d, c, x in rows], OBS)


def test_episode_coalesces_and_censors(spark):
    df = obs(spark, [("1", D_(2026, 1, 1), "01", None), ("1", D_(2026, 1, 5), "01", D_(2026, 1, 4))])
    e = E.episodes(E.require_observations(df, "2026-01-01", "2026-01-31"), "2026-01-01", "2026-01-31").first()
    assert (e.observation_count, e.start_censoring, e.end_censoring, e.right_censored) == (2, "LEFT_CENSORED", "RIGHT_CENSORED", True)
    assert (e.source_closure_date_first_observed, e.source_closure_date_first_quality) == (None, "MISSING")
    assert (e.source_closure_date_last_observed, e.source_closure_date_last_quality) == (D_(2026, 1, 4), "VALID")


def test_episode_reversal_return_and_order(spark):
    rows = [("1", D_(2026, 3, 16), "03", None), ("1", D_(2026, 3, 17), "01", None), ("2", D_(2026, 1, 1), "01", None), ("2", D_(2026, 2, 1), "03", None), ("2", D_(2026, 3, 1), "01", None), ("3", D_(2026, 1, 1), None, None), ("3", D_(2026, 1, 2), None, None), ("4", D_(2026, 1, 1), "05", None)]
    want = sorted(map(tuple, E.episodes(obs(spark, rows), "2026-01-01", "2026-12-31").collect()), key=str)
    random.Random(1).shuffle(rows)
    got = E.episodes(obs(spark, rows), "2026-01-01", "2026-12-31")
    assert sorted(map(tuple, got.collect()), key=str) == want
    by = {(r.management_number, r.episode_number): r for r in got.collect()}
    assert (by["1", 1].end_boundary_lower_date, by["1", 1].end_boundary_upper_date) == (D_(2026, 3, 16), D_(2026, 3, 17))
    assert by["1", 2].start_boundary_lower_date == D_(2026, 3, 16) and by["1", 2].right_censored
    assert len([k for k in by if k[0] == "2"]) == 3 and len([k for k in by if k[0] == "3"]) == 1
    assert by["4", 1].source_status_code == "05"
    assert len(got.columns) == 23
    assert E.verify_episodes(got).where("violations > 0").count() == 0
    broken = got.withColumn("end_boundary_upper_date", F.lit(None).cast("date"))
    assert E.verify_episodes(broken).where("violations > 0").count() > 0
    turn = E.first_reversal(obs(spark, rows), "03", "01").orderBy("management_number").collect()
    assert [(r.management_number, r.last_before_date) for r in turn] == [("1", D_(2026, 3, 16)), ("2", D_(2026, 2, 1))]


@pytest.mark.parametrize("rows", [[("1", D_(2026, 1, 1), "01", None)] * 2, [("1", D_(2027, 1, 1), "01", None)]])
def test_episode_gates(spark, rows):
    with pytest.raises(E.EpisodeError):
        E.require_observations(obs(spark, rows), "2026-01-01", "2026-12-31")
    with pytest.raises(E.EpisodeError):
        E.require_observations(obs(spark, [("1", D_(2026, 1, 1), "01", None)]), "2026-01-01", "2026-12-31", most=0)


SNAP = "id string, status_code string, detail_code string, closure_date string, permit_date string, business_name string, road_address string, x string"


def snap(spark, rows):
    return spark.createDataFrame([(i, s, None, c, "p", n, None, None) for i, s, c, n in rows], SNAP)


def audit(spark, a, b):
    return D.pair_audit(D.paired(snap(spark, a), snap(spark, b), "id", [c for c in snap(spark, a).columns if c != "id"])).first()


def test_diff_goldens(spark):
    mixed = audit(spark, [("A", "1", "", "n"), ("B", "1", "", "n")], [("A", "3", "", "o"), ("C", "1", "", "n")])
    assert (mixed.common_ids, mixed.added_ids, mixed.disappeared_ids, mixed.status_changes, mixed.business_name_changes, mixed.permit_date_changes) == (1, 1, 1, 1, 1, 0)
    assert (mixed.continuity, mixed.lifecycle_signal, mixed.codes_added) == ("MIXED", "AMBIGUOUS", ["3"])
    back = audit(spark, [("A", "03", "20250101", "n")], [("A", "01", "", "n")])
    assert (back.lifecycle_signal, back.reverse_total, back["reverse_closure_value_to_blank"]) == ("REVERSIBLE_OR_CORRECTION_SIGNAL", 1, 1)
    assert audit(spark, [("A", "01", "", "n")], [("A", "01", "", "n")]).lifecycle_signal == "INSUFFICIENT_EVENT_EVIDENCE"
    strong = audit(spark, [("A", "01", "", "n")], [("A", "03", "20260401", "n"), ("B", "01", "", "n")])
    assert (strong.continuity, strong.lifecycle_signal, strong.status_and_closure_changed) == ("STRONG", "USABLE_FOR_FURTHER_AUDIT", 1)


def test_null_is_not_empty(spark):
    pairs = D.paired(snap(spark, [("A", None, None, "n")]), snap(spark, [("A", "", "", "n")]), "id", ["status_code", "closure_date"])
    groups = {"status": ("status_code",), "closure_date": ("closure_date",)}
    assert {r.field_group: r.changed_rows for r in D.field_changes(pairs, groups).collect()} == {"status": 1, "closure_date": 1}
    assert D.transitions(pairs).first().transition == "->"


def test_cells_golden(spark):
    rows = [(s, "01", None) for s in "abc" for _ in range(11)] + [(s, "03", 2021) for s in "abc"]
    df = spark.createDataFrame(rows, "s string, code string, y int")
    assert [r.cell_count for r in C.k_anonymous_cells(df, ["s", "code", "y"]).collect()] == [11, 11, 11]
    t = C.suppression(df, ["s", "code", "y"]).first()
    assert (t.cells_total, t.cells_released, t.rows_released, t.rows_suppressed) == (6, 3, 33, 3)
    assert C.page_cost(df, "s", 10).first().pages == 6


def test_profile_goldens(spark):
    df = spark.createDataFrame([("a",), (" ",), ("",), (None,), ("bb",)], "v string")
    r = P.column_profile(df).first()
    assert (r.row_count, r.null_count, r.blank_count, r.whitespace_count, r.filled_count, r.max_length) == (5, 1, 1, 1, 2, 2)
    d = P.capped_distinct(spark.createDataFrame([("a",), ("b",), ("c",)], "v string"), ["v"], 2).first()
    assert (d.distinct_count, d.is_exact) == (2, False)
    with pytest.raises(P.DuplicateKeyError) as error:
        P.require_unique(spark.createDataFrame([("secret",)] * 2, "k string"), F.col("k"))
    assert "secret" not in str(error.value)
    assert P.column_profile(df.limit(0)).count() == 1
    o = P.key_overlap(spark.createDataFrame([("a", "1", "x"), ("b", "1", "x"), ("a", "2", "x"), ("b", "2", "y"), ("a", "3", "z")], "s string, k string, c string"), "s", F.col("k"), F.col("c")).first()
    assert (o.shared_keys, o.same_context, o.conflicting_context) == (2, 1, 1)


def test_scales(spark):
    df = spark.createDataFrame([(str(i), i) for i in range(1, 11)], "code string, total int")
    assert {r.label: r.total for r in W.quantile_rows(df, "total", "code").collect()} == {"q10": 2, "q50": 5, "q90": 9, "max": 10}
    src = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "2"), ("c", "2"), ("a", "3"), ("b", "3")], "s string, k string")
    assert [(r.k, r.total_rows) for r in J.in_all_sources(src, "s", "k").collect()] == [("2", 3)]


def test_calendar(spark):
    assert K.monthly_dates(spark, "2026-01-01", "2026-09-06").count() == 10
    assert K.stepped_dates(spark, "2026-01-01", "2026-09-06", 7).count() == 37
    assert K.stepped_dates(spark, "2026-01-01", "2026-09-06", 1).count() == 249
    assert sorted(r[0] for r in K.monthly_dates(spark, "2026-01-31", "2026-03-31").collect()) == [D_(2026, 1, 31), D_(2026, 2, 28), D_(2026, 3, 31)]
    with pytest.raises(K.PlanError):
        K.stepped_dates(spark, "2026-01-01", "2026-01-02", 0)
    plan = spark.createDataFrame([("1", 101, [D_(2026, 1, 1)]), ("2", 100, [D_(2026, 1, 1)])], "code string, n int, dates array<date>")
    assert K.expand_plan(plan, "code", "n", "dates", 100, 3).agg(F.sum("pages")).first()[0] == 3
    with pytest.raises(K.PlanError):
        K.expand_plan(plan, "code", "n", "dates", 100, 4)


def test_domain(spark):
    code = lambda *x: spark.createDataFrame([(v,) for v in x], "code string")
    J.check_domain(code("a", "b"), code("b"), code("z"), "code")
    for args in ((code("a"), code("b"), code("z")), (code("a"), code("a"), code("a"))):
        with pytest.raises(J.DomainError):
            J.check_domain(*args, "code")
    domain = J.effective_domain(code("a", "b"), code("b"), code("z"), "code", "2026-07-01")
    days = spark.createDataFrame([(D_(2026, 6, 30),), (D_(2026, 7, 1),)], "d date")
    assert sorted((r.d.day, r.code) for r in J.active_at(days, "d", domain).collect()) == [(1, "a"), (1, "b"), (30, "a"), (30, "z")]
    with pytest.raises(J.DomainError):
        J.pending(days, days.unionByName(days), ["d"])


def test_geography(spark):
    df = spark.createDataFrame([(200000.0, 500000.0, "서울특별시 중구"), (None, None, "x")], "x double, y double, a string")
    rows = G.with_geographic(df, "x", "y").collect()
    assert abs(rows[0].wgs84_longitude - 127.0) < 0.01 and abs(rows[0].wgs84_latitude - 38.0) < 0.01
    assert rows[1].coordinate_quality == "MISSING_SOURCE_COORDINATES" and rows[1].wgs84_latitude is None
    probe = G.axis_probe(df, "x", "y", "a").first()
    assert (probe.sampled, probe.eligible, probe.xy_region, probe.yx_region) == (1, 1, 1, 0)
    for bad in ([(1.0, None)], [(99999999.0, 99999999.0)]):
        with pytest.raises(Exception, match="coordinates"):
            G.with_geographic(spark.createDataFrame(bad, "x double, y double"), "x", "y").collect()


CONTRACT = T.Contract("t", (T.ColumnRule("k", "bigint", False), T.ColumnRule("q", "string", True, ("A", "B"))), (T.Invariant("positive", "k > 0"),), ("flag",))


def test_contract_and_build(spark, tmp_path):
    good = spark.createDataFrame([(1, "A"), (2, None)], "k bigint, q string")
    assert T.Contract.from_json(CONTRACT.to_json()) == CONTRACT
    for bad in (good.withColumn("flag", F.lit(1)), good.select("q", "k"), good.withColumn("q", F.lit("Z")), good.withColumn("k", -F.col("k"))):
        with pytest.raises(T.ContractError):
            CONTRACT.require(bad)
    root = f"file://{tmp_path}/builds"
    assert B.plan(good, CONTRACT, root, ["in"])["shape_errors"] == []
    manifest = B.materialise(spark, good, CONTRACT, root, ["in"])
    assert B.verify(spark, manifest, CONTRACT)["status"] == "PASS"
    with pytest.raises(B.BuildError):
        B.materialise(spark, good, CONTRACT, root, ["in"])
    with pytest.raises(B.BuildError):
        B.verify(spark, manifest | {"rows": 3}, CONTRACT)
    assert B.content_hash(good) == B.content_hash(good.orderBy(F.desc("k"))) != B.content_hash(good.unionByName(good))
    assert T.check_rules({"a": {"b": 1, "c": 2, "t": 3}}, [("a.b", "eq", 1), ("a.t", "sum_of", ["a.b", "a.c"]), ("a.z", "ge", 0)]) == ["a.z ge 0 fails"]
    assert T.readiness({"x": True, "y": None}) == ("UNDECIDED", ["y"])
    with pytest.raises(B.BuildError):
        B.package(tmp_path / "p", {"README.md": B.data_dictionary(CONTRACT), "x.txt": ""}, ["README.md"])
    with pytest.raises(B.BuildError):
        B.contained(tmp_path / ".." / "x", tmp_path)
