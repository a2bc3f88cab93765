"""All fields of the change groups, repeated ids, and the roll-up of pair audits."""

import pytest

from sedimenta.operators import diff as D

COLUMNS = ("area", "id", *D.FIELDS)


def snapshot(spark, *rows):
    """Rows of (area, id, changes of the fields)."""
    return spark.createDataFrame([(area, i, *[more.get(f, "01" if f == "status_code" else "same") for f in D.FIELDS]) for area, i, more in rows], ", ".join(f"{c} string" for c in COLUMNS))


def audits(spark, a, b):
    a, b = snapshot(spark, *a), snapshot(spark, *b)
    firsts = [D.first_of_each(x, "id") for x in (a, b)]
    return D.pair_audit(D.paired(*firsts, "id", D.FIELDS, ["area"]), ["area"], D.repeated_ids(a, b, "id", ["area"]))


@pytest.mark.parametrize("field", D.FIELDS)
def test_each_field_counts_for_its_group(spark, field):
    pairs = D.paired(snapshot(spark, ("a", "1", {})), snapshot(spark, ("a", "1", {field: "other"})), "id", D.FIELDS)
    found = {r.field_group: r.changed_rows for r in D.field_changes(pairs).collect()}
    assert len(D.FIELDS) == 11 and found == {g: int(field in fields) for g, fields in D.GROUPS.items()}


def test_standard_groups_need_a_field_each(spark):
    with pytest.raises(D.DiffError, match="coordinates"):
        D.field_changes(D.paired(snapshot(spark), snapshot(spark), "id", D.FIELDS[:-2]))


def test_repeated_ids(spark):
    a, b = snapshot(spark, ("a", "1", {}), ("a", "1", {}), ("a", "1", {}), ("b", "2", {})), snapshot(spark, ("a", "1", {}), ("b", "3", {}), ("b", "3", {}))
    assert {(r.area, r.repeated_a, r.repeated_b, r.repeated_ids) for r in D.repeated_ids(a, b, "id", ["area"]).collect()} == {("a", 2, 0, 2), ("b", 0, 1, 1)}
    assert D.repeated_ids(snapshot(spark), snapshot(spark), "id").first().repeated_ids == 0


def test_roll_up_adds_all_counters(spark):
    start = [("a", "1", {}), ("a", "2", {"status_code": "03"}), ("b", "3", {}), ("b", "3", {}), ("b", "4", {})]
    end = [("a", "1", {"status_code": "03", "closure_date": "x"}), ("a", "2", {"closure_date": "", "y": "9", "lot_address": "9", "business_name": "9"}), ("b", "3", {}), ("c", "5", {})]
    found = audits(spark, start, end)
    total = D.roll_up(found, ["area"]).first()
    assert (total.pairs, total.start_ids, total.end_ids, total.common_ids, total.added_ids, total.disappeared_ids, total.repeated_ids) == (3, 4, 4, 3, 1, 1, 1)
    assert (total.status_changes, total.closure_date_changes, total.address_changes, total.coordinates_changes) == (2, 2, 1, 1)
    assert (total.status_and_closure_changed, total.simultaneous_identity_changes, total.reverse_total, total.reverse_closure_value_to_blank, total.reverse_all_three_changed) == (2, 1, 1, 1, 1)
    assert (total.pairs_strong, total.pairs_mixed, total.pairs_weak) == (2, 0, 1)
    assert (total.pairs_reversible, total.pairs_without_events, total.sample_continuity, total.sample_signal) == (1, 2, "MIXED_SAMPLE", "REVERSIBLE_OR_CORRECTION_SIGNAL_PRESENT")
    rows = found.collect()
    for name in D.totals_of():
        assert total[name] == sum(r[name] for r in rows), name


def test_roll_up_of_twice_the_same_pair_or_none(spark):
    one = audits(spark, [("a", "1", {})], [("a", "1", {})])
    for wrong in (one.union(one), one.where("area = 'z'")):
        with pytest.raises(Exception, match="one audit for each pair"):
            D.roll_up(wrong, ["area"]).collect()


def test_count_given_twice(spark):
    counts = [("k", "t0", 1), ("k", "t1", 2), ("k", "t2", 2), ("k", "t3", 2)]
    good = D.count_freeze(spark.createDataFrame(counts, "k string, m string, n long"), ["k"], "m", "n", ["t0", "t1", "t2", "t3"]).first()
    assert (good.pairs, good.grown_pairs, good.frozen_pairs) == (1, 1, 1)
    with pytest.raises(Exception, match="given twice"):
        D.count_freeze(spark.createDataFrame([*counts, counts[0]], "k string, m string, n long"), ["k"], "m", "n", ["t0", "t1", "t2", "t3"]).collect()
