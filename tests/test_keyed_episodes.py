"""Episodes by keyed state against the batch operator: any order of batches, repeated ones, conflicts of a day, and the end of the window."""

import itertools
import random

import pandas as pd
import pytest

from sedimenta.operators.episodes import episodes
from sedimenta.streaming import keyed as K
from tests.test_operators import D_, obs


def test_packed_days_come_back():
    days = {0: ("01", None), 7: ("01", None), 8: ("03", "x"), 4000: ("01", None)}
    seen, runs = K.pack(days)
    assert K.unpack(seen, runs) == days and len(seen) < 600
    assert K.runs_of(days) == [[0, 7, 2, ("01", None)], [8, 8, 1, ("03", "x")], [4000, 4000, 1, ("01", None)]]
    drawn = random.Random(5)
    for _ in range(50):
        days = {drawn.randrange(400): (drawn.choice("abc"),) for _ in range(drawn.randrange(1, 60))}
        assert K.unpack(*K.pack(days)) == days
        assert [n for _, _, n, _ in K.runs_of(days)] == [len(list(g)) for _, g in itertools.groupby(days[d] for d in sorted(days))]


def follow(spark, folder, batches, start="2026-01-01", end="2026-12-31", keep_days=30):
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(batch.schema).parquet(f"{folder}/in")
        K.follow_keyed_episodes(stream, f"{folder}/state", start, end, K.publisher(f"{folder}/out"), keep_days).awaitTermination()
    return K.published(spark, f"{folder}/out")


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def test_scattered_and_repeated_batches(spark, tmp_path):
    drawn = random.Random(3)
    every = [(str(k), D_(2026, 1 + d // 28, 1 + d % 28), drawn.choice(["01", "03", None]), drawn.choice([None, D_(2026, 1, 5)])) for k in range(12) for d in drawn.sample(range(140), 25)]
    drawn.shuffle(every)
    parts = [every[0::3], every[1::3] + every[0:40], every[2::3]]
    got = follow(spark, f"file://{tmp_path}", [obs(spark, p) for p in parts])
    want = episodes(obs(spark, every), "2026-01-01", "2026-12-31")
    assert got.columns == want.columns and rows(got) == rows(want)


def test_conflicts_outsiders_and_nulls(spark, tmp_path):
    one = [("1", D_(2026, 1, 1), "03", None), ("1", D_(2026, 1, 2), "03", None), ("2", D_(2025, 12, 31), "01", None), ("3", None, "01", None), (None, D_(2026, 1, 1), "01", None)]
    two = [("1", D_(2026, 1, 2), "01", None), ("1", D_(2026, 1, 2), "09", None)]
    kept = obs(spark, [one[0], two[0]])
    want = rows(episodes(kept, "2026-01-01", "2026-12-31"))
    assert rows(follow(spark, f"file://{tmp_path}/a", [obs(spark, one), obs(spark, two)])) == want
    assert rows(follow(spark, f"file://{tmp_path}/b", [obs(spark, two), obs(spark, one)])) == want


def test_state_ends_after_the_window(spark, tmp_path):
    inside, beyond = [("1", D_(2026, 1, 1), "01", None)], [("9", D_(2026, 3, 1), "01", None)]
    late = [("1", D_(2026, 1, 9), "03", None)]
    got = follow(spark, f"file://{tmp_path}", [obs(spark, b) for b in (inside, beyond, late)], end="2026-01-10", keep_days=20)
    assert [(r.management_number, r.episode_number, r.observation_count) for r in got.collect()] == [("1", 1, 1)]
    spark.conf.set(K.PROVIDER, K.ROCKS)
    try:
        left = spark.read.format("statestore").option("path", f"file://{tmp_path}/state").option("stateVarName", "runs").load()
        assert left.count() == 0
    finally:
        spark.conf.unset(K.PROVIDER)
    with pytest.raises(ValueError, match="window"):
        follow(spark, f"file://{tmp_path}", [obs(spark, inside)], end="2025-01-01")


class Bucket:
    """The state of one bucket, and what is asked of it."""

    def __init__(self):
        self.rows, self.asked, self.timers = {}, [], []

    def getMapState(self, *schema):
        return self

    def registerTimer(self, at):
        self.timers.append(at)

    def iterator(self):
        for item in sorted(self.rows.items()):
            self.asked.append("walk")
            yield item

    def getValue(self, permit):
        self.asked.append("one")
        return self.rows.get(permit)

    def updateValue(self, permit, row):
        self.asked.append("update")
        self.rows[permit] = row

    def getCurrentWatermarkInMs(self):
        return 0


def test_a_bucket_is_one_group_and_reads_little_of_what_it_holds():
    bucket, state = Bucket(), K.RunState(366, 10**12)
    state.init(bucket)

    def batch(permits, day, code):
        part = pd.DataFrame([("s", str(k), day, code, None, None, None, None, "MISSING") for k in permits], columns=[*K.KEY, "day", *K.PAYLOAD])
        bucket.asked.clear()
        return list(state.handleInputRows((7,), iter([part[: len(part) // 2], part[len(part) // 2 :]]), bucket))

    assert len(batch(range(500), 3, "01")) == 1 and len(bucket.rows) == 500 and bucket.asked == ["update"] * 500 and bucket.timers == [10**12]
    assert len(batch(range(500), 4, "03")) == 1 and sorted(set(bucket.asked)) == ["update", "walk"] and len(bucket.asked) == 1000 and bucket.timers == [10**12]
    assert K.unpack(*bucket.rows["s", "9"]) == {3: ("01", None, None, None, None, "MISSING"), 4: ("03", None, None, None, None, "MISSING")}
    assert len(batch([499], 5, "03")) == 1 and len(bucket.asked) <= 12 and len(K.unpack(*bucket.rows["s", "499"])) == 3
    assert batch(range(500), 4, "03") == [] and "update" not in bucket.asked  # nothing new, nothing written


def test_many_permits_share_few_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "BUCKETS", 3)
    every = [(str(k), D_(2026, 1, 1 + d), "01" if (k + d) % 3 else "03", None) for k in range(60) for d in range(4)]
    got = follow(spark, f"file://{tmp_path}", [obs(spark, every[:150]), obs(spark, every[90:])])
    assert rows(got) == rows(episodes(obs(spark, every), "2026-01-01", "2026-12-31"))
    spark.conf.set(K.PROVIDER, K.ROCKS)
    try:
        left = spark.read.format("statestore").option("path", f"file://{tmp_path}/state").option("stateVarName", "runs").load().selectExpr("key.bucket", "user_map_key").collect()
    finally:
        spark.conf.unset(K.PROVIDER)
    assert len(left) == 60 and len({r.bucket for r in left}) == 3
