"""The mirror with several writers, its plans, and pages that come late."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import catalog as C
from tidemark.operators import mirror as M
from tidemark.streaming import feed

D1, TODAY = dt.date(2026, 1, 1), dt.date(2026, 6, 10)
DETAILS = "site_id string, props string, geometry string"
ROWS = "site_id string, country string, status string, v_major double, v_minor double, last_update date, hs boolean, seq bigint"
LOOSE = {"removed_abs": 1000, "removed_ratio": 1.0, "delta_ratio": 2.0}


def seeded(spark, tmp_path, n=40, **k):
    m = M.Mirror(spark, f"file://{tmp_path}/mirror", **k)
    idx = spark.createDataFrame([(f"i{i}", 1.0, 0.0, D1) for i in range(n)], "site_id string, v_major double, v_minor double, last_update date")
    lines = idx.select(F.concat(F.lit("s "), F.substring("site_id", 2, 1)).alias("shard"), F.xxhash64("site_id").alias("seq"), "site_id", F.lit("old").alias("props"), F.lit("g").alias("geometry"))
    m.seed(lines, idx, "2026-01-01", "2026-01-02")
    return m


def window(spark, *rows):
    return spark.createDataFrame([(s, "X", status, v, 0.0, d, False, i) for i, (s, status, v, d) in enumerate(rows)], ROWS)


def details(spark, *ids):
    return spark.createDataFrame([(i, f"new {i}", f"shape {i}") for i in ids], DETAILS)


def held(m):
    return {r["site_id"]: r["props"] for r in m.lines().collect()}


def test_of_two_writers_one_version_fails(spark, tmp_path):
    m = seeded(spark, tmp_path)
    state = m.state()
    one = state | {"version": 1, "last_sweep_date": TODAY}
    m.commit(one)
    with pytest.raises(M.Conflict):
        M.Mirror(spark, m.root).commit(state | {"version": 1, "last_sweep_date": D1})
    assert m.state()["last_sweep_date"] == TODAY and len(os.listdir(tmp_path / "mirror/log")) == 1 + 1 + sum(f.endswith(".crc") for f in os.listdir(tmp_path / "mirror/log"))
    assert not M.publish(spark, f"{tmp_path}/mirror/log/{1:020d}.json", "{}") and M.publish(spark, f"{tmp_path}/x/y.json", "{}")


def test_the_loser_starts_again_and_nothing_is_lost(spark, tmp_path, monkeypatch):
    m, other = seeded(spark, tmp_path), M.Mirror(spark, f"file://{tmp_path}/mirror")
    commit, turns = M.Mirror.commit, []

    def late(self, state, *a, **k):
        if self is m and not turns:
            turns.append(1)
            feed.apply_window(other, window(spark, ("i1", "active", 2.0, TODAY), ("n1", "active", 1.0, TODAY)), details(spark, "i1", "n1"), TODAY)
        return commit(self, state, *a, **k)

    monkeypatch.setattr(M.Mirror, "commit", late)
    feed.apply_window(m, window(spark, ("i2", "active", 2.0, TODAY), ("n2", "active", 1.0, TODAY)), details(spark, "i2", "n2"), TODAY)
    got = held(m)
    assert all(got[i] == f"new {i}" for i in ("i1", "n1", "i2", "n2")) and len(got) == 42 and m.state()["version"] == 2
    turns.clear()
    with pytest.raises(M.Conflict):
        feed.apply_window(m, window(spark, ("i3", "active", 2.0, TODAY)), details(spark, "i3"), TODAY, attempts=1)
    assert held(m)["i3"] == "old"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_not_shuffled_and_untouched_shards_stay(spark, tmp_path):
    m = seeded(spark, tmp_path, buckets=4)
    first = m.shards()
    feed.apply_window(m, window(spark, ("i11", "active", 2.0, TODAY), ("i25", "removed", None, TODAY)), details(spark, "i11"), TODAY)
    then = m.shards()
    assert {s for s in first if then[s] != first[s]} == {"s 1", "s 2"} and len(set(then.values())) == 2
    assert "i25" not in held(m) and len(held(m)) == 39
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        moved = m.bucketed("moved", "9-test", M.changes(details(spark, "i1", "i30"), window(spark, ("i2", "removed", None, TODAY))), 4)
        plan = plan_of(M.apply_changes(m.lines(), moved))
        assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 3
        assert "Exchange" not in plan_of(m.stores()[0].join(moved, "site_id", "left_semi"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # a session that did not write the tables finds them
    before = held(m)
    for t in spark.catalog.listTables():
        if t.name.startswith("tidemark_"):
            spark.sql(f"DROP TABLE {t.name}")
    assert held(m) == before and m.stores()[0].count() == 39


def test_crowded_versions_are_rewritten(spark, tmp_path):
    m = seeded(spark, tmp_path, most=2)
    for i in (11, 22, 33):
        feed.apply_window(m, window(spark, (f"i{i}", "active", 2.0, TODAY)), details(spark, f"i{i}"), TODAY)
        assert len(set(m.shards().values())) <= 2
    assert [held(m)[f"i{i}"] for i in (1, 11, 22, 33)] == ["old", "new i11", "new i22", "new i33"]


def test_shards_of_an_id_follow_its_lines(spark, tmp_path):
    m = seeded(spark, tmp_path, n=4)
    feed.apply_window(m, window(spark, ("n1", "active", 1.0, TODAY), ("i1", "active", 2.0, TODAY)), details(spark, "n1", "i1"), TODAY, LOOSE)
    shards = {r["site_id"]: r["shards"] for r in m.stores()[0].collect()}
    assert shards == {"i0": ["s 0"], "i1": ["s 1"], "i2": ["s 2"], "i3": ["s 3"], "n1": ["updates"]}
    feed.apply_window(m, window(spark, ("n1", "removed", None, TODAY)), details(spark), TODAY, LOOSE)
    assert "n1" not in held(m) and len(held(m)) == 4


def test_details_repeat(spark):
    d = spark.createDataFrame([("a", "p", None), ("a", "q", "g"), ("a", "r", "f")] * 2, DETAILS)
    assert [tuple(r) for r in feed._once(d).collect()] == [("a", "r", "f")]


@pytest.mark.parametrize("called", [True, False])
def test_details_are_sorted_a_bucket_at_once(spark, called):
    """Texts are dealt over the buckets before they are sorted, once, and joined as they stand."""
    d = spark.range(300).select((F.col("id") % 100).cast("string").alias("site_id"), F.col("id").cast("string").alias("props"), F.when(F.col("id") < 200, "g").alias("geometry"))
    wanted = spark.range(0, 200, 2).select(F.col("id").cast("string").alias("site_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = feed._refreshed((lambda ids: d) if called else d, wanted, 13)
        assert {tuple(r) for r in got.collect()} == {(str(i), str(max(str(i), str(i + 100))), "g") for i in range(0, 100, 2)}
        assert got.rdd.getNumPartitions() == 13
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.rindex("SortAggregate") < plan.index("Exchange") and "AQEShuffleRead" not in plan[: plan.index("Exchange")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_late_pages_overtake_nothing(spark, tmp_path):
    m = seeded(spark, tmp_path)
    land = tmp_path / "landing"
    land.mkdir()
    clock = [1_700_000_000]

    def page(*rows):
        clock[0] += 10
        name = land / f"{clock[0]}.json"
        name.write_text(json.dumps({"page": 1, "sites": [{"ps_id": i, "country": "X", "status": status, "site_major_version": str(v), "last_update": day} for i, status, v, day in rows]}))
        os.utime(name, (clock[0], clock[0]))

    def run():
        feed.stream_windows(spark, f"file://{land}", f"file://{tmp_path}/checkpoint", m, details(spark, "i1", "i2", "i3", "n1", "n2"), TODAY, LOOSE, files=1).awaitTermination()
        return {r["site_id"]: r["v_major"] for r in m.stores()[0].collect()}

    page(("i1", "active", 5, "2026-06-05"), ("i2", "removed", 5, "2026-06-04"))
    page(("i1", "active", 4, "2026-06-01"), ("i2", "active", 4, "2026-06-02"))  # late: overtaken by a row and by a removal
    page(("i3", "active", 3, "2026-05-01"))  # older than the mark by more than 30 days
    page(("n1", "active", 2, "2026-05-20"))  # late, but nothing newer is known
    got = run()
    assert (got["i1"], got["i3"], got["n1"]) == (5.0, 1.0, 2.0) and "i2" not in got and m.state()["mark"] == dt.date(2026, 6, 5)
    assert held(m)["i1"] == "new i1" and "i2" not in held(m)
    # started again: the same day counts, as corrections come with it, and a removed site can return
    page(("i1", "active", 6, "2026-06-05"), ("i2", "active", 6, "2026-06-07"))
    page(("i1", "removed", 1, "2026-06-01"))  # a late removal
    got = run()
    assert (got["i1"], got["i2"]) == (6.0, 6.0) and m.state()["mark"] == dt.date(2026, 6, 7)
    assert m.stores()[2].count() == 0


def watched(spark, df):
    """df and a counter of its rows that are read."""
    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(watch, df.schema), seen


@pytest.mark.parametrize("lateness", [None, 30])
def test_a_window_is_read_once(spark, tmp_path, lateness):
    m = seeded(spark, tmp_path)
    rows, seen = watched(spark, window(spark, ("i1", "active", 2.0, TODAY), ("i1", "active", 3.0, TODAY), ("i2", "removed", None, TODAY), ("n1", "active", 1.0, TODAY), ("i3", None, 9.0, dt.date(2020, 1, 1))))
    feed.apply_window(m, rows, details(spark, "i1", "n1"), TODAY, LOOSE, lateness)
    assert seen.value == 5
    assert {r["site_id"]: r["v_major"] for r in m.stores()[0].where("site_id IN ('i1', 'i2', 'n1')").collect()} == {"i1": 3.0, "n1": 1.0}
    bare = window(spark, ("i1", None, 2.0, TODAY))
    with pytest.raises(ValueError, match="no status"):
        feed.apply_window(m, bare, details(spark, "i1"), TODAY, LOOSE, lateness)


def test_a_census_reads_its_catalogue_once(spark, tmp_path):
    m = seeded(spark, tmp_path)
    listed = m.stores()[0].select("site_id", F.lit(2.0).alias("v_major"), "v_minor", "last_update", F.lit(False).alias("hs"))
    catalog, listing = watched(spark, listed)
    rows, seen = watched(spark, window(spark, ("i1", "active", 2.0, TODAY)))
    assert feed.apply_census(m, catalog, details(spark, "i1"), TODAY, rows)["changed"] == 40
    assert (listing.value, seen.value) == (40, 1)


@pytest.mark.parametrize("order", [["page", "pos"], ["seq"], ["page", "pos", "seq"]])
def test_windows_summed_by_id_equal_their_rows(spark, order):
    rng = random.Random(len(order))
    day = lambda: rng.choice([None, *(D1 + dt.timedelta(days=i) for i in range(4))])
    places = rng.sample([(p, q) for p in (None, 1, 2, 70_000) for q in range(80)], 300)
    rows = [(f"s{rng.randrange(60)}", rng.choice(["active", "Removed", None]), rng.choice([None, 1.0, 2.0, 3.0]), rng.choice([None, 5.0]), day(), rng.random() < 0.2, p, q, None if i == 7 else i) for i, (p, q) in enumerate(places)]
    df = spark.createDataFrame(rows, "site_id string, status string, v_major double, v_minor double, last_update date, hs boolean, page int, pos int, seq bigint").select("site_id", "status", "v_major", "v_minor", "last_update", "hs", *order)
    for live in (F.lit(True), F.coalesce(F.col("last_update") > D1, F.lit(False))):
        seen = C.by_id(C.by_day(df).withColumn("live", live))
        for got, want in zip(C.split_summed(seen), C.split_window(df.where(live)), strict=True):
            assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and want.count() > 5
        newest = df.where(live).groupBy("site_id").agg(F.max("last_update").alias("newest"))
        assert {tuple(r) for r in seen.select("site_id", "newest").where("newest is not null").collect()} == {tuple(r) for r in newest.where("newest is not null").collect()}
    assert {r[0] for r in seen.where("status").select("site_id").collect()} == {r[0] for r in rows if r[1]}
    assert len(order) == 3 or "SortAggregate" not in plan_of(seen)


def test_buckets_follow_the_size_of_the_mirror(spark, tmp_path, monkeypatch):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, 300)
    try:
        m = seeded(spark, tmp_path)
        assert m.state()["buckets"] == spark.sparkContext.defaultParallelism and len(held(m)) == 40
        monkeypatch.setattr(M, "BUCKET", 400)
        m = seeded(spark, tmp_path / "small")
        assert m.state()["buckets"] == -(-(40 * (2 * M.LINE + len("old" + "g"))) // 400)
        feed.apply_window(m, window(spark, ("i1", "active", 2.0, TODAY)), details(spark, "i1"), TODAY, LOOSE)
        assert held(m)["i1"] == "new i1" and len(held(m)) == 40
    finally:
        spark.conf.set(key, before)
