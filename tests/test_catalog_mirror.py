import datetime as dt
import json
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.functions.fixed import HIGH_SEAS
from tidemark.operators import catalog as C
from tidemark.operators import mirror as M
from tidemark.plans import views
from tidemark.plans.outputs import paged
from tidemark.session import shared_dir
from tidemark.sources import readers as S
from tidemark.streaming import feed

IDX = "site_id string, v_major double, v_minor double, last_update date"
D1, D2, TODAY = dt.date(2026, 1, 1), dt.date(2026, 2, 1), dt.date(2026, 6, 1)


def kinds(df):
    return {r["site_id"]: r["kind"] for r in df.collect()}


def test_census_diff(spark):
    idx = spark.createDataFrame([("same", 1.0, None, D1), ("bump", 1.0, 0.0, D1), ("date", 1.0, 0.0, D1), ("nodate", 1.0, 0.0, None), ("gone", 1.0, 0.0, D1), ("hs", 1.0, 0.0, D1)], IDX)
    cat = spark.createDataFrame([("same", 1.0, None, D1, False), ("bump", 2.0, 0.0, D1, False), ("date", 1.0, 0.0, D2, False), ("nodate", 1.0, 0.0, D2, False), ("hs", 1.0, 0.0, D1, True), ("new", 1.0, 0.0, D1, False), ("newhs", 1.0, 0.0, D1, True)], IDX + ", hs boolean")
    assert kinds(C.census_diff(idx, cat)) == {"bump": "changed", "date": "changed", "gone": "removed", "hs": "removed", "new": "added"}
    assert C.newest_update(cat).head()[0] == D2


def rows(spark, *r):
    return spark.createDataFrame([(s, c, st, 1.0, 0.0, D1, c == HIGH_SEAS, i) for i, (s, c, st) in enumerate(r)], "site_id string, country string, status string, v_major double, v_minor double, last_update date, hs boolean, seq bigint")


def stores(spark):
    return spark.createDataFrame([(f"i{n}", 1.0, 0.0, D1) for n in range(1, 60)], IDX), spark.createDataFrame([("p1", 1.0, 0.0), ("p2", 1.0, 0.0)], M.PARKED)


def test_window_and_removals(spark):
    idx, parked = stores(spark)
    w = rows(spark, ("i1", "X", "removed"), ("i1", "X", "active"), ("i2", "X", "REMOVED"), ("i3", HIGH_SEAS, "active"), ("p1", "X", "active"), ("p2", "X", "removed"), ("n1", "X", "active"), ("n2", HIGH_SEAS, "active"), ("n3", "X", "removed"))
    active, gone = C.split_window(w)
    assert kinds(C.classify(idx, parked, active)) == {"i1": "changed", "p1": "refetch", "n1": "added"}
    assert {r[0] for r in C.removals(idx, parked, gone, active).collect()} == {"i2", "i3", "p2"}
    assert C.flag_fault(w).head()[0] is None and C.flag_fault(w.withColumn("status", F.lit(None).cast("string"))).head()[0]
    skip = {r[0]: r[1] for r in C.split_added(active.where("site_id <> 'i1'"), active, parked).collect()}
    assert skip == {"p1": True, "n1": False}
    assert {r[0] for r in C.adopt_versions(spark.createDataFrame([("i1",), ("zz",)], "site_id string"), idx).collect()} == {"i1"}
    cat = idx.where("site_id <> 'i5'").withColumn("hs", F.lit(False)).unionByName(spark.createDataFrame([("p1", 1.0, 0.0, D1, False)], IDX + ", hs boolean"))
    folded = kinds(C.fold_census(C.census_diff(idx, cat), idx, parked, cat, active))
    assert folded == {"i5": "removed", "i1": "changed", "p1": "refetch"}


@pytest.mark.parametrize(
    ("sizes", "delta", "census"),
    [((0, 0, 999, 0, 0, 0), None, None), ((1, 1, 2, 0, 100, 100), None, None), ((0, 0, 3, 0, 100, 100), "too many removals", None), ((0, 0, 201, 0, 50000, 50000), "too many removals", None), ((30, 21, 0, 99, 100, 100), "too many changes", None), ((0, 0, 0, 0, 100, 49), None, "half-empty catalogue"), ((0, 0, 11, 0, 100, 100), "too many removals", "too many removals")],
)
def test_gates(spark, sizes, delta, census):
    df = spark.createDataFrame([sizes], "added long, changed long, removed long, refetch long, mirror_size long, catalog_size long")
    assert tuple(df.select(C.delta_fault(), C.census_fault()).head()) == (delta, census)


def test_census_choice(spark):
    def due(sweep, census, forced=False):
        return spark.range(1).select(C.wants_census(F.lit(sweep).cast("date"), F.lit(census).cast("date"), F.lit(TODAY), forced)).head()[0]

    ago = lambda n: TODAY - dt.timedelta(days=n)
    assert [due(ago(60), ago(30)), due(ago(61), ago(1)), due(ago(1), ago(31)), due(None, ago(1)), due(ago(1), None), due(ago(1), ago(1), True)] == [False, True, True, True, True, True]


def test_pages(spark):
    site = lambda i, **k: {"ps_id": i, "site_id": "old", "country": "X", "status": "active", "site_major_version": "1", "site_minor_version": None, "last_update": "2026-01-01"} | k
    pages = spark.createDataFrame([(1, [site("a"), site("b")]), (2, [site("a", site_major_version="2"), site("", site_id="")][:1])], S.PAGE)
    cat = {r["site_id"]: r["v_major"] for r in S.catalog(S.site_rows(pages)).collect()}
    assert cat == {"a": 2.0, "b": 1.0}
    S.require_complete(pages, limit=2)
    for bad in (pages.where("page = 2"), pages.where("page = 1"), pages.limit(0)):
        with pytest.raises(ValueError, match="pagination"):
            S.require_complete(bad, limit=2)


def test_listings_of_any_length(spark):
    long = spark.range(1, 702).select(F.col("id").cast("int").alias("page"), F.array_repeat(F.struct(*(F.lit("1").alias(f.name) for f in S.ROW)), F.when(F.col("id") < 701, 2).otherwise(1)).alias("sites"))
    S.require_complete(long, limit=2)
    with pytest.raises(ValueError, match="pages are missing"):
        S.require_complete(long.where("page <> 350"), limit=2)


def test_full_pages_end_with_an_empty_one(spark):
    rows = spark.range(6).select(F.struct("id").alias("key"), F.struct(*(F.col("id").cast("string").alias(f.name) for f in S.ROW)).alias("r"))
    pages = paged(spark, rows, 3)
    S.require_complete(pages, limit=3)
    assert sorted((r["page"], len(r["sites"])) for r in pages.collect()) == [(1, 3), (2, 3), (3, 0)]
    assert S.site_rows(pages).count() == 6


def test_no_task_numbers_or_gathers_more_than_a_range(spark, monkeypatch):
    """Rows are sorted in ranges of about V.RANGE, however few cores there are, and pages are gathered in as many partitions."""
    monkeypatch.setattr(views, "RANGE", 50)
    root = Path(shared_dir(spark).removeprefix("file://"))
    before = set(root.iterdir())
    at = F.xxhash64("id")
    rows = spark.range(1000).select(F.struct(at.alias("h"), "id").alias("key"), F.struct(*(at.cast("string").alias(f.name) for f in S.ROW)).alias("r"))
    pages = paged(spark, rows, 30)
    S.require_complete(pages, limit=30)
    got = [r["ps_id"] for p in sorted(pages.collect()) for r in p["sites"]]
    assert got == [str(r[0]) for r in rows.select("key.h").orderBy("h").collect()]
    (ranges,) = (p for p in set(root.iterdir()) - before if p.name.startswith("ranges-"))
    held = [pq.ParquetFile(f).metadata.num_rows for f in ranges.glob("*.parquet")]
    assert sum(held) == 1000 and len(held) > 15 and max(held) < 150
    (written,) = (p for p in set(root.iterdir()) - before if p.name.startswith("pages-"))
    assert len(list(written.glob("*.json"))) > 10


def seeded(spark, tmp_path):
    m = M.Mirror(spark, f"file://{tmp_path}/mirror")
    idx, _ = stores(spark)
    lines = idx.select(F.lit("a").alias("shard"), F.monotonically_increasing_id().alias("seq"), "site_id", F.lit("old").alias("props"), F.concat(F.lit("g"), "site_id").alias("geometry")).unionByName(spark.createDataFrame([("a", 999, "", "noid", None)], M.LINES))
    m.seed(lines, idx, "2026-05-28", "2026-06-01")
    return m


DETAILS = "site_id string, props string, geometry string"


def test_increment_replay_gate_and_quiet(spark, tmp_path):
    m = seeded(spark, tmp_path)
    assert m.state()["site_count"] == 59 and m.state()["last_full_census_date"] is None
    w = rows(spark, ("i1", "X", "active"), ("i2", "X", "removed"), ("n1", "X", "active"), ("n2", "X", "active"))
    details = spark.createDataFrame([("i1", "new", None), ("n1", "new", "gn1"), ("n2", "new", None)], DETAILS)
    for _ in range(2):  # a replay changes nothing
        feed.apply_window(m, w, details, TODAY)
        lines, idx, parked = m.tables()
        got = {r["site_id"]: (r["props"], r["geometry"]) for r in lines.collect()}
        assert got["i1"] == ("new", "gi1") and "i2" not in got and got["n1"] == ("new", "gn1") and "n2" not in got and got[""] == ("noid", None) and len(got) == 60
        assert idx.count() == 59 and [r[0] for r in parked.collect()] == ["n2"]
    before = m.state()
    with pytest.raises(ValueError, match="too many removals"):
        feed.apply_window(m, rows(spark, *((f"i{n}", "X", "removed") for n in range(3, 30))), details, TODAY)
    assert m.state() == before
    later = TODAY + dt.timedelta(days=1)
    feed.apply_window(m, rows(spark, ("zz", "X", "removed")), details, later)
    quiet = m.state()
    assert quiet["last_sweep_date"] == later and quiet["data_version"] == before["data_version"] and quiet["dataset_date"] == TODAY


def test_first_sync_is_a_census_then_a_stream(spark, tmp_path):
    m = seeded(spark, tmp_path)
    idx, _ = stores(spark)
    cat = idx.withColumn("hs", F.lit(False)).unionByName(spark.createDataFrame([("n1", 1.0, 0.0, D1, False)], IDX + ", hs boolean"))
    details = spark.createDataFrame([("n1", "new", "g"), ("i7", "new", "g7")], DETAILS)
    assert feed.sync(m, cat, rows(spark), details, TODAY)["added"] == 1 and m.state()["last_full_census_date"] == TODAY
    land = tmp_path / "landing"
    land.mkdir()
    (land / "p.json").write_text(json.dumps({"page": 1, "sites": [{"ps_id": "i7", "country": "X", "status": "active", "last_update": "2026-06-02"}]}))
    for _ in range(2):
        feed.stream_windows(spark, f"file://{land}", f"file://{tmp_path}/cp", m, details, TODAY).awaitTermination()
    assert {r["site_id"]: r["geometry"] for r in m.tables()[0].collect()}["i7"] == "g7"


def test_seed_dates(spark):
    idx, _ = stores(spark)
    assert M.seed_state(idx, "2026-01-01", "2026-01-01").head()["site_count"] == 59
    with pytest.raises(Exception, match="dataset date"):
        M.seed_state(idx, "2026-01-02", "2026-01-01").collect()
