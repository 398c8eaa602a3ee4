import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import geometry as G
from tidemark.functions.fixed import DEFAULT
from tidemark.operators import exclude as X
from tidemark.operators import regions as R
from tidemark.plans.catalogue import box_regions

POINTS = {(178, -17): "sw-pacific", (-179, -17): "sw-pacific", (-75, 18): "caribbean", (10, 40): "mediterranean", (70, -10): "indian-ocean", (140, 35): "nw-pacific", (3, 55): "north-europe", (-20, -55): "southern-ocean", (17, 20): "other", (180, 0): "other", (0, 48): "north-europe", (0, 90): "other"}


def boxes(spark):
    rows = [(i, (float(x), float(y), float(x), float(y)), want) for i, ((x, y), want) in enumerate(POINTS.items())]
    rows += [(98, None, "other"), (99, (-179.0, 0.0, 179.0, 1.0), "sw-pacific")]
    return spark.createDataFrame(rows, "id int, bbox struct<minx:double,miny:double,maxx:double,maxy:double>, want string")


def test_routing_by_boxes_and_by_join(spark):
    df = boxes(spark)
    assert R.tag(df).where("region <> want").count() == 0
    joined = R.tag_by_join(df, box_regions(spark), ["id"])
    assert joined.count() == df.count() and joined.where("region <> want").count() == 0


def test_region_meta_and_counts(spark):
    t = R.tag(boxes(spark))
    m = {r["region"]: r for r in R.region_meta(t).collect()}
    assert (m["sw-pacific"]["minx"], m["sw-pacific"]["maxx"], m["sw-pacific"]["feature_count"]) == (-179.0, 179.0, 3)
    assert [r["region"] for r in R.region_counts(t).collect()] == sorted(m)


def test_components_bbox_rounding(spark):
    many = "[[[[0,0],[4,0],[4,4],[0,0]]],[[[10.123456,-70.123456],[11,-70],[11,-69],[10.123456,-70.123456]]]]"
    df = spark.createDataFrame([(1, "MultiPolygon", many), (2, "Polygon", "[[[1,1,9],[2,1,9],[2,2,9],[1,1,9]]]"), (3, "Point", "[1,2]"), (4, None, None), (5, "Polygon", "[]")], "id int, t string, c string")
    df = df.withColumn("geometry", G.flat_2d(G.polygons(F.col("t"), F.col("c"))))
    rows = G.explode_components(df.select("id", "geometry")).orderBy("id", "component_index").collect()
    assert [(r["id"], r["component_index"]) for r in rows] == [(1, 0), (1, 1), (2, 0)]
    assert tuple(rows[1]["bbox"]) == (10.123456, -70.123456, 11.0, -69.0) and len(rows[2]["polygon"][0][0]) == 2
    assert df.select(G.span(G.geometry_bbox(F.col("geometry"))).alias("s")).orderBy("id").first()["s"] == 74.123456
    d = spark.createDataFrame([(-0.000005,), (1.0000049,), (-70.123456,)], "x double").select(G.half_up(F.col("x"), 5)).collect()
    assert [r[0] for r in d] == [0.0, 1.0, -70.12346]


def test_point_in_polygon_with_hole(spark):
    poly = [[[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0], [0.0, 0.0]], [[4.0, 4.0], [6.0, 4.0], [6.0, 6.0], [4.0, 6.0], [4.0, 4.0]]]
    df = spark.createDataFrame([(poly, 5.0, 5.0), (poly, 1.0, 1.0), (poly, 11.0, 1.0), (poly, 0.0, 3.0)], "p array<array<array<double>>>, x double, y double")
    assert [r[0] for r in df.select(G.point_in_polygon(F.col("p"), F.col("x"), F.col("y"))).collect()] == [False, True, False, True]


def test_simplify(spark):
    circle = [[math.cos(t * math.tau / 1000) / 10, math.sin(t * math.tau / 1000) / 10] for t in range(1000)]
    circle.append(circle[0])
    sliver = [[0.0, 0.0], [0.0, 0.0], [1e-7, 0.0], [0.0, 0.0]]
    df = spark.createDataFrame([(1, [circle]), (2, [sliver]), (3, None)], "id int, polygon array<array<array<double>>>")
    r = {x["id"]: x for x in G.simplify_display(df, DEFAULT.tolerance_deg, DEFAULT.decimals).collect()}
    ring = r[1]["display"][0]
    assert r[1]["vertices_in"] == 1001 and 4 <= len(ring) < 100 and ring[0] == ring[-1] and not r[1]["fallback"]
    assert r[2]["fallback"] and len(r[2]["display"][0]) == 4 and r[1]["polygon"][0][5] == circle[5]


def test_small_rings_are_thinned_together(monkeypatch):
    """Many rings far below the tolerance take a few passes, not one each, and stay as the tolerance that a ring alone would take leaves them."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    rings = [np.round(rng.normal(size=(rng.integers(4, 60), 2)), 2) * 10.0 ** -rng.integers(4, 9) for _ in range(300)]
    rings = [np.concatenate((r, r[:1])) for r in rings]
    calls, plain = [], G._farthest
    monkeypatch.setattr(G, "_farthest", lambda *a, **k: calls.append(1) or plain(*a, **k))
    out = G._thin(pa.array([[r.tolist()] for r in rings], pa.list_(pa.list_(pa.list_(pa.float64())))), DEFAULT.tolerance_deg, 12).to_pylist()
    assert len(calls) < 100
    for r, got in zip(rings, out, strict=True):
        clean = r[np.append(True, (r[1:] != r[:-1]).any(axis=1))]
        tolerance = DEFAULT.tolerance_deg
        at = lambda: G._thinned(clean[:, 0].copy(), clean[:, 1].copy(), np.array([0]), np.array([len(clean) - 1]), tolerance)  # noqa: E731, B023
        while at().sum() < 4:
            tolerance *= 0.99
        assert not got["fallback"] and got["vertices_in"] == len(r) and abs(got["vertices_out"] - at().sum()) <= 1


@pytest.mark.parametrize(
    ("category", "area", "span", "ban", "want"),
    [(9, 10.0, 1.0, True, "categoryId"), (3, 60000.0, 1.0, False, "areaWithoutHardBan"), (6, 60000.0, 1.0, True, None), (3, 50000.0, 1.0, False, None), (3, None, 91.0, False, "bboxSpanWithoutHardBan"), (3, None, 91.0, True, None), (None, None, 90.0, False, None)],
)
def test_drop_reason(spark, category, area, span, ban, want):
    df = spark.createDataFrame([(category, area, span, ban)], "c int, a double, s double, b boolean")
    assert df.select(X.drop_reason(F.col("c"), F.col("a"), F.col("s"), F.col("b"))).head()[0] == want


def test_tallies(spark):
    rows = [("LFP1", None, 2, 0), ("LFP1", "categoryId", 5, 0), ("LFP1", None, 1, 1), ("x_HighSeas", None, 4, 0)]
    t = X.tally(spark.createDataFrame(rows, "partition string, drop_reason string, components int, fallbacks int"))
    r = {x["partition"]: x for x in t.collect()}
    assert (r["LFP1"]["featuresIn"], r["LFP1"]["kept"], r["LFP1"]["componentsFull"], r["LFP1"]["categoryId"], r["LFP1"]["simplifyFallbacks"]) == (3, 2, 3, 1, 1)
    assert (r["x_HighSeas"]["featuresIn"], r["x_HighSeas"]["partitionDrop"], r["x_HighSeas"]["features_skipped"]) == (0, 1, 1)
    m = X.merge(t).head()
    assert (m["featuresIn"], m["partitionDrop"], m["partitions"]) == (3, 1, "LFP1,x_HighSeas")
    assert X.merge(t.limit(0)).head()["kept"] == 0
