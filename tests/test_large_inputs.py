"""Inputs larger than a task: documents cut into ranges, tilings beyond a broadcast, files hashed in chunks, extracts along a curve."""

import gzip
import hashlib
import json
import random
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.functions import geometry as G
from tidemark.operators import regions as R
from tidemark.plans import pipelines as P
from tidemark.sources import collections as K
from tidemark.sources import readers as S
from tidemark.sources import writers as W


@pytest.fixture
def ranges(spark):
    """Sets the size of the byte ranges that files are read in."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]

    def of(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 1)

    yield of
    for n, v in zip(names, before, strict=True):
        spark.conf.set(n, v)


def feature(i, rng):
    name = "".join(rng.choice('ab{}[]",:\\é😀 \n"features":[') for _ in range(rng.randrange(30)))
    shape = {"type": "Polygon", "coordinates": [[[rng.random(), 1.5]] * rng.randrange(1, 60)]} if i % 7 else None
    return {"type": "Feature", "properties": {"SITE_ID": f"S{i}", "site_name": name, "x": {"features": [{"no": 1}], "y": [{"z": i}, {}]}, "tags": ["}", "{", {}]}, "geometry": shape}


def document(n, seed=1):
    rng = random.Random(seed)
    return {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "x}{"}}, "links": [{"a": {}}, {"b": 1}], "features": [feature(i, rng) for i in range(n)], "more": [{"t": 1}, {"features": [{"q": 1}]}], "z": {}}


@pytest.mark.parametrize("size", [1 << 27, 20_000, 900])
def test_documents_in_ranges(spark, ranges, tmp_path, size):
    docs = {"a.json": (document(400 if size > 900 else 40), {}), "b.json": (document(1), {}), "c.json": (document(0), {"indent": 3}), "d.json": (document(90, 2), {"indent": 2, "ensure_ascii": False}), "e.json": ([1, {"features": 1}], {})}
    for name, (doc, how) in docs.items():
        (tmp_path / name).write_text(json.dumps(doc, **how), encoding="utf-8")
    ranges(size)
    got = K.feature_texts(spark, f"file://{tmp_path}").collect()
    plain = lambda x: json.dumps(x, sort_keys=True)
    want = {(n, i, plain(f)) for n, (d, _) in docs.items() if isinstance(d, dict) for i, f in enumerate(d["features"])}
    assert {(r["file"].rsplit("/", 1)[-1], r["place"], plain(json.loads(r["text"]))) for r in got} == want and len(got) == len(want)


def test_one_document_is_many_tasks_and_equals_lines(spark, ranges, tmp_path):
    doc = document(300)
    (tmp_path / "doc.json").write_text(json.dumps(doc))
    (tmp_path / "lines.ndjson").write_text("\n".join(map(json.dumps, doc["features"])))
    ranges(30_000)
    tasks = K.feature_texts(spark, f"file://{tmp_path}/doc.json").withColumn("p", F.spark_partition_id()).select("p").distinct().count()
    assert tasks > 5
    one = S.feature_collection(spark, f"file://{tmp_path}/doc.json")
    cols = ["SITE_ID", "site_name", "geometry_type", "coordinates"]
    assert sorted(map(repr, one.select(cols).collect())) == sorted(map(repr, S.ndjson(spark, f"file://{tmp_path}/lines.ndjson").select(cols).collect()))
    assert [r[0] for r in one.orderBy("_pos").select("SITE_ID").collect()] == [f"S{i}" for i in range(300)]


def test_escapes_and_deep_places():
    import numpy as np

    b = np.frombuffer(rb'{"a\\":"\\\"}{","b":[{}]}', np.uint8)
    m = K.marks(b, False, 0)
    assert bytes(m.char) == b"{[{}]}" and m.depth.tolist() == [0, 1, 2, 3, 2, 1] and not m.text and m.end == 0


def tiling(spark, n, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y, s = rng.uniform(-185, 180), rng.uniform(-92, 90), rng.choice([0.05, 1.0, 7.0, 40.0])
        shape = [[[x, y], [x + s, y], [x + s / 2, y + s], [x, y]]]
        if i % 5 == 0:  # with a hole, and a second part far away
            shape.append([[x + s * 0.4, y + s * 0.2], [x + s * 0.6, y + s * 0.2], [x + s * 0.5, y + s * 0.4], [x + s * 0.4, y + s * 0.2]])
        more = [[[[150.0, y], [150.0 + s, y], [150.0, y + s], [150.0, y]]]] if i % 9 == 0 else []
        rows.append((i * 7 % n, f"r{i}", [shape, *more]))
    rows.append((-1, "empty", []))
    return spark.createDataFrame(rows, f"ordinal int, region string, geometry {G.GEOMETRY}")


@pytest.mark.parametrize("hot", [1, 50, 100_000])
def test_cells_equal_the_broadcast_tiling(spark, hot):
    rng = random.Random(5)
    at = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(300)] + [(10.0, 10.0)] * 50 + [(10 + rng.random(), 10 + rng.random()) for _ in range(300)]
    rows = [(i, (x - 0.1, y - 0.1, x + 0.1, y + 0.1)) for i, (x, y) in enumerate(at)] + [(9001, (-179.0, 0.0, 179.0, 1.0)), (9002, (None, None, None, None)), (9003, None)]
    c = spark.createDataFrame(rows, "id int, bbox struct<minx:double,miny:double,maxx:double,maxy:double>").withColumn("region", F.lit("before"))
    t = tiling(spark, 150)
    plain = {r["id"]: r["region"] for r in R.tag_by_join(c, t).collect()}
    cells = R.tag_by_cells(c, t, hot=hot)
    assert {r["id"]: r["region"] for r in cells.collect()} == plain and len(set(plain.values())) > 20 and cells.count() == len(rows)
    assert {r["region"] for r in R.tag_by_cells(c, t.limit(0)).collect()} == {"other", "sw-pacific"}
    assert "CartesianProduct" not in cells._jdf.queryExecution().executedPlan().toString()


def test_rounds_of_regions_end_with_the_points(spark, monkeypatch):
    """Regions that lie over each other are not all met: a point stops at its first one."""
    rng = random.Random(7)
    rows = [(i, (x - 0.1, y - 0.1, x + 0.1, y + 0.1)) for i, (x, y) in enumerate((rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(200))]
    c = spark.createDataFrame(rows, "id int, bbox struct<minx:double,miny:double,maxx:double,maxy:double>")
    met, plain = [], R._first_of
    monkeypatch.setattr(R, "_first_of", lambda points, tiles, hot: met.append((points.count(), tiles.count())) or plain(points, tiles, hot))
    t = tiling(spark, 150)
    want = {r["id"]: r["region"] for r in R.tag_by_join(c, t).collect()}
    for sent in (R.SENT, 0):
        monkeypatch.setattr(R, "SENT", sent)
        met.clear()
        assert {r["id"]: r["region"] for r in R.tag_by_cells(c, t, first=8).collect()} == want
        assert [n for _, n in met] == [8, 24, 96, 22] and [p for p, _ in met] == sorted((p for p, _ in met), reverse=True) and met[-1][0] < met[0][0]
    world = [[[[-181.0, -91.0], [181.0, -91.0], [181.0, 91.0], [-181.0, 91.0], [-181.0, -91.0]]]]
    met.clear()
    assert {r["region"] for r in R.tag_by_cells(c, spark.createDataFrame([(i, f"w{i}", world) for i in range(60)], t.schema), first=5).collect()} == {"w0"}
    assert met == [(200, 5)]


def test_large_tilings_go_to_cells(spark, monkeypatch):
    monkeypatch.setattr(R, "MAX_REGIONS", 100)
    c = spark.createDataFrame([(1, (0.0, 0.0, 1.0, 1.0))], "id int, bbox struct<minx:double,miny:double,maxx:double,maxy:double>")
    assert R.tag_by_join(c, tiling(spark, 120)).count() == 1


def test_files_are_hashed_in_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 1000)
    data = {f"f{n}.bin": random.Random(n).randbytes(n) for n in (1, 999, 1000, 5000, 200_000)}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    got = {r["name"]: (r["size"], r["sha256"]) for r in S.assets(spark, f"file://{tmp_path}", with_content=True, whole=999).collect()}
    assert got == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in data.items()}


def test_a_box_reads_few_row_groups(spark, tmp_path):
    rng = random.Random(2)
    rows = []
    for i in range(20_000):
        x, y = rng.uniform(-179, 179), rng.uniform(-89, 89)
        ring = [[x, y], [x + 0.5, y], [x + 0.5, y + 0.5], [x, y]]
        rows.append((f"S{i}", "one", (x, y, x + 0.5, y + 0.5), [ring], [ring]))
    c = spark.createDataFrame(rows, f"siteId string, region string, bbox struct<minx:double,miny:double,maxx:double,maxy:double>, polygon {G.POLYGON}, display {G.POLYGON}")
    c = c.withColumns({"restrictions": F.struct(F.lit("na").alias("entry")), "raw": F.create_map(F.lit("entry"), F.lit("na")), "sourceUrls": F.array(F.lit("u")), "siteVersion": F.struct(F.lit(1.0).alias("major"), F.lit(0.0).alias("minor"))})
    W.write_extracts(c, f"file://{tmp_path}/x", file_bytes=2 << 20, group_bytes=64 << 10)
    files = sorted(tmp_path.glob("x/region=one/variant=full/*.parquet"))
    assert 8 < len(files) < 60
    box = (20.0, 10.0, 40.0, 30.0)
    hit = total = 0
    for f in files:
        meta = pq.ParquetFile(f).metadata
        at = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            low, high = (lambda c, g=g, meta=meta, at=at: meta.row_group(g).column(at[c]).statistics.min), (lambda c, g=g, meta=meta, at=at: meta.row_group(g).column(at[c]).statistics.max)
            total += 1
            hit += low("minx") <= box[2] and high("maxx") >= box[0] and low("miny") <= box[3] and high("maxy") >= box[1]
    assert total >= 10 and hit < total / 4
    # the same by Spark's own count of rows that leave the scan
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        q = spark.read.parquet(f"file://{tmp_path}/x").where("variant = 'full' AND minx <= 40 AND maxx >= 20 AND miny <= 30 AND maxy >= 10").select("siteId", "minx")
        found = q.collect()
        leaf = q._jdf.queryExecution().executedPlan().collectLeaves().head()
        read = leaf.metrics().apply("numOutputRows").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(found) == sum(x <= 40 and x + 0.5 >= 20 and y <= 30 and y + 0.5 >= 10 for _, _, (x, y, _, _), _, _ in rows)
    assert len(found) <= read < len(rows) / 4


def test_features_are_ranged_before_they_are_wide(spark):
    """What is sampled and shuffled for the ranges of landed features is the few columns that the others derive from."""
    from tidemark.plans import outputs

    plan = outputs.feature_lines(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RepartitionByExpression", 1)
    assert "SITE_ID" in above and "SITE_ID" not in below and "partition" in below


def test_normalize_reads_its_input_once(spark, tmp_path):
    """Every feature passes the scan once, whatever is read back."""
    feats = [{"type": "Feature", "properties": {"SITE_ID": f"S{i}", "marine_area": str(i * 1000)}, "geometry": {"type": "Polygon", "coordinates": [[[i, 0], [i + 1, 0], [i + 1, 1], [i, 0]]]} if i % 4 else None} for i in range(60)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/f.ndjson").write_text("\n".join(map(json.dumps, feats)))
    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    f = S.ndjson(spark, f"file://{tmp_path}/in")
    f = f.mapInArrow(watch, f.schema).withColumn("partition", F.when(F.col("SITE_ID").endswith("7"), "P_HighSeas_x").otherwise("P_Coast_x"))
    parts, tallies = P.normalize(f)
    t = {r["partition"]: r.asDict() for r in tallies.collect()}
    assert parts.count() == t["P_Coast_x"]["componentsFull"] == sum(1 for i in range(60) if i % 4 and i % 10 != 7 and i * 1000 <= 50_000)
    assert t["P_HighSeas_x"]["features_skipped"] == 6 and t["P_HighSeas_x"]["featuresIn"] == 0 and t["P_HighSeas_x"]["partitionDrop"] == 1
    assert t["P_Coast_x"]["featuresIn"] == 54 and t["P_Coast_x"]["kept"] == sum(1 for i in range(60) if i % 10 != 7 and i * 1000 <= 50_000)
    assert t["P_Coast_x"]["areaWithoutHardBan"] == sum(1 for i in range(51, 60) if i % 10 != 7)
    P.regional_build(parts, tallies, f"file://{tmp_path}/out", P.Release("v", "2026-01-01", "2026-01-02"))
    assert seen.value == 60


def in_blocks(path, text, places):
    """A document in blocks that end at the places."""
    cuts = [0, *places, len(text)]
    path.write_bytes(b"".join(K.block(text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)))


def test_documents_in_blocks(spark, tmp_path):
    rng = random.Random(4)
    texts = {"a": json.dumps(document(300)).encode(), "b": json.dumps(document(40, 2), indent=2, ensure_ascii=False).encode(), "c": json.dumps(document(0)).encode()}
    for kind, path in (("plain", tmp_path / "plain"), ("blocked", tmp_path / "blocked")):
        path.mkdir()
        for name, text in texts.items():
            # borders lie behind braces, in strings too, and so within features
            behind = [i + 1 for i, c in enumerate(text) if c == ord("}")]
            if kind == "plain":
                (path / f"{name}.json").write_bytes(text)
            else:
                in_blocks(path / f"{name}.json.gz", text, sorted(rng.sample(behind, min(9, len(behind)))))
    assert gzip.decompress((tmp_path / "blocked/a.json.gz").read_bytes()) == texts["a"]
    rows = lambda df: sorted((r["file"].rsplit("/", 1)[-1].split(".")[0], r["place"], r["text"]) for r in df.collect())
    want = rows(K.feature_texts(spark, f"file://{tmp_path}/plain"))
    blocked = K.feature_texts(spark, f"file://{tmp_path}/blocked", blocked=True)
    assert rows(blocked) == want and len(want) == 340
    one = S.feature_collection(spark, f"file://{tmp_path}/blocked/a.json.gz", blocked=True)
    assert [r[0] for r in one.orderBy("_pos").select("SITE_ID").collect()] == [f"S{i}" for i in range(300)]


def test_blocks_are_found_and_read_in_pieces(tmp_path, monkeypatch):
    monkeypatch.setattr(K, "BLOCK", 64)
    text = json.dumps(document(50)).encode()
    cut = text.index(b"}", 4000) + 1
    in_blocks(tmp_path / "d.gz", text, [cut])
    batch = lambda size: pa.RecordBatch.from_pydict({"file": [f"file://{tmp_path}/d.gz"], "length": [size]})
    whole = (tmp_path / "d.gz").stat().st_size
    (found,) = K._members([batch(whole)])
    assert found.num_rows == 2 and sum(found["size"].to_pylist()) == whole
    pieces = list(K.inflated([found]))
    assert len(pieces) > 20 and b"".join(b.tobytes() for _, _, b in pieces) == text
    assert b"".join(b.tobytes() for _, at, b in pieces if at == 0) == text[:cut]
    assert all(b[-1] == ord("}") for _, _, b in pieces[:-1])
    for bad in (gzip.compress(text), (tmp_path / "d.gz").read_bytes()[:-9]):
        (tmp_path / "d.gz").write_bytes(bad)
        with pytest.raises(ValueError, match="not in blocks"):
            list(K._members([batch(len(bad))]))
    (tmp_path / "d.gz").write_bytes(bad[:-20])
    with pytest.raises(ValueError, match="cut off"):
        list(K.inflated([found]))


def test_a_scan_of_documents_takes_less_disk_than_their_text(spark):
    """Documents, the files that they are joined from and the lines read from them are all compressed."""
    from tidemark.plans import outputs
    from tidemark.session import shared_dir

    root = Path(shared_dir(spark).removeprefix("file://"))
    used = lambda: sum(p.stat().st_size for p in root.rglob("*") if p.is_file())
    text = outputs.feature_lines(spark, "/root/testdata/sf0.01").agg(F.sum(F.octet_length("feature"))).head()[0]
    before = used()
    rows = outputs.collection_scan(spark, "/root/testdata/sf0.01").count()
    assert rows == 15_000 and used() - before < text * 0.6
