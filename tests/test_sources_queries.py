import gzip
import json

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.functions import decode as D
from tidemark.functions.fixed import CODED
from tidemark.operators import manifest as MF
from tidemark.plans import catalogue, outputs, views  # noqa: F401
from tidemark.sources import readers as S
from tidemark.sources import writers as W

SF = "/root/testdata/sf0.001"


def feature(i, **p):
    return {"type": "Feature", "properties": {"SITE_ID": i, "site_name": "n", "anchoring": 1, **p}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1.5, 0], [1, 1], [0, 0]]]}}


def test_collection_equals_ndjson_and_shards(spark, tmp_path):
    fs = [feature("a"), feature("b", marine_area="12")]
    fs[1]["properties"]["site_id"] = "other"
    del fs[1]["properties"]["SITE_ID"]
    (tmp_path / "c.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": fs}))
    (tmp_path / "n.ndjson").write_text("\n\n".join(map(json.dumps, fs)) + "\n")
    with gzip.open(tmp_path / "s1.ndjson.gz", "wt") as f:
        f.write("\n\n".join(map(json.dumps, fs)))
    one = S.feature_collection(spark, f"file://{tmp_path}/c.geojson").drop("_pos").orderBy("SITE_ID").collect()
    two = S.ndjson(spark, f"file://{tmp_path}/n.ndjson").orderBy("SITE_ID").collect()
    assert one == two and [r["SITE_ID"] for r in one] == ["a", "other"] and one[0]["anchoring"] == "1"
    sh = S.shards(spark, f"file://{tmp_path}/s1.ndjson.gz", 2).orderBy("_seq").collect()
    assert [(r["_shard"], r["site_id"]) for r in sh] == [("s1", "a"), ("s1", "other")]


def test_regions_tallies_sidecars_assets(spark, tmp_path):
    (tmp_path / "r.geojson").write_text(json.dumps({"features": [{"properties": {"region": "x"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}]}))
    r = S.regions(spark, f"file://{tmp_path}/r.geojson").head()
    assert (r["ordinal"], r["region"], len(r["geometry"][0][0])) == (0, "x", 4)
    d = tmp_path / "t"
    d.mkdir()
    (d / "t.json").write_text(json.dumps({"partition": "p", "drops": {"categoryId": 2}, "counts": {}}))
    assert S.tallies(spark, f"file://{d}").head()["drops"]["categoryId"] == 2
    meta = spark.createDataFrame([("x", 0.0, 0.0, 1.0, 1.0, 3)], "region string, minx double, miny double, maxx double, maxy double, feature_count long")
    a = tmp_path / "a"
    a.mkdir()
    (a / "x.full.parquet").write_bytes(b"abc")
    files = S.assets(spark, f"file://{a}", with_content=True)
    pairs = MF.pair_assets(meta, files.drop("path"))
    row = pairs.head()
    assert (row["variant"], row["size"], row["sha256"]) == ("full", 3, "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad")
    m = MF.manifest(pairs, F.lit("2026-05-28").cast("date"))
    W.write_manifest(m, f"file://{tmp_path}/m")
    got = json.loads(next(p for p in (tmp_path / "m").iterdir() if p.name.startswith("part")).read_text())
    assert got["version_tag"] == "v2026.05.28" and got["regions"][0]["assets"][0]["feature_count"] == 3


def test_documents_are_joined_from_ranges(spark, tmp_path):
    """Files of every range go into their shard's document in order; no task sorts a document."""
    rows = spark.range(500).select(F.when(F.col("id") % 5 > 0, "a").otherwise("b").alias("shard"), F.col("id").alias("seq"), F.concat(F.when(F.col("id").isin(0, 1), "").otherwise(","), F.format_string('{"n":%d}', "id")).alias("value"))
    W.write_documents(rows.repartitionByRange(13, "shard", "seq"), f"file://{tmp_path}/docs", '{"features":[', "]}")
    for shard, want in (("a", [i for i in range(500) if i % 5]), ("b", list(range(0, 500, 5)))):
        files = list((tmp_path / f"docs/shard={shard}").iterdir())
        assert [f["n"] for f in json.loads(files[0].read_text())["features"]] == want and len(files) == 1


def test_extracts_and_shards_out(spark, tmp_path):
    s = views.judged(spark, SF).limit(20)
    for c in ("country", "state", "managing_authority", "designation", "lfp", "season", "effective_from", "effective_to"):
        s = s.withColumn(c, F.lit(None).cast("string"))
    i = D.identity(s).select("siteId", F.col("coarse").alias("restrictions"), "raw", "sourceUrls", "siteVersion", F.expr("geometry[0]").alias("polygon"), F.lit("x").alias("region"))
    i = i.withColumn("display", F.col("polygon")).withColumn("bbox", F.struct(*(F.lit(0.0).alias(c) for c in ("minx", "miny", "maxx", "maxy"))))
    W.write_extracts(i, f"file://{tmp_path}/x")
    back = spark.read.parquet(f"file://{tmp_path}/x")
    assert back.count() == 40 and {r[0] for r in back.select("variant").distinct().collect()} == {"full", "display"}
    raw = json.loads(back.head()["raw"])
    assert list(raw) == CODED and json.loads(back.head()["siteVersion"])["major"] in (1, 2, 3)
    lines = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x")], "shard string, seq long, feature string")
    W.write_shards(lines, f"file://{tmp_path}/s")
    assert sorted(r[0] for r in spark.read.text(f"file://{tmp_path}/s/shard=a").collect()) == ["x", "y"]
    sizes = spark.createDataFrame([(1, 2, 3, 4), (0, 0, 0, 5), (0, 0, 0, 0)], "added long, changed long, removed long, refetch long")
    runs = W.run_summary(sizes, "2026-06-01", "2026-05-28").collect()
    assert runs[0]["version_tag"] == "v2026.06.01" and [(r["changed"], r["updated"], str(r["dataset_date"])) for r in runs] == [(True, 6, "2026-06-01"), (True, 5, "2026-06-01"), (False, 0, "2026-05-28")]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "customer supplier orders lineitem events pages".split():
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    v = v.item() if hasattr(v, "item") else v
    if isinstance(v, float):
        return None if v != v else round(v, 9)
    return v


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_against_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = duck.sql(catalogue.SQL[name])
    names = rel.columns
    assert sorted(names) == cols
    assert got == sorted((tuple(plain(dict(zip(names, r, strict=True))[c]) for c in cols) for r in rel.fetchall()), key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
