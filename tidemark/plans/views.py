"""Views of the reference domain over the driver's tables, by integer arithmetic that any SQL engine repeats."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import decode as D
from ..functions import geometry as G
from ..functions.fixed import CATEGORIES, CODED
from ..operators import exclude as X
from ..sources.readers import dealt

DRIFT = "Renamed Category"


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(spark.read.parquet(f"{sf_dir}/orders.parquet"), written=True)


def code_expr(i: int) -> str:
    """SQL of the raw code of coded column i: 0..3, else null."""
    x = f"((k * 31 + c * 17 + {i} * (k % 13 + 1) * 7) % 37)"
    return f"CASE WHEN {x} <= 3 THEN {x} END"


#: Sites of a range, about.
RANGE = 100_000


def sites(spark: SparkSession, sf_dir: str, ranged: bool = False) -> DataFrame:
    """Raw features with text properties, as a scan gives them, and their key k; ranged: in order of partition and k, in as many ranges as there are ``RANGE`` of them.

    The few columns that all others derive from are dealt, so neither the sampling of ranges nor their shuffle sees a wide row.
    """
    o = orders(spark, sf_dir).selectExpr("o_orderkey AS k", "o_custkey AS c", "o_totalprice / 4D AS area", "CAST(o_orderdate AS DATE) AS last_update", "concat('P', o_orderkey % 3, CASE WHEN o_orderkey % 29 = 0 THEN '_HighSeas_x' ELSE '_Coast_x' END) AS partition")
    if ranged:
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-o.count() // RANGE))
        o = o.repartitionByRange(n, "partition", "k").sortWithinPartitions("partition", "k")
    label = F.element_at(F.array(*map(F.lit, [*CATEGORIES, DRIFT])), (F.col("k") % 12 + 1).cast("int"))
    return o.select(
        "k",
        "c",
        "last_update",
        F.concat(F.lit("S"), F.col("k").cast("string")).alias("SITE_ID"),
        label.alias("category_name"),
        "partition",
        F.col("area").cast("string").alias("marine_area"),
        F.expr("CASE WHEN k % 5 = 0 THEN '  ' ELSE concat(' Area ', k, ' ') END").alias("site_name"),
        F.expr("CASE k % 4 WHEN 0 THEN '0' WHEN 1 THEN concat(k, '; ', c) WHEN 2 THEN concat(k, '_B') END").alias("wdpa_id"),
        F.expr("CASE k % 3 WHEN 0 THEN 'Unassigned' WHEN 1 THEN 'II' ELSE 'Unassigned; VI' END").alias("iucn_cat"),
        F.expr("CAST(k % 4 AS STRING)").alias("tribal"),
        F.expr("CASE WHEN k % 6 > 0 THEN concat('http://u/', k % 6) END").alias("url"),
        F.expr("CASE WHEN k % 2 = 0 THEN concat('http://u/', k % 3) END").alias("regulation_source"),
        F.expr("CASE WHEN k % 7 > 3 THEN 'http://u/1' END").alias("other_helpful_links"),
        F.expr("CASE WHEN k % 2 = 0 THEN concat('Line', k, ' <BR/>two') END").alias("purpose"),
        F.expr("CASE WHEN k % 3 = 0 THEN 'No  entry' END").alias("restrictions"),
        F.lit(None).cast("string").alias("allowed"),
        F.expr("CAST(k % 3 + 1 AS STRING)").alias("site_major_version"),
        F.expr("CAST(c % 4 AS STRING)").alias("site_minor_version"),
        *(F.expr(f"CAST({code_expr(i)} AS STRING)").alias(name) for i, name in enumerate(CODED)),
        geometry().alias("geometry"),
    )


def geometry():
    """1 to 3 squares; every 97th key's reach across the antimeridian."""

    def square(j):
        lon = (F.col("c") * 37 + F.col("k") * 101 + j * 1777) % 36000 / F.lit(100.0) - 180
        lat = (F.col("k") * 53 + j * 911) % 18000 / F.lit(100.0) - 90
        half = (F.col("k") % 7 + 1) / F.lit(100.0)
        wide = F.col("k") % 97 == 0
        x0, x1 = F.when(wide, -179.5).otherwise(lon - half), F.when(wide, 179.5).otherwise(lon + half)
        y0, y1 = lat - half, lat + half
        return F.array(F.array(F.array(x0, y0), F.array(x1, y0), F.array(x1, y1), F.array(x0, y1), F.array(x0, y0)))

    return F.transform(F.sequence(F.lit(0), (F.col("k") % 3).cast("int")), square)


def dense(rings: pa.Array) -> pa.Array:
    """Polygons of rings of five points, with 100 points on each side."""
    p = rings.flatten().flatten().to_numpy().reshape(-1, 5, 1, 2)
    t = np.arange(100).reshape(1, 1, 100, 1)
    sides = (p[:, :-1] + (p[:, 1:] - p[:, :-1]) * t / 100).reshape(-1, 400, 2)
    points = np.concatenate((sides, p[:, 0]), axis=1)
    every = lambda n, of: pa.ListArray.from_arrays(pa.array(np.arange(0, len(of) + 1, n, dtype=np.int32)), of)
    return every(1, every(401, every(2, pa.array(points.ravel()))))


def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.ranked(sites(spark, sf_dir))


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites with coarse levels, area, drop_reason, components and fallbacks."""
    s = ranked(spark, sf_dir).withColumn("coarse", D.coarse()).withColumn("area", D.safe_number(F.col("marine_area")))
    reason = X.drop_reason(D.category_id(F.col("category_name")), F.col("area"), G.span(G.geometry_bbox(F.col("geometry"))), X.hard_ban())
    return s.withColumns({"drop_reason": reason, "components": F.size("geometry"), "fallbacks": F.lit(0)})


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the sites that are kept."""
    kept = X.without_partitions(judged(spark, sf_dir)).where("drop_reason IS NULL").select("k", "SITE_ID", "geometry")
    return G.explode_components(kept)


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).where("o_orderkey % 50 <> 0").selectExpr("concat('S', o_orderkey) AS site_id", "CAST(o_orderkey % 3 + 1 AS DOUBLE) AS v_major", "CAST(o_custkey % 4 AS DOUBLE) AS v_minor", "CAST(o_orderdate AS DATE) AS last_update")


def catalog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of landed catalogue pages; every 23rd key is listed on two pages with different versions."""
    o = orders(spark, sf_dir).where("o_orderkey % 40 <> 1").withColumn("page", F.expr("explode(CASE WHEN o_orderkey % 23 = 0 THEN array(1, 2) ELSE array(1) END)"))
    return o.selectExpr("page", "o_orderkey AS pos", "concat('S', o_orderkey) AS site_id", "CAST(o_orderkey % 3 + 1 AS DOUBLE) AS v_major", "CAST(o_custkey % 4 + CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END + page - 1 AS DOUBLE) AS v_minor", "CAST(o_orderdate AS DATE) AS last_update", "CASE WHEN o_custkey % 40 = 0 THEN 'High Seas / International' ELSE 'Fiji' END AS country").withColumn("hs", D.high_seas(F.col("country"))).drop("country")


def window_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a change window: the events of the last six hours."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    last = e.agg((F.max("ts") - F.expr("INTERVAL 6 HOURS")).alias("since"))
    e = e.crossJoin(F.broadcast(last)).where("ts >= since")
    return e.selectExpr("user_id", "CAST(user_id AS STRING) AS site_id", "CASE WHEN event_type = 'error' THEN 'Removed' ELSE 'active' END AS status", "CASE WHEN event_type = 'signup' THEN 'High Seas / International' END AS country", "CAST(event_id % 5 AS DOUBLE) AS v_major", "CAST(NULL AS DOUBLE) AS v_minor", "CAST(ts AS DATE) AS last_update", "event_id AS seq").withColumn("hs", D.high_seas(F.col("country")))


def window_stores(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Index and parked store of the window's ids."""
    u = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id").distinct().withColumn("site_id", F.col("user_id").cast("string"))
    idx = u.where("user_id % 3 <> 0").selectExpr("site_id", "1D AS v_major", "CAST(NULL AS DOUBLE) AS v_minor", "DATE'2020-01-01' AS last_update")
    parked = u.where("user_id % 3 = 0 AND user_id % 2 = 0").selectExpr("site_id", "CAST(user_id % 5 AS DOUBLE) AS v_major", "CAST(NULL AS DOUBLE) AS v_minor")
    return idx, parked


def mirror_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return c.selectExpr("concat('sh', c_custkey % 8) AS shard", "c_custkey AS seq", "CASE WHEN c_custkey % 31 = 0 THEN '' ELSE concat('C', c_custkey) END AS site_id", "c_name AS props", "concat('old', c_custkey) AS geometry")


def refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refreshed records: every fifth customer and every supplier (new); every ninth withholds its geometry."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_custkey % 5 = 0").selectExpr("concat('C', c_custkey) AS site_id", "concat('new ', c_name) AS props", "CASE WHEN c_custkey % 9 <> 0 THEN concat('new', c_custkey) END AS geometry")
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").selectExpr("concat('U', s_suppkey) AS site_id", "s_name AS props", "CASE WHEN s_suppkey % 9 <> 0 THEN concat('new', s_suppkey) END AS geometry")
    return c.unionByName(s)


def removed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_custkey % 45 = 0 OR c_custkey % 11 = 0").selectExpr("concat('C', c_custkey) AS site_id")


def parked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    return s.where("s_suppkey % 2 = 0").selectExpr("concat('U', s_suppkey) AS site_id", "1D AS v_major", "2D AS v_minor")


def index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_custkey % 31 <> 0").selectExpr("concat('C', c_custkey) AS site_id", "CAST(c_nationkey AS DOUBLE) AS v_major", "1D AS v_minor", "DATE'2024-01-01' AS last_update")


def many_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A region an order, boxes and diamonds that overlap; none has a border where centres of components lie."""
    o = orders(spark, sf_dir).selectExpr("CAST(o_orderkey AS LONG) AS ordinal", "concat('R', o_orderkey) AS region", "o_orderkey * 7919 % 36000 / 100D - 180 AS x", "o_orderkey * 104729 % 18000 / 100D - 90 AS y", "(o_orderkey % 40 + 1) / 10D + 0.005D AS h", "o_orderkey % 2 = 0 AS box")
    ring = lambda *at: F.array(*(F.array(F.expr(p), F.expr(q)) for p, q in at))
    box = ring(("x - h", "y - h"), ("x + h", "y - h"), ("x + h", "y + h"), ("x - h", "y + h"), ("x - h", "y - h"))
    diamond = ring(("x - h", "y"), ("x", "y - h"), ("x + h", "y"), ("x", "y + h"), ("x - h", "y"))
    return o.select("ordinal", "region", F.array(F.array(F.when(F.col("box"), box).otherwise(diamond))).alias("geometry"))
