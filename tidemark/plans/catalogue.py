"""Registered queries over the reference domain and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as DT
from ..functions import decode as D
from ..functions import geometry as G
from ..functions.fixed import CATEGORIES, COARSE, CODED, DEFAULT, LEVELS, REGIONS
from ..operators import adapt as A
from ..operators import catalog as C
from ..operators import exclude as X
from ..operators import manifest as MF
from ..operators import mirror as M
from ..operators import regions as R
from ..sources import readers as S
from . import views as V

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- SQL of the views -------------------------------------------------------------------------

_LEVEL = {0: "allowed", 1: "prohibited", 2: "restricted", 3: "unknown"}


def _rank(i: int) -> str:
    return f"CASE ({V.code_expr(i)}) WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 0 THEN 2 WHEN 3 THEN 3 ELSE 4 END"


def _label(rank: str) -> str:
    return f"list_element([{', '.join(repr(x) for x in LEVELS)}], CAST(({rank}) AS INT) + 1)"


_AT = {c: i for i, c in enumerate(CODED)}
_O = "o AS (SELECT o_orderkey AS k, o_custkey AS c, o_totalprice / 4 AS area, CAST(o_orderdate AS DATE) AS last_update FROM orders)"
_COARSE = {name: f"least({', '.join(f'r_{c}' for c in cs)}, 4)" for name, cs in COARSE.items()}
_RANKED = f"{_O}, r AS (SELECT *, {', '.join(f'{_rank(i)} AS r_{c}' for c, i in _AT.items())} FROM o)"
_BAN = f"(({_COARSE['entry']}) = 0 OR ({_COARSE['anchoring']}) = 0)"
_X = [f"((c * 37 + k * 101 + {i * 1777}) % 36000 / 100.0::DOUBLE - 180)" for i in range(3)]
_Y = [f"((k * 53 + {i * 911}) % 18000 / 100.0::DOUBLE - 90)" for i in range(3)]
_HALF = "((k % 7 + 1) / 100.0::DOUBLE)"


def _side(at: list[str]) -> str:
    """The extent of the first 1 to 3 squares in one direction."""
    ends = [[f"({v} {sign} {_HALF})" for v in at] for sign in "+-"]
    return " ".join(["CASE k % 3", *(f"WHEN {n - 1} THEN {'greatest' if n > 1 else ''}({', '.join(ends[0][:n])}) - {'least' if n > 1 else ''}({', '.join(ends[1][:n])})" for n in (1, 2, 3)), "END"])


_SPAN = f"greatest(CASE WHEN k % 97 = 0 THEN 359 ELSE {_side(_X)} END, {_side(_Y)})"
_REASON = f"CASE WHEN k % 12 + 1 = 9 THEN 'categoryId' WHEN area > 50000 AND NOT {_BAN} THEN 'areaWithoutHardBan' WHEN {_SPAN} > 90 AND NOT {_BAN} THEN 'bboxSpanWithoutHardBan' END"
_JUDGED = f"{_RANKED}, j AS (SELECT *, {_REASON} AS drop_reason, k % 3 + 1 AS components, 'P' || (k % 3) || CASE WHEN k % 29 = 0 THEN '_HighSeas_x' ELSE '_Coast_x' END AS part FROM r)"
_COMP = f"""{_JUDGED}, g AS (SELECT k, c, CAST(unnest(range(0, k % 3 + 1)) AS INT) AS i FROM j WHERE drop_reason IS NULL AND k % 29 <> 0),
p AS (SELECT k, i, (c * 37 + k * 101 + i * 1777) % 36000 / 100.0::DOUBLE - 180 AS lon, (k * 53 + i * 911) % 18000 / 100.0::DOUBLE - 90 AS lat, (k % 7 + 1) / 100.0::DOUBLE AS half FROM g),
b AS (SELECT k, i, CASE WHEN k % 97 = 0 THEN -179.5 ELSE lon - half END AS minx, lat - half AS miny, CASE WHEN k % 97 = 0 THEN 179.5 ELSE lon + half END AS maxx, lat + half AS maxy FROM p)"""
_REGION = "CASE WHEN maxx - minx > 180 THEN 'sw-pacific' " + " ".join(f"WHEN (minx + maxx) / 2 >= {w} AND (minx + maxx) / 2 < {e} AND (miny + maxy) / 2 >= {s} AND (miny + maxy) / 2 < {n} THEN '{name}'" for name, w, s, e, n in REGIONS) + " ELSE 'other' END"


def _coarse_label(name: str) -> str:
    return _label(_COARSE[name])


_IDX = "idx AS (SELECT 'S' || o_orderkey AS site_id, CAST(o_orderkey % 3 + 1 AS DOUBLE) AS v_major, CAST(o_custkey % 4 AS DOUBLE) AS v_minor, CAST(o_orderdate AS DATE) AS last_update FROM orders WHERE o_orderkey % 50 <> 0)"
_ROWS = "rows_ AS (SELECT page, 'S' || o_orderkey AS site_id, CAST(o_orderkey % 3 + 1 AS DOUBLE) AS v_major, CAST(o_custkey % 4 + CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END + page - 1 AS DOUBLE) AS v_minor, CAST(o_orderdate AS DATE) AS last_update, o_custkey % 40 = 0 AS hs FROM orders, (VALUES (1), (2)) t(page) WHERE o_orderkey % 40 <> 1 AND (page = 1 OR o_orderkey % 23 = 0))"
_CAT = f"{_ROWS}, cat AS (SELECT site_id, v_major, v_minor, last_update, hs FROM rows_ QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY page DESC) = 1)"
_DIFF = f"{_IDX}, {_CAT}, diff AS (SELECT * FROM (SELECT coalesce(m.site_id, a.site_id) AS site_id, CASE WHEN m.site_id IS NOT NULL AND (a.site_id IS NULL OR a.hs) THEN 'removed' WHEN m.site_id IS NULL AND NOT a.hs THEN 'added' WHEN m.site_id IS NOT NULL AND a.site_id IS NOT NULL AND (m.v_major IS DISTINCT FROM a.v_major OR m.v_minor IS DISTINCT FROM a.v_minor OR coalesce(a.last_update > m.last_update, false)) THEN 'changed' END AS kind FROM idx m FULL OUTER JOIN cat a ON m.site_id = a.site_id) WHERE kind IS NOT NULL)"
_WIN = """w AS (SELECT CAST(user_id AS VARCHAR) AS site_id, event_type = 'error' OR event_type = 'signup' AS gone, CAST(event_id % 5 AS DOUBLE) AS v_major, event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 6 HOUR),
act AS (SELECT site_id, v_major FROM w WHERE NOT gone QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY event_id DESC) = 1),
u AS (SELECT DISTINCT user_id, CAST(user_id AS VARCHAR) AS site_id FROM events),
wi AS (SELECT site_id FROM u WHERE user_id % 3 <> 0),
wp AS (SELECT site_id, CAST(user_id % 5 AS DOUBLE) AS v_major FROM u WHERE user_id % 3 = 0 AND user_id % 2 = 0)"""
_KIND = f"{_WIN}, kinds AS (SELECT site_id, CASE WHEN site_id IN (SELECT site_id FROM wi) THEN 'changed' WHEN site_id IN (SELECT site_id FROM wp) THEN 'refetch' ELSE 'added' END AS kind FROM act), rem AS (SELECT DISTINCT site_id FROM w WHERE gone AND (site_id IN (SELECT site_id FROM wi) OR site_id IN (SELECT site_id FROM wp)) AND site_id NOT IN (SELECT site_id FROM act))"
_LINES = """l AS (SELECT 'sh' || (c_custkey % 8) AS shard, c_custkey AS seq, CASE WHEN c_custkey % 31 = 0 THEN '' ELSE 'C' || c_custkey END AS site_id, c_name AS props, 'old' || c_custkey AS geometry FROM customer),
rf AS (SELECT 'C' || c_custkey AS site_id, 'new ' || c_name AS props, CASE WHEN c_custkey % 9 <> 0 THEN 'new' || c_custkey END AS geometry FROM customer WHERE c_custkey % 5 = 0 UNION ALL SELECT 'U' || s_suppkey, s_name, CASE WHEN s_suppkey % 9 <> 0 THEN 'new' || s_suppkey END FROM supplier),
rm AS (SELECT 'C' || c_custkey AS site_id FROM customer WHERE c_custkey % 45 = 0 OR c_custkey % 11 = 0),
used AS (SELECT site_id FROM rf WHERE site_id IN (SELECT site_id FROM l) AND site_id NOT IN (SELECT site_id FROM rm))"""


# --- decoding ---------------------------------------------------------------------------------


@query(f"WITH {_RANKED} SELECT k AS site_key, {_label('r_anchoring')} AS anchoring, r_anchoring AS anchoring_rank, {_label('least(r_dredging, r_dredging_dumping)')} AS stricter FROM r")
def level_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = V.ranked(spark, sf_dir)
    return r.select(F.col("k").alias("site_key"), D.level(F.col("anchoring")).alias("anchoring"), F.col("r_anchoring").alias("anchoring_rank"), D.label(D.stricter(F.col("r_dredging"), F.col("r_dredging_dumping"))).alias("stricter"))


@query(f"WITH {_RANKED} SELECT k AS site_key, {', '.join(f'{_label(x)} AS {name}' for name, x in _COARSE.items())} FROM r")
def coarse_restrictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.ranked(spark, sf_dir).select(F.col("k").alias("site_key"), D.coarse().alias("x")).select("site_key", "x.*")


@query(f"WITH {_RANKED}, long AS ({' UNION ALL '.join(f"SELECT k, '{c}' AS activity, r_{c} AS rk FROM r" for c in CODED)}) SELECT activity, {_label('rk')} AS level, count(*) AS n FROM long GROUP BY ALL")
def raw_levels_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.unpivot_levels(V.ranked(spark, sf_dir), ["k"]).groupBy("activity", "level").agg(F.count("*").alias("n"))



@query(
    f"""WITH {_O}, t AS (SELECT *, [{', '.join(repr(x) for x in [*CATEGORIES, V.DRIFT])}] AS labels,
 CASE WHEN k % 6 > 0 THEN 'http://u/' || (k % 6) END AS u1, CASE WHEN k % 2 = 0 THEN 'http://u/' || (k % 3) END AS u2, CASE WHEN k % 7 > 3 THEN 'http://u/1' END AS u3 FROM o)
SELECT 'S' || k AS site_id, CASE WHEN k % 5 = 0 THEN '(unnamed area)' ELSE 'Area ' || k END AS name, CASE WHEN k % 12 < 11 THEN CAST(k % 12 + 1 AS VARCHAR) ELSE 'unknown' END AS category_id,
 CASE k % 4 WHEN 1 THEN k || '; ' || c WHEN 2 THEN k || '_B' END AS wdpa_id, CASE k % 3 WHEN 1 THEN 'II' WHEN 2 THEN 'Unassigned; VI' END AS iucn_cat,
 CASE k % 4 WHEN 0 THEN true WHEN 1 THEN false END AS tribal_exemption, area AS marine_area,
 concat_ws(' ', u1, CASE WHEN u2 IS DISTINCT FROM u1 THEN u2 END, CASE WHEN u3 IS DISTINCT FROM u1 AND u3 IS DISTINCT FROM u2 THEN u3 END) AS source_urls,
 nullif(concat_ws(chr(10) || chr(10), CASE WHEN k % 2 = 0 THEN 'Line' || k || chr(10) || 'two' END, CASE WHEN k % 3 = 0 THEN 'No  entry' END), '') AS summary,
 CAST(k % 3 + 1 AS DOUBLE) AS v_major, CAST(c % 4 AS DOUBLE) AS v_minor FROM t"""
)
def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = V.ranked(spark, sf_dir)
    for c in ("country", "state", "managing_authority", "designation", "lfp", "season", "effective_from", "effective_to"):
        s = s.withColumn(c, F.lit(None).cast("string"))
    i = D.identity(s)
    return i.select(F.col("siteId").alias("site_id"), "name", F.col("categoryId").alias("category_id"), F.col("wdpaId").alias("wdpa_id"), F.col("iucnCat").alias("iucn_cat"), F.col("tribalExemption").alias("tribal_exemption"), F.col("marineArea").alias("marine_area"), F.array_join("sourceUrls", " ").alias("source_urls"), "summary", F.col("siteVersion.major").alias("v_major"), F.col("siteVersion.minor").alias("v_minor"))


@query(r"""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '^\s+|\s+$', '', 'g'), '(?i)<br\s*/?>', chr(10), 'g'), '[ \t]+\n', chr(10), 'g'), '^\s+|\s+$', '', 'g') AS cleaned FROM pages""")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", D.clean_text(F.col("html")).alias("cleaned"))


# --- exclusion --------------------------------------------------------------------------------


@query(f"WITH {_JUDGED} SELECT k AS site_key, drop_reason, {_BAN} AS hard_ban FROM j")
def drop_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.judged(spark, sf_dir).select(F.col("k").alias("site_key"), "drop_reason", X.hard_ban().alias("hard_ban"))


_TALLY = f"""{_JUDGED}, t AS (SELECT part AS partition, part LIKE '%HighSeas%' AS ex, * FROM j),
ty AS (SELECT partition, count(*) FILTER (NOT ex AND drop_reason = 'categoryId') AS "categoryId", count(*) FILTER (NOT ex AND drop_reason = 'areaWithoutHardBan') AS "areaWithoutHardBan", count(*) FILTER (NOT ex AND drop_reason = 'bboxSpanWithoutHardBan') AS "bboxSpanWithoutHardBan", CAST(max(CASE WHEN ex THEN 1 ELSE 0 END) AS BIGINT) AS "partitionDrop", count(*) FILTER (NOT ex) AS "featuresIn", count(*) FILTER (NOT ex AND drop_reason IS NULL) AS "kept", CAST(coalesce(sum(components) FILTER (NOT ex AND drop_reason IS NULL), 0) AS BIGINT) AS "componentsFull", CAST(coalesce(sum(components) FILTER (NOT ex AND drop_reason IS NULL), 0) AS BIGINT) AS "componentsDisplay", CAST(0 AS BIGINT) AS "simplifyFallbacks", count(*) FILTER (ex) AS features_skipped FROM t GROUP BY partition)"""


@query(f"WITH {_TALLY} SELECT * FROM ty")
def exclusion_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.tally(V.judged(spark, sf_dir))


_SUMMED = ", ".join(f'CAST(sum("{c}") AS BIGINT) AS "{c}"' for c in [*X.REASONS, "partitionDrop", *X.COUNTS])


@query(f"WITH {_TALLY} SELECT {_SUMMED}, string_agg(partition, ',' ORDER BY partition) AS partitions FROM ty")
def exclusion_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.merge(X.tally(V.judged(spark, sf_dir)))


# --- geometry and regions ---------------------------------------------------------------------


@query(f"WITH {_COMP} SELECT k AS site_key, i AS component_index FROM b")
def explode_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.components(spark, sf_dir).select(F.col("k").alias("site_key"), "component_index")


@query(f"WITH {_COMP} SELECT k AS site_key, i AS component_index, minx, miny, maxx, maxy, (minx + maxx) / 2 AS center_x, (miny + maxy) / 2 AS center_y, maxx - minx > 180 AS crosses FROM b")
def component_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.col("bbox")
    x, y = G.center(b)
    return V.components(spark, sf_dir).select(F.col("k").alias("site_key"), "component_index", "bbox.*", x.alias("center_x"), y.alias("center_y"), G.crosses_antimeridian(b).alias("crosses"))


_RND = lambda x, d: f"floor(({x}) * 1e{d} + 0.5) / 1e{d}"


@query(f"WITH {_COMP} SELECT k AS site_key, i AS component_index, {_RND('minx / 7', 5)} AS x0, {_RND('miny / 7', 5)} AS y0, {_RND('maxx / 7', 5)} AS x1, {_RND('maxy / 7', 5)} AS y1, 5 AS vertices FROM b")
def round_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sevenths, so that there are digits to round
    c = V.components(spark, sf_dir).withColumn("polygon", F.transform("polygon", lambda r: F.transform(r, lambda p: F.transform(p, lambda v: v / 7))))
    c = c.withColumn("d", F.element_at(G.rounded(F.col("polygon"), DEFAULT.decimals), 1))
    return c.select(F.col("k").alias("site_key"), "component_index", F.expr("d[0][0] AS x0"), F.expr("d[0][1] AS y0"), F.expr("d[2][0] AS x1"), F.expr("d[2][1] AS y1"), F.size("d").alias("vertices"))


@query(f"WITH {_COMP}, q AS (SELECT {_REGION} AS region, k % 23 = 0 AS bad FROM b) SELECT region, 401 * count(*) AS vertices_in, CAST(sum(CASE WHEN bad THEN 401 ELSE 5 END) AS BIGINT) AS vertices_out, count(*) FILTER (WHERE bad) AS fallbacks FROM q GROUP BY region")
def simplify_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every component's ring with 400 points on its sides, thinned again: by region vertices in and out and fallbacks.

    Every 19th key's ring is far below the tolerance and keeps its corners all the same; every 23rd's is one point.
    """
    c = R.tag(V.components(spark, sf_dir))
    ring = F.element_at("polygon", 1)
    size = F.when(F.col("k") % 23 == 0, 0.0).when(F.col("k") % 19 == 0, 2.0**-10).otherwise(1.0)
    ring = F.transform(ring, lambda p: F.transform(p, lambda v: v * size))
    s = G.simplify_display(c.withColumn("polygon", F.arrow_udf(V.dense, G.POLYGON)(ring)).select("region", "polygon"), DEFAULT.tolerance_deg, DEFAULT.decimals)
    return s.groupBy("region").agg(F.sum("vertices_in").alias("vertices_in"), F.sum("vertices_out").alias("vertices_out"), F.count_if("fallback").alias("fallbacks"))


@query(f"WITH {_COMP} SELECT k AS site_key, i AS component_index, {_REGION} AS region FROM b")
def region_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.tag(V.components(spark, sf_dir)).select(F.col("k").alias("site_key"), "component_index", "region")


def box_regions(spark: SparkSession) -> DataFrame:
    """The default tiling as geometry rows."""
    rows = [(i, name, [[[[float(w), float(s)], [float(e), float(s)], [float(e), float(n)], [float(w), float(n)], [float(w), float(s)]]]]) for i, (name, w, s, e, n) in enumerate(REGIONS)]
    return spark.createDataFrame(rows, f"ordinal int, region string, geometry {G.GEOMETRY}")


@query(f"WITH {_COMP} SELECT region, count(*) AS n FROM (SELECT {_REGION} AS region FROM b) GROUP BY region")
def region_tag_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = R.tag_by_join(V.components(spark, sf_dir), box_regions(spark))
    return tagged.groupBy("region").agg(F.count("*").alias("n"))


@query(
    f"""WITH {_COMP}, t AS (SELECT o_orderkey AS ordinal, o_orderkey * 7919 % 36000 / 100.0::DOUBLE - 180 AS x, o_orderkey * 104729 % 18000 / 100.0::DOUBLE - 90 AS y, (o_orderkey % 40 + 1) / 10.0::DOUBLE + 0.005::DOUBLE AS h FROM orders),
ct AS (SELECT DISTINCT (minx + maxx) / 2 AS cx, (miny + maxy) / 2 AS cy FROM b WHERE maxx - minx <= 180),
f AS (SELECT cx, cy, min(ordinal) AS ordinal FROM ct JOIN t ON cx BETWEEN x - h AND x + h AND cy BETWEEN y - h AND y + h WHERE ordinal % 2 = 0 OR abs(cx - x) + abs(cy - y) < h GROUP BY cx, cy)
SELECT k AS site_key, i AS component_index, CASE WHEN maxx - minx > 180 THEN 'sw-pacific' ELSE coalesce('R' || ordinal, 'other') END AS region FROM b LEFT JOIN f ON cx = (minx + maxx) / 2 AND cy = (miny + maxy) / 2"""
)
def region_tag_by_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tiling with as many regions as there are orders."""
    tagged = R.tag_by_cells(V.components(spark, sf_dir), V.many_regions(spark, sf_dir))
    return tagged.select(F.col("k").alias("site_key"), "component_index", "region")


_META = f"{_COMP}, meta AS (SELECT region, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy, count(*) AS feature_count FROM (SELECT *, {_REGION} AS region FROM b) GROUP BY region)"


@query(f"WITH {_META} SELECT * FROM meta")
def region_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.region_meta(R.tag(V.components(spark, sf_dir)))


@query(f"WITH {_META} SELECT region, v AS variant, region || '.' || v || '.parquet' AS name, feature_count * 100 + length(v) AS size, minx, miny, maxx, maxy, feature_count FROM meta, (VALUES ('full'), ('display')) t(v) WHERE NOT (region = 'other' AND v = 'full')")
def manifest_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = region_meta(spark, sf_dir)
    files = meta.select(F.explode(F.array(*(F.struct(F.concat("region", F.lit(f".{v}.parquet")).alias("name"), (F.col("feature_count") * 100 + len(v)).alias("size")) for v in MF.VARIANTS))).alias("f")).select("f.*").where("name <> 'other.full.parquet'")
    return MF.pair_assets(meta, files)


# --- catalogue and mirror ---------------------------------------------------------------------


@query(f"WITH {_CAT} SELECT * FROM cat")
def catalog_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.catalog(V.catalog_rows(spark, sf_dir))


@query(f"WITH {_DIFF} SELECT * FROM diff")
def census_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.census_diff(V.index(spark, sf_dir), S.catalog(V.catalog_rows(spark, sf_dir)))


@query(f"WITH {_KIND} SELECT * FROM kinds")
def window_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, parked = V.window_stores(spark, sf_dir)
    return C.classify(index, parked, C.split_window(V.window_rows(spark, sf_dir))[0])


@query(f"WITH {_KIND} SELECT * FROM rem")
def removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, parked = V.window_stores(spark, sf_dir)
    active, gone = C.split_window(V.window_rows(spark, sf_dir))
    return C.removals(index, parked, gone, active)


@query("SELECT DISTINCT CAST(user_id AS VARCHAR) AS site_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 6 HOUR AND event_type <> 'signup'")
def changed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.changed_ids(V.window_rows(spark, sf_dir))


@query(f"WITH {_WIN} SELECT act.site_id, coalesce(wp.v_major IS NOT DISTINCT FROM act.v_major AND wp.site_id IS NOT NULL, false) AS skipped FROM act LEFT JOIN wp ON act.site_id = wp.site_id WHERE act.site_id NOT IN (SELECT site_id FROM wi)")
def withheld_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, parked = V.window_stores(spark, sf_dir)
    active = C.split_window(V.window_rows(spark, sf_dir))[0]
    return C.split_added(active.join(index, "site_id", "left_anti"), active, parked)


@query(
    f"""WITH {_DIFF}, s AS (SELECT count(*) FILTER (kind = 'added') AS added, count(*) FILTER (kind = 'changed') AS changed, count(*) FILTER (kind = 'removed') AS removed, count(*) FILTER (kind = 'refetch') AS refetch FROM diff),
z AS (SELECT s.*, (SELECT count(*) FROM idx) AS mirror_size, (SELECT count(*) FROM cat) AS catalog_size FROM s)
SELECT *, CASE WHEN mirror_size > 0 THEN CASE WHEN removed > least(200, ceil(mirror_size * 0.02)) THEN 'too many removals' WHEN added + changed + removed > ceil(mirror_size * 0.5) THEN 'too many changes' END END AS delta_fault,
 CASE WHEN mirror_size > 0 THEN CASE WHEN catalog_size < mirror_size * 0.5 THEN 'half-empty catalogue' WHEN removed > mirror_size * 0.1 THEN 'too many removals' END END AS census_fault FROM z"""
)
def sanity_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = S.catalog(V.catalog_rows(spark, sf_dir))
    sizes = C.delta_sizes(census_diff(spark, sf_dir), V.index(spark, sf_dir)).crossJoin(catalog.agg(F.count("*").alias("catalog_size")))
    return sizes.select("*", C.delta_fault().alias("delta_fault"), C.census_fault().alias("census_fault"))


@query(
    f"""WITH {_LINES} SELECT shard, seq, l.site_id, CASE WHEN rf.site_id IS NOT NULL THEN rf.props ELSE l.props END AS props, coalesce(rf.geometry, l.geometry) AS geometry, CASE WHEN rf.site_id IS NOT NULL THEN 'update' ELSE 'keep' END AS action
FROM l LEFT JOIN rf ON l.site_id = rf.site_id AND l.site_id <> '' WHERE l.site_id = '' OR l.site_id NOT IN (SELECT site_id FROM rm)
UNION ALL SELECT 'updates', NULL, site_id, props, geometry, 'append' FROM rf WHERE site_id NOT IN (SELECT site_id FROM used) AND geometry IS NOT NULL"""
)
def rewrite_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, new, gone = V.mirror_lines(spark, sf_dir), V.refreshed(spark, sf_dir), V.removed_lines(spark, sf_dir)
    used = M.consumed(lines, new, gone)
    return M.rewrite_lines(lines, new, gone).unionByName(M.new_lines(new, used).withColumn("seq", F.lit(None).cast("long")))


@query(
    f"""WITH {_LINES}, ix AS (SELECT 'C' || c_custkey AS site_id, CAST(c_nationkey AS DOUBLE) AS v_major, CAST(1 AS DOUBLE) AS v_minor FROM customer WHERE c_custkey % 31 <> 0),
pk AS (SELECT 'U' || s_suppkey AS site_id, CAST(1 AS DOUBLE) AS v_major, CAST(2 AS DOUBLE) AS v_minor FROM supplier WHERE s_suppkey % 2 = 0),
tch AS (SELECT site_id FROM rm UNION SELECT site_id FROM rf),
en AS (SELECT 'C' || c_custkey AS site_id, CAST(c_custkey % 6 AS DOUBLE) AS v_major FROM customer),
nw AS (SELECT rf.site_id, en.v_major, CAST(NULL AS DOUBLE) AS v_minor, rf.geometry IS NOT NULL OR rf.site_id IN (SELECT site_id FROM used) AS shown FROM rf LEFT JOIN en ON rf.site_id = en.site_id)
SELECT 'index' AS store, site_id, v_major, v_minor FROM ix WHERE site_id NOT IN (SELECT site_id FROM tch) UNION ALL SELECT 'index', site_id, v_major, v_minor FROM nw WHERE shown
UNION ALL SELECT 'parked', site_id, v_major, v_minor FROM pk WHERE site_id NOT IN (SELECT site_id FROM tch) UNION ALL SELECT 'parked', site_id, v_major, v_minor FROM nw WHERE NOT shown"""
)
def patch_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, new, gone = V.mirror_lines(spark, sf_dir), V.refreshed(spark, sf_dir), V.removed_lines(spark, sf_dir)
    entries = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr("concat('C', c_custkey) AS site_id", "CAST(c_custkey % 6 AS DOUBLE) AS v_major", "CAST(NULL AS DOUBLE) AS v_minor", "DATE'2024-06-01' AS last_update")
    idx, par = M.patch_stores(V.index_lines(spark, sf_dir), V.parked_lines(spark, sf_dir), gone, new, M.consumed(lines, new, gone), entries)
    cols = ["site_id", "v_major", "v_minor"]
    return idx.select(F.lit("index").alias("store"), *cols).unionByName(par.select(F.lit("parked").alias("store"), *cols))


@query("SELECT 'S' || l_orderkey AS site_id, l_linenumber AS fragment, l_partkey AS part FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC) = 1")
def fold_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("concat('S', l_orderkey) AS site_id", "l_linenumber AS fragment", "l_partkey AS seq")
    return M.fold_fragments(f).select("site_id", "fragment", F.col("seq").alias("part"))


@query("SELECT l_linenumber AS fragment, count(DISTINCT l_orderkey) AS sites FROM lineitem GROUP BY l_linenumber")
def fragment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.fragment_counts(spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("concat('S', l_orderkey) AS site_id", "l_linenumber AS fragment"))


@query(f"WITH {_IDX} SELECT count(*) AS site_count, DATE '2026-05-28' AS last_sweep_date, CAST(NULL AS DATE) AS last_full_census_date FROM idx")
def seed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.seed_state(V.index(spark, sf_dir), "2026-05-28", "2026-06-01").select("site_count", "last_sweep_date", "last_full_census_date")


@query(f"WITH {_CAT} SELECT max(last_update) AS newest FROM cat WHERE NOT hs")
def newest_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.newest_update(S.catalog(V.catalog_rows(spark, sf_dir)))


# --- dates ------------------------------------------------------------------------------------

_DATES = """d AS (SELECT page_id, CASE WHEN page_id % 5 > 0 THEN 'x Navigator_AllSites_' || lpad(CAST(page_id % 14 AS VARCHAR), 2, '0') || lpad(CAST(page_id % 31 AS VARCHAR), 2, '0') || '24_y' ELSE '' END AS a, CASE WHEN page_id % 3 > 0 THEN ' Last update: ' || lpad(CAST(page_id % 12 + 1 AS VARCHAR), 2, '0') || '-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') || '-2024' ELSE '' END AS b,
 CASE WHEN page_id % 5 > 0 THEN try_strptime('2024-' || lpad(CAST(page_id % 14 AS VARCHAR), 2, '0') || '-' || lpad(CAST(page_id % 31 AS VARCHAR), 2, '0'), '%Y-%m-%d')::DATE END AS da,
 CASE WHEN page_id % 3 > 0 THEN make_date(2024, page_id % 12 + 1, page_id % 28 + 1) END AS db FROM pages),
e AS (SELECT page_id, CASE WHEN da IS NULL THEN db WHEN db IS NULL THEN da ELSE greatest(da, db) END AS dataset_date FROM d)"""


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose html ends in marks derived from the page's id, some of them no dates."""
    p = spark.read.parquet(f"{sf_dir}/pages.parquet")
    a = F.expr("CASE WHEN page_id % 5 > 0 THEN concat('x Navigator_AllSites_', lpad(page_id % 14, 2, '0'), lpad(page_id % 31, 2, '0'), '24_y') ELSE '' END")
    b = F.expr("CASE WHEN page_id % 3 > 0 THEN concat(' Last update: ', lpad(page_id % 12 + 1, 2, '0'), '-', lpad(page_id % 28 + 1, 2, '0'), '-2024') ELSE '' END")
    return p.select("page_id", DT.page_date(F.concat(F.coalesce("html", F.lit("")), a, b)).alias("dataset_date"))


@query(f"WITH {_DATES} SELECT page_id, dataset_date FROM e")
def dataset_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(spark, sf_dir)


@query(f"WITH {_DATES} SELECT page_id, CASE WHEN dataset_date IS NULL THEN false WHEN page_id % 4 = 0 THEN true ELSE dataset_date > DATE '2024-06-15' END AS newer, coalesce(date_diff('day', dataset_date, DATE '2024-12-31'), 2147483647) AS age FROM e")
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = F.expr("CASE WHEN page_id % 4 <> 0 THEN DATE'2024-06-15' END")
    return _dated(spark, sf_dir).select("page_id", DT.is_newer(F.col("dataset_date"), published).alias("newer"), DT.days_between(F.col("dataset_date"), F.lit("2024-12-31").cast("date")).cast("long").alias("age"))


# --- second source ----------------------------------------------------------------------------


@query("SELECT coalesce(CASE WHEN s_suppkey % 3 > 0 THEN 'P' || s_suppkey END, 'Q' || s_suppkey) AS site_id, CASE WHEN s_suppkey % 4 > 0 THEN s_acctbal END AS marine_area, CASE s_suppkey % 5 WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE WHEN 2 THEN 25.0::DOUBLE END AS anchoring, 's; ' || s_suppkey AS wdpa_id, s_suppkey % 6 > 1 AS has_geometry, CASE WHEN s_suppkey % 6 > 1 THEN 2 END AS dimensions, CAST(NULL AS VARCHAR) AS other_helpful_links FROM supplier")
def adapt_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    ring = "[[[1.5,2.5,0],[2,2.5,0],[2,3,0],[1.5,2.5,0]]]"
    api = s.select(
        F.expr("CASE WHEN s_suppkey % 3 > 0 THEN concat('P', s_suppkey) END AS ps_id"),
        F.expr("concat('Q', s_suppkey) AS site_id"),
        F.expr("CASE WHEN s_suppkey % 4 > 0 THEN CAST(s_acctbal AS STRING) ELSE 'none' END AS total_marine_area"),
        F.expr("CASE s_suppkey % 5 WHEN 0 THEN '0' WHEN 1 THEN ' 1 ' WHEN 2 THEN '2.5e1' WHEN 3 THEN '' ELSE 'NaN' END AS anchoring"),
        F.expr("concat('s; ', s_suppkey) AS wdpa_id"),
        F.lit("x").alias("ogc_fid"),
        F.struct(F.expr("CASE s_suppkey % 6 WHEN 0 THEN 'Point' WHEN 1 THEN NULL WHEN 2 THEN 'Polygon' WHEN 3 THEN 'Polygon' ELSE 'MultiPolygon' END").alias("type"), F.expr(f"CASE WHEN s_suppkey % 6 > 3 THEN '[{ring}]' ELSE '{ring}' END").alias("coordinates")).alias("site_boundary"),
    )
    a = A.adapt(api)
    return a.select(F.col("SITE_ID").alias("site_id"), "marine_area", "anchoring", "wdpa_id", F.col("geometry").isNotNull().alias("has_geometry"), F.when(F.col("geometry").isNotNull(), F.size(F.expr("geometry[0][0][0]"))).alias("dimensions"), "other_helpful_links")
