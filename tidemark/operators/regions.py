"""Routing components to regions, and what each region holds."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import ANTIMERIDIAN, ELSEWHERE, REGIONS
from ..functions.geometry import center, crosses_antimeridian, geometry_bbox, point_in_geometry
from ..session import kept


def region_of(box: Column, regions=REGIONS) -> Column:
    """The first region whose box holds the centre; west and south edges belong to a box, east and north do not.

    Right for tilings of boxes; ``tag_by_join`` takes any polygons.
    """
    x, y = center(box)
    out = F.when(box.isNull() | x.isNull(), ELSEWHERE).when(crosses_antimeridian(box), ANTIMERIDIAN)
    for name, west, south, east, north in regions:
        out = out.when((x >= west) & (x < east) & (y >= south) & (y < north), name)
    return out.otherwise(ELSEWHERE)


def tag(components: DataFrame, regions=REGIONS) -> DataFrame:
    return components.withColumn("region", region_of(F.col("bbox"), regions))


MAX_REGIONS = 10_000


def tag_by_join(components: DataFrame, regions: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Any tiling (ordinal, region, geometry): the first region in order that holds the centre.

    The tiling becomes one broadcast row, after its regions are counted; of more regions see ``tag_by_cells``.  Each component
    looks at the regions whose box holds its centre, so nothing is shuffled.  key is not needed.
    """
    if regions.limit(MAX_REGIONS + 1).count() > MAX_REGIONS:
        return tag_by_cells(components, regions)
    one = regions.select(F.struct("ordinal", "region", geometry_bbox(F.col("geometry")).alias("box"), "geometry").alias("r")).agg(F.array_sort(F.collect_list("r")).alias("__tiling"))
    x, y = center(F.col("bbox"))

    def holds(r: Column) -> Column:
        near = (F.col("__x") >= r["box"]["minx"]) & (F.col("__x") <= r["box"]["maxx"]) & (F.col("__y") >= r["box"]["miny"]) & (F.col("__y") <= r["box"]["maxy"])
        return near & point_in_geometry(r["geometry"], F.col("__x"), F.col("__y"))

    t = components.withColumns({"__x": x, "__y": y}).join(F.broadcast(one))
    first = F.get(F.filter("__tiling", holds), 0)["region"]
    region = F.when(F.coalesce(crosses_antimeridian(F.col("bbox")), F.lit(False)), ANTIMERIDIAN).otherwise(F.coalesce(first, F.lit(ELSEWHERE)))
    return t.withColumn("region", region).drop("__x", "__y", "__tiling")


#: Cells of level l have sides of 360 / 2^l degrees.
DEEPEST = 24
#: Points of one cell that meet in one task, about.
HOT_CELL = 100_000


def _cell(v: Column, level: Column, low: float) -> Column:
    return F.floor((v - low) * F.pow(F.lit(2.0), level) / 360).cast("long")


#: Regions of the first round; each later one takes GROWTH times as many as all before.
FIRST_ROUND = 4096
GROWTH = 3
#: A round of up to this many regions is broadcast.
SENT = 40_000


def _rounds(tiles: DataFrame, first: int) -> list:
    """Upper ends of the rounds' ranges of ordinals, the last one None: without an end."""
    n = tiles.count()
    sizes = []
    while first < n:
        sizes.append(first)
        first *= 1 + GROWTH
    if not sizes:
        return [None]
    ends = tiles.agg(F.percentile_approx("ordinal", [s / n for s in sizes], 100_000).alias("e")).head()["e"]
    return [*sorted(set(ends)), None]


def tag_by_cells(components: DataFrame, regions: DataFrame, hot: int = HOT_CELL, first: int = FIRST_ROUND) -> DataFrame:
    """``tag_by_join`` for tilings of any size, by an equi-join on cells of a grid.

    A region stands in the cells, four at most, that its box touches on the level where cells are just larger than the box; a
    point looks into its own cell on every level that the tiling uses.  Box and polygon decide in a cell, then the lowest ordinal.
    Regions come in rounds by ordinal, each of several times as many as all before, and only points that no round has found go on:
    where regions overlap, a point meets about as many as lie over it up to its first one, not all.  The rounds end with the points.
    Only distinct centres travel; cells with more than ``hot`` of them are dealt over several tasks, where each finds all of the
    cell's regions.  The list of such cells is broadcast: at most 10,000 times the levels, as ``hot`` grows with the points.
    """
    x, y = center(F.col("bbox"))
    crossing = F.coalesce(crosses_antimeridian(F.col("bbox")), F.lit(False))
    located = components.withColumns({"__x": x, "__y": y})
    points = kept(located.where(F.col("__x").isNotNull() & F.col("__y").isNotNull() & ~crossing).select("__x", "__y").distinct(), "centres")

    box = geometry_bbox(F.col("geometry"))
    tiles = regions.where(F.size("geometry") > 0).select("ordinal", "region", "geometry", box.alias("box"))
    side = F.greatest(F.col("box.maxx") - F.col("box.minx"), F.col("box.maxy") - F.col("box.miny"))
    level = F.when(side > 0, F.greatest(F.lit(0), F.least(F.lit(DEEPEST), F.floor(F.log2(360 / side))))).otherwise(DEEPEST).cast("int")
    tiles = kept(tiles.withColumn("level", level), "tiles")
    found, low = [], None
    for high in _rounds(tiles, first):
        some = tiles if low is None else tiles.where(F.col("ordinal") > low)
        some = some if high is None else some.where(F.col("ordinal") <= high)
        low = high
        seen = kept(_first_of(points, some, hot).select("__x", "__y", "__first"), "round")
        points = kept(seen.where("__first is null").select("__x", "__y"), "centres") if high is not None else points
        found.append(seen.where("__first is not null"))
        if high is None or points.isEmpty():
            break
    out = located.join(functools.reduce(DataFrame.unionByName, found), ["__x", "__y"], "left")
    region = F.when(crossing, ANTIMERIDIAN).otherwise(F.coalesce("__first", F.lit(ELSEWHERE)))
    return out.withColumn("region", region).select(*[c for c in components.columns if c != "region"], "region")


def _first_of(points: DataFrame, tiles: DataFrame, hot: int) -> DataFrame:
    """points with __first, the region of tiles of lowest ordinal that holds each; null if none does."""
    levels = {r["level"]: r["count"] for r in tiles.groupBy("level").count().collect()}  # 25 at most
    small = sum(levels.values()) <= SENT
    span = lambda lo, hi, low: F.explode(F.sequence(_cell(F.col(f"box.{lo}"), F.col("level"), low), _cell(F.col(f"box.{hi}"), F.col("level"), low)))
    tiles = tiles.withColumn("cx", span("minx", "maxx", -180.0)).withColumn("cy", span("miny", "maxy", -90.0))
    cells = points.withColumn("level", F.explode(F.array(*map(F.lit, sorted(levels))) if levels else F.array().cast("array<int>")))
    cells = cells.withColumns({"cx": _cell(F.col("__x"), F.col("level"), -180.0), "cy": _cell(F.col("__y"), F.col("level"), -90.0)})
    at = ["level", "cx", "cy"]
    if small:
        tiles = F.broadcast(tiles)
    else:
        hot = max(hot, points.count() // 10_000)
        many = cells.groupBy(*at).count().where(F.col("count") > hot).select(*at, F.ceil(F.col("count") / hot).cast("int").alias("deals"))
        many = F.broadcast(kept(many, "cells"))
        cells = cells.join(many, at, "left").withColumn("deal", F.pmod(F.xxhash64("__x", "__y"), F.coalesce("deals", F.lit(1))).cast("int")).drop("deals")
        tiles = tiles.join(many, at, "left").withColumn("deal", F.explode(F.sequence(F.lit(0), F.coalesce("deals", F.lit(1)) - 1))).drop("deals")
        at.append("deal")
    inside = (F.col("__x") >= F.col("box.minx")) & (F.col("__x") <= F.col("box.maxx")) & (F.col("__y") >= F.col("box.miny")) & (F.col("__y") <= F.col("box.maxy"))
    found = cells.join(tiles, at).where(inside).where(point_in_geometry(F.col("geometry"), F.col("__x"), F.col("__y")))
    first = found.groupBy("__x", "__y").agg(F.min_by("region", "ordinal").alias("__first"))
    return points.join(first, ["__x", "__y"], "left")


def region_meta(tagged: DataFrame) -> DataFrame:
    """Union of boxes and number of components by region."""
    return tagged.groupBy("region").agg(F.min("bbox.minx").alias("minx"), F.min("bbox.miny").alias("miny"), F.max("bbox.maxx").alias("maxx"), F.max("bbox.maxy").alias("maxy"), F.count("*").alias("feature_count"))


def region_counts(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("region").count().orderBy("region")
