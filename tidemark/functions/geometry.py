"""Geometry as arrays: a point is [x, y], a ring an array of points, a polygon an array of rings, a geometry an array of polygons."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RING = "array<array<double>>"
POLYGON = f"array<{RING}>"
GEOMETRY = f"array<{POLYGON}>"


def polygons(kind: Column, coordinates: Column) -> Column:
    """Polygons of GeoJSON type and coordinates text; null for any other or empty geometry."""
    one = F.from_json(coordinates, POLYGON)
    many = F.from_json(coordinates, GEOMETRY)
    out = F.when(kind == "Polygon", F.array(one)).when(kind == "MultiPolygon", many)
    return once(out, lambda g: F.when((F.size(g) > 0) & (F.size(F.element_at(g, 1)) > 0), g))


def flat_points(geometry: Column) -> Column:
    return F.flatten(F.flatten(geometry))


def once(value: Column, f) -> Column:
    """f(value), with value computed once however often f names it; projects and pushed filters would repeat it."""
    return F.get(F.transform(F.array(value), f), 0)


def bbox_of_points(points: Column) -> Column:
    """The extent, in one pass over the points; nulls inside if there are none."""
    sides = {"minx": (F.least, 0), "miny": (F.least, 1), "maxx": (F.greatest, 0), "maxy": (F.greatest, 1)}
    none = F.struct(*(F.lit(None).cast("double").alias(c) for c in sides))
    return F.aggregate(points, none, lambda box, p: F.struct(*(f(box[c], p[i]).alias(c) for c, (f, i) in sides.items())))


def polygon_bbox(polygon: Column) -> Column:
    return bbox_of_points(F.flatten(polygon))


def geometry_bbox(geometry: Column) -> Column:
    return bbox_of_points(flat_points(geometry))


def span(box: Column) -> Column:
    """The larger side; 0 without a geometry."""
    return F.coalesce(once(box, lambda b: F.greatest(b["maxx"] - b["minx"], b["maxy"] - b["miny"])), F.lit(0.0))


def center(box: Column) -> tuple[Column, Column]:
    return (box["minx"] + box["maxx"]) / 2, (box["miny"] + box["maxy"]) / 2


def crosses_antimeridian(box: Column) -> Column:
    return box["maxx"] - box["minx"] > 180


def explode_components(df: DataFrame, geometry: str = "geometry", outer: bool = False) -> DataFrame:
    """One row a polygon, with component_index, polygon and bbox; outer: a row of nulls for no polygon."""
    kept = [c for c in df.columns if c != geometry]
    out = df.select(*kept, (F.posexplode_outer if outer else F.posexplode)(geometry).alias("component_index", "polygon"))
    return out.withColumn("bbox", polygon_bbox(F.col("polygon")))


def _spread(v: Column) -> Column:
    """The low 16 bits, with a zero before each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return v


def curve(x: Column, y: Column) -> Column:
    """A place on a Z-shaped curve through all cells of a grid of 2^16 by 2^16: close places are mostly close on the map."""
    step = lambda v, low, width: F.greatest(F.lit(0), F.least(F.lit(65535), F.floor((v - low) / width * 65536))).cast("long")
    return _spread(step(x, -180.0, 360.0)).bitwiseOR(F.shiftleft(_spread(step(y, -90.0, 180.0)), 1))


def half_up(x: Column, decimals: int) -> Column:
    """Rounded half up towards positive infinity."""
    f = float(10**decimals)
    return F.floor(x * f + 0.5) / f


def rounded(polygon: Column, decimals: int) -> Column:
    return F.transform(polygon, lambda ring: F.transform(ring, lambda p: F.transform(p, lambda v: half_up(v, decimals))))


def flat_2d(geometry: Column) -> Column:
    """Without a third coordinate."""
    return F.transform(geometry, lambda poly: F.transform(poly, lambda ring: F.transform(ring, lambda p: F.slice(p, 1, 2))))


def _crossings(ring: Column, x: Column, y: Column) -> Column:
    edges = F.arrays_zip(F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0))).alias("a"), F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))).alias("b"))

    def crossed(e: Column) -> Column:
        ax, ay, bx, by = e["a"][0], e["a"][1], e["b"][0], e["b"][1]
        at = ax + (bx - ax) * F.try_divide(y - ay, by - ay)
        return ((ay > y) != (by > y)) & F.coalesce(x < at, F.lit(False))

    return F.size(F.filter(edges, crossed))


def point_in_ring(ring: Column, x: Column, y: Column) -> Column:
    """Even-odd rule; the ring is closed."""
    return _crossings(ring, x, y) % 2 == 1


def point_in_polygon(polygon: Column, x: Column, y: Column) -> Column:
    """Inside the outer ring and in no hole."""
    holes = F.slice(polygon, 2, 1 << 20)
    return point_in_ring(F.element_at(polygon, 1), x, y) & ~F.exists(holes, lambda h: point_in_ring(h, x, y))


def point_in_geometry(geometry: Column, x: Column, y: Column) -> Column:
    return F.exists(geometry, lambda p: point_in_polygon(p, x, y))


def _farthest(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, root: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """For each segment from point a to point b, more than one apart: distance (squared, without root) of the farthest point between them, and the first such point."""
    n = b - a - 1
    begin = np.cumsum(n) - n
    seg = np.repeat(np.arange(len(a)), n)
    at = np.arange(len(seg)) + (a + 1 - begin)[seg]
    dx, dy = x[b] - x[a], y[b] - y[a]
    size = dx * dx + dy * dy
    qx, qy, dx, dy = x[at] - x[a][seg], y[at] - y[a][seg], dx[seg], dy[seg]
    size = size[seg]
    t = np.clip(np.divide(qx * dx + qy * dy, size, out=np.zeros(len(at)), where=size > 0), 0, 1)
    far = (qx - t * dx) ** 2 + (qy - t * dy) ** 2
    far = np.sqrt(far) if root else far
    most = np.maximum.reduceat(far, begin)
    hit = np.flatnonzero(far == most[seg])
    return most, at[hit[np.diff(seg[hit], prepend=-1) > 0]]


def _thinned(x: np.ndarray, y: np.ndarray, first: np.ndarray, last: np.ndarray, tolerance: float) -> np.ndarray:
    """Douglas-Peucker on many rings at once, level by level: which points stay."""
    keep = np.zeros(len(x), bool)
    keep[first] = keep[last] = True
    a, b = first, last
    while True:
        a, b = a[b - a > 1], b[b - a > 1]
        if not len(a):
            return keep
        most, i = _farthest(x, y, a, b)
        go = most > tolerance * tolerance
        keep[i[go]] = True
        a, b = np.concatenate((a[go], i[go])), np.concatenate((i[go], b[go]))


def _least_thinned(x: np.ndarray, y: np.ndarray, first: np.ndarray, last: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Of rings that thin to fewer than four points: which points stay with the tolerance lowered by hundredths until four do, and for which rings none is low enough.

    A point's worth is the tolerance below which it stays.  Only the second largest of a ring counts and what is within hundredths
    of it, so segments far below that are not looked into.
    """
    worth = np.zeros(len(x))
    top = np.zeros((len(first), 2))  # second largest and largest worth so far
    a, b, limit, ring = first, last, np.full(len(first), np.inf), np.arange(len(first))
    while True:
        go = b - a > 1
        a, b, limit, ring = a[go], b[go], limit[go], ring[go]
        if not len(a):
            break
        most, i = _farthest(x, y, a, b, root=True)
        w = np.minimum(limit, most)
        worth[i] = w
        of, values = np.concatenate((np.repeat(np.arange(len(first)), 2), ring)), np.concatenate((top.ravel(), w))
        values = values[np.lexsort((values, of))]
        end = np.cumsum(np.bincount(of))
        top = np.stack((values[end - 2], values[end - 1]), axis=1)
        go = (w > 0) & (w > 0.97 * top[ring, 0])
        a, b, limit, ring = np.concatenate((a[go], i[go])), np.concatenate((i[go], b[go])), np.tile(w[go], 2), np.tile(ring[go], 2)
    second = top[:, 0]
    none = second <= 0
    some = np.where(none, tolerance, second)
    lower = np.minimum(tolerance, tolerance * 0.99 ** np.ceil(np.log(some / tolerance) / np.log(0.99)))
    while (high := ~none & (lower >= second)).any():
        lower[high] *= 0.99
    keep = np.zeros(len(x), bool)
    for_each = last - first + 1
    at = np.arange(for_each.sum()) + np.repeat(first - np.cumsum(for_each) + for_each, for_each)
    keep[at] = worth[at] > np.repeat(np.where(none, -1.0, lower), for_each)
    keep[first] = keep[last] = True
    return keep, none


#: Points that are thinned at once, about; a polygon is never cut.
AT_ONCE = 1 << 17


def _thin(column: pa.Array, tolerance: float, decimals: int) -> pa.StructArray:
    """display, fallback, vertices_in and vertices_out of polygons."""
    rings = column.flatten()
    points = rings.flatten()
    per_poly = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    per_ring = pc.list_value_length(rings).to_numpy()
    width = int(pc.max(pc.list_value_length(points)).as_py() or 2)
    xy = points.flatten().to_numpy().reshape(-1, width)
    at = np.concatenate(([0], np.cumsum(per_ring)))
    poly = np.repeat(np.arange(len(column)), per_poly)
    new = np.ones(len(xy), bool)
    new[1:] = functools.reduce(np.logical_or, (xy[1:, i] != xy[:-1, i] for i in range(width)))
    new[at[:-1][per_ring > 0]] = True
    x, y, cuts_ = xy[new, 0], xy[new, 1], np.concatenate(([0], np.cumsum(new)))[at]
    many = np.flatnonzero(np.diff(cuts_) >= 4)
    keep = _thinned(x, y, cuts_[many], cuts_[many + 1] - 1, tolerance)
    left = np.diff(np.concatenate(([0], np.cumsum(keep)))[cuts_])
    short = np.diff(cuts_) < 4  # rings without a shape
    few = many[left[many] < 4]
    if len(few):
        some, none = _least_thinned(x, y, cuts_[few], cuts_[few + 1] - 1, tolerance)
        keep |= some
        short[few] = none
    bad = np.zeros(len(column), bool)
    bad[poly[short]] = True
    stay = np.zeros(len(xy), bool)
    stay[np.flatnonzero(new)[keep]] = True
    stay |= np.repeat(bad[poly], per_ring)
    sizes = np.diff(np.concatenate(([0], np.cumsum(stay)))[at])
    f = float(10**decimals)
    flat = np.floor(xy[stay] * f + 0.5) / f + 0.0
    cuts = lambda n: np.concatenate(([0], np.cumsum(n))).astype(np.int32)
    pts = pa.ListArray.from_arrays(pa.array(cuts(np.full(len(flat), width))), pa.array(flat.ravel()))
    ring = pa.ListArray.from_arrays(pa.array(cuts(sizes)), pts)
    per, none = cuts(per_poly), pc.is_null(column).to_numpy(zero_copy_only=False)
    display = pa.ListArray.from_arrays(pa.array(per, mask=np.append(none, False)), ring)
    count = lambda n: pa.array(np.diff(np.concatenate(([0], np.cumsum(n)))[per]).astype(np.int32), mask=none)
    return pa.StructArray.from_arrays([display, pa.array(bad), count(per_ring), count(sizes)], ["display", "fallback", "vertices_in", "vertices_out"])


def simplify_display(components: DataFrame, tolerance: float, decimals: int, polygon: str = "polygon") -> DataFrame:
    """components with display (thinned, then rounded), fallback, vertices_in and vertices_out.

    The tolerance bounds how far any dropped vertex lies from the line that replaces it; there is no pass by radial
    distance before.  A ring that would thin to fewer than four points takes a lower tolerance.  A polygon with a ring of
    fewer than four points once repeated vertices are gone, or with all of them on one line, keeps all vertices and is only rounded.
    """

    @F.arrow_udf(f"display {POLYGON}, fallback boolean, vertices_in int, vertices_out int")
    def thin(column: pa.Array) -> pa.Array:
        points = pc.list_value_length(column.flatten()).to_numpy()
        per = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
        end = np.concatenate(([0], np.cumsum(points)))[np.cumsum(per)]
        cuts, done = [0], 0
        while cuts[-1] < len(column):  # the working arrays are several times the points
            cuts.append(max(cuts[-1] + 1, int(np.searchsorted(end, done + AT_ONCE, side="right"))))
            done = end[cuts[-1] - 1]
        some = [_thin(column.slice(i, j - i), tolerance, decimals) for i, j in zip(cuts, cuts[1:], strict=False)] or [_thin(column, tolerance, decimals)]
        return pa.concat_arrays(some)

    t = components.withColumn("__thin", thin(F.col(polygon)))
    return t.withColumns({c: F.col(f"__thin.{c}") for c in ("display", "fallback", "vertices_in", "vertices_out")}).drop("__thin")
