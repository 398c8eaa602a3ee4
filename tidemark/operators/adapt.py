"""Adapting the second source's detail records to the canonical columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.decode import safe_number
from ..functions.fixed import API_ONLY, DOWNLOAD_ONLY, NUMERIC, RENAMED
from ..functions.geometry import flat_2d, polygons
from ..sources.writers import geometry_text


def site_key(df: DataFrame) -> Column:
    """ps_id, else site_id, whichever the record has."""
    return F.coalesce(*(F.col(c) for c in ("ps_id", "site_id") if c in df.columns), F.lit(None).cast("string"))


def adapt(df: DataFrame) -> DataFrame:
    """Renamed, coerced and null-filled properties; geometry in two dimensions, null if withheld."""
    cols = [F.col("geometry")] if "geometry" in df.columns else []
    if "site_boundary" in df.columns:
        cols = [flat_2d(polygons(F.col("site_boundary.type"), F.col("site_boundary.coordinates"))).alias("geometry")]
    out = []
    for c in df.columns:
        if c in (*API_ONLY, "ps_id", "site_id", "geometry"):
            continue
        name = RENAMED.get(c, c)
        out.append((safe_number(F.col(c)) if name in NUMERIC else F.col(c)).alias(name))
    have = {RENAMED.get(c, c) for c in df.columns}
    out += [F.lit(None).cast("string").alias(c) for c in DOWNLOAD_ONLY if c not in have]
    return df.select(site_key(df).alias("SITE_ID"), *out, *cols)


def detail_lines(details: DataFrame) -> DataFrame:
    """(site_id, props, geometry) of detail records: canonical properties and GeoJSON as text; geometry is null if withheld."""
    a = adapt(details)
    names = [c for c in a.columns if c != "geometry"]
    shape = geometry_text(F.col("geometry")) if "geometry" in a.columns else F.lit(None).cast("string")
    return a.select(F.col("SITE_ID").alias("site_id"), F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("props"), shape.alias("geometry"))
