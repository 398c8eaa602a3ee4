"""The release manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VARIANTS = ("display", "full")


def pair_assets(meta: DataFrame, files: DataFrame, suffix: str = "parquet") -> DataFrame:
    """Assets of each region that exist: both variants share one box and count."""
    names = meta.withColumn("variant", F.explode(F.array(*map(F.lit, VARIANTS)))).withColumn("name", F.concat_ws(".", "region", "variant", F.lit(suffix)))
    return names.join(files, "name").select("region", "variant", "name", "size", *(c for c in files.columns if c == "sha256"), "minx", "miny", "maxx", "maxy", "feature_count")


def pair_extracts(meta: DataFrame, files: DataFrame) -> DataFrame:
    """Assets of each region from partitioned extracts: every data file below region=.../variant=..., with its region's box and count."""
    at = lambda key: F.regexp_extract("path", f"/{key}=([^/]+)/", 1)
    f = files.where(F.col("name").endswith(".parquet")).select(at("region").alias("region"), at("variant").alias("variant"), F.concat_ws("/", at("region"), at("variant"), "name").alias("name"), "size", *(c for c in files.columns if c == "sha256"))
    return f.join(meta, "region").select("region", "variant", "name", "size", *(c for c in f.columns if c == "sha256"), "minx", "miny", "maxx", "maxy", "feature_count")


def release_manifest(assets: DataFrame, release, exclusions: DataFrame) -> DataFrame:
    """One row: the release's literal columns, regions with their assets, and the merged tallies."""
    m = manifest(assets, F.lit(release.dataset_date).cast("date"), exclusions).drop("dataset_date", "version_tag")
    names = {"version": "version", "dataset_date": "datasetDate", "download_date": "downloadDate", "generated_from": "generatedFrom", "license": "license", "citation": "citations", "disclaimer": "disclaimer", "attribution": "attribution"}
    return m.select(*(F.lit(getattr(release, k)).cast("string").alias(v) for k, v in names.items()), "regions", "exclusions")


def manifest(assets: DataFrame, dataset_date: Column, exclusions: DataFrame | None = None) -> DataFrame:
    """One row: dataset date, version tag and regions with their assets, sorted; assets are a few a region."""
    inner = F.struct(*(c for c in assets.columns if c != "region"))
    by = assets.groupBy("region").agg(F.array_sort(F.collect_list(inner)).alias("assets"))
    out = by.agg(F.array_sort(F.collect_list(F.struct("region", "assets"))).alias("regions")).select(dataset_date.alias("dataset_date"), F.date_format(dataset_date, "'v'yyyy.MM.dd").alias("version_tag"), "regions")
    return out.crossJoin(F.broadcast(exclusions.limit(1).select(F.struct("*").alias("exclusions")))) if exclusions is not None else out
