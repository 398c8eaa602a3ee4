"""Whole jobs composed of operators: normalize, regional build, seed."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import decode as D
from ..functions import geometry as G
from ..functions.dates import is_newer
from ..functions.fixed import DEFAULT, Config
from ..operators import exclude as X
from ..operators import manifest as MF
from ..operators import mirror as M
from ..operators import regions as R
from ..session import shared_dir, split_code
from ..sources import readers as S
from ..sources import writers as W


def judged(features: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Features (flat text columns, geometry_type, coordinates, partition) decoded, with geometry and drop_reason."""
    f = D.identity(D.ranked(features)).withColumn("geometry", G.polygons(F.col("geometry_type"), F.col("coordinates")))
    reason = X.drop_reason(D.category_id(F.col("category_name")), F.col("marineArea"), G.span(G.geometry_bbox(F.col("geometry"))), X.hard_ban(config), config)
    return f.withColumns({"drop_reason": reason, "restrictions": F.col("coarse")})


def normalized(features: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """A row for each component: its feature's decoded properties, polygon, display, fallback, bbox, component_index, region.

    A feature without components, as it is dropped or has no polygon, is one row with a null index and no properties, so that
    the rows tell what became of every feature.
    """
    f = judged(features, config)
    out = D.has_token(F.col("partition"), config.exclude_partitions)
    live = ~out & F.col("drop_reason").isNull()
    rows = f.select("partition", "drop_reason", out.alias("excluded"), *(F.when(live, F.col(c)).alias(c) for c in D.PROPERTIES), F.when(live, F.col("geometry")).alias("geometry"))
    parts = G.simplify_display(G.explode_components(rows, outer=True), config.tolerance_deg, config.decimals)
    return R.tag(parts)


def normalize(features: DataFrame, config: Config = DEFAULT, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(components, tallies): decode, exclude, explode, thin and tag; and what that kept by partition.

    The input is read, and every ring thinned, once: the rows of ``normalized`` go to path (by default a new one in the shared
    folder), and both results read them back, the tallies five columns only.
    """
    path = path or f"{shared_dir(features.sparkSession)}/normalized-{uuid.uuid4().hex}"
    rows = normalized(features, config)
    with split_code(features.sparkSession):
        rows.write.parquet(path)
    rows = features.sparkSession.read.schema(rows.schema).parquet(path)
    return rows.where("component_index IS NOT NULL").drop("drop_reason", "excluded"), X.tally_rows(rows)


@dataclass(frozen=True)
class Release:
    """Literal columns of a release."""

    version: str
    dataset_date: str
    download_date: str
    generated_from: str | None = None
    license: str | None = None
    citation: str | None = None
    disclaimer: str | None = None
    attribution: str | None = None


def regional_build(components: DataFrame, tallies: DataFrame, path: str, release: Release) -> DataFrame:
    """Write extracts by region and variant, sidecars, tallies and the manifest under path; returns the manifest."""
    spark = components.sparkSession
    W.write_extracts(components.drop("partition", "fallback", "vertices_in", "vertices_out"), f"{path}/extracts")
    W.write_json(X.fragments(tallies), f"{path}/tallies")
    meta = R.region_meta(components)
    W.write_json(meta.select("region", F.when(F.col("feature_count") > 0, F.array("minx", "miny", "maxx", "maxy")).alias("bbox"), F.col("feature_count").alias("featureCount")), f"{path}/meta")
    side = S.sidecars(spark, f"{path}/meta")
    side = side.select("region", *(F.col("bbox")[i].alias(c) for i, c in enumerate(("minx", "miny", "maxx", "maxy"))), F.col("featureCount").alias("feature_count"))
    assets = MF.pair_extracts(side, S.assets(spark, f"{path}/extracts", with_content=True))
    total = X.merge(X.flat(S.tallies(spark, f"{path}/tallies")))
    W.write_manifest(MF.release_manifest(assets, release, total), f"{path}/manifest")
    return spark.read.json(f"{path}/manifest")


def freshness(pages: DataFrame, manifest: DataFrame) -> DataFrame:
    """(page_id, newer) of pages (page_id, dataset_date): whether a page names a newer dataset than the manifest publishes.

    A manifest is one row; without one everything dated is newer.
    """
    published = manifest.select(F.to_date("datasetDate").alias("published")).agg(F.max("published").alias("published"))
    return pages.join(F.broadcast(published)).select("page_id", is_newer(F.col("dataset_date"), F.col("published")).alias("newer"))


def seed_mirror(mirror: M.Mirror, lines: DataFrame, dataset_date: str, download_date: str, config: Config = DEFAULT) -> DataFrame:
    """The first snapshot from lines of features (partition, seq, site_id, props, geometry, v_major, v_minor, last_update).

    Lines without an id and those of excluded partitions are left out; every other line stays in its partition's shard,
    and the index has each id's last one.  Returns (partition, sites, skipped).
    """
    have = lines.where(F.coalesce("site_id", F.lit("")) != "")
    live = X.without_partitions(have, config=config)
    index = M.fold_fragments(live.withColumn("fragment", F.col("partition"))).select("site_id", "v_major", "v_minor", "last_update")
    mirror.seed(live.select(F.col("partition").alias("shard"), "seq", "site_id", "props", "geometry"), index, dataset_date, download_date)
    skip = D.has_token(F.col("partition"), config.exclude_partitions)
    return lines.groupBy("partition").agg(F.count_distinct(F.when(F.coalesce("site_id", F.lit("")) != "", F.col("site_id"))).alias("n")).select("partition", F.when(skip, 0).otherwise(F.col("n")).cast("long").alias("sites"), skip.alias("skipped"))
