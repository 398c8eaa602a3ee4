"""Reading features, catalogue pages, regions and build outputs.  Every scan has a fixed schema."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.decode import high_seas, safe_number
from ..functions.fixed import CODED, IDENTITY
from ..session import kept, shared_dir
from .collections import feature_texts

_S = T.StringType()
SHAPE = T.StructType([T.StructField("type", _S), T.StructField("coordinates", _S)])


def _texts(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, _S) for n in names])


PROPS = _texts(["SITE_ID", "site_id", *IDENTITY, *CODED])
FEATURE = T.StructType([T.StructField("type", _S), T.StructField("properties", PROPS), T.StructField("geometry", SHAPE)])
ROW = _texts(["ps_id", "site_id", "country", "status", "site_major_version", "site_minor_version", "last_update"])
PAGE = T.StructType([T.StructField("page", T.IntegerType()), T.StructField("sites", T.ArrayType(ROW))])
TALLY = "partition string, drops struct<categoryId:bigint,areaWithoutHardBan:bigint,bboxSpanWithoutHardBan:bigint,partition:bigint>, counts struct<featuresIn:bigint,kept:bigint,componentsFull:bigint,componentsDisplay:bigint,simplifyFallbacks:bigint>, excludedPartition boolean"


@contextmanager
def case_sensitive(spark: SparkSession):
    """Identifiers that differ in case only are different columns while this holds."""
    key = "spark.sql.caseSensitive"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def dealt(df: DataFrame, written: bool = False) -> DataFrame:
    """df over as many partitions as there are cores at least: a small table in one file would be one task.

    Filters and projections are pushed below the exchange, back into that one task; written stops them by a table in between.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return kept(df.repartition(cores), "dealt") if written else df.repartition(cores)


def _features(spark: SparkSession, df: DataFrame, root: str = "") -> DataFrame:
    """One flat row a feature: SITE_ID, other properties, geometry type and coordinates text."""
    with case_sensitive(spark):
        p = f"{root}properties."
        return df.select(
            *[c for c in df.columns if c.startswith("_")],
            F.coalesce(F.col(p + "SITE_ID"), F.col(p + "site_id"), F.lit("")).alias("SITE_ID"),
            *(F.col(p + c).alias(c) for c in [*IDENTITY, *CODED]),
            F.col(f"{root}geometry.type").alias("geometry_type"),
            F.col(f"{root}geometry.coordinates").alias("coordinates"),
        )


def feature_collection(spark: SparkSession, path: str | list[str], with_file: bool = False, blocked: bool = False) -> DataFrame:
    """Features of whole GeoJSON documents, each cut into ranges for many tasks; _pos is a feature's place in its document, with_file also _file.

    The features are written as compressed lines to the shared folder, once, and read from there: only the reader of JSON files keeps
    the spelling of coordinates, and lines can be read again without the document.  blocked: see ``feature_texts``.
    """
    lines = f"{shared_dir(spark)}/features-{uuid.uuid4().hex}"
    texts = feature_texts(spark, path, blocked).withColumn("head", F.to_json(F.struct(F.col("file").alias("_file"), F.col("place").alias("_pos"))))
    # a line break stands between tokens only: within strings JSON has it escaped
    line = F.when(F.contains("text", F.lit("\n")) | F.contains("text", F.lit("\r")), F.translate("text", "\r\n", "  ")).otherwise(F.col("text"))
    value = F.concat(F.expr("left(head, length(head) - 1)"), F.lit(',"f":'), line, F.lit("}"))
    texts.select(value.alias("value")).write.option("compression", "gzip").text(lines)
    with case_sensitive(spark):
        schema = T.StructType([T.StructField("_file", _S), T.StructField("_pos", T.LongType()), T.StructField("f", FEATURE)])
        df = _features(spark, spark.read.schema(schema).json(lines), "f.")
    return df if with_file else df.drop("_file")


def ndjson(spark: SparkSession, path: str) -> DataFrame:
    """One feature a line; blank lines are skipped."""
    with case_sensitive(spark):
        df = spark.read.schema(FEATURE).json(path)
    return _features(spark, df.where(F.col("type").isNotNull() | F.col("properties").isNotNull()))


def shards(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Compressed shards of features: _shard (by folder or file name), _seq (place in the shard), SITE_ID and the line itself.

    gzip does not split, so the lines are dealt out after the read.
    """
    text = spark.read.text(path)
    shard = F.col("shard").cast("string") if "shard" in text.columns else F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)", 1)
    df = text.select(shard.alias("_shard"), F.monotonically_increasing_id().alias("_seq"), F.col("value").alias("line"))
    df = df.where(F.trim("line") != "")
    site = F.coalesce(F.get_json_object("line", "$.properties.SITE_ID"), F.get_json_object("line", "$.properties.site_id"), F.lit(""))
    df = df.withColumn("site_id", site)
    return df.repartition(partitions) if partitions else df


def components(spark: SparkSession, path: str | list[str], properties: str) -> DataFrame:
    """Components from lines of features, blank lines skipped; properties: their schema as DDL.  Several paths are one table."""
    meta = "struct<componentIndex:int,bbox:struct<minx:double,miny:double,maxx:double,maxy:double>,region:string>"
    shape = "struct<type:string,coordinates:array<array<array<double>>>>"
    kind = f"type string, properties struct<{properties}>, geometry {shape}, _meta {meta}"
    lines = spark.read.text(path).where(F.trim("value") != "").select(F.from_json("value", kind).alias("f"))
    return lines.select("f.properties.*", F.col("f.geometry.coordinates").alias("polygon"), F.col("f._meta.componentIndex").alias("component_index"), F.col("f._meta.bbox").alias("bbox"), F.col("f._meta.region").alias("region"))


def regions(spark: SparkSession, path: str) -> DataFrame:
    """region, ordinal and geometry of a tiling, in array order; regions of several polygons are one row."""
    feature = "struct<properties:struct<region:string>,geometry:struct<type:string,coordinates:string>>"
    df = spark.read.option("multiLine", True).schema(f"features array<{feature}>").json(path)
    from ..functions.geometry import polygons

    df = df.select(F.posexplode("features").alias("ordinal", "f"))
    return df.select("ordinal", F.col("f.properties.region").alias("region"), polygons(F.col("f.geometry.type"), F.col("f.geometry.coordinates")).alias("geometry"))


def site_rows(pages: DataFrame) -> DataFrame:
    """Rows of landed pages with page and pos; rows without an id are dropped."""
    rows = pages.select("page", F.posexplode("sites").alias("pos", "s"))
    rows = rows.select("page", "pos", F.coalesce("s.ps_id", "s.site_id", F.lit("")).alias("site_id"), F.col("s.country").alias("country"), F.col("s.status").alias("status"), safe_number(F.col("s.site_major_version")).alias("v_major"), safe_number(F.col("s.site_minor_version")).alias("v_minor"), F.to_date(F.substring("s.last_update", 1, 10)).alias("last_update"))
    return rows.where("site_id <> ''").withColumn("hs", high_seas(F.col("country")))


def pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE).json(path)


def last_write(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """The last row of each key by an explicit order."""
    w = Window.partitionBy(key).orderBy(*(o.desc() for o in order))
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def catalog(rows: DataFrame) -> DataFrame:
    """The catalogue of all pages: one row an id, the last one listed."""
    return last_write(rows, "site_id", F.col("page"), F.col("pos")).select("site_id", "v_major", "v_minor", "last_update", "hs")


def page_faults(pages: DataFrame, limit: int) -> DataFrame:
    """One row with a message if the pages are not complete: 1..n, all full but the last; else none.

    Pages that have landed come to an end, so their number is not bounded.
    """
    n = pages.groupBy("page").agg(F.sum(F.size("sites")).alias("n"))
    a = n.agg(F.count("*").alias("pages"), F.min("page").alias("first"), F.max("page").alias("last"), F.count_if((F.col("n") != limit)).alias("short"), F.max_by("n", "page").alias("tail"))
    why = F.when(F.col("pages") == 0, "no pages").when((F.col("first") != 1) | (F.col("last") != F.col("pages")), "pages are missing").when(F.col("tail") >= limit, "the last page is full").when(F.col("short") > 1, "a page before the last is short")
    return a.select(why.alias("fault")).where("fault is not null")


def require_complete(pages: DataFrame, limit: int = 500) -> None:
    if bad := page_faults(pages, limit).head():
        raise ValueError(f"pagination: {bad['fault']}")


def window(rows: DataFrame, since: Column) -> DataFrame:
    """Rows of a change window from a day on, that day included."""
    return rows.where(F.col("last_update") >= since)


def changed_ids(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("hs")).select("site_id").distinct()


def details(spark: SparkSession, path: str, schema: T.StructType, ids: DataFrame) -> DataFrame:
    """Landed detail records of the wanted ids only."""
    df = spark.read.schema(schema).json(path)
    return df.withColumn("__id", F.coalesce("ps_id", "site_id")).join(ids.select(F.col("site_id").alias("__id")), "__id", "left_semi").drop("__id")


def tallies(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TALLY).json(path)


def sidecars(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("region string, bbox array<double>, featureCount bigint").json(path).orderBy("region")


#: Files up to this size are hashed as one value, larger ones in chunks.
WHOLE_FILE = 16 << 20
CHUNK = 4 << 20


def _digests(batches):
    """(path, length, sha256) of files that are read in chunks of bounded size."""
    import hashlib

    import pyarrow as pa
    from pyarrow import fs

    for b in batches:
        found = []
        for path in b.column(0).to_pylist():
            system, at = fs.FileSystem.from_uri(path)
            digest = hashlib.sha256()
            with system.open_input_stream(at) as stream:
                while chunk := stream.read(CHUNK):
                    digest.update(chunk)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.string())], ["path", "length", "sha256"])


def assets(spark: SparkSession, path: str, with_content: bool = False, whole: int = WHOLE_FILE) -> DataFrame:
    """Files with their size, and with_content their sha256; Spark lists no empty ones.

    A task holds a file of ``whole`` bytes or a chunk of a larger one.  Larger files need a store that Arrow opens by its URI
    (local, HDFS, S3, GCS); what only Spark's own readers reach stays below ``whole``.
    """
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.element_at(F.split("path", "/"), -1).alias("name")
    if not with_content:
        return df.select("path", name, F.col("length").alias("size"))
    small = df.where(F.col("length") <= whole).select("path", "length", F.sha2("content", 256).alias("sha256"))
    # a path's scheme decides the file system; Spark writes local ones as file:/x
    large = df.where(F.col("length") > whole).select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"), "length")
    large = large.repartition("path").mapInArrow(_digests, "path string, length long, sha256 string")
    return small.unionByName(large).select("path", name, F.col("length").alias("size"), "sha256")
