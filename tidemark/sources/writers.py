"""Writing build outputs."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.decode import scalar_columns
from ..functions.geometry import curve
from .collections import BLOCK, block, copy_block


def variants(components: DataFrame) -> DataFrame:
    """Two rows a component, with variant and its geometry: full has every vertex, display is thinned."""
    both = F.array(F.struct(F.lit("full").alias("variant"), F.col("polygon").alias("geometry")), F.struct(F.lit("display").alias("variant"), F.col("display").alias("geometry")))
    return components.withColumn("v", F.explode(both)).select("*", "v.variant", "v.geometry").drop("v", "polygon", "display")


#: Bytes of an extract's file before compression, about, and of its row groups.
FILE_BYTES = 256 << 20
GROUP_BYTES = 16 << 20


def write_extracts(components: DataFrame, path: str, file_bytes: int = FILE_BYTES, group_bytes: int = GROUP_BYTES) -> None:
    """Extracts by region and variant, scalar columns only, as files of about equal size.

    Rows stand along a curve that keeps close places together, so a file, and a row group of it, covers a small box, and its
    statistics prune in both directions; a region of a third of all rows is many files.  components is read twice: for its size,
    which needs two columns, and for writing.
    """
    flat = scalar_columns(variants(components))
    flat = flat.withColumns({"minx": F.col("bbox.minx"), "miny": F.col("bbox.miny"), "maxx": F.col("bbox.maxx"), "maxy": F.col("bbox.maxy")}).drop("bbox")
    points = lambda c: F.coalesce(F.aggregate(c, F.lit(0), lambda s, r: s + F.size(r)), F.lit(0))
    size = components.agg(F.sum(points(F.col("polygon")) * 24 + points(F.col("display")) * 24 + 2048)).head()[0] or 0
    along = curve((F.col("minx") + F.col("maxx")) / 2, (F.col("miny") + F.col("maxy")) / 2)
    order = ["region", "variant", "__along"]
    dealt = flat.withColumn("__along", along).repartitionByRange(max(1, -(-size // file_bytes)), *order).sortWithinPartitions(*order).drop("__along")
    dealt.write.mode("overwrite").option("parquet.block.size", group_bytes).partitionBy("region", "variant").parquet(path)


def write_shards(lines: DataFrame, path: str, ranged: bool = False) -> None:
    """Lines of features as compressed text, by shard, in order; ranged: they stand in ranges of shard and seq already."""
    lines = lines if ranged else lines.repartitionByRange(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard", "seq")
    lines.sortWithinPartitions("shard", "seq").select("shard", F.col("feature").alias("value")).write.mode("overwrite").option("compression", "gzip").partitionBy("shard").text(path)


def _joined(batches):
    """(target, bytes) of documents that are put together from gzip files in order, of which a task holds a few MB at a time; a .gz document is in blocks, a file each."""
    import pyarrow as pa
    from pyarrow import fs

    for b in batches:
        sizes = []
        for target, files, head, tail in zip(*(b.column(c).to_pylist() for c in ("target", "files", "head", "tail")), strict=True):
            system, at = fs.FileSystem.from_uri(target)
            system.create_dir(at.rsplit("/", 1)[0])
            # a second attempt of the task puts its own draft in place
            draft = f"{at.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
            text = block if (blocked := at.endswith(".gz")) else bytes
            with system.open_output_stream(draft) as out:
                out.write(text(head.encode()))
                for path, size in (f.values() for f in files):
                    with system.open_input_stream(fs.FileSystem.from_uri(path)[1], compression=None if blocked else "gzip") as stream:
                        if blocked:
                            copy_block(stream, size, out)
                            continue
                        while chunk := stream.read(BLOCK):
                            out.write(chunk)
                out.write(text(tail.encode()))
            system.move(draft, at)
            sizes.append(system.get_file_info(at).size)
        yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("target")), pa.array(sizes, pa.int64())], ["target", "size"])


def write_documents(lines: DataFrame, path: str, head: str, tail: str, blocked: bool = False) -> None:
    """One document a shard, of head, the values of its lines and tail: path/shard=<shard>/document.json, blocked: document.json.gz.

    lines (shard, seq, value) stand in ranges of shard and seq; each range is written by its own task, and the compressed files of a shard are
    then joined as streams, so no task holds or sorts more than a range.  blocked: each is a block of the document (``collections``), so head,
    lines and tail end between two tokens.  The folder needs a store that Arrow opens by its URI.
    """
    spark = lines.sparkSession
    parts = f"{path}.parts"
    lines.sortWithinPartitions("shard", "seq").select("shard", "value").write.option("compression", "gzip").partitionBy("shard").text(parts)
    at = F.regexp_replace("path", "^file:/+", "file:///").alias("path")
    number = F.regexp_extract("path", r"part-([0-9]+)[^/]*$", 1).cast("long")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(parts).select(at, "length").select("path", "length", number.alias("n"), F.regexp_extract("path", r"/(shard=[^/]+)/[^/]*$", 1).alias("shard"))
    whole = files.groupBy("shard").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "path", "length"))), lambda f: F.struct(f["path"], f["length"])).alias("files"))
    whole = whole.select(F.concat(F.lit(f"{path}/"), "shard", F.lit("/document.json" + ".gz" * blocked)).alias("target"), "files", F.lit(head).alias("head"), F.lit(tail).alias("tail"))
    whole.repartition("target").mapInArrow(_joined, "target string, size long").write.format("noop").mode("overwrite").save()


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_manifest(manifest: DataFrame, path: str) -> None:
    """One document."""
    write_json(manifest.coalesce(1), path)


def feature_text(props: Column, geometry: Column) -> Column:
    """A feature as one line of text, of its properties and geometry as JSON."""
    return F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), F.coalesce(geometry, F.lit("null")), F.lit("}"))


def geometry_text(geometry: Column) -> Column:
    """GeoJSON of an array of polygons; null stays null."""
    return F.when(F.size(geometry) == 1, F.to_json(F.struct(F.lit("Polygon").alias("type"), geometry[0].alias("coordinates")))).when(F.size(geometry) > 1, F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), geometry.alias("coordinates"))))


def write_components(components: DataFrame, path: str) -> None:
    """Components as lines of features by variant: properties, a polygon, and _meta with index, box and region."""
    c = variants(components)
    skip = {"variant", "geometry", "bbox", "region", "component_index", "fallback", "vertices_in", "vertices_out"}
    meta = F.struct(F.col("component_index").alias("componentIndex"), F.col("bbox"), F.col("region"))
    shape = F.struct(F.lit("Polygon").alias("type"), F.col("geometry").alias("coordinates"))
    line = F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*(x for x in c.columns if x not in skip)).alias("properties"), shape.alias("geometry"), meta.alias("_meta")), {"ignoreNullFields": "false"})
    c.select("variant", line.alias("value")).write.mode("overwrite").partitionBy("variant").text(path)


def run_summary(delta_sizes: DataFrame, today: str, dataset_date: str | None = None) -> DataFrame:
    """One row: changed, added, updated, removed, dataset_date, version_tag.

    Parked sites that were fetched again count as updated; the dataset's date is today's unless nothing moved.
    """
    day = F.lit(today).cast("date")
    moved = F.col("added") + F.col("changed") + F.col("refetch") + F.col("removed") > 0
    date = day if dataset_date is None else F.when(moved, day).otherwise(F.lit(dataset_date).cast("date"))
    return delta_sizes.select(moved.alias("changed"), "added", (F.col("changed") + F.col("refetch")).alias("updated"), "removed", date.alias("dataset_date"), F.date_format(day, "'v'yyyy.MM.dd").alias("version_tag"))
