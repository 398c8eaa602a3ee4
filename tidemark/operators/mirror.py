"""The mirror: lines of features by shard, an index, parked and removed sites and a state, in versioned snapshots."""

from __future__ import annotations

import functools
import hashlib
import json
import os
import uuid
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINES = "shard string, seq bigint, site_id string, props string, geometry string"
INDEX = "site_id string, v_major double, v_minor double, last_update date, shards array<string>"
PARKED = "site_id string, v_major double, v_minor double"
GONE = "site_id string, last_update date"
STORES = {"index": INDEX, "parked": PARKED, "gone": GONE}
TABLES = {"lines": (LINES, "shard"), "stores": (f"{INDEX}, store string", "store")}
STATE = "version bigint, schema string, dataset_date date, download_date date, last_sweep_date date, last_full_census_date date, site_count bigint"
MORE = ", data_version string, buckets int, mark date, shards map<string,string>"


#: Bytes of lines and index in a bucket, about, and of a row without its texts.
BUCKET, LINE = 16 << 20, 100


def _cores(spark: SparkSession) -> int:
    """Buckets of a small mirror: no more than there are cores, as every bucket is a file a shard and version."""
    return min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: The shard of lines that a delta adds.
UPDATES = "updates"


def changes(refreshed: DataFrame, removed: DataFrame) -> DataFrame:
    """(site_id, hit, new_props, new_geometry, gone): one row an id of a delta; refreshed has one row an id."""
    r = refreshed.select("site_id", F.lit(True).alias("hit"), F.col("props").alias("new_props"), F.col("geometry").alias("new_geometry"))
    gone = removed.select("site_id").distinct().withColumn("gone", F.lit(True))
    return r.join(gone, "site_id", "full_outer").where("site_id <> ''")


def apply_changes(lines: DataFrame, delta: DataFrame) -> DataFrame:
    """lines after a delta of ``changes``, in one join: bucketed like the delta, the lines are not shuffled."""
    j = lines.join(delta, "site_id", "left").where("gone is null")
    return j.select("shard", "seq", "site_id", F.when(F.col("hit"), F.col("new_props")).otherwise(F.col("props")).alias("props"), F.coalesce("new_geometry", "geometry").alias("geometry"), F.when(F.col("hit"), "update").otherwise("keep").alias("action"))


def rewrite_lines(lines: DataFrame, refreshed: DataFrame, removed: DataFrame) -> DataFrame:
    """lines after a delta: removed ids go (even if refreshed), refreshed ones change, others stay as they are.

    A refreshed record without a geometry keeps the old one; lines without an id always stay; every line of
    an id is kept.  refreshed has one row an id: site_id, props, geometry.
    """
    return apply_changes(lines, changes(refreshed, removed))


def consumed(lines: DataFrame, refreshed: DataFrame, removed: DataFrame) -> DataFrame:
    """Refreshed ids whose old line was updated."""
    return refreshed.select("site_id").join(lines.select("site_id"), "site_id", "left_semi").join(removed, "site_id", "left_anti")


def new_lines(refreshed: DataFrame, used: DataFrame, shard: str = "updates") -> DataFrame:
    """Lines of refreshed ids that had none and have a geometry."""
    fresh = refreshed.join(used, "site_id", "left_anti").where(F.col("geometry").isNotNull())
    return fresh.select(F.lit(shard).alias("shard"), F.xxhash64("site_id").alias("seq"), "site_id", "props", "geometry", F.lit("append").alias("action"))


def patch_stores(index: DataFrame, parked: DataFrame, removed: DataFrame, refreshed: DataFrame, used: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Index and parked store after a delta; rows it does not touch are carried forward.

    A refreshed id with a geometry or an updated line is indexed, else parked, with the entry's version and date.  An index
    with the shards of each id's lines keeps them; an id without lines gets those of ``new_lines``.
    """
    touched = removed.select("site_id").union(refreshed.select("site_id")).distinct()
    new = refreshed.select("site_id", F.col("geometry").isNotNull().alias("shape")).join(used.select("site_id", F.lit(True).alias("used")), "site_id", "left").join(entries.select("site_id", "v_major", "v_minor", "last_update"), "site_id", "left")
    shown = F.col("shape") | F.coalesce("used", F.lit(False))
    cols = ["site_id", "v_major", "v_minor", "last_update"]
    fresh = new.where(shown)
    if "shards" in index.columns:
        cols.append("shards")
        fresh = fresh.join(index.select("site_id", F.col("shards").alias("held")), "site_id", "left")
        fresh = fresh.withColumn("shards", F.when(F.col("used") & (F.size("held") > 0), F.col("held")).otherwise(F.array(F.lit(UPDATES))))
    idx = index.join(touched, "site_id", "left_anti").select(*cols).unionByName(fresh.select(*cols))
    par = parked.join(touched, "site_id", "left_anti").select("site_id", "v_major", "v_minor").unionByName(new.where(~shown).select("site_id", "v_major", "v_minor"))
    return idx, par


def fold_fragments(fragments: DataFrame) -> DataFrame:
    """The index of all fragments: an id's row in the last fragment, and the last within it."""
    from ..sources.readers import last_write

    return last_write(fragments, "site_id", F.col("fragment"), F.col("seq"))


def fragment_counts(fragments: DataFrame) -> DataFrame:
    return fragments.groupBy("fragment").agg(F.count_distinct("site_id").alias("sites"))


def seed_state(index: DataFrame, dataset_date: str, download_date: str, version: int = 0) -> DataFrame:
    """The first state; without a census date the next run takes one.  A dataset cannot be newer than its download."""
    ok = F.assert_true(F.lit(dataset_date).cast("date") <= F.lit(download_date).cast("date"), F.lit("dataset date is after the download date"))
    day = F.lit(dataset_date).cast("date")
    return index.agg(F.count("*").alias("site_count")).withColumn("ok", ok).select(F.lit(version).cast("long").alias("version"), F.lit("mirror-state/1").alias("schema"), day.alias("dataset_date"), F.lit(download_date).cast("date").alias("download_date"), F.when(F.col("ok").isNull(), day).alias("last_sweep_date"), F.lit(None).cast("date").alias("last_full_census_date"), "site_count")


def touched_shards(index: DataFrame, ids: DataFrame) -> list[str]:
    """Shards that hold a line of some id, by the index; one row a shard reaches the driver."""
    held = index.join(ids.select("site_id").distinct(), "site_id", "left_semi").select(F.explode("shards").alias("shard"))
    return sorted(r[0] for r in held.distinct().collect())


class Conflict(RuntimeError):
    """Another writer has committed the version first; nothing of it is lost, and nothing of this run is in the mirror."""


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content, unless there is one; whether that was done.

    A link on a local or mounted disk, elsewhere a rename, which Hadoop's file systems refuse onto a file that exists.
    """
    at = urlparse(path)
    if at.scheme in ("", "file"):
        target = Path(at.path)
        target.parent.mkdir(parents=True, exist_ok=True)
        draft = target.with_name(f".{uuid.uuid4().hex}")
        draft.write_text(text)
        try:
            os.link(draft, target)
        except FileExistsError:
            return False
        finally:
            draft.unlink()
        return True
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    target = hadoop(path)
    draft = hadoop(target.getParent(), f".{uuid.uuid4().hex}")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    done = not fs.exists(target) and fs.rename(draft, target)
    if not done:
        fs.delete(draft, False)
    return done


class Mirror:
    """Snapshots under one folder, in a log of versions.

    A version is a file of the log with its state; it is created whole and only if no other writer has created it, so of
    two runs that start from one version the second fails with ``Conflict`` and can start again from what the first left.  All data
    are written before, in folders of their own: a run that dies, or loses, leaves the mirror as it was, and readers never see half a version.

    Tables are bucketed by id, all with the number of buckets that the size of the first snapshot asks for, so joins with a delta that is bucketed alike
    shuffle none of them.  Lines also stand by shard, and a version lists which version wrote each shard last: a delta
    rewrites the shards that its ids are in, which the index tells, and reads no others.  When lines are spread over
    ``most`` versions, the next delta rewrites all.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None, most: int = 16):
        self.spark, self.root, self.most = spark, root.rstrip("/"), most
        self._buckets = buckets

    def state(self) -> dict:
        rows = self.spark.read.schema(STATE + MORE).json(f"{self.root}/log")
        return rows.orderBy(F.desc("version")).limit(1).collect()[0].asDict()

    def _name(self, kind: str, version: str) -> str:
        return f"tidemark_{hashlib.sha256(self.root.encode()).hexdigest()[:12]}_{kind}_{version.replace('-', '_')}"

    def bucketed(self, kind: str, version: str, df: DataFrame, buckets: int) -> DataFrame:
        """df as a table bucketed by id; those of ``TABLES`` also by folders."""
        write = df.repartition(buckets, "site_id").write.bucketBy(buckets, "site_id").sortBy("site_id").option("path", f"{self.root}/{kind}/version={version}")
        (write.partitionBy(TABLES[kind][1]) if kind in TABLES else write).saveAsTable(self._name(kind, version))
        return self.spark.table(self._name(kind, version))

    def table(self, kind: str, version: str, buckets: int) -> DataFrame:
        name = self._name(kind, version)
        if not self.spark.catalog.tableExists(name):
            # another session wrote it
            columns, folder = TABLES[kind]
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({folder}) CLUSTERED BY (site_id) SORTED BY (site_id) INTO {buckets} BUCKETS LOCATION '{self.root}/{kind}/version={version}'")
            self.spark.sql(f"MSCK REPAIR TABLE {name}")
        return self.spark.table(name)

    def shards(self, state: dict | None = None) -> dict[str, str]:
        """The version of each shard's lines."""
        return (state or self.state())["shards"]

    def lines(self, only: list[str] | None = None, state: dict | None = None) -> DataFrame:
        """Lines of all shards, or of some: a scan for each version that wrote one of them."""
        state = state or self.state()
        by: dict[str, list[str]] = {}
        for s, v in self.shards(state).items():
            if only is None or s in only:
                by.setdefault(v, []).append(s)
        found = [self.table("lines", v, state["buckets"]).where(F.col("shard").isin(names)) for v, names in sorted(by.items())]
        return functools.reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame([], LINES)

    def stores(self, state: dict | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
        """index, parked and gone, which are one table."""
        state = state or self.state()
        t = self.table("stores", state["data_version"], state["buckets"])
        return tuple(t.where(F.col("store") == k).select(*(c.split()[0] for c in kind.split(", "))) for k, kind in STORES.items())

    def tables(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        state = self.state()
        return self.lines(state=state), *self.stores(state)[:2]

    def commit(self, state: dict, lines: DataFrame | None = None, index: DataFrame | None = None, parked: DataFrame | None = None, gone: DataFrame | None = None, kept: dict[str, str] | None = None) -> None:
        """Make state its version's; with data, these are written first.  lines has whole shards; kept: the versions of all others."""
        state = {"buckets": self._buckets or _cores(self.spark), "shards": {}} | {k: v for k, v in state.items() if v is not None}
        if lines is not None:
            v, n = f"{state['version']}-{uuid.uuid4().hex[:8]}", state["buckets"]
            new = self.bucketed("lines", v, lines.select(*(c.split()[0] for c in LINES.split(", "))), n)
            state["shards"] = (kept or {}) | {r[0]: v for r in new.select("shard").distinct().collect()}
            stores = [df.withColumn("store", F.lit(k)) for k, df in (("index", index), ("parked", parked), ("gone", gone)) if df is not None]
            both = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stores)
            both = self.bucketed("stores", v, both.select(*(c.split()[0] for c in TABLES["stores"][0].split(", "))), n)
            state |= {"data_version": v, "site_count": both.where("store = 'index'").count()}
        if not publish(self.spark, f"{self.root}/log/{state['version']:020d}.json", json.dumps(state, default=str)):
            raise Conflict(f"version {state['version']} of {self.root} is another writer's")

    def seed(self, lines: DataFrame, index: DataFrame, dataset_date: str, download_date: str) -> None:
        row = seed_state(index, dataset_date, download_date).collect()[0].asDict()
        size = F.coalesce(F.octet_length("props"), F.lit(0)) + F.coalesce(F.octet_length("geometry"), F.lit(0)) + LINE
        held = lines.groupBy("site_id").agg(F.sort_array(F.collect_set("shard")).alias("shards"), F.sum(size.cast("long")).alias("size"))
        path = f"{self.root}/held/{uuid.uuid4().hex}"
        held.write.parquet(path)
        held = self.spark.read.schema(held.schema).parquet(path)
        if not self._buckets:
            size = (held.agg(F.sum("size")).head()[0] or 0) + LINE * row["site_count"]
            row["buckets"] = max(_cores(self.spark), -(-size // BUCKET))
        index = index.join(held.drop("size"), "site_id", "left").withColumn("shards", F.coalesce("shards", F.array().cast("array<string>")))
        self.commit(row, lines, index)

    def log(self, summary: DataFrame) -> None:
        """Append a run's row."""
        summary.coalesce(1).write.mode("append").parquet(f"{self.root}/runs")
