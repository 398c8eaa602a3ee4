"""Keeping the mirror current: one batch of the change feed, a census, and a stream of landed windows."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import adapt as A
from ..operators import catalog as C
from ..operators import mirror as M
from ..sources import readers as S
from ..sources import writers as W
from ..sources.readers import PAGE, catalog, require_complete, site_rows, window


#: site_id, props, geometry of any sites, or a function that gives those of some ids.
Details = DataFrame | Callable[[DataFrame], DataFrame]


def landed_details(spark: SparkSession, path: str, schema: str):
    """Details for ``sync``: of the ids that a delta asks for, the landed records at path, adapted to (site_id, props, geometry)."""
    return lambda ids: A.detail_lines(S.details(spark, path, schema, ids))


def _once(details: DataFrame) -> DataFrame:
    """One detail record an id, the same one in every replay: with a geometry rather than without, then the greatest text."""
    best = F.max(F.struct(F.col("geometry").isNotNull().alias("shape"), "props", "geometry")).alias("d")
    return details.groupBy("site_id").agg(best).select("site_id", "d.props", "d.geometry")


def _refreshed(details: Details, wanted: DataFrame, buckets: int) -> DataFrame:
    """``_once`` of the wanted ids.

    Texts are sorted for that.  They are dealt over buckets first: by the bytes they have in a shuffle, where they are compressed many
    times, they would be put together to few large partitions, and a sum before it gains nothing, as few ids have two records.
    """
    dealt = lambda df: df.repartition(buckets, "site_id")
    if callable(details):  # it can give more than it is asked for
        return _once(dealt(details(wanted)).join(dealt(wanted), "site_id", "left_semi"))
    return _once(dealt(details.join(wanted, "site_id", "left_semi")))


def _attempt(state: dict) -> str:
    return f"{state['version']}-{uuid.uuid4().hex[:8]}"


def _apply(mirror: M.Mirror, state: dict, delta: DataFrame, entries: DataFrame, details: Details, today: dt.date, gate: Column, rows: DataFrame, catalog_size: int | None = None) -> dict:
    """Apply a classified delta to the version of state; details: site_id, props, geometry of any sites, or what gives those of
    some ids.  Returns sizes.

    The delta is written once, and its sizes are observed in that pass: gates, writes and the summary see the same rows, and
    a gate that refuses leaves the mirror as it is.  Only shards that the delta touches are read and rewritten.
    """
    spark = mirror.spark
    index, stored, gone = mirror.stores(state)
    parked = C.versioned_parked(stored, entries)
    census = catalog_size is not None
    before = str(state["dataset_date"])
    state = state | {"version": state["version"] + 1, "last_sweep_date": today} | ({"last_full_census_date": today} if census else {})
    split = C.split_added(delta.where("kind = 'added'"), entries, parked)
    attempt = _attempt(state)
    kinds = ("added", "changed", "removed", "refetch")
    count = [F.count_if(F.col("kind") == k).alias(k) for k in kinds]
    judged, left = Observation(), Observation()
    path = f"{mirror.root}/deltas/{attempt}"
    delta.observe(judged, *count).join(split.where("skipped"), "site_id", "left_anti").select("site_id", "kind").observe(left, *count).write.parquet(path)
    sizes = left.get | {"mirror_size": state["site_count"]}
    one = lambda x: spark.createDataFrame([x | {"mirror_size": state["site_count"], "catalog_size": catalog_size or 0}])
    C.require(one(judged.get).select(gate.alias("fault")))
    newest = rows.agg(F.max("last_update")).head()[0]
    state["mark"] = max((d for d in (state.get("mark"), newest) if d), default=None)
    summed = one(left.get)
    if not sum(sizes[k] for k in kinds):
        mirror.commit(state)  # quiet: the data stay, the high-water mark moves
        mirror.log(W.run_summary(summed, str(today), before))
        return sizes
    delta = spark.read.schema("site_id string, kind string").parquet(path)
    removed = delta.where("kind = 'removed'").select("site_id")
    wanted = delta.where("kind <> 'removed'").select("site_id")
    refreshed = _refreshed(details, wanted, state["buckets"])
    held = state["shards"]
    crowded = len(set(held.values())) >= mirror.most
    touched = list(held) if crowded else sorted({*M.touched_shards(index, delta), M.UPDATES} & set(held))
    moved = mirror.bucketed("moved", attempt, M.changes(refreshed, removed.repartition(state["buckets"], "site_id")), state["buckets"])
    refreshed = moved.where("hit").select("site_id", F.col("new_props").alias("props"), F.col("new_geometry").alias("geometry"))
    had = index.where(F.size("shards") > 0).select("site_id")
    used = M.consumed(had, refreshed, removed)
    after = M.apply_changes(mirror.lines(touched, state), moved).unionByName(M.new_lines(refreshed, used))
    idx, par = M.patch_stores(index, parked, removed, refreshed, used, entries)
    # an id that went keeps its date, so that a late row cannot bring it back; ids that are back lose it
    dated = rows.groupBy("site_id").agg(F.max("last_update").alias("last_update"))
    late = gone.join(moved, "site_id", "left_anti").unionByName(removed.join(dated, "site_id").select("site_id", "last_update").where("last_update is not null"))
    mirror.commit(state | {"dataset_date": today}, after, idx, par, late, {s: v for s, v in held.items() if s not in touched})
    mirror.log(W.run_summary(summed, str(today), before))
    return sizes


def _again(run, attempts: int) -> dict:
    """run, from the mirror's new state if another writer was first."""
    for i in range(attempts):
        try:
            return run()
        except M.Conflict:
            if i + 1 == attempts:
                raise


def newest_only(mirror: M.Mirror, state: dict, days: DataFrame, lateness: int) -> DataFrame:
    """days of ids with live: false where an id's newer row, or its removal, has overtaken them, and where they are older than the mark by more than lateness days.

    Pages may come in any order: an id's date in the index, or of its removal, is what a day has to reach.
    """
    index, _, gone = mirror.stores(state)
    live = F.col("known").isNull() | (F.col("last_update") >= F.col("known"))
    if state["mark"]:
        live &= F.col("last_update") >= F.lit(state["mark"]) - F.lit(lateness)
    known = index.select("site_id", F.col("last_update").alias("known")).unionByName(gone.select("site_id", F.col("last_update").alias("known"))).where("known is not null")
    days = days.repartition(state["buckets"], "site_id").join(known, "site_id", "left")
    return days.withColumn("live", F.coalesce(live, F.lit(False))).drop("known")


def _summed(mirror: M.Mirror, state: dict, rows: DataFrame, lateness: int | None = None) -> DataFrame:
    """A window's rows, read once, as a table of one row an id that is bucketed like the mirror; all later steps read that."""
    days = C.by_day(rows)
    days = days.repartition(state["buckets"], "site_id").withColumn("live", F.lit(True)) if lateness is None else newest_only(mirror, state, days, lateness)
    return mirror.bucketed("windows", _attempt(state), C.by_id(days), state["buckets"])


def apply_window(mirror: M.Mirror, rows: DataFrame, details: Details, today: dt.date, caps: dict | None = None, lateness: int | None = None, attempts: int = 3) -> dict:
    """One increment, within caps (of delta_fault).  Applying a window twice gives the same mirror, so a replayed batch is harmless.

    lateness: rows may be older than what the mirror holds, see ``newest_only``.
    """

    def run() -> dict:
        state = mirror.state()
        seen = _summed(mirror, state, rows, lateness)
        C.require(C.flag_fault(seen))
        index, parked, _ = mirror.stores(state)
        active, gone = C.split_summed(seen)
        drop = C.removals(index, parked, gone, active).withColumn("kind", F.lit("removed"))
        delta = C.classify(index, parked, active).unionByName(drop)
        newest = seen.select("site_id", F.col("newest").alias("last_update"))
        return _apply(mirror, state, delta, active, details, today, C.delta_fault(**(caps or {})), newest)

    return _again(run, attempts)


def apply_census(mirror: M.Mirror, catalog: DataFrame, details: Details, today: dt.date, rows: DataFrame | None = None, attempts: int = 3) -> dict:
    """A full comparison with the catalogue, with a window's corrections if given."""

    def run() -> dict:
        state = mirror.state()
        index, parked, _ = mirror.stores(state)
        whole = mirror.bucketed("catalogs", _attempt(state), catalog, state["buckets"])
        listed = whole.where(~F.col("hs")).select("site_id", "v_major", "v_minor", "last_update")
        diff = C.census_diff(index, whole)
        if rows is not None:
            seen = _summed(mirror, state, rows)
            C.require(C.flag_fault(seen))
            diff = C.fold_census(diff, index, parked, whole, C.split_summed(seen)[0])
        return _apply(mirror, state, diff, listed, details, today, C.census_fault(), whole.where(~F.col("hs")), whole.count())

    return _again(run, attempts)


def sync(mirror: M.Mirror, catalog: DataFrame, rows: DataFrame, details: Details, today: dt.date, forced: bool = False) -> dict:
    """A census if one is due, else an increment of the rows from the stored high-water mark on, its day included."""
    s = mirror.state()
    one = mirror.spark.range(1).select(C.wants_census(F.lit(s["last_sweep_date"]).cast("date"), F.lit(s["last_full_census_date"]).cast("date"), F.lit(today), forced).alias("c"))
    since = window(rows, F.lit(s["last_sweep_date"]).cast("date")) if s["last_sweep_date"] else None
    if one.head()["c"]:
        return apply_census(mirror, catalog, details, today, since)
    return apply_window(mirror, since, details, today)


def sync_pages(mirror: M.Mirror, catalog_pages: DataFrame, window_pages: DataFrame, details: Details, today: dt.date, forced: bool = False, limit: int = 500) -> dict:
    """sync from landed pages, which must be complete: a cut-off listing would look like removals."""
    for pages in (catalog_pages, window_pages):
        require_complete(pages, limit)
    return sync(mirror, catalog(site_rows(catalog_pages)), site_rows(window_pages), details, today, forced)


#: Days that a streamed row may be older than the newest one applied.
LATENESS = 30


def stream_windows(spark: SparkSession, landing: str, checkpoint: str, mirror: M.Mirror, details: Details, today: dt.date, caps: dict | None = None, lateness: int = LATENESS, files: int | None = None):
    """Apply landed pages of change windows as they come, ``files`` at once, then stop.

    All state is in the mirror: a stream that starts again from its checkpoint goes on where it was.  The mark in the mirror's state,
    the newest date applied, tells which rows are too old to count, and each id's own date which are overtaken, so pages may come
    late or out of order.
    """

    def batch(df: DataFrame, _: int) -> None:
        rows = site_rows(df)
        if not rows.isEmpty():
            apply_window(mirror, rows, details, today, caps, lateness)

    feed = spark.readStream.schema(PAGE)
    feed = (feed.option("maxFilesPerTrigger", files) if files else feed).json(landing)
    return feed.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
