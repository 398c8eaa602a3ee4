"""Catalogue differences, change windows and the gates before any write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import days_between
from ..functions.decode import removed
from ..functions.fixed import DEFAULT, Config


def same_version(a: str, b: str) -> Column:
    """Null equals null."""
    return F.col(f"{a}.v_major").eqNullSafe(F.col(f"{b}.v_major")) & F.col(f"{a}.v_minor").eqNullSafe(F.col(f"{b}.v_minor"))


def census_diff(index: DataFrame, catalog: DataFrame) -> DataFrame:
    """(site_id, kind): added, changed or removed, by a full comparison of the index with the catalogue."""
    j = index.alias("m").join(catalog.alias("a"), F.col("m.site_id") == F.col("a.site_id"), "full_outer")
    here, there = F.col("m.site_id").isNotNull(), F.col("a.site_id").isNotNull()
    gone = here & (~there | F.coalesce(F.col("a.hs"), F.lit(False)))
    moved = ~same_version("m", "a") | F.coalesce(F.col("a.last_update") > F.col("m.last_update"), F.lit(False))
    kind = F.when(gone, "removed").when(~here & ~F.col("a.hs"), "added").when(here & there & moved, "changed")
    return j.select(F.coalesce("m.site_id", "a.site_id").alias("site_id"), kind.alias("kind")).where("kind is not null")


def split_window(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Active rows (the last of each id) and ids that the window removes or moves to the high seas."""
    from ..sources.readers import last_write

    r = rows.withColumn("gone", removed(F.col("status")) | F.col("hs"))
    order = [F.col(c) for c in ("page", "pos", "seq") if c in rows.columns]
    active = last_write(r.where(~F.col("gone")), "site_id", *order).select("site_id", "v_major", "v_minor", "last_update")
    return active, r.where("gone").select("site_id").distinct()


def by_day(rows: DataFrame) -> DataFrame:
    """A window's rows summed by id and day: place (at) and versions of the last active one, whether one is gone, whether one has a status.

    All sums have a fixed width, so they form in hash tables before the shuffle, and an id with many rows is no burden.
    """
    low = {"page": -(1 << 31), "pos": 0, "seq": -(1 << 63)}
    order = [c for c in low if c in rows.columns]
    parts = [F.coalesce(F.col(c), F.lit(low[c])) for c in order]
    if order == ["page", "pos"]:
        at = F.shiftleft(parts[0].cast("long"), 32) + parts[1]
    else:
        at = parts[0].cast("long") if len(parts) == 1 else F.struct(*parts)
    gone = removed(F.col("status")) | F.col("hs")
    r = rows.select("site_id", "last_update", "v_major", "v_minor", gone.alias("gone"), F.col("status").isNotNull().alias("told"), F.when(~gone, at).alias("at"))
    last = [F.max_by(c, "at").alias(c) for c in ("v_major", "v_minor")]
    return r.groupBy("site_id", "last_update").agg(F.max("at").alias("at"), *last, F.bool_or("gone").alias("gone"), F.bool_or("told").alias("told"))


def by_id(days: DataFrame) -> DataFrame:
    """One row an id of ``by_day``: the last active row of its days that are live, the newest of those, and status, not null if a row of any day has one."""
    live = F.col("live")
    at = F.when(live, F.col("at"))
    last = [F.max_by(c, at).alias(c) for c in ("v_major", "v_minor", "last_update")]
    gone, newest = F.bool_or(live & F.col("gone")), F.max(F.when(live, F.col("last_update")))
    return days.groupBy("site_id").agg(F.max(at).isNotNull().alias("active"), *last, gone.alias("gone"), newest.alias("newest"), F.when(F.bool_or("told"), True).alias("status"))


def split_summed(seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``split_window`` of rows summed by id."""
    return seen.where("active").select("site_id", "v_major", "v_minor", "last_update"), seen.where("gone").select("site_id")


def classify(index: DataFrame, parked: DataFrame, active: DataFrame) -> DataFrame:
    """(site_id, kind) of active rows: changed if indexed, refetch if parked, else added."""
    a = active.select("site_id").join(index.select("site_id", F.lit(1).alias("i")), "site_id", "left").join(parked.select("site_id", F.lit(1).alias("p")), "site_id", "left")
    return a.select("site_id", F.when(F.col("i") == 1, "changed").when(F.col("p") == 1, "refetch").otherwise("added").alias("kind"))


def removals(index: DataFrame, parked: DataFrame, gone: DataFrame, active: DataFrame) -> DataFrame:
    """Ids to remove: those the window drops, that are mirrored and not active in it; its order does not matter."""
    held = index.select("site_id").union(parked.select("site_id")).distinct()
    return gone.select("site_id").distinct().join(held, "site_id", "left_semi").join(active, "site_id", "left_anti")


def fold_census(diff: DataFrame, index: DataFrame, parked: DataFrame, catalog: DataFrame, active: DataFrame) -> DataFrame:
    """A census with the corrections of a window: listed ids only; indexed ones change, parked ones are fetched again."""
    listed = active.select("site_id").join(catalog.where(~F.col("hs")), "site_id", "left_semi")
    extra = classify(index, parked, listed).where("kind <> 'added'")
    base = diff.join(extra.where("kind = 'refetch'"), "site_id", "left_anti")
    return base.unionByName(extra.join(base, ["site_id", "kind"], "left_anti"))


def split_added(added: DataFrame, source: DataFrame, parked: DataFrame) -> DataFrame:
    """(site_id, skipped): an added id that is parked with the version it still has need not be fetched."""
    j = added.select("site_id").join(source.alias("a"), "site_id", "left").join(parked.withColumn("known", F.lit(True)).alias("p"), "site_id", "left")
    there = F.col("a.v_major").isNotNull() | F.col("a.v_minor").isNotNull() | F.col("a.last_update").isNotNull()
    return j.select("site_id", (F.coalesce(F.col("p.known"), F.lit(False)) & there & same_version("a", "p")).alias("skipped"))


def adopt_versions(legacy_ids: DataFrame, source: DataFrame) -> DataFrame:
    """A parked list without versions takes those of the source; ids it does not list go."""
    return legacy_ids.join(source, "site_id").select("site_id", "v_major", "v_minor")


def versioned_parked(parked: DataFrame, source: DataFrame) -> DataFrame:
    """The parked store with versions: a legacy list, where no row has one, adopts the source's."""
    known = F.count_if(F.col("v_major").isNotNull() | F.col("v_minor").isNotNull())
    n = parked.agg(F.count("*").alias("n"), known.alias("known")).head()
    return adopt_versions(parked.select("site_id"), source) if n["n"] and not n["known"] else parked


def delta_sizes(delta: DataFrame, index: DataFrame) -> DataFrame:
    """One row: added, changed, removed, refetch, mirror_size."""
    kinds = ["added", "changed", "removed", "refetch"]
    return delta.agg(*(F.count_if(F.col("kind") == k).alias(k) for k in kinds)).crossJoin(index.agg(F.count("*").alias("mirror_size")))


def delta_fault(removed_abs: int = 200, removed_ratio: float = 0.02, delta_ratio: float = 0.5) -> Column:
    """Why an increment must not be applied, from delta_sizes; null if it may."""
    m = F.col("mirror_size")
    cap = F.least(F.lit(removed_abs), F.ceil(m * removed_ratio))
    touched = F.col("added") + F.col("changed") + F.col("removed")
    return F.when(m > 0, F.when(F.col("removed") > cap, "too many removals").when(touched > F.ceil(m * delta_ratio), "too many changes"))


def census_fault(removed_ratio: float = 0.1) -> Column:
    """Why a census must not be applied, from delta_sizes with catalog_size; null if it may."""
    m = F.col("mirror_size")
    return F.when(m > 0, F.when(F.col("catalog_size") < m * 0.5, "half-empty catalogue").when(F.col("removed") > m * removed_ratio, "too many removals"))


def flag_fault(rows: DataFrame) -> DataFrame:
    """A window with rows must carry a status on one of them, or removals would be invisible."""
    return rows.agg(F.when((F.count("*") > 0) & (F.count("status") == 0), "no status in the window").alias("fault"))


def require(gate: DataFrame) -> None:
    """Raise if a one-row gate has a fault.  Runs before any write."""
    if why := gate.select("fault").head()["fault"]:
        raise ValueError(f"refused: {why}")


def newest_update(catalog: DataFrame) -> DataFrame:
    return catalog.where(~F.col("hs")).agg(F.max("last_update").alias("newest"))


def wants_census(last_sweep: Column, last_census: Column, today: Column, forced: Column | bool = False, config: Config = DEFAULT) -> Column:
    """Forced, without a baseline, with one over 60 days old, or with the last census over 30 days ago."""
    forced = F.lit(forced) if isinstance(forced, bool) else forced
    return forced | last_sweep.isNull() | (days_between(last_sweep, today) > config.baseline_days) | (days_between(last_census, today) > config.census_days)
