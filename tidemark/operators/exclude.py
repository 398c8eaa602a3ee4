"""The exclusion policy and its tallies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.decode import has_token
from ..functions.fixed import DEFAULT, Config

REASONS = ["categoryId", "areaWithoutHardBan", "bboxSpanWithoutHardBan"]
COUNTS = ["featuresIn", "kept", "componentsFull", "componentsDisplay", "simplifyFallbacks"]


def hard_ban(config: Config = DEFAULT, coarse: str = "coarse") -> Column:
    out = F.lit(False)
    for c in config.hard_bans:
        out = out | (F.col(f"{coarse}.{c}") == "prohibited")
    return out


def drop_reason(category_id: Column, area: Column, span: Column, ban: Column, config: Config = DEFAULT) -> Column:
    """The first rule that excludes a feature; null keeps it.  A null area or category trips nothing."""
    return F.when(category_id.isin(*config.exclude_categories), REASONS[0]).when((area > config.max_area_km2) & ~ban, REASONS[1]).when((span > config.max_span_deg) & ~ban, REASONS[2])


def without_partitions(df: DataFrame, column: str = "partition", config: Config = DEFAULT) -> DataFrame:
    """Leaves whole partitions out; on a partition column this prunes files."""
    return df.where(~has_token(F.col(column), config.exclude_partitions))


def tally(features: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """One row a partition: drops by reason and counts, in one pass.

    features has partition, drop_reason, components and fallbacks.  An excluded partition counts as one drop
    whatever it holds, and features_skipped tells how many.
    """
    out = has_token(F.col("partition"), config.exclude_partitions)
    f = features.withColumn("out", out)
    live, kept = ~F.col("out"), ~F.col("out") & F.col("drop_reason").isNull()
    return f.groupBy("partition").agg(
        *(F.count_if(live & (F.col("drop_reason") == r)).alias(r) for r in REASONS),
        F.max(F.col("out").cast("long")).alias("partitionDrop"),
        F.count_if(live).alias("featuresIn"),
        F.count_if(kept).alias("kept"),
        F.coalesce(F.sum(F.when(kept, F.col("components"))), F.lit(0)).cast("long").alias("componentsFull"),
        F.coalesce(F.sum(F.when(kept, F.col("components"))), F.lit(0)).cast("long").alias("componentsDisplay"),
        F.coalesce(F.sum(F.when(kept, F.col("fallbacks"))), F.lit(0)).cast("long").alias("simplifyFallbacks"),
        F.count_if(F.col("out")).alias("features_skipped"),
    )


def tally_rows(rows: DataFrame) -> DataFrame:
    """``tally`` of rows that were exploded already: partition, drop_reason, excluded, component_index and fallback.

    A feature with several components has a row each, any other one row without an index.
    """
    one = F.coalesce(F.col("component_index"), F.lit(0)) == 0
    live, whole = ~F.col("excluded"), F.col("component_index").isNotNull()
    return rows.groupBy("partition").agg(
        *(F.count_if(one & live & (F.col("drop_reason") == r)).alias(r) for r in REASONS),
        F.max(F.col("excluded").cast("long")).alias("partitionDrop"),
        F.count_if(one & live).alias("featuresIn"),
        F.count_if(one & live & F.col("drop_reason").isNull()).alias("kept"),
        F.count_if(whole).alias("componentsFull"),
        F.count_if(whole).alias("componentsDisplay"),
        F.count_if(whole & F.col("fallback")).alias("simplifyFallbacks"),
        F.count_if(one & ~live).alias("features_skipped"),
    )


def fragments(tallies: DataFrame) -> DataFrame:
    """Nested form of tallies, as written."""
    return tallies.select("partition", F.struct(*REASONS, F.col("partitionDrop").alias("partition")).alias("drops"), F.struct(*COUNTS).alias("counts"), (F.col("partitionDrop") > 0).alias("excludedPartition"))


def flat(fragments: DataFrame) -> DataFrame:
    """Tallies again, from their nested form; leaves that a fragment lacks are 0."""
    leaf = lambda path, name: F.coalesce(F.col(path), F.lit(0)).alias(name)
    return fragments.select("partition", *(leaf(f"drops.{r}", r) for r in REASONS), leaf("drops.partition", "partitionDrop"), *(leaf(f"counts.{c}", c) for c in COUNTS))


def merge(tallies: DataFrame) -> DataFrame:
    """One row: every count summed over partitions, missing ones as 0, and the sorted partition names."""
    leaves = [*REASONS, "partitionDrop", *COUNTS]
    return tallies.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in leaves), F.array_join(F.sort_array(F.collect_list("partition")), ",").alias("partitions"))
