"""Shared storage for intermediate tables, and size-checked row-id filters."""

from __future__ import annotations

import os
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


def fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back with the same schema."""
    spark, path = df.sparkSession, fresh(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def local_uri(uri: str) -> str:
    return uri[7:] if uri.startswith("file://") else os.path.abspath(uri) if "://" not in uri else uri


BLOOM_WORDS = 1 << 19  # of 64 bits: 4 MB, whatever the data


def _slot(ids: np.ndarray) -> np.ndarray:
    from .text import mix

    return mix(ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(BLOOM_WORDS * 64 - 1)


def id_filter(ids: DataFrame, column: str):
    """A broadcast bitmap of fixed size that holds the hashed ids.

    It lets a scan leave out most rows that a later exact join would drop; it never decides a
    result.  When the ids are too many it fills up and just lets everything pass.
    """

    def bits(batches):
        import pyarrow as pa

        for b in batches:
            s = np.unique(_slot(b.column(0).to_numpy(zero_copy_only=False)))
            w, at = np.unique(s >> np.uint64(6), return_index=True)
            v = np.bitwise_or.reduceat(np.uint64(1) << (s & np.uint64(63)), at) if len(s) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(v.view(np.int64))], ["w", "v"])

    got = ids.select(F.col(column).cast("long")).where(F.col(column).isNotNull()).mapInArrow(bits, "w long, v long").groupBy("w").agg(F.expr("bit_or(v)").alias("v")).toArrow()
    table = np.zeros(BLOOM_WORDS, np.uint64)
    table[got.column("w").to_numpy()] = got.column("v").to_numpy().view(np.uint64)
    return ids.sparkSession.sparkContext.broadcast(table)


def may_hold(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    s = _slot(ids)
    return (table[s >> np.uint64(6)] >> (s & np.uint64(63))) & np.uint64(1) != 0
