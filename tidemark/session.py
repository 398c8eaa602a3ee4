"""Shipping this package to the executors' Python workers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; where it is unset, as in tests, a local one.

    Without the setting a session on several machines is refused: each would write to its own disk.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    sc = spark.sparkContext
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _own:
        _own[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    return _own[sc.applicationId]


@contextmanager
def split_code(spark: SparkSession):
    """Wide projections that run while this holds are compiled as many methods.

    As one method they are beyond the 8,000 bytes of code up to which HotSpot compiles, and every row would be interpreted.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def kept(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder once and read back, so that several uses do not compute it again."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes in a batch sent to a Python worker: rows can be long texts, so a bound on rows alone bounds no memory.
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the application's Python files, once an application, and bound batches by bytes."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark-src.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)
