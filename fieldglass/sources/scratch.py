"""Intermediate tables in the shared folder the cluster names.

A written table cuts lineage the way a reliable checkpoint does, is read back with column pruning,
and survives the loss of any executor.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

#: Folders of the open scopes of a thread, innermost last.
_open = threading.local()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a local one only for local masters without it."""
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a shared folder on a cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="fieldglass-"))
    return context.getCheckpointDir().rstrip("/")


def _scopes() -> list[str]:
    if not hasattr(_open, "folders"):
        _open.folders = []
    return _open.folders


def scratch_path(spark: SparkSession, label: str = "table", keep: bool = False) -> str:
    """A fresh, never reused path below the scratch root, in the folder of the open scope, or of the one around it to ``keep`` it."""
    folders = _scopes()[: -1 if keep else None]
    base = folders[-1] if folders else f"{scratch_root(spark)}/fieldglass/{spark.sparkContext.applicationId}"
    return f"{base}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that are materialised inside are deleted at the end, except those that are kept. Results must not read deleted ones."""
    folder = scratch_path(spark, "scope")
    _scopes().append(folder)
    try:
        yield
    finally:
        _scopes().remove(folder)
        _delete(spark, folder)


def materialize(df: DataFrame, label: str = "table", keep: bool = False) -> DataFrame:
    """Write ``df`` once and return a DataFrame over the written table. ``keep``: it outlives the open scope."""
    spark = df.sparkSession
    path = scratch_path(spark, label, keep)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application. Call it once their results are stored."""
    _delete(spark, f"{scratch_root(spark)}/fieldglass/{spark.sparkContext.applicationId}")
