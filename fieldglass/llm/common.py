"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows turned into Python objects at a time, so that memory follows the texts and not the Arrow batch.
SLICE_ROWS = 256


def share_package(spark: SparkSession) -> None:
    """Let Python workers that see this folder import the package from it; elsewhere it must be shipped with ``--py-files``."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[list[list]]:
    """Python columns of at most ``rows`` rows each."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield [column.to_pylist() for column in batch.slice(start, rows).columns]


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def partitions(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
