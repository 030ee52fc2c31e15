"""Append-only run tables. What is "latest" is a query, not a stored pointer, so appends never race."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .files import path_exists

ARTIFACTS = "run_id string, ts timestamp_ntz, artifact string, path string, schema_json string"
MODELS = "run_id string, ts timestamp_ntz, target string, model string, path string"
METRICS = "run_id string, target string, model string, metric string, value double"


def append(rows: DataFrame, path: str) -> str:
    rows.write.mode("append").parquet(path)
    return path


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The run table; empty before the first append."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def record_artifacts(spark: SparkSession, path: str, run_id: str, ts: datetime, artifacts: list[tuple[str, str, str]]) -> str:
    return append(spark.createDataFrame([(run_id, ts, *a) for a in artifacts], ARTIFACTS), path)


def latest_artifacts(catalog: DataFrame, before: datetime | None = None) -> DataFrame:
    """``(artifact, ts, run_id, path)``: the newest entry per artifact, up to a moment if given.

    An aggregate that combines before its shuffle, so an artifact with most of the entries is cheap.
    """
    entries = catalog if before is None else catalog.filter(F.col("ts") <= F.lit(before).cast("timestamp_ntz"))
    newest = F.max(F.struct("ts", "run_id", "path")).alias("e")
    return entries.groupBy("artifact").agg(newest).select("artifact", "e.ts", "e.run_id", "e.path")


def latest_artifact_path(catalog: DataFrame, artifact: str) -> str:
    row = latest_artifacts(catalog.filter(F.col("artifact") == artifact)).first()
    if row is None:
        raise LookupError(f"no artifact {artifact!r}")
    return row["path"]


def record_models(spark: SparkSession, path: str, entries: list[tuple]) -> str:
    return append(spark.createDataFrame(entries, MODELS), path)


def latest_models(models: DataFrame) -> DataFrame:
    """The newest model per target; equal times go by run id."""
    newest = F.max(F.struct("ts", "run_id", "model", "path")).alias("e")
    return models.groupBy("target").agg(newest).select("target", "e.ts", "e.run_id", "e.model", "e.path")


def latest_overall(models: DataFrame) -> DataFrame:
    return models.agg(F.max(F.struct("ts", "run_id", "target", "model", "path")).alias("e")).select("e.*")


def record_metrics(metrics: DataFrame, path: str) -> str:
    """Append a table ``(run_id, target, model, metric, value)``."""
    return append(metrics.select("run_id", "target", "model", "metric", "value"), path)


def leaderboard(metrics: DataFrame, metric: str = "rmse", top: int = 5) -> DataFrame:
    """``(target, rank, model, value)``: the ``top`` smallest values per target, missing ones last.

    One row per model and target comes in (the best of its runs).
    """
    best = metrics.filter(F.col("metric") == metric).groupBy("target", "model").agg(F.min("value").alias("value"))
    order = Window.partitionBy("target").orderBy(F.col("value").asc_nulls_last(), "model")
    return (
        best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("target", "rank", "model", "value")
    )
