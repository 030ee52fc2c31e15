"""Queries over the streaming operators: what a drained stream leaves equals the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.scratch import scratch_path
from ..streaming import incremental
from .base import check, rounded, table, union_all
from .sources import READ, day_files

SCHEMA = "event_id INT, ts TIMESTAMP_NTZ, user_id INT, event_type STRING, value DOUBLE"


def parquet_files(spark, sf_dir):
    """Events in several Parquet files."""
    path = scratch_path(spark, "arrivals")
    events = table(spark, sf_dir, "events").drop("props")
    events.repartition(6, "event_id").write.parquet(path)
    return path, events.schema


@check("incremental_ingest", READ)
def incremental_ingest(spark, sf_dir):
    folder, base = day_files(spark, sf_dir), scratch_path(spark, "ingest")
    return incremental.incremental_ingest(spark, folder, SCHEMA, f"{base}/table", f"{base}/checkpoint", files_per_batch=10).drop("day")


_NUMBERS = ("event_id", "user_id", "value")


@check(
    "mergeable_profile",
    union_all(
        [
            f"SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) - count({c}) AS missing_count, count({c}) AS nonnull_count, "
            + (f"round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS stddev " if c in _NUMBERS else "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev ")
            + "FROM events"
            for c in ("event_id", "ts", "user_id", "event_type", "value")
        ]
    ),
)
def mergeable_profile(spark, sf_dir):
    folder, schema = parquet_files(spark, sf_dir)
    base = scratch_path(spark, "profile")
    stream = incremental.file_stream(spark, folder, schema, "parquet", 2)
    incremental.update_profile(stream, f"{base}/parts", f"{base}/checkpoint")
    return rounded(incremental.merged_profile(spark, f"{base}/parts").drop("approx_distinct_count"), 5)


@check(
    "incremental_pca",
    "SELECT component, round(ratio, 6) AS ratio FROM (SELECT 'pca_0' AS component, big / (big + small) AS ratio FROM v UNION ALL SELECT 'pca_1', small / (big + small) FROM v)".replace(
        "FROM v",
        "FROM (SELECT (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS big, (a + c) / 2 - sqrt(pow((a - c) / 2, 2) + b * b) AS small "
        "FROM (SELECT var_samp(value) AS a, covar_samp(value, user_id) AS b, var_samp(user_id) AS c FROM events) m) v",
    ),
)
def incremental_pca(spark, sf_dir):
    folder, schema = parquet_files(spark, sf_dir)
    base = scratch_path(spark, "pca")
    stream = incremental.file_stream(spark, folder, schema, "parquet", 2)
    incremental.update_moments(stream, ["value", "user_id"], f"{base}/parts", f"{base}/checkpoint")
    loadings = incremental.incremental_pca(spark, ["value", "user_id"], f"{base}/parts")
    return rounded(loadings.select("component", "ratio").distinct())


@check(
    "windowed_event_stats",
    "SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, event_type, count(*) AS n, round(avg(value), 9) AS mean, round(stddev_samp(value), 9) AS std, min(value) AS min, max(value) AS max "
    "FROM (SELECT *, date_trunc('day', ts)::TIMESTAMP AS window_start FROM events) e WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY window_start, event_type",
)
def windowed_event_stats(spark, sf_dir):
    """Windows closed by the watermark; the last day stays open."""
    folder, schema = parquet_files(spark, sf_dir)
    base = scratch_path(spark, "windows")
    stream = incremental.file_stream(spark, folder, schema, "parquet")
    incremental.windowed_event_stats(stream, "ts", "value", f"{base}/table", f"{base}/checkpoint", ["event_type"])
    stats = spark.read.parquet(f"{base}/table")
    return rounded(
        stats.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}), 9
    )
