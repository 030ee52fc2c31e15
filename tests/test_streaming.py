"""A drained stream equals the batch; a replay adds nothing; late rows are dropped."""

import shutil

from pyspark.sql import functions as F

from fieldglass.operators import profile
from fieldglass.sources.scratch import scratch_path
from fieldglass.streaming import incremental

SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, value DOUBLE"


def drop(events, folder, condition):
    events.filter(condition).select("event_id", "ts", "value").coalesce(1).write.mode("append").parquet(folder)


def test_ingest_continues_where_it_stopped(spark, events):
    folder, base = scratch_path(spark, "in"), scratch_path(spark, "out")

    def run():
        return incremental.incremental_ingest(spark, folder, SCHEMA, f"{base}/t", f"{base}/c", "parquet", 1, "ts").count()

    drop(events, folder, "event_id < 400")
    assert run() == 400
    assert run() == 400
    drop(events, folder, "event_id >= 400")
    assert run() == events.count()


def test_profile_parts_merge_to_the_batch_profile(spark, events):
    folder, base = scratch_path(spark, "in"), scratch_path(spark, "out")
    for part in range(3):
        drop(events, folder, F.col("event_id") % 3 == part)
    for _ in range(2):  # the second run finds nothing new
        incremental.update_profile(incremental.file_stream(spark, folder, SCHEMA, "parquet", 1), f"{base}/p", f"{base}/c")
    merged = {r["column_name"]: r for r in incremental.merged_profile(spark, f"{base}/p").collect()}
    batch = {r["column_name"]: r for r in profile.profile_columns(events.select("event_id", "ts", "value")).collect()}
    for name, row in batch.items():
        assert merged[name]["total_rows"] == row["total_rows"] and merged[name]["missing_count"] == row["missing_count"]
        assert abs(merged[name]["approx_distinct_count"] - row["distinct_count"]) <= 0.05 * row["distinct_count"]
    spread = events.agg(F.stddev_samp("value")).first()[0]
    assert abs(merged["value"]["stddev"] - spread) < 1e-9


def test_replayed_batch_overwrites_its_part(spark, events):
    folder, base = scratch_path(spark, "in"), scratch_path(spark, "out")
    drop(events, folder, "true")
    for _ in range(2):
        incremental.update_moments(
            incremental.file_stream(spark, folder, SCHEMA, "parquet"), ["value", "event_id"], f"{base}/p", f"{base}/c"
        )
        shutil.rmtree(f"{base}/c")  # as if the checkpoint had been lost after the write
    assert incremental.merged_moments(spark, ["value", "event_id"], f"{base}/p").n == events.count()


def test_moments_of_many_batches(spark, events):
    import numpy as np

    folder, base = scratch_path(spark, "in"), scratch_path(spark, "out")
    drop(events.repartition(40).withColumn("value", F.expr("value + 1e9")), folder, "true")
    stream = incremental.file_stream(spark, folder, SCHEMA, "parquet", 2)
    incremental.update_moments(stream, ["value", "event_id"], f"{base}/p", f"{base}/c")
    found = incremental.merged_moments(spark, ["value", "event_id"], f"{base}/p")
    rows = np.array([(r["value"], r["event_id"]) for r in events.collect()], float)
    assert found.n == len(rows) and np.allclose(found.covariance(), np.cov(rows.T), rtol=1e-6)
    empty = incremental.file_stream(spark, folder, SCHEMA, "parquet").filter("event_id < 0")
    incremental.update_moments(empty, ["value", "event_id"], f"{base}/q", f"{base}/d")
    assert incremental.incremental_pca(spark, ["value", "event_id"], f"{base}/q").count() == 0


def test_late_rows_are_dropped(spark, events):
    folder, base = scratch_path(spark, "in"), scratch_path(spark, "out")

    def run():
        stream = incremental.file_stream(spark, folder, SCHEMA, "parquet", 1)
        incremental.windowed_event_stats(stream, "ts", "value", f"{base}/t", f"{base}/c")
        return {str(r["window_start"].date()): r["n"] for r in spark.read.parquet(f"{base}/t").collect()}

    late = "event_id = 5"
    drop(events, folder, f"NOT ({late})")
    first = run()
    drop(events, folder, late)
    assert run() == first
    days = {str(r["d"]): r["count"] for r in events.filter(f"NOT ({late})").groupBy(F.to_date("ts").alias("d")).count().collect()}
    assert first == {d: n for d, n in days.items() if d in first} and len(first) >= len(days) - 2
