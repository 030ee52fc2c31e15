"""File streams: ingest, mergeable profiles, mergeable PCA and windowed statistics.

State lives in tables of additive parts keyed by batch id. A replayed batch overwrites its own part, so
results are the same after any restart.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.missing import known_double, missing, quoted, row_per
from ..operators import gram, states
from ..sources.files import CSV_OPTIONS, path_exists


def file_stream(spark: SparkSession, folder: str, schema: StructType | str, fmt: str = "csv", files_per_batch: int | None = None) -> DataFrame:
    """New files of a folder with a declared schema."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.load(folder)


def _run(writer, checkpoint: str) -> None:
    """Process what is available, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def incremental_ingest(
    spark: SparkSession, folder: str, schema: StructType | str, sink: str, checkpoint: str, fmt: str = "csv", files_per_batch: int = 2, date_column: str | None = None
) -> DataFrame:
    """Append the files that arrived since the last call to a Parquet table and return the table.

    With ``date_column`` the table is partitioned by day.
    """
    stream = file_stream(spark, folder, schema, fmt, files_per_batch)
    if date_column:
        stream = stream.withColumn("day", quoted(date_column).cast("date"))
    writer = stream.writeStream.format("parquet").option("path", sink).outputMode("append")
    _run(writer.partitionBy("day") if date_column else writer, checkpoint)
    return spark.read.parquet(sink)


# --- profile -------------------------------------------------------------------------------------


def _profile_parts(batch: DataFrame) -> DataFrame:
    """One row per column: counts, mean, sum of squared deviations and a distinct-count sketch."""
    entries = []
    for field in batch.schema:
        numeric = field.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double") or field.dataType.typeName().startswith("decimal")
        value = known_double(batch, field.name) if numeric else F.lit(None).cast("double")
        entries.append(
            {
                "column_name": F.lit(field.name),
                "gap": missing(field),
                "present": quoted(field.name).isNotNull(),
                "value": value,
                "hash": F.when(quoted(field.name).isNotNull(), F.xxhash64(quoted(field.name))),
            }
        )
    long = batch.select(row_per(entries)).select("r.*")
    return long.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("gap").alias("missing"),
        F.count_if("present").alias("nonnull"),
        F.count("value").alias("numbers"),
        F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("value")).alias("m2"),
        F.hll_sketch_agg("hash").alias("sketch"),
    )


def update_profile(stream: DataFrame, parts: str, checkpoint: str) -> None:
    """Write the partial profile of every new batch below ``parts``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        _profile_parts(batch).write.mode("overwrite").parquet(f"{parts}/batch_id={batch_id}")

    _run(stream.writeStream.foreachBatch(write), checkpoint)


PARTS = "column_name string, n bigint, missing bigint, nonnull bigint, numbers bigint, mean double, m2 double, sketch binary, batch_id bigint"


def merged_profile(spark: SparkSession, parts: str) -> DataFrame:
    """``(column_name, total_rows, missing_count, nonnull_count, mean, stddev, approx_distinct_count)``."""
    if not path_exists(spark, parts):
        table = spark.createDataFrame([], PARTS)
    else:
        table = spark.read.schema(PARTS).parquet(parts)
    weighted = F.try_divide(F.sum(F.col("numbers") * F.col("mean")), F.sum("numbers").cast("double"))
    sums = table.groupBy("column_name").agg(
        F.sum("n").alias("total_rows"),
        F.sum("missing").alias("missing_count"),
        F.sum("nonnull").alias("nonnull_count"),
        F.sum("numbers").alias("numbers"),
        weighted.alias("mean"),
        F.sum("m2").alias("inner"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct_count"),
    )
    # sums has one row per column
    centres = sums.select("column_name", F.col("mean").alias("centre"))
    shift = F.pow(F.col("mean") - F.col("centre"), F.lit(2.0)) * F.col("numbers")
    between = table.join(F.broadcast(centres), "column_name").groupBy("column_name").agg(F.sum(shift).alias("outer"))
    variance = F.try_divide(F.col("inner") + F.col("outer"), (F.col("numbers") - 1).cast("double"))
    return sums.join(F.broadcast(between), "column_name").select(
        "column_name", "total_rows", "missing_count", "nonnull_count", "mean", F.sqrt(variance).alias("stddev"), "approx_distinct_count"
    )


# --- principal components ------------------------------------------------------------------------

MOMENT_PARTS = f"{states.SCHEMA}, batch_id bigint"


def update_moments(stream: DataFrame, columns: Sequence[str], parts: str, checkpoint: str) -> None:
    """Write the states of each new batch: count, means and centred products of the columns, tile by tile.

    Rows with a missing input are skipped. A batch that runs again replaces what it wrote.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        gram.tiles_of(batch, columns).write.mode("overwrite").parquet(f"{parts}/batch_id={batch_id}")

    _run(stream.writeStream.foreachBatch(write), checkpoint)


def merged_moments(spark: SparkSession, columns: Sequence[str], parts: str) -> gram.Gram | None:
    """The state of all rows seen so far, or None before the first complete one."""
    stored = spark.read.schema(MOMENT_PARTS).parquet(parts)
    # tasks of different batches have the same numbers: deal the states out evenly
    spread = F.pmod(F.xxhash64("batch_id", "node"), F.lit(max(1, stored.count())))
    found = states.tree_merged(stored.select("key", spread.alias("node"), "state"), gram.merged)
    return gram.assembled(found, len(columns)).get(0)


def incremental_pca(spark: SparkSession, columns: Sequence[str], parts: str, k: int | None = None) -> DataFrame:
    """``(component, ratio, column_name, loading)`` of the rows seen so far.

    The states of all batches are merged in a tree to one small matrix; its eigenvectors are found on the driver. The sign of a
    component makes its largest loading positive. With fewer than two complete rows there are no components.
    """
    found = merged_moments(spark, columns, parts)
    rows = []
    if found is not None and found.n > 1:
        values, vectors = np.linalg.eigh(found.covariance())
        for place, at in enumerate(np.argsort(values)[::-1][: k or len(columns)]):
            vector = vectors[:, at]
            vector = vector * np.sign(vector[np.argmax(np.abs(vector))])
            rows += [(f"pca_{place}", float(values[at] / values.sum()), c, float(v)) for c, v in zip(columns, vector)]
    return spark.createDataFrame(rows, "component string, ratio double, column_name string, loading double")


# --- windows -------------------------------------------------------------------------------------


def windowed_event_stats(
    stream: DataFrame, ts: str, value: str, sink: str, checkpoint: str, by: Sequence[str] = (), length: str = "1 day", delay: str = "1 hour"
) -> None:
    """Append count, mean, sample deviation and extremes of every closed tumbling window.

    Rows later than the watermark are dropped, as is usual for append mode.
    """
    v = quoted(value)
    timed = stream.withColumn("_at", quoted(ts).cast("timestamp")).withWatermark("_at", delay)
    stats = timed.groupBy(F.window("_at", length), *[quoted(c) for c in by]).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )
    shaped = stats.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *[quoted(c) for c in by], "n", "mean", "std", "min", "max"
    )
    _run(shaped.writeStream.format("parquet").option("path", sink).outputMode("append"), checkpoint)
