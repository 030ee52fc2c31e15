"""Writing tables, reports, samples, selected features and models."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import quoted
from ..operators.schema import project_features
from .files import FAILURES, delta_available, path_exists, remove_path, replace_path

REPORT_SCHEMA = (
    "column_name string, dtype string, total_rows bigint, missing_count bigint, missing_fraction double, "
    "nonnull_count bigint, distinct_count bigint, is_constant boolean, cardinality bigint"
)


def write_with_fallback(df: DataFrame, path: str, formats: Sequence[str] = ("delta", "parquet", "csv")) -> tuple[str, str]:
    """Replace ``path`` in the first format that works; ``(format, path)``. Raises if none does, and then what was there is still there.

    A format is written beside the target, which takes the target's place once it is complete.
    """
    spark, failures = df.sparkSession, []
    for fmt in formats:
        if fmt == "delta" and not delta_available(spark):
            failures.append("delta: connector not available")
            continue
        writer = df.write.format(fmt).mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", "true")
        try:
            if fmt == "delta":  # its log makes the change all at once
                writer.save(path)
                return fmt, path
            beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
            try:
                writer.save(beside)
                replace_path(spark, beside, path)
                return fmt, path
            finally:
                remove_path(spark, beside)
        except FAILURES as error:
            failures.append(f"{fmt}: {str(error).splitlines()[0]}")
    raise RuntimeError("no format could be written: " + "; ".join(failures))


def single_csv(df: DataFrame, path: str) -> str:
    """One CSV file with header. For result tables of known small size only."""
    df.coalesce(1).write.option("header", "true").mode("overwrite").csv(path)
    return path


def write_report(report: DataFrame, path: str, fmt: str = "json") -> str:
    report.write.format(fmt).mode("overwrite").save(path)
    return path


def read_report(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """The stored quality report; empty if there is none."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], REPORT_SCHEMA)
    return spark.read.schema(REPORT_SCHEMA).format(fmt).load(path)


def write_selected_features(
    df: DataFrame, path: str, features: dict[str, Sequence[str]], targets: Sequence[str], keys: Sequence[str] = ()
) -> list[tuple[str, str, str]]:
    """Write all selected columns, and per target its own; ``(artifact, path, schema as JSON)`` each.

    ``keys`` (series key and order columns) lead every table, so that its rows can be ordered again.
    """
    union = list(dict.fromkeys(f for chosen in features.values() for f in chosen))
    artifacts = [("selected_features", f"{path}/all", project_features(df, [*keys, *union], targets))]
    for target in targets:
        artifacts.append((f"features_{target}", f"{path}/target={target}", project_features(df, [*keys, *features.get(target, [])], [target])))
    for _, where, table in artifacts:
        table.write.mode("overwrite").parquet(where)
    return [(name, where, table.schema.json()) for name, where, table in artifacts]


def write_sample(sample: DataFrame, path: str) -> str:
    """Text form of a sample; arrays are not expressible in CSV and become JSON."""
    complex_types = (T.ArrayType, T.MapType, T.StructType)
    flat = [
        F.to_json(quoted(f.name)).alias(f.name) if isinstance(f.dataType, complex_types) else quoted(f.name) for f in sample.schema
    ]
    sample.select(*flat).write.option("header", "true").mode("overwrite").csv(path)
    return path


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
