"""Ingest many CSV files, profile them, drop what the profile condemns, write table and report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EtlConfig
from ..operators import profile, quality, schema
from ..sources import files, sinks
from ..sources.scratch import materialize, scratch_scope

SUMMARY = (
    "files int, rejected_files int, total_rows bigint, initial_columns int, kept_columns int, "
    "dropped_columns int, format string, location string"
)


@dataclass(frozen=True)
class EtlResult:
    table: DataFrame
    report: DataFrame
    summary: DataFrame
    rejected: DataFrame


def read_inputs(spark: SparkSession, cfg: EtlConfig) -> tuple[DataFrame, list[str], DataFrame, int]:
    paths = list(cfg.input_files)
    if cfg.window_days:
        paths = [r["path"] for r in files.file_window(spark, paths, cfg.window_days).select("path").collect()]
    table, names, rejected, accepted = files.read_csv_files(spark, paths, schema=cfg.input_schema)
    if table is None:
        raise ValueError("no readable input file")
    return table, names, rejected, accepted


def run_etl(spark: SparkSession, cfg: EtlConfig) -> EtlResult:
    """Read, profile, drop and store. Intermediate tables are deleted; without an output path the ingested copy stays, as the result reads it."""
    with scratch_scope(spark):
        table, names, rejected, count = read_inputs(spark, cfg)
        rejected = materialize(rejected, "rejected", keep=True)
        table = schema.keep_columns(table, cfg.keep_columns)
        table = schema.drop_by_type(table, cfg.drop_types)
        # text is parsed once; profile and output read the columnar copy
        table = materialize(table, "ingested", keep=not cfg.output_path)
        report = materialize(profile.profile_columns(table), "report", keep=True)
        kept = quality.drop_high_missing(table, report, cfg.missing_threshold)
        if cfg.constant_columns == "drop":
            kept = quality.drop_constant(kept, report)
        if cfg.high_cardinality == "drop":
            kept = quality.drop_high_cardinality(kept, report, cfg.high_cardinality_threshold)
        if cfg.duplicate_rows == "drop":
            kept = quality.drop_duplicates(kept)
        fmt, location = ("none", None)
        if cfg.output_path:
            fmt, location = sinks.write_with_fallback(kept, cfg.output_path)
            kept = files.csv_scan(spark, location, kept.schema) if fmt == "csv" else files.load_table(spark, location, fmt)
        if cfg.report_path:
            sinks.write_report(report, cfg.report_path)
    summary = etl_run_summary(report, count, rejected, names, kept, fmt, location)
    return EtlResult(kept, report, summary, rejected)


def etl_run_summary(
    report: DataFrame, count: int, rejected: DataFrame, names: list[str], kept: DataFrame, fmt: str, location: str | None
) -> DataFrame:
    """One row; ``count`` is the number of files read. The row count comes from the report, not from another pass."""
    skipped = rejected.count()
    return report.agg(F.max("total_rows").alias("total_rows")).select(
        F.lit(count).alias("files"),
        F.lit(skipped).alias("rejected_files"),
        F.coalesce("total_rows", F.lit(0).cast("bigint")).alias("total_rows"),
        F.lit(len(names)).alias("initial_columns"),
        F.lit(len(kept.columns)).alias("kept_columns"),
        F.lit(len(names) - len(kept.columns)).alias("dropped_columns"),
        F.lit(fmt).alias("format"),
        F.lit(location).cast("string").alias("location"),
    )


def analyze(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame | None, str | None]:
    """``(summary, report, error)`` of the files; if profiling fails the report is None and the error its message."""
    table, _, _, accepted = files.read_csv_files(spark, paths)
    if table is None:
        raise ValueError("no readable input file")
    report = error = None
    try:
        report = materialize(profile.profile_columns(table), "report")
        roles = schema.classify_columns(table, report)
    except files.FAILURES as failure:
        error = str(failure).splitlines()[0]
        roles = schema.classify_columns(table, spark.createDataFrame([], sinks.REPORT_SCHEMA))
    return profile.dataset_summary(table, roles, accepted), report, error
