"""Dropping columns and rows by quality measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import fields, is_floating, missing, quoted
from .profile import constant_flags


def _without(df: DataFrame, report: DataFrame, condition: Column) -> DataFrame:
    """Drop the columns whose report row meets the condition; only their names reach the driver."""
    names = [r["column_name"] for r in report.filter(condition).select("column_name").collect()]
    return df.select(*[quoted(c) for c in df.columns if c not in set(names)])


def drop_high_missing(df: DataFrame, report: DataFrame, threshold: float = 0.95) -> DataFrame:
    if threshold >= 1:
        return df
    return _without(df, report, F.col("missing_fraction") > threshold)


def drop_constant(df: DataFrame, report: DataFrame | None = None) -> DataFrame:
    """Without a report the constant columns are found by one aggregate of least and largest values."""
    return _without(df, report if report is not None else constant_flags(df), F.col("is_constant"))


def drop_high_cardinality(df: DataFrame, report: DataFrame, threshold: int = 1000) -> DataFrame:
    return _without(df, report, F.col("cardinality") > threshold)


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def inf_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    chosen = {f.name for f in fields(df, columns) if is_floating(f.dataType)}
    infinite = float("inf")
    return df.select(
        *[
            F.when(F.abs(quoted(c)) != infinite, quoted(c)).alias(c) if c in chosen else quoted(c)
            for c in df.columns
        ]
    )


def drop_rows_any_null(df: DataFrame) -> DataFrame:
    """Keep the rows without NULL or NaN in any column."""
    return df.na.drop("any")


def skip_invalid_rows(df: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """Keep the rows without NULL or NaN in the input columns."""
    valid = F.lit(True)
    for field in fields(df, inputs):
        valid = valid & ~missing(field)
    return df.filter(valid)
