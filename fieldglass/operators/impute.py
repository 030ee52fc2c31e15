"""Filling missing values by a constant. Filled columns are DOUBLE, so means keep their fraction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import known_double, quoted


def fit_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Means of the known values: one job, one number per column on the driver."""
    if not columns:
        return {}
    row = df.agg(*[F.avg(known_double(df, c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return {c: row[i] for i, c in enumerate(columns)}


def _replace(df: DataFrame, filled: dict[str, Column]) -> DataFrame:
    return df.select(*[filled[c].alias(c) if c in filled else quoted(c) for c in df.columns])


def fill_with(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    """Each column's gaps replaced by its value."""
    return _replace(df, {c: F.coalesce(known_double(df, c), F.lit(v).cast("double")) for c, v in values.items()})


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return fill_with(df, fit_means(df, columns))


def impute_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return fill_with(df, {c: 0.0 for c in columns})


def impute_ffill_as_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mean, and zero for a column without any known value."""
    return fill_with(df, {c: m or 0.0 for c, m in fit_means(df, columns).items()})


def columns_with_missing(report: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of ``columns`` that the quality report knows to have gaps; names only."""
    gaps = {r[0] for r in report.filter("missing_count > 0").select("column_name").collect()}
    return [c for c in columns if c in gaps]
