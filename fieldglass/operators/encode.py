"""Category indexes, indicators and scaling.

Fitted parameters are small: one label table per column, two numbers per scaled column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import fields, known_double, quoted
from ..sources.scratch import materialize
from .ordered import POSITION, with_positions
from .quality import skip_invalid_rows

MAX_BROADCAST_LABELS = 10_000


def label_table(df: DataFrame, column: str, chunk_rows: int | None = None) -> tuple[DataFrame, int]:
    """``(label, label_count, label_index)`` by frequency, ties in label order, and the label count."""
    counts = materialize(
        df.filter(quoted(column).isNotNull())
        .groupBy(quoted(column).alias("label"))
        .agg(F.count(F.lit(1)).alias("label_count")),
        "labels",
    )
    size = counts.count()
    if size <= MAX_BROADCAST_LABELS:
        order = Window.orderBy(F.col("label_count").desc(), "label")
        return counts.select("*", (F.row_number().over(order) - 1).cast("double").alias("label_index")), size
    ranked = with_positions(counts.withColumn("_less", -F.col("label_count")), [], ["_less", "label"], chunk_rows)
    return ranked.select("label", "label_count", F.col(POSITION).cast("double").alias("label_index")), size


def string_index(df: DataFrame, column: str, output: str | None = None, chunk_rows: int | None = None) -> DataFrame:
    """Index by descending frequency, ties alphabetical; NULL gets the extra last index.

    The most frequent labels (a bounded number) are broadcast, so hot ones never meet in one task;
    only rows with one of the remaining, rare labels are shuffled.
    """
    output = output or f"{column}_index"
    labels, size = label_table(df, column, chunk_rows)
    frequent = labels.filter(F.col("label_index") < MAX_BROADCAST_LABELS).select("label", "label_index")
    match = quoted(column) == F.col("label")

    def shaped(joined: DataFrame) -> DataFrame:
        index = F.coalesce(F.col("label_index"), F.lit(float(size)))
        return joined.select(*[quoted(c) for c in df.columns], index.alias(output))

    joined = df.join(F.broadcast(frequent), match, "left")
    if size <= MAX_BROADCAST_LABELS:
        return shaped(joined)
    settled = joined.filter(F.col("label_index").isNotNull() | quoted(column).isNull())
    rest = joined.filter(F.col("label_index").isNull() & quoted(column).isNotNull()).drop("label", "label_index")
    rare = labels.filter(F.col("label_index") >= MAX_BROADCAST_LABELS).select("label", "label_index")
    return shaped(settled).unionByName(shaped(rest.join(rare, match, "left")))


def one_hot(df: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """``ARRAY<DOUBLE>`` with one slot per label in index order; NULL is all zeros."""
    output = output or f"{column}_encoded"
    _, size = label_table(df, column)
    indexed = string_index(df, column, "_index")
    slots = F.sequence(F.lit(0), F.lit(size - 1)) if size else F.array().cast("array<int>")
    return indexed.select(
        *[quoted(c) for c in df.columns],
        F.transform(slots, lambda i: (i == F.col("_index")).cast("double")).alias(output),
    )


def one_hot_long(df: DataFrame, key: Sequence[str], column: str) -> DataFrame:
    """The same in sparse form, for any number of labels: ``(key, label_index)``, one row per row with a label."""
    indexed = string_index(df.select(*[quoted(k) for k in key], quoted(column)), column, "label_index")
    return indexed.filter(quoted(column).isNotNull()).select(*[quoted(k) for k in key], "label_index")


def indicator_columns(df: DataFrame, column: str, limit: int | None = None) -> tuple[DataFrame, list[str]]:
    """One 0/1 DOUBLE column per label, named ``<column>_<label>``, in index order; more than ``limit`` are refused."""
    labels, size = label_table(df, column)
    if limit is not None and size > limit:
        raise ValueError(f"{column}: {size} labels exceed the limit of {limit} indicator columns")
    values = [r["label"] for r in labels.orderBy("label_index").collect()]
    names = [f"{column}_{v}" for v in values]
    flags = [F.coalesce((quoted(column) == F.lit(v)).cast("double"), F.lit(0.0)).alias(n) for v, n in zip(values, names)]
    return df.select("*", *flags), names


def assemble(df: DataFrame, inputs: Sequence[str], output: str = "features") -> DataFrame:
    """Numbers and arrays side by side in one ``ARRAY<DOUBLE>``; rows with a missing input are dropped."""
    parts = [
        quoted(f.name).cast("array<double>") if isinstance(f.dataType, T.ArrayType) else F.array(quoted(f.name).cast("double"))
        for f in fields(df, inputs)
    ]
    return skip_invalid_rows(df, inputs).withColumn(output, F.concat(*parts))


# --- scaling -------------------------------------------------------------------------------------


def fit_range(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """``{column: (min, max)}`` over the known values."""
    measures = [m(known_double(df, c)).alias(f"{n}{i}") for i, c in enumerate(columns) for n, m in (("a", F.min), ("b", F.max))]
    row = df.agg(*measures).first()
    return {c: (row[f"a{i}"], row[f"b{i}"]) for i, c in enumerate(columns)}


def fit_spread(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """``{column: (mean, sample standard deviation)}`` over the known values."""
    measures = [
        m(known_double(df, c)).alias(f"{n}{i}") for i, c in enumerate(columns) for n, m in (("a", F.avg), ("b", F.stddev_samp))
    ]
    row = df.agg(*measures).first()
    return {c: (row[f"a{i}"], row[f"b{i}"]) for i, c in enumerate(columns)}


def _number(value: float | None) -> Column:
    return F.lit(value).cast("double")


def _standard(value: Column, mean: float | None, deviation: float | None) -> Column:
    if not deviation:
        return F.when(value.isNotNull(), F.lit(0.0))
    return (value - _number(mean)) / _number(deviation)


def _minmax(value: Column, low: float | None, high: float | None, constant: float) -> Column:
    if low == high:
        return F.when(value.isNotNull(), F.lit(constant))
    return (value - _number(low)) / _number(high - low)


def fit_scale(df: DataFrame, columns: Sequence[str], method: str) -> dict[str, tuple[float, float]]:
    """What ``scaled_columns`` needs of the rows: mean and deviation for ``standard``, else least and largest value."""
    return fit_spread(df, columns) if method == "standard" else fit_range(df, columns)


def scaled_columns(df: DataFrame, fitted: dict[str, Sequence[float]], method: str) -> list[Column]:
    """``<c>_scaled`` for every fitted column."""
    if method == "standard":
        return [_standard(known_double(df, c), *f).alias(f"{c}_scaled") for c, f in fitted.items()]
    return [_minmax(known_double(df, c), *f, 0.5).alias(f"{c}_scaled") for c, f in fitted.items()]


def scale(df: DataFrame, columns: Sequence[str], method: str = "standard") -> DataFrame:
    """Add ``<c>_scaled``; rows with a missing input are dropped first, as assembling them would.

    ``standard`` centres and divides by the sample deviation (constant: 0), ``none`` adds nothing,
    every other method maps to [0, 1] (constant: 0.5).
    """
    if method == "none" or not columns:
        return df
    valid = skip_invalid_rows(df, columns)
    return valid.select("*", *scaled_columns(df, fit_scale(valid, columns, method), method))


def minmax_column(df: DataFrame, column: str, bounds: tuple[float, float]) -> Column:
    """To (0, 1) by fitted bounds; a constant column gives 0."""
    return _minmax(known_double(df, column), *bounds, 0.0)


def minmax_inverse(scaled: Column, bounds: tuple[float, float]) -> Column:
    """From (0, 1) back to the original scale."""
    low, high = bounds
    return scaled * _number(high - low) + _number(low)


def minmax_exogenous(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each column by its (0, 1) image."""
    bounds = fit_range(df, columns)
    return df.select(*[minmax_column(df, c, bounds[c]).alias(c) if c in bounds else quoted(c) for c in df.columns])
