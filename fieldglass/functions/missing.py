"""One notion of a missing value: NULL, and NaN in FLOAT and DOUBLE columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """Column by exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def known(field: T.StructField) -> Column:
    """The value with NaN turned into NULL."""
    value = quoted(field.name)
    return F.nanvl(value, F.lit(None).cast(field.dataType)) if is_floating(field.dataType) else value


def known_double(df: DataFrame, name: str) -> Column:
    """The value as DOUBLE with NaN turned into NULL."""
    return F.nanvl(quoted(name).cast("double"), F.lit(None).cast("double"))


def missing(field: T.StructField) -> Column:
    value = quoted(field.name)
    return value.isNull() | F.isnan(value) if is_floating(field.dataType) else value.isNull()


def fields(df: DataFrame, columns=None) -> list[T.StructField]:
    """Schema fields in the order of ``columns`` (default: all)."""
    by_name = {f.name: f for f in df.schema}
    return [by_name[c] for c in (columns if columns is not None else df.columns)]


def row_per(entries: list[dict[str, Column]]) -> Column:
    """Generator of one output row per entry; used as ``select(row_per(...)).select('r.*')``."""
    structs = [F.struct(*[c.alias(n) for n, c in e.items()]) for e in entries]
    return F.explode(F.array(*structs)).alias("r")
