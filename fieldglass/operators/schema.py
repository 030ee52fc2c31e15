"""Column names, column types, column roles and target resolution."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import quoted


AWKWARD = re.compile(r"[. -]")


@dataclass(frozen=True)
class ColumnRoles:
    categorical: tuple[str, ...] = ()
    numerical: tuple[str, ...] = ()
    temporal: tuple[str, ...] = ()


def keep_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in table order; an empty list keeps all."""
    if not names:
        return df
    return df.select(*[quoted(c) for c in df.columns if c in set(names)])


def drop_by_type(df: DataFrame, types: Iterable[str]) -> DataFrame:
    unwanted = set(types)
    return df.select(*[quoted(f.name) for f in df.schema if f.dataType.simpleString() not in unwanted])


def clean_name(name: str) -> str:
    return AWKWARD.sub("_", name)


def sanitize_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Dots, spaces and hyphens become ``_``; the map of all names, or ``{}`` if nothing changed."""
    mapping = {c: clean_name(c) for c in df.columns}
    clashes = [n for n, times in Counter(mapping.values()).items() if times > 1]
    if clashes:
        raise ValueError(f"column names collide after cleaning: {sorted(clashes)}")
    if all(old == new for old, new in mapping.items()):
        return df, {}
    return df.toDF(*mapping.values()), mapping


def restore_names(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    back = {new: old for old, new in mapping.items()}
    return df.toDF(*[back.get(c, c) for c in df.columns])


def name_table(spark, mapping: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(list(mapping.items()), "original_name string, clean_name string")


def rename_in_table(table: DataFrame, mapping: dict[str, str], column: str = "column_name", restore: bool = False) -> DataFrame:
    """Replace names held as values: original to clean, or back."""
    if not mapping:
        return table
    names = name_table(table.sparkSession, mapping)
    source, result = ("clean_name", "original_name") if restore else ("original_name", "clean_name")
    joined = table.join(F.broadcast(names), table[column] == names[source], "left")
    value = F.coalesce(F.col(result), quoted(column)).alias(column)
    return joined.select(*[value if c == column else quoted(c) for c in table.columns])


def resolve_targets(columns: Sequence[str], requested: Sequence[str], primary: str | None = None) -> tuple[list[str], str]:
    """Requested targets that exist (compared by clean name), and the primary one."""
    by_clean = {clean_name(c): c for c in columns}
    found = [by_clean[clean_name(t)] for t in requested if clean_name(t) in by_clean]
    if not found:
        raise ValueError(f"none of the targets {list(requested)} is a column")
    wanted = by_clean.get(clean_name(primary)) if primary else None
    return found, wanted if wanted in found else found[0]


# --- roles ---------------------------------------------------------------------------------------


def _kind(dtype: T.DataType) -> str:
    if isinstance(dtype, T.IntegralType):
        return "integral"
    if isinstance(dtype, (T.FractionalType, T.DecimalType)):
        return "fractional"
    if isinstance(dtype, T.StringType):
        return "string"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "temporal"
    return "other"


def classify_columns(
    df: DataFrame,
    report: DataFrame,
    targets: Sequence[str] = (),
    categorical: Sequence[str] = (),
    numerical: Sequence[str] = (),
    threshold: int = 10,
) -> DataFrame:
    """``(column_name, role)`` from types and the reported cardinality.

    Explicit lists win and targets are left out. An integer is categorical when its reported
    cardinality is at most ``threshold``, numerical when larger or unknown.
    """
    targets_clean = {clean_name(t) for t in targets}
    rows = []
    for field in df.schema:
        if clean_name(field.name) in targets_clean:
            continue
        given = "categorical" if field.name in categorical else "numerical" if field.name in numerical else None
        rows.append((field.name, _kind(field.dataType), given))
    schema = df.sparkSession.createDataFrame(rows, "column_name string, kind string, given string")
    few = F.coalesce(F.col("cardinality") <= threshold, F.lit(False))
    role = (
        F.when(F.col("given").isNotNull(), F.col("given"))
        .when(F.col("kind") == "integral", F.when(few, "categorical").otherwise("numerical"))
        .when(F.col("kind") == "fractional", "numerical")
        .when(F.col("kind") == "string", "categorical")
        .when(F.col("kind") == "temporal", "temporal")
    )
    # the report has one row per column
    return (
        schema.join(F.broadcast(report.select("column_name", "cardinality")), "column_name", "left")
        .select("column_name", role.alias("role"))
        .filter(F.col("role").isNotNull())
    )


def classify_columns_counted(df: DataFrame, targets: Sequence[str] = (), threshold: int = 10, rsd: float = 0.01) -> DataFrame:
    """Roles with the cardinality of every integer column counted instead of reported."""
    from .profile import approx_distinct_profile

    integers = [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)]
    counts = approx_distinct_profile(df, integers, rsd).withColumnRenamed("approx_distinct_count", "cardinality")
    return classify_columns(df, counts, targets, threshold=threshold)


def collect_roles(roles: DataFrame, order: Sequence[str]) -> ColumnRoles:
    """Role lists on the driver, in table order: names only."""
    by_name = {r["column_name"]: r["role"] for r in roles.collect()}
    return ColumnRoles(*[tuple(c for c in order if by_name.get(c) == r) for r in ("categorical", "numerical", "temporal")])


def project_features(df: DataFrame, features: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """Selected features, then targets, every name once."""
    return df.select(*[quoted(c) for c in dict.fromkeys([*features, *targets])])


def fallback_features(selected: Sequence[str], numerical: Sequence[str], limit: int | None = None) -> list[str]:
    """The selected features, or all (the first ``limit``) numerical columns if none was selected."""
    return list(selected) or list(numerical)[:limit]
