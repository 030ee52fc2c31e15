"""Column profiles: counts, missing values, cardinality, duplicates, spread and outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import fields, is_floating, known_double, missing, quoted, row_per
from ..sources.scratch import materialize
from .ordered import running_sums

LONG_TEXT = 64


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def dtype_report(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "column_name string, dtype string")


# --- the long-form profile -----------------------------------------------------------------------


def _grouping_value(field: T.StructField) -> tuple[str, Column]:
    """Lane name and value by which equal values of a column are recognised.

    Long texts are grouped by their SHA-256 digest: the shuffle carries 64 characters, not the text.
    """
    value, dtype = quoted(field.name), field.dataType
    if isinstance(dtype, T.IntegralType):
        return "bigint", value.cast("bigint")
    if is_floating(dtype):
        return "double", value.cast("double")
    if isinstance(dtype, T.StringType):
        return "string", F.when(F.length(value) > LONG_TEXT, F.sha2(value, 256)).otherwise(value)
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return "string", F.sha2(F.to_json(value), 256)
    return dtype.simpleString(), value


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_id, lane_0.., is_missing, n)``: one row per distinct value of every column.

    One scan; combining before the shuffle keeps it to distinct values, so a hot value is cheap.
    """
    chosen = fields(df, columns)
    lanes = [_grouping_value(f) for f in chosen]
    types = list(dict.fromkeys(name for name, _ in lanes))
    entries = []
    for number, (lane, value) in enumerate(lanes):
        entry = {"column_id": F.lit(number)}
        for place, dtype in enumerate(types):
            entry[f"lane_{place}"] = value if dtype == lane else F.lit(None).cast(dtype)
        entry["is_missing"] = missing(chosen[number])
        entries.append(entry)
    keys = ["column_id", *[f"lane_{p}" for p in range(len(types))], "is_missing"]
    return df.select(row_per(entries)).select("r.*").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The whole quality report, one row per column.

    ``total_rows, missing_count, missing_fraction, nonnull_count, distinct_count, is_constant`` and
    ``cardinality`` (set for STRING and INT columns). An all-NULL column is not constant; NaN counts
    as missing, as non-NULL and as one distinct value. An empty table yields zeros.
    """
    chosen = fields(df, columns)
    counts = value_counts(df, columns)
    lanes = [c for c in counts.columns if c.startswith("lane_")]
    present = F.lit(False)
    for lane in lanes:
        present = present | F.col(lane).isNotNull()
    found = counts.groupBy("column_id").agg(
        F.sum("n").alias("t"),
        F.sum(F.when(F.col("is_missing"), F.col("n"))).alias("m"),
        F.sum(F.when(present, F.col("n"))).alias("k"),
        F.count(F.when(present, 1)).alias("d"),
    )
    names = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(chosen)],
        "column_id int, column_name string, dtype string",
    )
    zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in "tmkd"}
    # found has one row per column of the table
    return names.join(F.broadcast(found), "column_id", "left").select(
        "column_name",
        "dtype",
        zero["t"].alias("total_rows"),
        zero["m"].alias("missing_count"),
        F.coalesce(F.try_divide(zero["m"].cast("double"), zero["t"].cast("double")), F.lit(0.0)).alias(
            "missing_fraction"
        ),
        zero["k"].alias("nonnull_count"),
        zero["d"].alias("distinct_count"),
        ((zero["d"] == 1) & (zero["k"] > 0)).alias("is_constant"),
        F.when(F.col("dtype").isin("string", "int"), zero["d"]).alias("cardinality"),
    )


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL-or-NaN count and fraction per column, without any shuffle of values."""
    return _counted(df, columns, {"missing_count": missing}).select(
        "column_name",
        "missing_count",
        F.coalesce(
            F.try_divide(F.col("missing_count").cast("double"), F.col("total_rows").cast("double")), F.lit(0.0)
        ).alias("missing_fraction"),
    )


def nonnull_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return _counted(df, columns, {"nonnull_count": lambda f: quoted(f.name).isNotNull()}).select(
        "column_name", "nonnull_count"
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL counts of the columns that have any."""
    return (
        _counted(df, columns, {"null_count": lambda f: quoted(f.name).isNull()})
        .select("column_name", "null_count")
        .filter("null_count > 0")
    )


def _counted(df: DataFrame, columns, tests: dict) -> DataFrame:
    """Counts per column of the rows passing each test: one aggregate, turned into rows."""
    chosen = fields(df, columns)
    totals = [F.count(F.lit(1)).alias("total")]
    entries = []
    for number, field in enumerate(chosen):
        entry = {"column_name": F.lit(field.name), "total_rows": F.col("total")}
        for name, test in tests.items():
            totals.append(F.count_if(test(field)).alias(f"{name}_{number}"))
            entry[name] = F.col(f"{name}_{number}")
        entries.append(entry)
    return df.agg(*totals).select(row_per(entries)).select("r.*")


def distinct_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return profile_columns(df, columns).select("column_name", "distinct_count")


def constant_flags(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns whose known values are all the same: the least equals the largest. One aggregate, no distinct values travel."""
    chosen = fields(df, columns)
    values = [_grouping_value(f)[1] for f in chosen]
    ends = df.agg(*[m(v).alias(f"{n}{i}") for i, v in enumerate(values) for n, m in (("a", F.min), ("b", F.max))])
    same = [F.coalesce(F.col(f"a{i}") == F.col(f"b{i}"), F.lit(False)) for i in range(len(chosen))]
    return ends.select(row_per([{"column_name": F.lit(f.name), "is_constant": c} for f, c in zip(chosen, same)])).select("r.*")


def cardinality(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct counts of the STRING and INT columns."""
    return (
        profile_columns(df, columns)
        .filter(F.col("cardinality").isNotNull())
        .select("column_name", "cardinality")
    )


def approx_distinct_profile(df: DataFrame, columns: Sequence[str] | None = None, rsd: float = 0.05) -> DataFrame:
    """HyperLogLog sibling of ``distinct_profile``: only sketches are shuffled."""
    chosen = fields(df, columns)
    entries = [
        {"column_name": F.lit(f.name), "h": F.when(quoted(f.name).isNotNull(), F.xxhash64(_grouping_value(f)[1]))}
        for f in chosen
    ]
    return (
        df.select(row_per(entries))
        .select("r.*")
        .groupBy("column_name")
        .agg(F.approx_count_distinct("h", rsd).alias("approx_distinct_count"))
    )


# --- duplicates ----------------------------------------------------------------------------------


def duplicate_rows(df: DataFrame) -> DataFrame:
    """``total_rows, distinct_rows, duplicate_rows`` by exact comparison of all columns."""
    keys = [_grouping_value(f)[1].alias(f"k{i}") for i, f in enumerate(df.schema)]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return counts.agg(
        total.alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        (total - F.count(F.lit(1))).alias("duplicate_rows"),
    )


# --- spread --------------------------------------------------------------------------------------


def _long_doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    entries = [{"column_id": F.lit(i), "value": known_double(df, c)} for i, c in enumerate(columns)]
    return df.select(row_per(entries)).select("r.*").filter(F.col("value").isNotNull())


def _named(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    names = F.array(*[F.lit(c) for c in columns])
    rest = [c for c in df.columns if c != "column_id"]
    return df.select(F.get(names, F.col("column_id")).alias("column_name"), *rest)


SKETCH_ACCURACY = 1_000
MARGIN = 0.003


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: dict[str, float], chunk_rows: int | None = None
) -> DataFrame:
    """Linearly interpolated quantiles per column, exact, with no column gathered in one task.

    A sketch brackets each quantile by two values; one aggregate counts what lies below the bracket
    and only the values inside are counted, sorted chunk by chunk and searched. A bracket that misses
    its quantile (the sketch promises it does not) is widened to the whole column.
    """
    slots = [(c, name, p) for c in columns for name, p in probabilities.items()]
    marks = [q for p in probabilities.values() for q in (max(p - MARGIN, 0.0), min(p + MARGIN, 1.0))]
    sketch = df.agg(
        *[F.percentile_approx(known_double(df, c), marks, SKETCH_ACCURACY).alias(f"q{i}") for i, c in enumerate(columns)],
        *[F.count(known_double(df, c)).alias(f"n{i}") for i, c in enumerate(columns)],
    ).first()
    sizes = {c: sketch[f"n{i}"] for i, c in enumerate(columns)}
    brackets: list[tuple[float, float] | None] = []
    for c, name, p in slots:
        found, at = sketch[f"q{list(columns).index(c)}"], 2 * list(probabilities).index(name)
        low = float("-inf") if p <= MARGIN else found and found[at]
        high = float("inf") if p >= 1 - MARGIN else found and found[at + 1]
        brackets.append((low, high) if found else None)
    brackets, below = _checked_brackets(df, slots, sizes, brackets)
    entries = [
        {"slot": F.lit(i), "value": F.when((known_double(df, c) >= b[0]) & (known_double(df, c) <= b[1]), known_double(df, c))}
        for i, ((c, _, _), b) in enumerate(zip(slots, brackets))
        if b
    ]
    if not entries:
        empty = ", ".join(["column_name string", *[f"{n} double" for n in probabilities]])
        return df.sparkSession.createDataFrame([], empty)
    inside = df.select(row_per(entries)).select("r.*").filter(F.col("value").isNotNull())
    counts = materialize(inside.groupBy("slot", "value").agg(F.count(F.lit(1)).alias("n")), "counts")
    ran = running_sums(counts, ["slot"], ["value"], {"cum": F.col("n")}, chunk_rows=chunk_rows)

    def per_slot(values, kind: str) -> Column:
        return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("slot"))

    targets = [(sizes[c] - 1) * p for c, _, p in slots]
    upto = F.col("cum") + per_slot(below, "bigint")
    low = per_slot([int(t) for t in targets], "bigint")
    high = per_slot([min(int(t) + 1, max(sizes[c] - 1, 0)) for t, (c, _, _) in zip(targets, slots)], "bigint")
    picked = ran.groupBy("slot").agg(
        F.min(F.when(upto > low, F.col("value"))).alias("lo"), F.min(F.when(upto > high, F.col("value"))).alias("hi")
    )
    weight = per_slot([t - int(t) for t in targets], "double")
    value = F.col("lo") + weight * (F.col("hi") - F.col("lo"))
    shown = picked.select(
        per_slot([c for c, _, _ in slots], "string").alias("column_name"), per_slot([n for _, n, _ in slots], "string").alias("name"), value.alias("v")
    )
    # one row per column and quantile
    return shown.groupBy("column_name").agg(*[F.max(F.when(F.col("name") == n, F.col("v"))).alias(n) for n in probabilities])


def _checked_brackets(df: DataFrame, slots, sizes: dict, brackets: list):
    """Brackets known to hold their quantile positions, and how many values lie below each."""
    measures = [F.lit(1).alias("one")]
    for i, ((c, _, _), b) in enumerate(zip(slots, brackets)):
        if b:
            measures.append(F.count_if(known_double(df, c) < b[0]).alias(f"b{i}"))
            measures.append(F.count_if(known_double(df, c) <= b[1]).alias(f"u{i}"))
    row = df.agg(*measures).first()
    checked, below = [], []
    for i, ((c, _, p), b) in enumerate(zip(slots, brackets)):
        at = int((sizes[c] - 1) * p)
        if b and not (row[f"b{i}"] <= at and row[f"u{i}"] > min(at + 1, sizes[c] - 1)):
            checked.append((float("-inf"), float("inf")))
            below.append(0)
        else:
            checked.append(b)
            below.append(row[f"b{i}"] if b else 0)
    return checked, below


QUARTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def summary_stats(
    df: DataFrame, columns: Sequence[str] | None = None, chunk_rows: int | None = None, approximate: bool = False
) -> DataFrame:
    """Mean, sample standard deviation, extremes and quartiles per numeric column."""
    columns = list(columns or numeric_columns(df))
    value = F.col("value")
    measures = [
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]
    if approximate:
        measures += [F.percentile_approx(value, p).alias(n) for n, p in QUARTILES.items()]
    moments = _named(_long_doubles(df, columns).groupBy("column_id").agg(*measures), columns)
    if approximate:
        return moments
    quartiles = exact_quantiles(df, columns, QUARTILES, chunk_rows)
    # one row per column on both sides
    return moments.join(F.broadcast(quartiles), "column_name")


def boxplot_bounds(df: DataFrame, columns: Sequence[str], factor: float = 1.5, chunk_rows: int | None = None) -> dict:
    """``{column: (lower, upper)}`` whiskers; the driver holds two numbers per column."""
    spread = F.col("q75") - F.col("q25")
    rows = (
        exact_quantiles(df, columns, {"q25": 0.25, "q75": 0.75}, chunk_rows)
        .select("column_name", (F.col("q25") - factor * spread).alias("lo"), (F.col("q75") + factor * spread).alias("hi"))
        .collect()
    )
    return {r["column_name"]: (r["lo"], r["hi"]) for r in rows}


def outlier_flag(df: DataFrame, column: str, bounds: dict) -> Column:
    lower, upper = bounds[column]
    value = known_double(df, column)
    return F.coalesce((value < lower) | (value > upper), F.lit(False))


def boxplot_outliers(df: DataFrame, columns: Sequence[str], factor: float = 1.5, chunk_rows: int | None = None) -> DataFrame:
    """Whisker bounds and number of values beyond them, per column."""
    bounds = boxplot_bounds(df, columns, factor, chunk_rows)
    present = [c for c in columns if c in bounds]
    counted = df.agg(*[F.count_if(outlier_flag(df, c, bounds)).alias(f"o{i}") for i, c in enumerate(present)])
    entries = [
        {
            "column_name": F.lit(c),
            "lower_bound": F.lit(bounds[c][0]),
            "upper_bound": F.lit(bounds[c][1]),
            "outlier_count": F.col(f"o{i}"),
        }
        for i, c in enumerate(present)
    ]
    return counted.select(row_per(entries)).select("r.*")


def outlier_rows(df: DataFrame, columns: Sequence[str], factor: float = 1.5, chunk_rows: int | None = None) -> DataFrame:
    """Rows with at least one value beyond its column's whiskers."""
    bounds = boxplot_bounds(df, columns, factor, chunk_rows)
    flag = F.lit(False)
    for c in columns:
        if c in bounds:
            flag = flag | outlier_flag(df, c, bounds)
    return df.filter(flag)


def column_means(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Means of the known values, all columns in one aggregate."""
    columns = list(columns or numeric_columns(df))
    means = df.agg(*[F.avg(known_double(df, c)).alias(f"m{i}") for i, c in enumerate(columns)])
    entries = [{"column_name": F.lit(c), "mean": F.col(f"m{i}")} for i, c in enumerate(columns)]
    return means.select(row_per(entries)).select("r.*")


# --- summaries -----------------------------------------------------------------------------------


def dataset_summary(df: DataFrame, roles: DataFrame, files: int | None = None) -> DataFrame:
    """One row: files, rows, columns and how many columns play each role."""
    per_role = roles.agg(
        *[F.count_if(F.col("role") == r).alias(f"{r}_columns") for r in ("categorical", "numerical", "temporal")]
    )
    rows = row_count(df)
    # two one-row tables
    return (
        rows.withColumn("one", F.lit(1))
        .join(F.broadcast(per_role.withColumn("one", F.lit(1))), "one")
        .select(
            F.lit(files).cast("int").alias("files"),
            "total_rows",
            F.lit(len(df.columns)).alias("total_columns"),
            *per_role.columns,
        )
    )
