"""Queries over the profiling operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile, quality, schema
from .base import LINES, MEASURES, check, columns_of, line_measures, profile_sql, rounded, table, union_all

# --- fixtures ------------------------------------------------------------------------------------

FLAWED = (
    "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, CASE WHEN l_partkey % 50 = 0 THEN l_tax END AS rare, "
    "7 AS seven, CAST(NULL AS DOUBLE) AS nothing, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_linenumber END AS line, "
    "concat('k', CAST(l_orderkey AS {text})) AS tag FROM lineitem"
)
FLAWED_SQL = FLAWED.format(text="VARCHAR")
FLAWED_COLUMNS = [
    ("l_orderkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"), ("l_shipdate", "timestamp_ntz"),
    ("rare", "double"), ("seven", "int"), ("nothing", "double"), ("line", "int"), ("tag", "string"),
]


def flawed(spark, sf_dir):
    """Line items with a nearly empty, a constant, an empty and a gappy column, and a high-cardinality text."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "CASE WHEN l_partkey % 50 = 0 THEN l_tax END AS rare",
        "7 AS seven", "CAST(NULL AS DOUBLE) AS nothing", "nullif(l_linenumber, 3) AS line", "concat('k', l_orderkey) AS tag",
    )


NONFINITE = (
    "SELECT event_id, CASE WHEN event_id % 97 = 0 THEN CAST('NaN' AS DOUBLE) WHEN event_id % 97 = 1 THEN CAST('Infinity' AS DOUBLE) "
    "WHEN event_id % 97 = 2 THEN CAST('-Infinity' AS DOUBLE) WHEN event_id % 97 = 3 THEN NULL ELSE value END AS value, event_type FROM events"
)


def nonfinite(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE WHEN event_id % 97 = 0 THEN double('NaN') WHEN event_id % 97 = 1 THEN double('Infinity') "
        "WHEN event_id % 97 = 2 THEN double('-Infinity') WHEN event_id % 97 = 3 THEN NULL ELSE value END AS value",
        "event_type",
    )


DOUBLED = "SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 10 = 0"


def doubled(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.unionAll(lines.filter("l_orderkey % 10 = 0"))


def from_profile(source: str, columns, wanted: str, where: str = "true") -> str:
    return f"SELECT {wanted} FROM ({profile_sql(source, columns)}) p WHERE {where}"


# --- counts --------------------------------------------------------------------------------------


@check("row_count", "SELECT count(*) AS total_rows FROM lineitem")
def row_count(spark, sf_dir):
    return profile.row_count(table(spark, sf_dir, "lineitem"))


@check("missing_profile", from_profile(FLAWED_SQL, FLAWED_COLUMNS, "column_name, missing_count, missing_fraction"))
def missing_profile(spark, sf_dir):
    return rounded(profile.missing_profile(flawed(spark, sf_dir)))


NONFINITE_COLUMNS = [("event_id", "bigint"), ("value", "double"), ("event_type", "string")]


@check("missing_profile_nonfinite", from_profile(NONFINITE, NONFINITE_COLUMNS, "column_name, missing_count, missing_fraction"))
def missing_profile_nonfinite(spark, sf_dir):
    return rounded(profile.missing_profile(nonfinite(spark, sf_dir)))


@check("distinct_profile", from_profile("SELECT * FROM lineitem", columns_of("lineitem"), "column_name, distinct_count"))
def distinct_profile(spark, sf_dir):
    return profile.distinct_profile(table(spark, sf_dir, "lineitem"))


@check("nonnull_profile", from_profile(FLAWED_SQL, FLAWED_COLUMNS, "column_name, nonnull_count"))
def nonnull_profile(spark, sf_dir):
    return profile.nonnull_profile(flawed(spark, sf_dir))


@check("constant_flag", from_profile(FLAWED_SQL, FLAWED_COLUMNS, "column_name, is_constant"))
def constant_flag(spark, sf_dir):
    return profile.constant_flags(flawed(spark, sf_dir))


@check("cardinality", from_profile(FLAWED_SQL, FLAWED_COLUMNS, "column_name, cardinality", "cardinality IS NOT NULL"))
def cardinality(spark, sf_dir):
    return profile.cardinality(flawed(spark, sf_dir))


@check("dtype_report", union_all([f"SELECT '{c}' AS column_name, '{t}' AS dtype, count({c}) AS nonnull_count FROM lineitem" for c, t in columns_of("lineitem")]))
def dtype_report(spark, sf_dir):
    """Types beside the number of values that have them."""
    lines = table(spark, sf_dir, "lineitem")
    return profile.dtype_report(lines).join(F.broadcast(profile.nonnull_profile(lines)), "column_name")


def _profile_query(name: str):
    @check(f"profile_columns_{name}", profile_sql(f"SELECT * FROM {name}", columns_of(name)))
    def query(spark, sf_dir):
        return rounded(profile.profile_columns(table(spark, sf_dir, name)))


for _name in ("lineitem", "orders", "events", "documents", "customer"):
    _profile_query(_name)


@check("profile_columns_flawed", profile_sql(FLAWED_SQL, FLAWED_COLUMNS))
def profile_columns_flawed(spark, sf_dir):
    return rounded(profile.profile_columns(flawed(spark, sf_dir)))


@check("profile_columns_nonfinite", profile_sql(NONFINITE, NONFINITE_COLUMNS))
def profile_columns_nonfinite(spark, sf_dir):
    return rounded(profile.profile_columns(nonfinite(spark, sf_dir)))


@check(
    "duplicate_rows",
    f"SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM "
    f"(SELECT {', '.join(c for c, _ in columns_of('lineitem'))}, count(*) AS n FROM ({DOUBLED}) d GROUP BY ALL) g",
)
def duplicate_rows(spark, sf_dir):
    return profile.duplicate_rows(doubled(spark, sf_dir))


@check(
    "duplicate_rows_documents",
    "SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows "
    "FROM (SELECT text, lang, count(*) AS n FROM documents GROUP BY text, lang) g",
)
def duplicate_rows_documents(spark, sf_dir):
    return profile.duplicate_rows(table(spark, sf_dir, "documents").select("text", "lang"))


# --- spread --------------------------------------------------------------------------------------

SPREAD = MEASURES + ["volume"]


def _stats_sql(columns) -> str:
    return union_all(
        [
            f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, "
            f"round(min({c}), 4) AS min, round(max({c}), 4) AS max, round(quantile_cont({c}, 0.25), 4) AS q25, "
            f"round(quantile_cont({c}, 0.5), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS q75 FROM ({LINES}) l"
            for c in columns
        ]
    )


@check("summary_stats", _stats_sql(SPREAD))
def summary_stats(spark, sf_dir):
    return rounded(profile.summary_stats(line_measures(spark, sf_dir), SPREAD), 4)


@check("summary_stats_approximate")
def summary_stats_approximate(spark, sf_dir):
    return profile.summary_stats(line_measures(spark, sf_dir), SPREAD, approximate=True)


def _bounds(c: str) -> str:
    return (
        f"SELECT quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo, "
        f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi FROM ({LINES}) l"
    )


@check(
    "boxplot_outliers",
    union_all(
        [
            f"SELECT '{c}' AS column_name, round(min(lo), 4) AS lower_bound, round(min(hi), 4) AS upper_bound, "
            f"count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS outlier_count FROM ({LINES}) l, ({_bounds(c)}) b"
            for c in SPREAD
        ]
    ),
)
def boxplot_outliers(spark, sf_dir):
    return rounded(profile.boxplot_outliers(line_measures(spark, sf_dir), SPREAD), 4)


@check(
    "outlier_rows",
    f"SELECT l_orderkey, l_partkey, l_linenumber, round(volume, 4) AS volume FROM ({LINES}) l, ({_bounds('volume')}) b WHERE volume < lo OR volume > hi",
)
def outlier_rows(spark, sf_dir):
    rows = profile.outlier_rows(line_measures(spark, sf_dir), ["volume"])
    return rounded(rows.select("l_orderkey", "l_partkey", "l_linenumber", "volume"), 4)


@check("null_counts", from_profile(FLAWED_SQL, FLAWED_COLUMNS, "column_name, missing_count AS null_count", "missing_count > 0"))
def null_counts(spark, sf_dir):
    return profile.null_counts(flawed(spark, sf_dir))


@check(
    "column_means",
    union_all(
        [f"SELECT '{c}' AS column_name, round(avg({c}), 6) AS mean FROM ({FLAWED_SQL}) f" for c in ("l_quantity", "rare", "line", "nothing")]
    ),
)
def column_means(spark, sf_dir):
    return rounded(profile.column_means(flawed(spark, sf_dir), ["l_quantity", "rare", "line", "nothing"]))


@check(
    "dataset_summary",
    "SELECT 1 AS files, count(*) AS total_rows, 11 AS total_columns, 3 AS categorical_columns, 7 AS numerical_columns, 1 AS temporal_columns FROM lineitem",
)
def dataset_summary(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    roles = schema.classify_columns(lines, profile.profile_columns(lines))
    summary = profile.dataset_summary(lines, roles, 1)
    return summary.select(*[F.col(c).cast("int").alias(c) if c.endswith("columns") else F.col(c) for c in summary.columns])


@check("approx_distinct_profile")
def approx_distinct_profile(spark, sf_dir):
    return profile.approx_distinct_profile(table(spark, sf_dir, "lineitem"))


# --- quality filters -----------------------------------------------------------------------------


@check("drop_high_missing", f"SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, seven, line, tag FROM ({FLAWED_SQL}) f")
def drop_high_missing(spark, sf_dir):
    lines = flawed(spark, sf_dir)
    return quality.drop_high_missing(lines, profile.profile_columns(lines))


@check("drop_constant", f"SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, rare, nothing, line, tag FROM ({FLAWED_SQL}) f")
def drop_constant(spark, sf_dir):
    lines = flawed(spark, sf_dir)
    return quality.drop_constant(lines)


@check("drop_high_cardinality", f"SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, rare, seven, nothing, line FROM ({FLAWED_SQL}) f")
def drop_high_cardinality(spark, sf_dir):
    lines = flawed(spark, sf_dir)
    return quality.drop_high_cardinality(lines, profile.profile_columns(lines))


@check("drop_duplicates", f"SELECT DISTINCT * FROM ({DOUBLED}) d")
def drop_duplicates(spark, sf_dir):
    return quality.drop_duplicates(doubled(spark, sf_dir))


@check(
    "inf_to_null",
    f"SELECT event_id, CASE WHEN isinf(value) OR isnan(value) THEN NULL ELSE value END AS value, event_type, "
    f"CASE WHEN isinf(value) THEN NULL ELSE isnan(value) END AS is_nan FROM ({NONFINITE}) e",
)
def inf_to_null(spark, sf_dir):
    """NaN stays NaN; it is shown as a flag because engines disagree on how to print it."""
    out = quality.inf_to_null(nonfinite(spark, sf_dir))
    flag = F.when(F.col("value").isNotNull(), F.isnan("value")).alias("is_nan")
    return out.select("event_id", F.nanvl("value", F.lit(None).cast("double")).alias("value"), "event_type", flag)


@check("drop_rows_any_null", f"SELECT * FROM ({NONFINITE}) e WHERE value IS NOT NULL AND NOT isnan(value) AND NOT isinf(value)")
def drop_rows_any_null(spark, sf_dir):
    return quality.drop_rows_any_null(quality.inf_to_null(nonfinite(spark, sf_dir)))


@check("skip_invalid_rows", f"SELECT l_orderkey, l_quantity, line, rare FROM ({FLAWED_SQL}) f WHERE line IS NOT NULL AND l_quantity IS NOT NULL")
def skip_invalid_rows(spark, sf_dir):
    return quality.skip_invalid_rows(flawed(spark, sf_dir), ["line", "l_quantity"]).select("l_orderkey", "l_quantity", "line", "rare")
