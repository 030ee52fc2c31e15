"""Registration of queries and the fixtures they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the same result for any SQL engine over the same tables."""

    def register(query: Query) -> Query:
        assert name not in QUERIES, name
        QUERIES[name] = query
        if sql:
            ORACLES[name] = sql
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """DOUBLE columns rounded: the order of additions must not show."""
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


# Derived columns, the same text in both engines.
SPARSE = "CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END"
GAPPED = (
    "CASE WHEN event_id < 3 OR event_id > (SELECT max(event_id) - 3 FROM events) "
    "OR event_id BETWEEN 700 AND 760 OR event_id % 11 = 0 THEN NULL ELSE value END"
)


def gapped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose value is missing at the start, at the end, over a long stretch and here and there."""
    events = table(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).first()[0]
    condition = (
        (F.col("event_id") < 3)
        | (F.col("event_id") > last - 3)
        | F.col("event_id").between(700, 760)
        | (F.col("event_id") % 11 == 0)
    )
    return events.select("event_id", "ts", "user_id", "event_type", F.when(~condition, F.col("value")).alias("value"))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sums per event type."""
    events = table(spark, sf_dir, "events")
    return events.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.sum("value").alias("y"))


DAILY = "SELECT event_type, CAST(ts AS DATE) AS day, sum(value) AS y FROM events GROUP BY 1, 2"


def line_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a target that depends on two of the measures."""
    return table(spark, sf_dir, "lineitem").select(
        "*",
        (F.col("l_quantity") * F.col("l_extendedprice")).alias("volume"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
    )


LINES = "SELECT *, l_quantity * l_extendedprice AS volume, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem"
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


TYPES = {
    "lineitem": "l_orderkey:bigint l_partkey:bigint l_suppkey:bigint l_linenumber:int l_quantity:double l_extendedprice:double "
    "l_discount:double l_tax:double l_returnflag:string l_linestatus:string l_shipdate:timestamp_ntz",
    "orders": "o_orderkey:bigint o_custkey:bigint o_orderstatus:string o_totalprice:double o_orderdate:timestamp_ntz o_orderpriority:string",
    "events": "event_id:bigint ts:timestamp_ntz user_id:bigint event_type:string value:double props:string",
    "documents": "doc_id:bigint text:string lang:string source:string n_chars:bigint",
    "customer": "c_custkey:bigint c_name:string c_nationkey:int c_acctbal:double c_mktsegment:string",
}


def columns_of(name: str) -> list[tuple[str, str]]:
    return [tuple(part.split(":")) for part in TYPES[name].split()]


def profile_sql(source: str, columns: list[tuple[str, str]]) -> str:
    """One aggregate per column of the whole quality report."""
    parts = []
    for name, dtype in columns:
        gap = f"{name} IS NULL" + (f" OR isnan({name})" if dtype in ("double", "float") else "")
        shown = f"count(DISTINCT {name})" if dtype in ("string", "int") else "CAST(NULL AS BIGINT)"
        parts.append(
            f"SELECT '{name}' AS column_name, '{dtype}' AS dtype, count(*) AS total_rows, "
            f"count(*) FILTER (WHERE {gap}) AS missing_count, "
            f"round(CAST(count(*) FILTER (WHERE {gap}) AS DOUBLE) / count(*), 6) AS missing_fraction, "
            f"count({name}) AS nonnull_count, count(DISTINCT {name}) AS distinct_count, "
            f"count(DISTINCT {name}) = 1 AND count({name}) > 0 AS is_constant, {shown} AS cardinality FROM ({source}) s"
        )
    return union_all(parts)
