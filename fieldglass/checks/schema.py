"""Queries over names, types and roles."""

from __future__ import annotations

from ..operators import profile, schema
from .base import check, columns_of, profile_sql, rounded, table, union_all
from .profile import FLAWED_COLUMNS, FLAWED_SQL, flawed


def awkward(spark, sf_dir):
    return table(spark, sf_dir, "orders").toDF("order.key", "cust key", "order-status", "totalprice", "order date", "priority")


@check("keep_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def keep_columns(spark, sf_dir):
    return schema.keep_columns(table(spark, sf_dir, "orders"), ["o_totalprice", "absent", "o_orderkey"])


@check("drop_by_type", "SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def drop_by_type(spark, sf_dir):
    return schema.drop_by_type(table(spark, sf_dir, "lineitem"), ["string", "timestamp_ntz", "int"])


@check(
    "sanitize_names",
    "SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus AS order_status, o_totalprice AS totalprice, "
    "o_orderdate AS order_date, o_orderpriority AS priority FROM orders",
)
def sanitize_names(spark, sf_dir):
    return schema.sanitize_names(awkward(spark, sf_dir))[0]


ORIGINAL = ["order.key", "cust key", "order-status", "totalprice", "order date", "priority"]


def _named_counts(names) -> str:
    return union_all(
        [f"SELECT '{shown}' AS column_name, count(DISTINCT {c}) AS distinct_count FROM orders" for shown, (c, _) in zip(names, columns_of("orders"))]
    )


@check("restore_names", _named_counts(ORIGINAL))
def restore_names(spark, sf_dir):
    """Profile under clean names, report under the original ones."""
    clean, names = schema.sanitize_names(awkward(spark, sf_dir))
    return schema.rename_in_table(profile.distinct_profile(clean), names, restore=True)


@check("report_rename", _named_counts([schema.clean_name(n) for n in ORIGINAL]))
def report_rename(spark, sf_dir):
    orders = awkward(spark, sf_dir)
    return schema.rename_in_table(profile.distinct_profile(orders), schema.sanitize_names(orders)[1])


ROLE = (
    "CASE WHEN dtype = 'int' THEN CASE WHEN cardinality <= 10 THEN 'categorical' ELSE 'numerical' END WHEN dtype = 'bigint' THEN {big} "
    "WHEN dtype = 'double' THEN 'numerical' WHEN dtype = 'string' THEN 'categorical' ELSE 'temporal' END"
)


@check(
    "classify_columns",
    f"SELECT column_name, {ROLE.format(big=chr(39) + 'numerical' + chr(39))} AS role FROM ({profile_sql(FLAWED_SQL, FLAWED_COLUMNS)}) p WHERE column_name <> 'l_quantity'",
)
def classify_columns(spark, sf_dir):
    lines = flawed(spark, sf_dir)
    return schema.classify_columns(lines, profile.profile_columns(lines), ["l_quantity"])


@check(
    "classify_columns_counted",
    "SELECT column_name, "
    + ROLE.format(big="CASE WHEN distinct_count <= 10 THEN 'categorical' ELSE 'numerical' END")
    + f" AS role FROM ({profile_sql(FLAWED_SQL, FLAWED_COLUMNS)}) p WHERE column_name <> 'l_quantity'",
)
def classify_columns_counted(spark, sf_dir):
    return schema.classify_columns_counted(flawed(spark, sf_dir), ["l_quantity"])


@check("project_features", "SELECT l_quantity, l_tax, l_extendedprice FROM lineitem")
def project_features(spark, sf_dir):
    return schema.project_features(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_tax", "l_quantity"], ["l_extendedprice", "l_tax"])
