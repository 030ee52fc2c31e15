"""Queries over imputation by constants, encoding and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode, impute, profile
from .base import check, rounded, table
from .profile import FLAWED_SQL, flawed

FILLED = ["rare", "line", "nothing"]


def _filled(expression: dict[str, str]) -> str:
    shown = ", ".join(f"{e} AS {c}" for c, e in expression.items())
    return f"SELECT l_orderkey, l_linenumber, l_quantity, {shown} FROM ({FLAWED_SQL}) f, (SELECT avg(rare) AS m_rare, avg(line) AS m_line FROM ({FLAWED_SQL}) g) m"


def _shown(df):
    return rounded(df.select("l_orderkey", "l_linenumber", "l_quantity", "rare", "line", "nothing"))


@check(
    "impute_mean",
    _filled({"rare": "round(coalesce(rare, m_rare), 6)", "line": "round(coalesce(CAST(line AS DOUBLE), m_line), 6)", "nothing": "nothing"}),
)
def impute_mean(spark, sf_dir):
    return _shown(impute.impute_mean(flawed(spark, sf_dir), FILLED))


@check("impute_zero", _filled({"rare": "coalesce(rare, 0)", "line": "coalesce(CAST(line AS DOUBLE), 0)", "nothing": "coalesce(nothing, 0)"}))
def impute_zero(spark, sf_dir):
    return _shown(impute.impute_zero(flawed(spark, sf_dir), FILLED))


@check(
    "impute_ffill_as_mean",
    _filled(
        {"rare": "round(coalesce(rare, m_rare), 6)", "line": "round(coalesce(CAST(line AS DOUBLE), m_line), 6)", "nothing": "coalesce(nothing, 0)"}
    ),
)
def impute_ffill_as_mean(spark, sf_dir):
    return _shown(impute.impute_ffill_as_mean(flawed(spark, sf_dir), FILLED))


@check(
    "impute_only_missing",
    _filled({"rare": "round(coalesce(rare, m_rare), 6)", "line": "round(coalesce(CAST(line AS DOUBLE), m_line), 6)", "nothing": "nothing"}),
)
def impute_only_missing(spark, sf_dir):
    lines = flawed(spark, sf_dir)
    gaps = impute.columns_with_missing(profile.profile_columns(lines), ["l_quantity", *FILLED])
    return _shown(impute.impute_mean(lines, gaps))


# --- categories ----------------------------------------------------------------------------------

CATEGORY = "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS segment, c_acctbal FROM customer"
LABELS = (
    f"SELECT segment, row_number() OVER (ORDER BY count(*) DESC, segment) - 1 AS i, count(*) OVER () AS k FROM ({CATEGORY}) c "
    "WHERE segment IS NOT NULL GROUP BY segment"
)


def category(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr("c_custkey", "nullif(c_mktsegment, 'BUILDING') AS segment", "c_acctbal")


INDEXED = f"SELECT c.*, l.i, coalesce(l.i, (SELECT max(k) FROM ({LABELS}) x)) AS j FROM ({CATEGORY}) c LEFT JOIN ({LABELS}) l ON c.segment = l.segment"


@check("string_index", f"SELECT c_custkey, segment, CAST(j AS DOUBLE) AS segment_index FROM ({INDEXED}) s")
def string_index(spark, sf_dir):
    return encode.string_index(category(spark, sf_dir), "segment").drop("c_acctbal")


@check(
    "string_index_many_labels",
    "SELECT p.l_orderkey, p.l_partkey, CAST(l.i AS DOUBLE) AS l_orderkey_index FROM lineitem p JOIN "
    "(SELECT l_orderkey, row_number() OVER (ORDER BY count(*) DESC, l_orderkey) - 1 AS i FROM lineitem GROUP BY l_orderkey) l "
    "ON p.l_orderkey = l.l_orderkey",
)
def string_index_many_labels(spark, sf_dir):
    """More labels than are broadcast: the rare ones are joined by shuffle."""
    return encode.string_index(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"), "l_orderkey")


@check(
    "one_hot",
    f"SELECT c_custkey, segment, {', '.join(f'CASE WHEN i = {i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS slot_{i}' for i in range(4))}, "
    f"(SELECT count(*) FROM ({LABELS}) x) AS slots FROM ({INDEXED}) s",
)
def one_hot(spark, sf_dir):
    encoded = encode.one_hot(category(spark, sf_dir), "segment")
    slots = [F.get("segment_encoded", F.lit(i)).alias(f"slot_{i}") for i in range(4)]
    return encoded.select("c_custkey", "segment", *slots, F.size("segment_encoded").cast("bigint").alias("slots"))


@check(
    "assemble",
    f"SELECT c_custkey, c_acctbal AS f_0, {', '.join(f'CASE WHEN i = {i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS f_{i + 1}' for i in range(4))} "
    f"FROM ({INDEXED}) s WHERE c_acctbal IS NOT NULL",
)
def assemble(spark, sf_dir):
    table_ = encode.assemble(encode.one_hot(category(spark, sf_dir), "segment"), ["c_acctbal", "segment_encoded"])
    return table_.select("c_custkey", *[F.get("features", F.lit(i)).alias(f"f_{i}") for i in range(5)])


# --- scaling -------------------------------------------------------------------------------------

COMPLETE = f"SELECT * FROM ({FLAWED_SQL}) f WHERE line IS NOT NULL"


def _scaled(df):
    return rounded(df.select("l_orderkey", "line", "l_quantity_scaled", "line_scaled", "seven_scaled"))


@check(
    "scale_standard",
    "SELECT l_orderkey, line, round((l_quantity - mq) / sq, 6) AS l_quantity_scaled, round((line - ml) / sl, 6) AS line_scaled, "
    f"0.0::DOUBLE AS seven_scaled FROM ({COMPLETE}) c, (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(line) AS ml, "
    f"stddev_samp(line) AS sl FROM ({COMPLETE}) d) p",
)
def scale_standard(spark, sf_dir):
    return _scaled(encode.scale(flawed(spark, sf_dir), ["l_quantity", "line", "seven"], "standard"))


@check(
    "scale_minmax",
    "SELECT l_orderkey, line, round((l_quantity - aq) / (bq - aq), 6) AS l_quantity_scaled, round(CAST(line - al AS DOUBLE) / (bl - al), 6) AS line_scaled, "
    f"0.5::DOUBLE AS seven_scaled FROM ({COMPLETE}) c, (SELECT min(l_quantity) AS aq, max(l_quantity) AS bq, min(line) AS al, max(line) AS bl FROM ({COMPLETE}) d) p",
)
def scale_minmax(spark, sf_dir):
    return _scaled(encode.scale(flawed(spark, sf_dir), ["l_quantity", "line", "seven"], "minmax"))


@check(
    "minmax_fit_inverse",
    "SELECT p_partkey, round((p_retailprice - a) / (b - a), 6) AS scaled, round(p_retailprice, 4) AS restored, 0.0::DOUBLE AS constant "
    "FROM part, (SELECT min(p_retailprice) AS a, max(p_retailprice) AS b FROM part) m",
)
def minmax_fit_inverse(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("seven", F.lit(7.0))
    bounds = encode.fit_range(part, ["p_retailprice", "seven"])
    scaled = encode.minmax_column(part, "p_retailprice", bounds["p_retailprice"])
    return part.select(
        "p_partkey",
        F.round(scaled, 6).alias("scaled"),
        F.round(encode.minmax_inverse(scaled, bounds["p_retailprice"]), 4).alias("restored"),
        encode.minmax_column(part, "seven", bounds["seven"]).alias("constant"),
    )


@check(
    "minmax_exogenous",
    "SELECT p_partkey, round((p_retailprice - a) / (b - a), 6) AS p_retailprice, round(CAST(p_size - c AS DOUBLE) / (d - c), 6) AS p_size "
    "FROM part, (SELECT min(p_retailprice) AS a, max(p_retailprice) AS b, min(p_size) AS c, max(p_size) AS d FROM part) m",
)
def minmax_exogenous(spark, sf_dir):
    return rounded(encode.minmax_exogenous(table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size"), ["p_retailprice", "p_size"]))
