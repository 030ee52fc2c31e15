"""Queries over association measures and feature selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import association, profile, schema, selection
from .base import LINES, MEASURES, check, line_measures, profile_sql, rounded, table, union_all

TARGETS = ["volume", "revenue"]

GAPPY = f"SELECT *, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS gappy, 7.0::DOUBLE AS seven FROM ({LINES}) g"


def gappy(spark, sf_dir):
    return line_measures(spark, sf_dir).selectExpr("*", "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS gappy", "7.0D AS seven")


def _r(a: str, b: str) -> str:
    """Pearson's r in DuckDB, 0 where it is undefined."""
    return f"CASE WHEN stddev_pop({a}) FILTER (WHERE {b} IS NOT NULL) > 0 AND stddev_pop({b}) FILTER (WHERE {a} IS NOT NULL) > 0 THEN corr({a}, {b}) ELSE 0 END"


def _scores(source: str, targets, features, digits: int = 6) -> str:
    return union_all(
        [
            f"SELECT '{t}' AS target, '{f}' AS feature, 'correlation' AS method, round(abs({_r(t, f)}), {digits}) AS score FROM ({source}) s"
            for t in targets
            for f in features
            if f != t
        ]
    )


FEATURES = MEASURES + ["gappy", "seven"]


@check("corr_pearson", _scores(GAPPY, TARGETS, FEATURES))
def corr_pearson(spark, sf_dir):
    return rounded(association.correlation_scores(gappy(spark, sf_dir), TARGETS, FEATURES))


@check("corr_pearson_many_pairs", _scores(GAPPY, TARGETS + ["l_tax"], FEATURES))
def corr_pearson_many_pairs(spark, sf_dir):
    return rounded(association.correlation_scores(gappy(spark, sf_dir), TARGETS + ["l_tax"], FEATURES))


# Values near 1e9 that differ by less than 2.
NEAR = [f"1e9 + l_discount * {i} + l_tax * {12 - i} / 2 + l_quantity / 50" for i in range(1, 13)]
NEAR_PAIRS = [(f"c{i}", f"c{j}") for i in range(12) for j in range(i + 1, 12)]


@check(
    "corr_pearson_over_60_pairs",
    # the other engine's sums lose digits near 1e9; taking 1e9 off again is exact and leaves r as it is
    union_all([f"SELECT '{a}' AS a, '{b}' AS b, round({_r(a, b)}, 6) AS r FROM (SELECT {', '.join(f'({c}) - 1e9 AS c{i}' for i, c in enumerate(NEAR))} FROM lineitem) n" for a, b in NEAR_PAIRS]),
)
def corr_pearson_over_60_pairs(spark, sf_dir):
    near = table(spark, sf_dir, "lineitem").selectExpr(*[f"{c} AS c{i}" for i, c in enumerate(NEAR)])
    return rounded(association.pearson(near, NEAR_PAIRS))


def _ranks(source: str, a: str, b: str) -> str:
    """Average ranks of both columns over pairwise complete rows."""
    return (
        "SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx, "
        "rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM "
        f"(SELECT CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y FROM ({source}) s WHERE {a} IS NOT NULL AND {b} IS NOT NULL) p"
    )


SPEARMAN_FEATURES = ["l_quantity", "l_discount", "gappy", "seven"]


@check(
    "corr_spearman",
    union_all(
        [
            f"SELECT 'volume' AS target, '{f}' AS feature, 'correlation' AS method, round(abs({_r('CAST(rx AS DOUBLE)', 'CAST(ry AS DOUBLE)')}), 6) AS score "
            f"FROM ({_ranks(GAPPY, 'volume', f)}) r"
            for f in SPEARMAN_FEATURES
        ]
    ),
)
def corr_spearman(spark, sf_dir):
    return rounded(association.correlation_scores(gappy(spark, sf_dir), ["volume"], SPEARMAN_FEATURES, "spearman"))


def _tau(a: str, b: str) -> str:
    """tau-b over all pairs of rows."""
    return (
        "SELECT CASE WHEN sum(abs(sign(p.x - q.x))) > 0 AND sum(abs(sign(p.y - q.y))) > 0 THEN "
        "sum(sign(p.x - q.x) * sign(p.y - q.y)) / (sqrt(sum(abs(sign(p.x - q.x)))) * sqrt(sum(abs(sign(p.y - q.y))))) ELSE 0 END "
        f"FROM (SELECT CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y FROM part) p, (SELECT CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y FROM part) q"
    )


@check(
    "corr_kendall",
    union_all(
        [
            f"SELECT 'p_retailprice' AS target, '{f}' AS feature, 'correlation' AS method, round(abs(({_tau('p_retailprice', f)})), 6) AS score"
            for f in ("p_size", "p_partkey")
        ]
    ),
)
def corr_kendall(spark, sf_dir):
    return rounded(association.correlation_scores(table(spark, sf_dir, "part"), ["p_retailprice"], ["p_size", "p_partkey"], "kendall"))


@check("corr_kendall_lineitem")
def corr_kendall_lineitem(spark, sf_dir):
    return association.correlation_scores(line_measures(spark, sf_dir), ["volume"], ["l_quantity", "l_extendedprice"], "kendall")


@check(
    "corr_matrix",
    union_all(
        [
            f"SELECT '{a}' AS a, '{b}' AS b, round({_r(a, b)}, 6) AS r FROM ({LINES}) s"
            for a in MEASURES + TARGETS
            for b in MEASURES + TARGETS
            if a != b
        ]
    ),
)
def corr_matrix(spark, sf_dir):
    return rounded(association.correlation_matrix(line_measures(spark, sf_dir), MEASURES + TARGETS))


@check("corr_threshold", f"SELECT * FROM ({_scores(LINES, TARGETS, MEASURES)}) s WHERE score >= 0.1")
def corr_threshold(spark, sf_dir):
    return rounded(selection.above_threshold(association.correlation_scores(line_measures(spark, sf_dir), TARGETS, MEASURES), 0.1))


@check("corr_preview", _scores(LINES, ["volume"], ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *MEASURES, "revenue"]))
def corr_preview(spark, sf_dir):
    lines = line_measures(spark, sf_dir)
    return rounded(selection.correlation_preview(lines, "volume", profile.numeric_columns(lines)))


@check("bounded_sample", "SELECT *, true AS approximate FROM lineitem WHERE (l_orderkey * 7 + l_linenumber) % 100 < 10")
def bounded_sample(spark, sf_dir):
    """A tenth by arithmetic on the key, which any engine can repeat."""
    lines = table(spark, sf_dir, "lineitem")
    return selection.bounded_sample(lines, ["l_orderkey", "l_linenumber"], by=F.expr("double((l_orderkey * 7 + l_linenumber) % 100) / 100"))


@check(
    "lasso_importance",
    f"SELECT 'volume' AS target, 'l_quantity' AS feature, 'lasso' AS method, round(greatest(0, abs(corr(l_quantity, volume)) - 20000 / stddev_samp(volume)) * stddev_samp(volume) / stddev_samp(l_quantity), 0) AS score FROM ({LINES}) l",
)
def lasso_importance(spark, sf_dir):
    """One feature: the standardised coefficient is the correlation less the penalty relative to the target's deviation. The solver stops at six digits."""
    return rounded(selection.lasso_importance(line_measures(spark, sf_dir), "volume", ["l_quantity"], 20000.0), 0)


def _ranked(scores: str, ratio: float, share: float) -> str:
    return (
        "SELECT target, feature, round(s, 6) AS score, row_number() OVER (PARTITION BY target ORDER BY s DESC, feature) AS rank, "
        f"row_number() OVER (PARTITION BY target ORDER BY s DESC, feature) <= greatest(1, floor(count(*) OVER (PARTITION BY target) * {share})) AS kept "
        f"FROM (SELECT target, feature, {ratio} * CASE WHEN max(score) OVER (PARTITION BY target) = 0 THEN 0 ELSE score / max(score) OVER (PARTITION BY target) END AS s "
        f"FROM ({scores}) c) n"
    )


def _as_ranked(df):
    return rounded(df.withColumn("rank", F.col("rank").cast("bigint")))


@check("rank_and_keep", _ranked(_scores(LINES, TARGETS, MEASURES, 9), 0.8, 0.5))
def rank_and_keep(spark, sf_dir):
    scores = rounded(association.correlation_scores(line_measures(spark, sf_dir), TARGETS, MEASURES), 9)
    return _as_ranked(selection.rank_and_keep(scores, {"correlation": 0.8, "lasso": 0.5}, ["correlation", "lasso"]))


@check("rank_and_keep_default_ratios", _ranked(_scores(LINES, TARGETS, MEASURES, 9), 1.0, 0.0))
def rank_and_keep_default_ratios(spark, sf_dir):
    scores = rounded(association.correlation_scores(line_measures(spark, sf_dir), TARGETS, MEASURES), 9)
    return _as_ranked(selection.rank_and_keep(scores, {"correlation": 1.0, "lasso": 0.0}, ["correlation", "lasso"]))


VOTED = f"SELECT feature, max(score) AS top FROM ({_scores(LINES, TARGETS, MEASURES, 9)}) s GROUP BY feature"


@check(
    "combine_methods",
    f"SELECT feature, round(CAST(sum(w) AS DOUBLE), 6) AS score FROM (SELECT feature, 0.8::DOUBLE AS w FROM ({VOTED}) v WHERE top >= 0.01 "
    f"UNION ALL SELECT feature, 0.5::DOUBLE FROM ({VOTED}) v WHERE top >= 0.3 UNION ALL SELECT feature, 0.3::DOUBLE FROM ({VOTED}) v) u GROUP BY feature",
)
def combine_methods(spark, sf_dir):
    scores = rounded(association.correlation_scores(line_measures(spark, sf_dir), TARGETS, MEASURES), 9)
    best = scores.groupBy("feature").agg(F.max("score").alias("top"))
    votes = best.select(
        "feature",
        F.explode(
            F.array_compact(
                F.array(F.when(F.col("top") >= 0.01, "correlation"), F.when(F.col("top") >= 0.3, "lasso"), F.lit("rfe"))
            )
        ).alias("method"),
    )
    return rounded(selection.combine_methods(votes))


@check("multi_target_correlations", _scores(LINES, TARGETS, MEASURES))
def multi_target_correlations(spark, sf_dir):
    chosen = selection.multi_target_selection(line_measures(spark, sf_dir), TARGETS, MEASURES, {"correlation": 1.0, "lasso": 0.0})
    return rounded(chosen.filter("method = 'correlation'").drop("kept"))


@check("multi_target_selection")
def multi_target_selection(spark, sf_dir):
    return selection.multi_target_selection(line_measures(spark, sf_dir), TARGETS, MEASURES, {"correlation": 0.8, "lasso": 0.5})


@check(
    "top_exogenous",
    "SELECT feature, score, row_number() OVER (ORDER BY score DESC, feature) AS rank FROM "
    f"({_scores(f'SELECT *, l_quantity AS volume_lag_1 FROM ({LINES}) q', ['volume'], MEASURES + ['revenue'])}) s QUALIFY rank <= 3",
)
def top_exogenous(spark, sf_dir):
    lines = line_measures(spark, sf_dir).withColumn("volume_lag_1", F.col("l_quantity"))
    found = selection.top_exogenous(lines, "volume", MEASURES + ["revenue", "volume_lag_1"], 3)
    return rounded(found.drop("method").withColumn("rank", F.col("rank").cast("bigint")))


_COLUMNS = [("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"), ("l_linenumber", "int")]


@check(
    "feature_metadata",
    "SELECT r.column_name, r.role, CASE r.role WHEN 'categorical' THEN 'categorical_features' ELSE 'scaled_features' END AS destination, s.target, s.method, s.score FROM "
    f"(SELECT column_name, CASE WHEN dtype = 'double' THEN 'numerical' ELSE 'categorical' END AS role FROM ({profile_sql('SELECT * FROM lineitem', _COLUMNS)}) p) r "
    f"LEFT JOIN (SELECT * FROM ({_scores(LINES, TARGETS, MEASURES)}) x QUALIFY row_number() OVER (PARTITION BY target ORDER BY score DESC, feature) <= 2) s "
    "ON r.column_name = s.feature",
)
def feature_metadata(spark, sf_dir):
    lines = line_measures(spark, sf_dir)
    report = profile.profile_columns(lines, [c for c, _ in _COLUMNS])
    roles = schema.classify_columns(lines.select(*[c for c, _ in _COLUMNS]), report)
    scores = association.correlation_scores(lines, TARGETS, MEASURES)
    marks = selection.rank_and_keep(scores, {"correlation": 0.5}, ["correlation"]).select("target", "feature", "kept")
    return rounded(selection.feature_metadata(roles, scores.join(marks, ["target", "feature"])))


def _elimination_sql() -> str:
    """Three features of a label: which of the standardised coefficients is smallest, by the closed forms for three inputs, then for two."""
    xs = ["l_quantity", "l_discount", "l_tax"]
    r = lambda a, b: f"corr({a}, {b})"
    three = []
    for k, a in enumerate(xs):
        b, c = xs[(k + 1) % 3], xs[(k + 2) % 3]
        # by Cramer's rule; the determinant is the same for all three
        three.append(
            f"({r(a, 'y')} * (1 - {r(b, c)} * {r(b, c)}) - {r(b, 'y')} * ({r(a, b)} - {r(a, c)} * {r(b, c)}) - {r(c, 'y')} * ({r(a, c)} - {r(a, b)} * {r(b, c)}))"
        )
    first = union_all([f"SELECT '{a}' AS feature, abs({s}) AS size FROM l" for a, s in zip(xs, three)])
    second = union_all(
        [
            f"SELECT '{a}' AS feature, abs({r(a, 'y')} - {r(b, 'y')} * {r(a, b)}) AS size, '{c}' AS without FROM l"
            for a in xs for b in xs for c in xs if len({a, b, c}) == 3
        ]
    )
    return (
        f"WITH l AS (SELECT *, 3 * l_quantity + 100 * l_discount - 60 * l_tax + l_extendedprice / 1000 AS y FROM lineitem), "
        f"one AS (SELECT feature FROM ({first}) f ORDER BY size, feature LIMIT 1), "
        f"two AS (SELECT s.feature FROM ({second}) s JOIN one ON s.without = one.feature ORDER BY size, s.feature LIMIT 1) "
        "SELECT x.feature, CASE WHEN x.feature = one.feature THEN 1 WHEN x.feature = two.feature THEN 2 END AS eliminated_at, x.feature NOT IN (one.feature, two.feature) AS kept "
        f"FROM (SELECT unnest({xs}) AS feature) x, one, two"
    )


@check("recursive_elimination", _elimination_sql())
def recursive_elimination(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("y", F.expr("3 * l_quantity + 100 * l_discount - 60 * l_tax + l_extendedprice / 1000"))
    return selection.recursive_elimination(lines, "y", ["l_quantity", "l_discount", "l_tax"], 1)


@check("recursive_elimination_collinear", "SELECT unnest(['l_quantity', 'twice', 'seven', 'l_tax']) AS feature, unnest([NULL, 1, 2, 3]) AS eliminated_at, unnest([true, false, false, false]) AS kept")
def recursive_elimination_collinear(spark, sf_dir):
    """A feature that follows from another one and a constant one go first."""
    lines = table(spark, sf_dir, "lineitem").selectExpr("*", "2 * l_quantity + 1 AS twice", "7.0D AS seven", "3 * l_quantity + l_tax AS y")
    return selection.recursive_elimination(lines, "y", ["l_quantity", "twice", "seven", "l_tax"], 1)


# The larger component of two columns: (big - c, b) is its direction.
TWO_COMPONENTS = (
    "SELECT l_orderkey, l_linenumber, l_partkey, round(abs(((big - c) * l_quantity + b * percent) / sqrt((big - c) * (big - c) + b * b)), 5) AS pca_0{second} FROM "
    "(SELECT *, 100 * l_discount AS percent FROM lineitem) l, (SELECT *, (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS big FROM "
    "(SELECT var_samp(l_quantity) AS a, covar_samp(l_quantity, 100 * l_discount) AS b, var_samp(100 * l_discount) AS c FROM lineitem) m) v"
)
SECOND = ", round(abs((b * l_quantity - (big - c) * percent) / sqrt((big - c) * (big - c) + b * b)), 5) AS pca_1"


def _two_columns(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumn("percent", F.col("l_discount") * 100)


def _unsigned(reduced, names):
    """A component may have either sign."""
    return reduced.select("l_orderkey", "l_linenumber", "l_partkey", *[F.round(F.abs(n), 5).alias(n) for n in names])


@check("pca", TWO_COMPONENTS.format(second=SECOND))
def pca(spark, sf_dir):
    reduced, names, _ = selection.pca(_two_columns(spark, sf_dir), ["l_quantity", "percent"], 2)
    return _unsigned(reduced, names)


@check("pca_by_variance", TWO_COMPONENTS.format(second=""))
def pca_by_variance(spark, sf_dir):
    """The first component alone has nine tenths of the variance."""
    reduced, names, _ = selection.pca_by_variance(_two_columns(spark, sf_dir), ["l_quantity", "percent"], 0.9)
    return _unsigned(reduced, names)


@check(
    "explained_variance",
    "SELECT component, round(ratio, 6) AS ratio, round(cumulative, 6) AS cumulative FROM (SELECT 'pca_0' AS component, big / (big + small) AS ratio, big / (big + small) AS cumulative FROM v "
    "UNION ALL SELECT 'pca_1', small / (big + small), 1.0 FROM v)".replace(
        "FROM v",
        "FROM (SELECT (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS big, (a + c) / 2 - sqrt(pow((a - c) / 2, 2) + b * b) AS small "
        "FROM (SELECT var_samp(l_quantity) AS a, covar_samp(l_quantity, 100 * l_discount) AS b, var_samp(100 * l_discount) AS c FROM lineitem) m) v",
    ),
)
def explained_variance(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("percent", F.col("l_discount") * 100)
    _, model = selection.fit_pca(lines, ["l_quantity", "percent"], 2)
    return rounded(selection.explained_variance(model, spark))


@check(
    "drop_multicollinear",
    "SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem",
)
def drop_multicollinear(spark, sf_dir):
    """Revenue goes: it follows the extended price."""
    lines = line_measures(spark, sf_dir).select("l_orderkey", *MEASURES, "revenue")
    return selection.drop_multicollinear(lines, MEASURES + ["revenue"])[0]


@check(
    "low_variance_columns",
    union_all(
        [
            f"SELECT '{c}' AS feature, round(var_samp({c}), 4) AS variance, var_samp({c}) <= 0.01 AS dropped FROM ({GAPPY}) g"
            for c in FEATURES
        ]
    ),
)
def low_variance_columns(spark, sf_dir):
    return rounded(selection.low_variance_columns(gappy(spark, sf_dir), FEATURES, 0.01), 4)


@check("drop_low_variance", f"SELECT l_orderkey, l_quantity, l_extendedprice, gappy FROM ({GAPPY}) g")
def drop_low_variance(spark, sf_dir):
    lines = gappy(spark, sf_dir).select("l_orderkey", *FEATURES)
    return selection.drop_low_variance(lines, FEATURES, 0.01)


@check(
    "polynomial_features",
    "SELECT l_orderkey, l_quantity AS t_0, l_quantity * l_quantity AS t_1, l_discount AS t_2, "
    "round(l_quantity * l_discount, 6) AS t_3, round(l_discount * l_discount, 6) AS t_4 FROM lineitem",
)
def polynomial_features(spark, sf_dir):
    expanded = selection.polynomial_features(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"])
    terms = [F.round(F.get("polynomial", F.lit(i)), 6).alias(f"t_{i}") for i in range(5)]
    return expanded.select("l_orderkey", *terms)


@check(
    "feature_interactions",
    "SELECT l_orderkey, round(l_quantity * l_discount, 6) AS l_quantity_x_l_discount, round(l_quantity * l_tax, 6) AS l_quantity_x_l_tax, "
    "round(l_discount * l_tax, 6) AS l_discount_x_l_tax FROM lineitem",
)
def feature_interactions(spark, sf_dir):
    crossed = selection.feature_interactions(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    return rounded(crossed.select("l_orderkey", "l_quantity_x_l_discount", "l_quantity_x_l_tax", "l_discount_x_l_tax"))


@check(
    "univariate_selection",
    f"SELECT feature, row_number() OVER (ORDER BY r DESC, feature) <= 2 AS kept FROM ({union_all([f'SELECT {chr(39)}{m}{chr(39)} AS feature, abs(corr(volume, {m})) AS r FROM ({LINES}) l' for m in MEASURES])}) s",
)
def univariate_selection(spark, sf_dir):
    return selection.univariate_selection(line_measures(spark, sf_dir), "volume", MEASURES, 2)


@check(
    "class_weights",
    "SELECT quality AS label, count(*) AS n, round(CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)), 6) AS weight FROM labels GROUP BY quality",
)
def class_weights(spark, sf_dir):
    return rounded(selection.class_weights(table(spark, sf_dir, "labels"), "quality"))


@check("oversample_null_label", "SELECT doc_id, CAST(1 AS BIGINT) AS copy FROM labels WHERE doc_id % 7 = 0")
def oversample_null_label(spark, sf_dir):
    """Rows without a label are neither lost nor repeated."""
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id", "CASE WHEN doc_id % 7 > 0 THEN toxic END AS toxic")
    return selection.oversample(labels, "toxic", ["doc_id"]).filter("toxic IS NULL").select("doc_id", "copy")


@check("oversample")
def oversample(spark, sf_dir):
    return selection.oversample(table(spark, sf_dir, "labels"), "toxic", ["doc_id"])
