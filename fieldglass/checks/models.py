"""Queries over splits, samples, anomalies and model comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import models, sampling
from .base import LINES, MEASURES, check, line_measures, rounded, table
from .profile import NONFINITE, nonfinite
from .series import ORDER, events

KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]


def text_measures(spark, sf_dir):
    """Labelled documents with a few measures of their text."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("chars"),
        F.size(F.split("text", r"\s+")).cast("double").alias("words"),
        F.size(F.split("text", "\n")).cast("double").alias("lines"),
        F.regexp_count("text", F.lit("[0-9]")).cast("double").alias("digits"),
    )
    return docs.join(table(spark, sf_dir, "labels"), "doc_id")


TEXT = ["chars", "words", "lines", "digits"]


@check("compare_regressors")
def compare_regressors(spark, sf_dir):
    return models.compare_regressors(line_measures(spark, sf_dir), "volume", MEASURES, KEY)


@check("compare_classifiers")
def compare_classifiers(spark, sf_dir):
    return models.compare_classifiers(text_measures(spark, sf_dir), "quality", TEXT, ["doc_id"])


@check("compare_classifiers_several_classes")
def compare_classifiers_several_classes(spark, sf_dir):
    return models.compare_classifiers(table(spark, sf_dir, "lineitem"), "l_returnflag", MEASURES, KEY)


@check("compare_clusterers")
def compare_clusterers(spark, sf_dir):
    return models.compare_clusterers(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"], 3)


def _ridge_sql(regs: list[float]) -> str:
    """One input: the standardised coefficient is r / (1 + penalty / deviation of the label); errors of written predictions per fold."""
    parts = []
    for reg in regs:
        parts.append(
            f"SELECT CAST({reg} AS DOUBLE) AS reg_param, round(avg(e), 6) AS rmse FROM (SELECT k, sqrt(avg(pow(y - (my + b * (x - mx)), 2))) AS e FROM l JOIN "
            f"(SELECT k, avg(x) AS mx, avg(y) AS my, corr(x, y) / (1 + {reg} / stddev_pop(y)) * stddev_pop(y) / stddev_pop(x) AS b FROM l, (SELECT unnest(range(5)) AS k) f WHERE fold <> k GROUP BY k) m "
            "ON fold = k GROUP BY k) e"
        )
    return "WITH l AS (SELECT l_extendedprice AS x, l_quantity * l_extendedprice / 1000 AS y, l_orderkey % 5 AS fold FROM lineitem) " + " UNION ALL ".join(parts)


@check("kfold_cv", _ridge_sql([0.0, 0.1, 50.0]))
def kfold_cv(spark, sf_dir):
    """Folds by order key, so that any engine can form them."""
    lines = table(spark, sf_dir, "lineitem").withColumn("y", F.expr("l_quantity * l_extendedprice / 1000"))
    return rounded(models.kfold_cv(lines, "y", ["l_extendedprice"], KEY, [0.0, 0.1, 50.0], fold=F.expr("l_orderkey % 5")))


@check("holdout_split", "SELECT CASE WHEN (l_orderkey * 7 + l_linenumber) % 100 < 80 THEN 'train' ELSE 'test' END AS part, count(*) AS n FROM lineitem GROUP BY part")
def holdout_split(spark, sf_dir):
    """Parts by arithmetic on the key, which any engine can repeat."""
    by = F.expr("double((l_orderkey * 7 + l_linenumber) % 100) / 100")
    return sampling.holdout_split(table(spark, sf_dir, "lineitem"), KEY, by=by).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@check("calibration_sample", "SELECT CAST(floor(count(*) * 0.1) AS BIGINT) AS rows FROM lineitem")
def calibration_sample(spark, sf_dir):
    """The exact size; which rows is up to the hash."""
    return sampling.calibration_sample(table(spark, sf_dir, "lineitem"), KEY).agg(F.count(F.lit(1)).alias("rows"))


@check("calibration_sample_stratified", "SELECT l_returnflag, CAST(ceil(count(*) * 0.1) AS BIGINT) AS rows FROM lineitem GROUP BY l_returnflag")
def calibration_sample_stratified(spark, sf_dir):
    sample = sampling.calibration_sample(table(spark, sf_dir, "lineitem"), KEY, strata="l_returnflag")
    return sample.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows"))


@check(
    "detect_anomalies_robust_z",
    "SELECT l_orderkey, l_partkey, l_linenumber, round(volume, 4) AS volume, round((volume - m) * 0.6745 / d, 6) AS volume_z FROM "
    f"({LINES}) l, (SELECT quantile_cont(volume, 0.5) AS m, mad(volume) AS d FROM ({LINES}) k) p WHERE abs((volume - m) * 0.6745 / d) > 2.5",
)
def detect_anomalies_robust_z(spark, sf_dir):
    found = models.robust_z_anomalies(line_measures(spark, sf_dir), ["volume"], 2.5)
    out = found.select("l_orderkey", "l_partkey", "l_linenumber", F.round("volume", 4).alias("volume"), F.round("volume_z", 6).alias("volume_z"))
    return out


@check(
    "detect_anomalies_mahalanobis",
    "SELECT l_orderkey, l_partkey, l_linenumber, round((c * x * x - 2 * b * x * y + a * y * y) / (a * c - b * b), 5) AS distance FROM "
    "(SELECT *, l_quantity - avg(l_quantity) OVER () AS x, l_discount * 100 - avg(l_discount * 100) OVER () AS y FROM lineitem) l, "
    "(SELECT var_samp(l_quantity) AS a, covar_samp(l_quantity, l_discount * 100) AS b, var_samp(l_discount * 100) AS c FROM lineitem) m",
)
def detect_anomalies_mahalanobis(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("percent", F.col("l_discount") * 100)
    return rounded(models.mahalanobis(lines, ["l_quantity", "percent"]).select("l_orderkey", "l_partkey", "l_linenumber", "distance"), 5)


@check("detect_anomalies_centre_distance")
def detect_anomalies_centre_distance(spark, sf_dir):
    found = models.centre_distance(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"])
    return found.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("farthest"))


@check("compare_forecasters")
def compare_forecasters(spark, sf_dir):
    return models.compare_forecasters(events(spark, sf_dir), "value", ORDER)


@check(
    "regression_metrics",
    "SELECT l_returnflag, round(avg(pow(e, 2)), 6) AS mse, round(sqrt(avg(pow(e, 2))), 6) AS rmse, round(avg(abs(e)), 6) AS mae FROM "
    "(SELECT l_returnflag, l_discount - l_tax AS e FROM lineitem) x GROUP BY l_returnflag",
)
def regression_metrics(spark, sf_dir):
    return rounded(models.regression_metrics(table(spark, sf_dir, "lineitem"), "l_discount", "l_tax", ["l_returnflag"]))


@check(
    "classification_metrics",
    "WITH p AS (SELECT CAST(quality AS DOUBLE) AS label, CAST(toxic AS DOUBLE) AS prediction FROM labels), "
    "c AS (SELECT label, count(*) AS support, count(*) FILTER (WHERE label = prediction) AS hits FROM p GROUP BY label), "
    "n AS (SELECT prediction, count(*) AS named FROM p GROUP BY prediction) "
    "SELECT round(CAST(sum(hits) AS DOUBLE) / sum(support), 6) AS accuracy, round(sum(2.0::DOUBLE * hits / (support + coalesce(named, 0)) * support) / sum(support), 6) AS f1 "
    "FROM c LEFT JOIN n ON c.label = n.prediction",
)
def classification_metrics(spark, sf_dir):
    pairs = table(spark, sf_dir, "labels").selectExpr("double(quality) AS label", "double(toxic) AS prediction")
    return rounded(models.classification_metrics(pairs))


@check("lookback_regressors")
def lookback_regressors(spark, sf_dir):
    table_ = events(spark, sf_dir).withColumn("hour", F.hour("ts").cast("double"))
    return models.lookback_regressors(table_, "value", ORDER, lookback=30, exogenous=["hour"])


@check(
    "score_and_compare",
    "SELECT event_id, model, round(value, 4) AS actual FROM (SELECT event_id, value, row_number() OVER (ORDER BY ts, event_id) - 31 AS p, count(*) OVER () - 30 AS n FROM events) x, "
    "(SELECT unnest(['lookback_linear', 'lookback_forest', 'lookback_gbt']) AS model) m WHERE p >= floor(n * 0.8)",
)
def score_and_compare(spark, sf_dir):
    """Which rows are scored by which model, and the actual values mapped back to their scale."""
    compared = models.score_and_compare(events(spark, sf_dir), "value", ORDER, lookback=30)
    return rounded(compared.select("event_id", "model", "actual"), 4)


@check("prepare_ml", f"SELECT event_id, CASE WHEN isinf(value) OR isnan(value) THEN NULL ELSE value END AS value, event_type FROM ({NONFINITE}) e WHERE NOT isnan(value) OR value IS NULL")
def prepare_ml(spark, sf_dir):
    prepared, _ = models.prepare_ml(nonfinite(spark, sf_dir), "value")
    return prepared.filter(~F.coalesce(F.isnan("value"), F.lit(False)))


@check(
    "per_target_runs",
    f"SELECT 'volume' AS target, 'ok' AS status, round(avg(volume), 4) AS mean FROM ({LINES}) l UNION ALL "
    f"SELECT 'revenue', 'ok', round(avg(revenue), 4) FROM ({LINES}) l UNION ALL SELECT 'absent', 'failed', NULL UNION ALL SELECT 'broken', 'failed', NULL",
)
def per_target_runs(spark, sf_dir):
    """One target does not exist and one fails in its job: both are reported and the others still run."""
    lines = line_measures(spark, sf_dir).withColumn("broken", F.when(F.col("l_quantity") > 0, F.raise_error(F.lit("no value"))).cast("double"))

    def body(target):
        return models.prepare_ml(lines, target)[0].agg(F.round(F.avg(target), 4).alias("mean")).withColumn("target", F.lit(target))

    results, status = models.per_target_runs(spark, ["volume", "absent", "broken", "revenue"], body)
    means = results["volume"].unionByName(results["revenue"])
    return status.select("target", "status").join(means, "target", "left")
