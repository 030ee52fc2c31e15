"""Queries over the end-to-end entry points."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import EtlConfig, FeatureConfig, ModelConfig, ModelSetup, SeriesConfig
from ..plans import etl, features, modelling
from ..sources import registry, sinks
from ..sources.files import load_table
from ..sources.scratch import scratch_path
from .base import LINES, MEASURES, check, line_measures, profile_sql, rounded, table
from .models import KEY
from .selection import TARGETS, _scores
from .sources import _paths

CSV_COLUMNS = [("event_id", "int"), ("user_id", "int"), ("event_type", "string"), ("value", "double"), ("site", "string")]
CSV_ROWS = (
    "SELECT CAST(event_id AS INTEGER) AS event_id, CAST(user_id AS INTEGER) AS user_id, event_type, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS value, 'north' AS site, "
    "CASE WHEN event_id % 50 = 0 THEN 1 END AS rare FROM events"
)


def day_csv(spark, sf_dir):
    """Day files with a constant column, a nearly empty one and gaps."""
    path = scratch_path(spark, "days")
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "event_type", "CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS value", "'north' AS site",
        "CASE WHEN event_id % 50 = 0 THEN 1 END AS rare", "string(date(ts)) AS day",
    )
    rows.repartition("day").write.option("header", "true").partitionBy("day").csv(path)
    return _paths(spark, path)


@check("run_etl", f"SELECT event_id, user_id, event_type, value FROM ({CSV_ROWS}) r")
def run_etl(spark, sf_dir):
    """Constant and nearly empty columns are gone from the written table."""
    out = scratch_path(spark, "etl")
    cfg = EtlConfig(input_files=tuple(day_csv(spark, sf_dir)), output_path=f"{out}/table", report_path=f"{out}/report")
    etl.run_etl(spark, cfg)
    return load_table(spark, f"{out}/table", "parquet")


@check(
    "etl_run_summary",
    "SELECT CAST(count(DISTINCT CAST(ts AS DATE)) AS INTEGER) AS files, 0 AS rejected_files, count(*) AS total_rows, 6 AS initial_columns, 4 AS kept_columns, 2 AS dropped_columns, 'none' AS format FROM events",
)
def etl_run_summary(spark, sf_dir):
    return etl.run_etl(spark, EtlConfig(input_files=tuple(day_csv(spark, sf_dir)))).summary.drop("location")


@check("run_etl_folder", "SELECT CAST(count(DISTINCT CAST(ts AS DATE)) AS INTEGER) AS files, 1 AS rejected_files, count(*) AS total_rows FROM events")
def run_etl_folder(spark, sf_dir):
    """A folder given as a whole, with an empty file in it: files are counted, not paths."""
    folder = day_csv(spark, sf_dir)[0].split("/day=")[0]
    spark.range(0).select(F.lit("").alias("x")).coalesce(1).write.mode("append").text(f"{folder}/day=2000-01-01")
    return etl.run_etl(spark, EtlConfig(input_files=(folder,))).summary.select("files", "rejected_files", "total_rows")


@check(
    "run_features_many_labels",
    "SELECT event_id, CAST(event_id % 4 = 0 AS DOUBLE) AS site_main, round(CAST(n AS DOUBLE) / (SELECT count(*) FROM events), 9) AS site_frequency FROM "
    "(SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'main' ELSE concat('s', event_id % 150) END AS site FROM events) e JOIN "
    "(SELECT CASE WHEN event_id % 4 = 0 THEN 'main' ELSE concat('s', event_id % 150) END AS site, count(*) AS n FROM events GROUP BY 1) c USING (site)",
)
def run_features_many_labels(spark, sf_dir):
    """A category with one frequent label, which gets a column, and many rare ones, which are known by their frequency."""
    rows = table(spark, sf_dir, "events").selectExpr("event_id", "CASE WHEN event_id % 4 = 0 THEN 'main' ELSE concat('s', event_id % 150) END AS site", "value + event_id % 150 AS y")
    cfg = FeatureConfig(
        targets=("y",), order_by=("event_id",), categorical_columns=("site",), selection_methods=("correlation",), selection_ratio={"correlation": 1.0}
    )
    return rounded(features.prepare_features(spark, rows, cfg).table.select("event_id", "site_main", "site_frequency"), 9)


NEW_LINES = f"""
WITH lines AS (SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS q, l_tax AS t, l_returnflag AS f, CASE WHEN l_partkey % 3 = 0 THEN 'big' ELSE concat('p', l_partkey % 211) END AS p, volume AS v FROM ({LINES}) l),
old AS (SELECT * FROM lines WHERE l_orderkey % 2 = 0),
m AS (SELECT avg(q) AS mq FROM old),
filled AS (SELECT coalesce(q, mq) AS q, t FROM old, m),
s AS (SELECT avg(q) AS aq, stddev_samp(q) AS dq, avg(t) AS mt, stddev_samp(t) AS dt FROM filled),
shares AS (SELECT p, count(*) / (SELECT count(*) FROM old) AS share FROM old GROUP BY p)
SELECT l_orderkey, l_partkey, l_linenumber, round(coalesce(q, mq), 6) AS q, t, CAST(f = 'A' AS DOUBLE) AS f_A, CAST(f = 'N' AS DOUBLE) AS f_N, CAST(f = 'R' AS DOUBLE) AS f_R,
  CAST(p = 'big' AS DOUBLE) AS p_big, round(coalesce(share, 0), 9) AS p_frequency, round((coalesce(q, mq) - aq) / dq, 6) AS q_scaled, round((t - mt) / dt, 6) AS t_scaled
FROM lines LEFT JOIN shares USING (p), m, s WHERE l_orderkey % 2 = 1
"""


@check("features_applied_to_new_rows", NEW_LINES)
def features_applied_to_new_rows(spark, sf_dir):
    """A preparation fitted on the even orders, stored, found by the catalogue, loaded and applied to the odd ones, which have no target."""
    lines = line_measures(spark, sf_dir).selectExpr(
        "l_orderkey", "l_partkey", "l_linenumber", "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS q", "l_tax AS t", "l_returnflag AS f",
        "CASE WHEN l_partkey % 3 = 0 THEN 'big' ELSE concat('p', l_partkey % 211) END AS p", "volume AS v",
    )
    stored, out = scratch_path(spark, "lines"), scratch_path(spark, "features")
    lines.filter("l_orderkey % 2 = 0").write.parquet(stored)
    cfg = FeatureConfig(
        input_path=stored, output_path=out, targets=("v",), order_by=("l_orderkey", "l_partkey", "l_linenumber"), imputation="mean",
        selection_methods=("correlation",), selection_ratio={"correlation": 1.0},
    )
    features.run_features(spark, cfg)
    ready = features.apply_preparation(spark, f"{out}/catalog", lines.filter("l_orderkey % 2 = 1").drop("v"))
    return ready.select(*[F.round(c, 9 if c == "p_frequency" else 6).alias(c) if t == "double" and c != "t" else F.col(c) for c, t in ready.dtypes])


@check("analyze", profile_sql(CSV_ROWS, CSV_COLUMNS))
def analyze(spark, sf_dir):
    report = etl.analyze(spark, day_csv(spark, sf_dir))[1]
    return rounded(report.filter("column_name <> 'rare'"))


@check(
    "analyze_summary",
    "SELECT CAST(count(DISTINCT CAST(ts AS DATE)) AS INTEGER) AS files, count(*) AS total_rows, 6 AS total_columns, 3 AS categorical_columns, 3 AS numerical_columns, 0 AS temporal_columns FROM events",
)
def analyze_summary(spark, sf_dir):
    summary = etl.analyze(spark, day_csv(spark, sf_dir))[0]
    return summary.select(*[F.col(c).cast("int").alias(c) if c.endswith("columns") else F.col(c) for c in summary.columns])


def _stored_lines(spark, sf_dir):
    path = scratch_path(spark, "lines")
    line_measures(spark, sf_dir).drop("l_shipdate").write.parquet(path)
    return path


FEATURE_SETTINGS = dict(
    targets=("volume", "revenue"), primary_target="volume", imputation="mean", selection_ratio={"correlation": 1.0, "lasso": 0.5},
)


@check("run_features")
def run_features(spark, sf_dir):
    cfg = FeatureConfig(input_path=_stored_lines(spark, sf_dir), output_path=scratch_path(spark, "features"), **FEATURE_SETTINGS)
    features.run_features(spark, cfg)
    return features.files.load_table(spark, f"{cfg.output_path}/data/all", "parquet")


@check("feature_scores", _scores(LINES, TARGETS, ["l_orderkey", "l_partkey", "l_suppkey", *MEASURES]))
def feature_scores(spark, sf_dir):
    cfg = FeatureConfig(input_path=_stored_lines(spark, sf_dir), **FEATURE_SETTINGS)
    scores = features.prepare_features(spark, load_table(spark, cfg.input_path, "parquet"), cfg).scores
    wanted = ["l_orderkey", "l_partkey", "l_suppkey", *MEASURES]
    return rounded(scores.filter("method = 'correlation'").filter(F.col("feature").isin(wanted)).drop("kept"))


@check("analyze_features", _scores(LINES, ["volume"], ["l_orderkey", "l_partkey", "l_suppkey", *MEASURES, "revenue"]))
def analyze_features(spark, sf_dir):
    return rounded(features.analyze_features(spark, _stored_lines(spark, sf_dir), "volume")[1])


@check("run_models_regression")
def run_models_regression(spark, sf_dir):
    cfg = ModelConfig(
        use_case="regression", targets=("volume",), features=tuple(MEASURES), key=tuple(KEY), output_path=scratch_path(spark, "models"),
        excluded_models=("gbt", "random_forest"),
    )
    return modelling.run_models(spark, line_measures(spark, sf_dir), cfg).metrics.drop("run_id")


@check("run_models_saved_model", "SELECT l_orderkey, l_partkey, l_linenumber, round(3 * l_quantity - 200 * l_tax + 1, 3) AS y FROM lineitem")
def run_models_saved_model(spark, sf_dir):
    """The best model of an exactly linear target, stored, found by the catalogue, loaded and applied."""
    lines = line_measures(spark, sf_dir).withColumn("y", F.expr("3 * l_quantity - 200 * l_tax + 1"))
    cfg = ModelConfig(
        use_case="regression", targets=("y",), features=("l_quantity", "l_tax"), key=tuple(KEY), output_path=scratch_path(spark, "models"),
        excluded_models=("gbt", "random_forest", "decision_tree"),
    )
    modelling.run_models(spark, lines, cfg)
    newest = registry.latest_models(registry.read(spark, f"{cfg.output_path}/models", registry.MODELS)).first()
    scored = sinks.load_model(newest["path"]).transform(lines.drop("y"))
    return scored.select("l_orderkey", "l_partkey", "l_linenumber", F.round("prediction", 3).alias("y"))


@check("run_models_with_setup", "SELECT l_orderkey, l_partkey, l_linenumber, round(0.2 * l_quantity * l_quantity - 300 * l_quantity * l_tax + 40 * l_tax + 1, 3) AS y FROM lineitem")
def run_models_with_setup(spark, sf_dir):
    """A target of products of features: the set-up drops a constant and a repeated feature, adds products and standardises; the stored model repeats it all on raw rows."""
    lines = table(spark, sf_dir, "lineitem").selectExpr("*", "7.0D AS seven", "2 * l_quantity + 1 AS twice", "0.2 * l_quantity * l_quantity - 300 * l_quantity * l_tax + 40 * l_tax + 1 AS y")
    cfg = ModelConfig(
        use_case="regression", targets=("y",), features=("l_quantity", "l_tax", "seven", "twice"), key=tuple(KEY), output_path=scratch_path(spark, "models"),
        excluded_models=("gbt", "random_forest", "decision_tree"),
        setup=ModelSetup(normalize=True, ignore_low_variance=True, remove_multicollinearity=True, polynomial_features=True),
    )
    modelling.run_models(spark, lines, cfg)
    newest = registry.latest_models(registry.read(spark, f"{cfg.output_path}/models", registry.MODELS)).first()
    scored = sinks.load_model(newest["path"]).transform(lines.drop("y"))
    return scored.select("l_orderkey", "l_partkey", "l_linenumber", F.round("prediction", 3).alias("y"))


@check("run_models_without_target", "SELECT 'all' AS target, count(*) AS n FROM lineitem")
def run_models_without_target(spark, sf_dir):
    """Clusters of lines; the stored model assigns every line."""
    cfg = ModelConfig(use_case="clustering", features=("l_quantity", "l_tax"), output_path=scratch_path(spark, "models"))
    lines = table(spark, sf_dir, "lineitem")
    modelling.run_models(spark, lines, cfg)
    newest = registry.latest_models(registry.read(spark, f"{cfg.output_path}/models", registry.MODELS)).first()
    scored = sinks.load_model(newest["path"]).transform(lines)
    return scored.groupBy(F.lit(newest["target"]).alias("target")).agg(F.count("prediction").alias("n"))


@check("run_models_time_series")
def run_models_time_series(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    cfg = ModelConfig(targets=("value",), key=("event_id",), order_by=("event_id",), series=SeriesConfig(time_column="ts", lookback=10))
    return modelling.run_models(spark, events, cfg).metrics.drop("run_id")
