"""From catalogued features to compared models, per target."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ModelConfig
from ..functions.missing import row_per
from ..operators import models, prepared, sampling, schema, selection, series
from ..operators.profile import numeric_columns
from ..operators.quality import inf_to_null
from ..sources import files, registry, sinks
from ..sources.scratch import materialize

#: Stands for the target of runs that have none.
NO_TARGET = "all"
METRICS = ("mse", "rmse", "mae", "accuracy", "f1", "silhouette", "mase")


@dataclass(frozen=True)
class ModelResult:
    leaderboards: dict[str, DataFrame]
    metrics: DataFrame
    status: DataFrame


def latest_features(spark: SparkSession, catalog_path: str, artifact: str = "selected_features") -> DataFrame:
    catalog = registry.read(spark, catalog_path, registry.ARTIFACTS)
    return files.load_table(spark, registry.latest_artifact_path(catalog, artifact), "parquet")


def _long_metrics(board: DataFrame, run_id: str, target: str) -> DataFrame:
    present = [m for m in METRICS if m in board.columns]
    entries = [
        {"model": F.col("model"), "metric": F.lit(m), "value": F.col(m).cast("double")} for m in present
    ]
    return board.select(row_per(entries)).select(F.lit(run_id).alias("run_id"), F.lit(target).alias("target"), "r.*")


def _inputs(df: DataFrame, target: str, cfg: ModelConfig) -> tuple[list, DataFrame, list[str]]:
    """The set-up's stages, the table without infinities and with the inputs they make, and the inputs: of the features named, else of all other numbers."""
    clean = inf_to_null(df) if target == NO_TARGET else models.prepare_ml(df, target)[0]
    skip = {target, *cfg.targets, *cfg.key}
    features = list(cfg.features) or [c for c in numeric_columns(clean) if c not in skip]
    label = target if cfg.use_case == "regression" else None
    return prepared.model_inputs(clean, features, label, cfg.setup)


def _save_best(df: DataFrame, target: str, best: str, cfg: ModelConfig, path: str) -> str | None:
    """Fit the best model on all rows and store it with the set-up of its inputs. Look-back models are compared only."""
    if cfg.use_case == "time_series":
        return None
    stages, table, features = _inputs(df, target, cfg)
    if cfg.use_case == "classification":
        rows = _balanced(table, target, cfg)
        model, labels = models.fit_classifier(rows, target, features, best, cfg.seed)
        sinks.write_report(labels, f"{path}-labels", "parquet")
    elif cfg.use_case == "clustering":
        model = models.fit_clusterer(table, features, best, seed=cfg.seed)
    else:
        model = models.fit_regressor(table, target, features, best, cfg.seed)
    return sinks.save_model(PipelineModel([*stages, *model.stages]), path)


def _balanced(df: DataFrame, target: str, cfg: ModelConfig) -> DataFrame:
    return selection.oversample(df, target, cfg.key, cfg.seed).drop("copy") if cfg.setup.fix_imbalance else df


def _compare(df: DataFrame, target: str, cfg: ModelConfig) -> DataFrame:
    """The leaderboard of one target for the configured use case."""
    if cfg.use_case == "time_series":
        s = cfg.series
        if not cfg.order_by:
            raise ValueError("time series need order_by: rows of a DataFrame have no order of their own")
        prepared = series.full_ts_prepare(df, [target], cfg.order_by, cfg.series_key, s.time_column, s.chunk_rows)
        prepared = materialize(prepared, "prepared")
        table = series.ts_feature_table(
            prepared, target, ["ts", *cfg.order_by] if s.time_column else ["ts"], cfg.series_key,
            max_lag=s.max_lag, windows=s.rolling_windows, periods=s.seasonal_periods, chunk_rows=s.chunk_rows,
        )
        table = materialize(table, "series")
        order = [c for c in dict.fromkeys(["ts", *cfg.order_by]) if c in table.columns]
        candidates = [c for c in numeric_columns(table) if c not in {target, *cfg.order_by, *cfg.series_key}]
        exogenous = [r["feature"] for r in selection.top_exogenous(table, target, candidates).collect()]
        return models.lookback_regressors(
            table, target, order, cfg.series_key, lookback=s.lookback, exogenous=exogenous,
            test_size=cfg.test_size, seed=cfg.seed, chunk_rows=s.chunk_rows,
        )
    if cfg.use_case not in ("regression", "classification", "clustering", "anomaly"):
        raise ValueError(f"unknown use case {cfg.use_case!r}")
    _, clean, features = _inputs(df, target, cfg)
    if cfg.use_case == "regression":
        return models.compare_regressors(clean, target, features, cfg.key, cfg.excluded_models, cfg.seed)
    if cfg.use_case == "classification":
        balance = (lambda rows: _balanced(rows, target, cfg)) if cfg.setup.fix_imbalance else None
        return models.compare_classifiers(clean, target, features, cfg.key, cfg.excluded_models, cfg.seed, balance)
    if cfg.use_case == "clustering":
        return models.compare_clusterers(clean, features, seed=cfg.seed)
    scored = models.centre_distance(clean, features, seed=cfg.seed)
    return scored.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("farthest"))


def run_models(spark: SparkSession, df: DataFrame, cfg: ModelConfig) -> ModelResult:
    """Compare models for every target; one failing target is reported and the others go on.

    With an output path the best model of each target is fitted on all rows, stored, and catalogued with its path; anomaly tables
    are stored as well. Clustering and anomaly detection need no target.
    """
    if cfg.use_case in ("clustering", "anomaly") and not cfg.targets:
        targets = [NO_TARGET]
    else:
        targets, _ = schema.resolve_targets(df.columns, cfg.targets, cfg.primary_target)
    run_id = uuid.uuid4().hex

    def body(target: str) -> DataFrame:
        if cfg.output_path and cfg.key and target != NO_TARGET:
            strata = target if cfg.use_case == "classification" else None
            sample = sampling.calibration_sample(df, cfg.key, cfg.sample_share, cfg.seed, strata)
            sinks.write_sample(sample, f"{cfg.output_path}/calibration/{run_id}/{target}")
        return materialize(_compare(df, target, cfg), "leaderboard")

    boards, status = models.per_target_runs(spark, targets, body)
    metrics = spark.createDataFrame([], registry.METRICS)
    for target, board in boards.items():
        if "model" in board.columns:
            metrics = metrics.unionByName(_long_metrics(board, run_id, target))
    if cfg.output_path:
        registry.record_metrics(metrics, f"{cfg.output_path}/metrics")
        best = {t: b.orderBy("rank").first()["model"] for t, b in boards.items() if "model" in b.columns}
        stored = {t: _save_best(df, t, name, cfg, f"{cfg.output_path}/fitted/{run_id}/{t}") for t, name in best.items()}
        if best:
            entries = [(run_id, datetime.now(), t, name, stored[t]) for t, name in best.items()]
            registry.record_models(spark, f"{cfg.output_path}/models", entries)
        for target, board in boards.items():
            if "model" not in board.columns:
                sinks.write_report(board, f"{cfg.output_path}/anomalies/{run_id}/{target}", "parquet")
    return ModelResult(boards, metrics, status)
