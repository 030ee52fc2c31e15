"""From a stored table and its quality report to imputed, encoded, selected and catalogued features."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..config import FeatureConfig
from ..operators import impute, prepared, profile, schema, selection
from ..sources import files, registry, sinks
from ..sources.scratch import materialize


@dataclass(frozen=True)
class FeatureResult:
    table: DataFrame
    selected: list[str]
    scores: DataFrame
    metadata: DataFrame
    names: dict[str, str]
    #: Everything fitted, from raw columns to the table above; to be stored and applied to new rows.
    preparation: PipelineModel


def _report(spark: SparkSession, cfg: FeatureConfig, table: DataFrame, names: dict[str, str]) -> DataFrame:
    """The stored report under clean names, or a fresh one."""
    if cfg.report_path:
        stored = sinks.read_report(spark, cfg.report_path)
        if stored.take(1):
            return schema.rename_in_table(stored, names)
    return materialize(profile.profile_columns(table), "report")


def prepare_features(spark: SparkSession, df: DataFrame, cfg: FeatureConfig) -> FeatureResult:
    """The feature stage on a DataFrame, without sinks."""
    (clean,), table = prepared.run_stages(df, [prepared.CleanNames()])
    names = clean["names"]
    targets, primary = schema.resolve_targets(table.columns, cfg.targets, cfg.primary_target)
    report = _report(spark, cfg, table, names)
    order, key = [[schema.clean_name(c) for c in given] for given in (cfg.order_by, cfg.series_key)]
    axis = {*order, *key}
    roles = schema.classify_columns(
        table,
        report,
        targets,
        [schema.clean_name(c) for c in cfg.categorical_columns],
        [schema.clean_name(c) for c in cfg.numerical_columns],
        cfg.categorical_threshold,
    )
    lists = schema.collect_roles(roles, table.columns)
    numerical = [c for c in lists.numerical if c not in axis]
    stages = [
        prepared.EncodeLabels(columns=[c for c in lists.categorical if c not in axis], rows_per_indicator=cfg.rows_per_indicator),
        prepared.FillMissing(
            columns=impute.columns_with_missing(report, numerical), method=cfg.imputation, order_by=order, series_key=key, chunk_rows=cfg.chunk_rows
        ),
        prepared.ScaleColumns(columns=numerical, method=cfg.scaling),
    ]
    fitted, table = prepared.run_stages(table, stages)
    indicators = fitted[0].names
    # everything below reads this table several times
    table = materialize(table, "prepared")
    features = numerical + indicators
    scores = materialize(
        selection.multi_target_selection(
            table, targets, features, cfg.selection_ratio, cfg.selection_methods, cfg.correlation_method, cfg.lasso_alpha
        ),
        "scores",
    )
    kept = scores.filter("kept").select("feature").distinct().collect()
    chosen = schema.fallback_features([f for f in features if f in {r["feature"] for r in kept}], numerical)
    if cfg.use_pca:
        (components,), table = prepared.run_stages(table, [prepared.Components(columns=chosen, components=cfg.pca_components)])
        fitted.append(components)
        chosen = chosen + components.names
    metadata = schema.rename_in_table(selection.feature_metadata(roles, scores, cfg.scaling), names, restore=True)
    scaled = [f"{c}_scaled" for c in chosen if f"{c}_scaled" in table.columns]
    keep = [c for c in table.columns if c in axis]
    last = prepared.KeepColumnsModel({"columns": [*keep, *chosen, *scaled], "optional": targets})
    preparation = PipelineModel([clean, *fitted, last])
    return FeatureResult(last.transform(table), chosen, scores, metadata, names, preparation)


def project(result: FeatureResult, target: str) -> DataFrame:
    """The table of one target: the features kept for it and the target."""
    rows = result.scores.filter("kept").filter(result.scores["target"] == target).select("feature").distinct().collect()
    return schema.project_features(result.table, sorted(r["feature"] for r in rows), [target])


def run_features(spark: SparkSession, cfg: FeatureConfig) -> FeatureResult:
    result = prepare_features(spark, files.load_table(spark, cfg.input_path), cfg)
    if cfg.output_path:
        per_target: dict[str, list[str]] = {}
        for row in result.scores.filter("kept").select("target", "feature").distinct().collect():
            per_target.setdefault(row["target"], []).append(row["feature"])
        targets, _ = schema.resolve_targets(result.table.columns, cfg.targets)
        per_target = {t: sorted(per_target.get(t, [])) for t in targets}
        axis = [schema.clean_name(c) for c in (*cfg.series_key, *cfg.order_by)]
        artifacts = sinks.write_selected_features(result.table, f"{cfg.output_path}/data", per_target, targets, axis)
        sinks.write_report(result.metadata, f"{cfg.output_path}/metadata")
        sinks.save_model(result.preparation, f"{cfg.output_path}/preparation")
        artifacts.append(("preparation", f"{cfg.output_path}/preparation", result.table.schema.json()))
        artifacts.append(("metadata", f"{cfg.output_path}/metadata", result.metadata.schema.json()))
        catalog = cfg.catalog_path or f"{cfg.output_path}/catalog"
        registry.record_artifacts(spark, catalog, uuid.uuid4().hex, datetime.now(), artifacts)
    return result


def apply_preparation(spark: SparkSession, catalog_path: str, df: DataFrame) -> DataFrame:
    """New rows prepared as those of the latest run were: with its means, labels, bounds and selection. Targets may be absent."""
    catalog = registry.read(spark, catalog_path, registry.ARTIFACTS)
    return sinks.load_model(registry.latest_artifact_path(catalog, "preparation")).transform(df)


def analyze_features(spark: SparkSession, path: str, target: str) -> tuple[DataFrame, DataFrame]:
    """``(summary, scores of the first numerical columns against the target)`` of a stored table."""
    table, _ = schema.sanitize_names(files.load_table(spark, path))
    targets, primary = schema.resolve_targets(table.columns, [target])
    report = materialize(profile.profile_columns(table), "report")
    roles = schema.classify_columns(table, report, targets)
    numerical = schema.collect_roles(roles, table.columns).numerical
    return profile.dataset_summary(table, roles, 1), selection.correlation_preview(table, primary, numerical)
