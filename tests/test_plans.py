"""The three stages one after another on files."""

from datetime import datetime

from pyspark.sql import functions as F

from fieldglass.config import EtlConfig, FeatureConfig, ModelConfig, SeriesConfig
from fieldglass.operators import models
from fieldglass.plans import etl, features, modelling
from fieldglass.sources import registry
from fieldglass.sources.scratch import scratch_path


def test_three_stages(spark, events):
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "stages")
    wide = events.select(
        "event_id",
        F.col("event_type").alias("event type"),
        F.when(F.col("event_id") % 9 > 0, F.col("value")).alias("value.raw"),
        (F.col("value") * 2 + F.col("user_id")).alias("load"),
        F.lit("k").alias("constant"),
        F.col("ts").cast("string").substr(1, 10).alias("day"),
    )
    wide.repartition("day").write.partitionBy("day").option("header", "true").csv(raw)

    cfg = EtlConfig(input_files=(raw,), output_path=f"{out}/table", report_path=f"{out}/report")
    done = etl.run_etl(spark, cfg)
    assert "constant" not in done.table.columns
    assert done.summary.first()["total_rows"] == events.count()

    chosen = FeatureConfig(
        input_path=f"{out}/table", report_path=f"{out}/report", output_path=f"{out}/features", targets=("load",),
        order_by=("event_id",), selection_ratio={"correlation": 1.0, "lasso": 0.0},
    )
    result = features.run_features(spark, chosen)
    assert result.selected[0] == "value_raw" or "value_raw" in result.selected
    assert result.names["value.raw"] == "value_raw"
    assert result.metadata.filter("column_name = 'value.raw'").count() >= 1
    assert result.table.filter(F.col("value_raw").isNull()).count() == 0

    catalog = registry.read(spark, f"{out}/features/catalog", registry.ARTIFACTS)
    assert {r["artifact"] for r in registry.latest_artifacts(catalog, datetime(2100, 1, 1)).collect()} == {
        "selected_features", "features_load", "metadata", "preparation",
    }
    new = events.selectExpr("event_id", "event_type AS `event type`", "CAST(NULL AS DOUBLE) AS `value.raw`", "CAST(ts AS STRING) AS day").limit(7)
    again = features.apply_preparation(spark, f"{out}/features/catalog", new)
    assert again.columns == [c for c in result.table.columns if c != "load"] and again.count() == 7
    assert again.filter(F.col("value_raw").isNull()).count() == 0
    table = modelling.latest_features(spark, f"{out}/features/catalog")
    assert "load" in table.columns

    models = ModelConfig(
        targets=("load",), key=("event_id",), order_by=("event_id",), output_path=f"{out}/models",
        series=SeriesConfig(lookback=5, max_lag=2, rolling_windows=(3,), seasonal_periods=(7,)),
    )
    compared = modelling.run_models(spark, table, models)
    assert [r["status"] for r in compared.status.collect()] == ["ok"], compared.status.collect()
    assert compared.metrics.filter("metric = 'rmse'").count() >= 3
    saved = registry.read(spark, f"{out}/models/models", registry.MODELS)
    assert registry.latest_models(saved).first()["target"] == "load"


def test_classifiers_work_out_their_features_once(spark, tmp_path):
    """Labels, bounds and parts come from written rows, not from the table again."""
    seen = spark.sparkContext.accumulator(0)

    def slow(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(300).selectExpr("id", "double(id % 17) AS x", "double(id % 5) AS z", "id % 2 AS y", "repeat('a', 100) AS text")
    table = rows.mapInArrow(slow, rows.schema)
    found = models.compare_classifiers(table, "y", ["x", "z"], ["id"], exclude=["gbt", "linear_svc", "random_forest", "logistic", "naive_bayes"]).collect()
    assert [r.model for r in found] == ["decision_tree"] and seen.value == 300
