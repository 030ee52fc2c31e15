"""Stages that are fitted, stored and applied to rows they have not seen."""

import math

import pytest
from pyspark.ml import Pipeline, PipelineModel

from fieldglass.operators import encode, prepared
from fieldglass.sources.scratch import scratch_path


def stored(model, spark):
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    return type(model).load(path)


def test_labels_new_rare_and_missing(spark, monkeypatch):
    rows = [(i, "big" if i % 2 else f"s{i % 40}", i % 3) for i in range(200)] + [(900, None, None)]
    df = spark.createDataFrame(rows, "id int, c string, k int")
    stage = prepared.EncodeLabels(columns=["c", "k"], rows_per_indicator=10)
    model = stage.fit(df)
    assert model.names == ["c_big", "c_frequency", "k_0", "k_1", "k_2"]
    new = spark.createDataFrame([(1, "big", 2), (2, "s4", 7), (3, "never", None), (4, None, 0)], "id int, c string, k int")
    want = [(1, 1.0, 0.5, 0.0, 0.0, 1.0), (2, 0.0, 5 / 200, 0.0, 0.0, 0.0), (3, 0.0, 0.0, 0.0, 0.0, 0.0), (4, 0.0, 0.0, 1.0, 0.0, 0.0)]
    for limit in (prepared.MAX_BROADCAST_LABELS, 3):  # by broadcast, and by a shuffle of the rows with rare labels
        monkeypatch.setattr(prepared, "MAX_BROADCAST_LABELS", limit)
        for one in (model, stored(model, spark)):
            assert sorted(map(tuple, one.transform(new).drop("c", "k").collect())) == want
    many = df.selectExpr("id", "concat('l', id) AS c", "k")
    assert prepared.EncodeLabels(columns=["c"], rows_per_indicator=100).fit(many).names == ["c_frequency"]
    assert prepared.EncodeLabels(columns=["c"], rows_per_indicator=100).fit(df.limit(0)).names == []


@pytest.mark.parametrize("method, start", [("ffill", 2.5), ("mean", 2.0), ("zero", 0.0), ("ffill_as_mean", 2.0)])
def test_gaps_of_new_rows_get_fitted_values(spark, method, start):
    df = spark.createDataFrame([(1, None), (2, 1.0), (3, None), (4, 3.0), (5, None), (6, 2.0), (7, None)], "t int, x double")
    stage = prepared.FillMissing(columns=["x"], method=method, order_by=["t"], series_key=[], chunk_rows=None)
    model, table = stage.fitted(df)
    if method == "ffill":
        start = sum((1, 1, 3, 3, 2, 2)) / 6
        assert [r["x"] for r in table.orderBy("t").collect()] == [start, 1, 1, 3, 3, 2, 2]
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, model.transform(df).collect()))
    new = spark.createDataFrame([(1, None), (2, 9.0), (3, math.nan)], "t int, x double")
    assert [r["x"] for r in stored(model, spark).transform(new).orderBy("t").collect()] == [start, 9.0, 9.0 if method == "ffill" else start]


@pytest.mark.parametrize("method", ["standard", "minmax", "none"])
def test_scales_keep_the_fitted_bounds(spark, method):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 1.0)], "x double, y double")
    stage = prepared.ScaleColumns(columns=["x", "y"], method=method)
    model, table = stage.fitted(df)
    assert sorted(map(str, table.collect())) == sorted(map(str, encode.scale(df, ["x", "y"], method).collect()))
    new = stored(model, spark).transform(spark.createDataFrame([(5.0, 5.0)], "x double, y double")).first()
    if method != "none":
        assert new["x_scaled"] == pytest.approx(3 / 2**0.5 if method == "standard" else 2.0) and new["y_scaled"] == (0.0 if method == "standard" else 0.5)


def test_a_whole_pipeline_is_loaded_as_it_was(spark):
    df = spark.createDataFrame([(float(i), float(i * i % 7), "ab"[i % 2], float(i)) for i in range(30)], "`a b` double, y double, c string, z double")
    stages = [
        prepared.CleanNames(),
        prepared.EncodeLabels(columns=["c"], rows_per_indicator=5),
        prepared.FillMissing(columns=["y"], method="mean", order_by=[], series_key=[], chunk_rows=None),
        prepared.ScaleColumns(columns=["a_b", "y"], method="standard"),
        prepared.Components(columns=["a_b", "y"], components=2),
    ]
    path = scratch_path(spark, "pipeline")
    model = Pipeline(stages=stages).fit(df)
    last = prepared.KeepColumnsModel({"columns": ["a_b_scaled", "c_a", "pca_0", "pca_1"], "optional": ["z"]})
    PipelineModel([*model.stages, last]).write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    assert loaded.transform(df).columns == ["a_b_scaled", "c_a", "pca_0", "pca_1", "z"]
    assert loaded.transform(df.drop("z")).columns == ["a_b_scaled", "c_a", "pca_0", "pca_1"]
    want = sorted(map(tuple, last.transform(model.transform(df)).collect()))
    assert sorted(map(tuple, loaded.transform(df).collect())) == want


def test_forward_fill_needs_an_order(spark):
    with pytest.raises(ValueError, match="order_by"):
        prepared.FillMissing(columns=["x"], method="ffill", order_by=[], series_key=[], chunk_rows=None).fit(spark.createDataFrame([(1.0,)], "x double"))
    with pytest.raises(ValueError, match="unknown"):
        prepared.FillMissing(columns=[], method="other", order_by=[], series_key=[], chunk_rows=None).fit(spark.range(1))


def test_inputs_of_models(spark):
    from pyspark.sql import functions as F

    from fieldglass.config import ModelSetup

    df = spark.range(60).select(
        F.col("id").cast("double").alias("a"), (F.col("id") * 2 + 1).cast("double").alias("twice"), F.lit(3.0).alias("seven"), ((F.col("id") * 7) % 11).cast("double").alias("b"),
        (F.col("id") * ((F.col("id") * 7) % 11)).cast("double").alias("y"),
    )
    names = ["a", "twice", "seven", "b"]
    models, table, chosen = prepared.model_inputs(df, names, "y", ModelSetup())
    assert (models, table, chosen) == ([], df, names)
    setup = ModelSetup(ignore_low_variance=True, remove_multicollinearity=True, feature_interaction=True, feature_selection=True, selected_share=0.4, normalize=True)
    models, table, chosen = prepared.model_inputs(df, names, "y", setup)
    assert chosen == ["a_x_b_scaled"]
    loaded = [stored(m, spark) for m in models]
    again = df
    for m in loaded:
        again = m.transform(again)
    assert sorted(r[chosen[0]] for r in again.collect()) == sorted(r[chosen[0]] for r in table.collect())
    _, _, chosen = prepared.model_inputs(df, names, None, ModelSetup(ignore_low_variance=True, polynomial_features=True, pca=True, pca_components=2))
    assert chosen == ["pca_0", "pca_1"]
    # a correlation of just the limit counts
    assert prepared.distinct_inputs(df, names, None, 1.0) == ["a", "seven", "b"] and prepared.distinct_inputs(df, names, 0.0, None) == ["a", "twice", "b"]
