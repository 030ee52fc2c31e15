"""Clusterings over packed rows against those of Spark ML."""

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler

from fieldglass.operators import clusters, models


@pytest.fixture(scope="module")
def data(spark):
    pick = np.random.default_rng(5)
    centres = np.array([[0.0, 0.0, 0.0], [6.0, 1.0, -3.0], [-5.0, 4.0, 2.0]])
    rows = np.concatenate([c + pick.normal(size=(700, 3)) * [1.0, 0.5, 2.0] for c in centres] + [[[90.0, 90.0, 90.0]]])
    frame = spark.createDataFrame(rows.tolist(), "a double, b double, c double")
    return models.materialize(VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(frame).select("features"))


@pytest.mark.parametrize("collected", [1 << 24, 0])
def test_packed_clusterings_are_those_of_spark(spark, data, monkeypatch, collected):
    monkeypatch.setattr(clusters, "ROWS", 100)
    monkeypatch.setattr(clusters, "COLLECTED", collected)
    measure = ClusteringEvaluator(featuresCol="features", metricName="silhouette")
    with clusters.packed_rows(data, "features") as packed:
        for name, estimator in models.clusterers(3).items():
            if collected == 0 and name != "kmeans":
                continue
            found = clusters.fit(data, packed, estimator)
            ours, theirs = clusters.spark_model(spark, found, estimator).transform(data), estimator.fit(data).transform(data)
            assert [r.prediction for r in ours.collect()] == [r.prediction for r in theirs.collect()], name
            assert clusters.silhouettes(packed, [found])[0] == pytest.approx(measure.evaluate(theirs), abs=1e-9)


def test_fits_over_packed_rows_run_no_rounds_of_spark(spark, monkeypatch):
    rows = [(float(i % 7), float((i * i) % 11)) for i in range(400)]
    frame = spark.createDataFrame(rows, "x double, y double")
    rounds = []
    for kind in (models.KMeans, models.GaussianMixture, models.BisectingKMeans):
        monkeypatch.setattr(kind, "fit", lambda self, df, params=None, f=kind.fit: (rounds.append(self.getMaxIter()), f(self, df, params))[1])
    board = models.compare_clusterers(frame, ["x", "y"], 3).orderBy("rank").collect()
    assert [r.rank for r in board] == [1, 2, 3] and all(0 < r.silhouette < 1 for r in board)
    for name in models.clusterers(3):
        scored = models.fit_clusterer(frame, ["x", "y"], name, 3).transform(frame)
        assert 1 < scored.select("prediction").distinct().count() <= 3
    assert max(rounds) <= 1


def test_rows_in_one_cluster_have_no_silhouette(spark):
    rows = clusters.Centres(np.array([[0.0, 0.0]]))
    frame = spark.createDataFrame([(float(i), 1.0) for i in range(20)], "x double, y double")
    packed = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(frame)
    with clusters.packed_rows(packed, "features") as cells:
        assert clusters.silhouettes(cells, [rows, clusters.Centres(np.array([[0.0, 1.0], [19.0, 1.0]]))])[0] is None
