"""Products of columns from one pass, and what is derived from them, against numpy and Spark ML."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from fieldglass.operators import gram, models, selection


def frame(spark, x, more=()):
    return spark.createDataFrame([tuple(map(float, row)) for row in x], ", ".join(f"c{i} double" for i in range(x.shape[1]))).repartition(7)


def close(state, x):
    return state.n == len(x) and np.allclose(state.mean, x.mean(axis=0), rtol=1e-12) and np.allclose(state.covariance(), np.cov(x.T), rtol=1e-6, atol=1e-6)


def test_tiles_and_groups(spark, monkeypatch):
    x = np.random.default_rng(1).normal(1e9, 3, (500, 7)).round(3)
    df = frame(spark, x)
    columns = df.columns
    assert close(gram.gram(df, columns, fan_in=2), x)
    monkeypatch.setattr(gram, "TILE", 3)
    monkeypatch.setattr(gram, "ROWS", 11)
    assert close(gram.gram(df, columns), x)
    by = gram.grams(df, columns, F.when(F.col("c0") > 1e9, 1).when(F.col("c0") < 1e9 - 2, 0))
    assert set(by) == {0, 1}
    assert close(by[1], x[x[:, 0] > 1e9]) and close(by[0], x[x[:, 0] < 1e9 - 2])
    kept = (x[:, 0] > 1e9) | (x[:, 0] < 1e9 - 2)
    assert close(by[0].with_rows_of(by[1]), x[kept])


def test_rows_with_gaps_are_left_out(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, 2.0), (None, 3.0), (4, nan), (3, 7.0)], "a int, b double")
    state = gram.gram(df, ["a", "b"])
    assert state.n == 2 and state.mean.tolist() == [2.0, 4.5]
    assert gram.gram(df.limit(0), ["a", "b"]).n == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(2, 6), st.integers(0, 2**32))
def test_elimination_equals_refitting(width, seed):
    random = np.random.default_rng(seed)
    x = random.normal(size=(60, width)) * random.uniform(0.1, 50, width)
    y = x @ random.normal(size=width) + random.normal(size=60)
    rows = np.column_stack([x, y])
    state = gram.Gram(60, rows.mean(axis=0), (rows - rows.mean(axis=0)).T @ (rows - rows.mean(axis=0)))
    gone, left = gram.elimination_order(state, 1)
    scaled, alive, expected = (x - x.mean(axis=0)) / x.std(axis=0), list(range(width)), []
    while len(alive) > 1:
        sizes = np.abs(np.linalg.lstsq(scaled[:, alive], y - y.mean(), rcond=None)[0])
        expected.append(alive.pop(int(sizes.argmin())))
    assert gone == expected and left == alive


def test_elimination_reads_the_rows_once(spark):
    x = np.random.default_rng(3).normal(size=(200, 6))
    df = frame(spark, x)
    counter = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            counter.add(batch.num_rows)
            yield batch

    table = selection.recursive_elimination(df.mapInArrow(seen, df.schema), "c5", df.columns[:5], 1)
    assert table.count() == 5 and counter.value == 200


@pytest.mark.parametrize("reg", [0.0, 0.3])
def test_ridge_equals_spark(spark, reg):
    random = np.random.default_rng(5)
    x = random.normal(size=(300, 3)) * (1, 10, 0.2) + (5, -100, 0)
    rows = np.column_stack([x, x @ (2.0, -0.3, 4.0) + random.normal(size=300)])
    df = frame(spark, rows)
    fit = LinearRegression(featuresCol="f", labelCol="c3", regParam=reg, solver="normal").fit(VectorAssembler(inputCols=["c0", "c1", "c2"], outputCol="f").transform(df))
    state = gram.gram(df, df.columns)
    intercept, coefficients = gram.ridge(state, reg)
    assert np.allclose(coefficients, fit.coefficients.toArray(), rtol=1e-8) and abs(intercept - fit.intercept) < 1e-6
    error = rows[:, 3] - intercept - rows[:, :3] @ coefficients
    assert abs(gram.squared_error(state, intercept, coefficients) - (error**2).sum()) < 1e-6


def test_folds_leave_their_own_rows_out(spark):
    random = np.random.default_rng(6)
    x = random.normal(size=(90, 2))
    rows = np.column_stack([np.arange(90) % 3, x, x @ (1.0, 2.0) + random.normal(size=90)])
    df = frame(spark, rows)
    found = models.kfold_cv(df, "c3", ["c1", "c2"], ["c0"], [0.0], fold=F.col("c0")).first()["rmse"]
    errors = []
    for k in range(3):
        train, test = rows[rows[:, 0] != k], rows[rows[:, 0] == k]
        with_one = lambda part: np.column_stack([np.ones(len(part)), part[:, 1:3]])
        fit = np.linalg.lstsq(with_one(train), train[:, 3], rcond=None)[0]
        errors.append(np.sqrt(((test[:, 3] - with_one(test) @ fit) ** 2).mean()))
    assert abs(found - np.mean(errors)) < 1e-9


@pytest.mark.parametrize("width", [3, 12])
def test_distances_of_few_and_many_columns(spark, width):
    x = np.random.default_rng(width).normal(size=(80, width)) @ np.random.default_rng(7).normal(size=(width, width)) + 5
    df = frame(spark, x)
    found = {round(r["c0"], 9): r["distance"] for r in models.mahalanobis(df, df.columns).collect()}
    inverse = np.linalg.pinv(np.cov(x.T))
    for row in x:
        apart = row - x.mean(axis=0)
        assert abs(found[round(float(row[0]), 9)] - apart @ inverse @ apart) < 1e-6
    assert models.mahalanobis(df, df.columns).columns == [*df.columns, "distance"]
