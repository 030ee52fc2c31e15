"""Comparing Spark ML models: every function returns the table of results.

Inputs are assembled and written once, then read by every fit. The driver loops over model kinds and
targets, never over data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.feature import MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.missing import known_double, quoted
from ..sources.scratch import materialize, scratch_scope
from . import clusters, gram
from .encode import fit_range, label_table, minmax_column, minmax_exogenous, minmax_inverse, scale, string_index
from .profile import exact_quantiles, null_counts
from .quality import inf_to_null, skip_invalid_rows
from .sampling import fold_column, holdout_split
from .series import chronological_split, lookback_sequences

FEATURES, LABEL = "features", "label"
#: Columns up to which a sum over all pairs of columns is written out.
FORMULA_COLUMNS = 8


def regressors(seed: int = 42) -> dict[str, Estimator]:
    return {
        "linear": LinearRegression(),
        "ridge": LinearRegression(regParam=0.1, elasticNetParam=0.0),
        "lasso": LinearRegression(regParam=0.01, elasticNetParam=1.0),
        "elastic_net": LinearRegression(regParam=0.01, elasticNetParam=0.5),
        "decision_tree": DecisionTreeRegressor(seed=seed),
        "random_forest": RandomForestRegressor(numTrees=20, seed=seed),
        "gbt": GBTRegressor(maxIter=10, seed=seed),
    }


def classifiers(classes: int, seed: int = 42) -> dict[str, Estimator]:
    several = {
        "logistic": LogisticRegression(),
        "decision_tree": DecisionTreeClassifier(seed=seed),
        "random_forest": RandomForestClassifier(numTrees=20, seed=seed),
        "naive_bayes": NaiveBayes(),
    }
    binary = {"gbt": GBTClassifier(maxIter=10, seed=seed), "linear_svc": LinearSVC(maxIter=30, regParam=0.01)}
    return several | binary if classes == 2 else several


# --- metrics -------------------------------------------------------------------------------------


def regression_metrics(df: DataFrame, actual: str = LABEL, predicted: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """``mse``, ``rmse`` and ``mae``, per group if given."""
    error = quoted(actual) - quoted(predicted)
    out = df.groupBy(*[quoted(c) for c in by]).agg(F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"))
    return out.select(*[quoted(c) for c in by], "mse", F.sqrt("mse").alias("rmse"), "mae")


def classification_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``accuracy`` and class-weighted ``f1`` from the confusion counts."""
    keys = [quoted(c) for c in by]
    cells = df.groupBy(*keys, LABEL, "prediction").agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col(LABEL) == F.col("prediction"), F.col("n")).otherwise(0)
    per = [*by, "class"]
    # classes x models rows
    actual = cells.groupBy(*keys, F.col(LABEL).alias("class")).agg(F.sum("n").alias("support"), F.sum(hit).alias("hits"))
    named = cells.groupBy(*keys, F.col("prediction").alias("class")).agg(F.sum("n").alias("named"))
    f1 = 2.0 * F.col("hits") / (F.col("support") + F.coalesce(F.col("named"), F.lit(0)))
    return (
        actual.join(named, per, "left")
        .groupBy(*keys)
        .agg(
            (F.sum("hits") / F.sum("support")).alias("accuracy"),
            (F.sum(f1 * F.col("support")) / F.sum("support")).alias("f1"),
        )
    )


def _scored(models: dict, train: DataFrame, test: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, dict]:
    """``(label, prediction, model, ..)`` of all fitted models on the test rows, and the fits."""
    fits, parts = {}, []
    for name, estimator in models.items():
        fits[name] = estimator.fit(train, {estimator.featuresCol: FEATURES, estimator.labelCol: LABEL})
        predicted = fits[name].transform(test)
        parts.append(predicted.select(*[quoted(c) for c in keep], LABEL, F.col("prediction").cast("double"), F.lit(name).alias("model")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out, fits


def _ranked(metrics: DataFrame, by: Column) -> DataFrame:
    return metrics.withColumn("rank", F.row_number().over(Window.orderBy(by, "model")))


def _assembled(df: DataFrame, label: Column, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    valid = skip_invalid_rows(df, features)
    plain = valid.select(
        *[quoted(c) for c in keep], label.alias(LABEL), *[known_double(df, c).alias(f"_in{i}") for i, c in enumerate(features)]
    ).filter(F.col(LABEL).isNotNull())
    vector = VectorAssembler(inputCols=[f"_in{i}" for i in range(len(features))], outputCol=FEATURES)
    return vector.transform(plain).select(*[quoted(c) for c in keep], LABEL, FEATURES)


# --- comparisons ---------------------------------------------------------------------------------


def compare_regressors(
    df: DataFrame, label: str, features: Sequence[str], key: Sequence[str], exclude: Sequence[str] = (), seed: int = 42
) -> DataFrame:
    """``(model, mse, rmse, mae, rank)`` on a held-out fifth, best first by RMSE."""
    split = holdout_split(df, key, seed=seed)
    data = materialize(_assembled(split, known_double(df, label), features, ["part"]), "assembled")
    models = {n: m for n, m in regressors(seed).items() if n not in exclude}
    scored, _ = _scored(models, data.filter("part = 'train'"), data.filter("part = 'test'"))
    return _ranked(regression_metrics(scored, by=["model"]), F.col("rmse"))


def compare_classifiers(
    df: DataFrame, label: str, features: Sequence[str], key: Sequence[str], exclude: Sequence[str] = (), seed: int = 42,
    balance: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``(model, accuracy, f1, rank)`` on a held-out fifth, best first by accuracy.

    Features are scaled by the range of the training rows; test rows beyond it are cut to it, as some models need numbers from 0.
    ``balance`` may repeat training rows; the held-out ones stay as they are.
    """
    rows = skip_invalid_rows(df.filter(quoted(label).isNotNull()), features)
    if balance is None:
        # balancing may need further columns
        rows = rows.select(*[quoted(c) for c in dict.fromkeys([*key, label, *features])])
    # labels, bounds and parts are all taken from these rows: what the features are worked out from is read once
    indexed = string_index(materialize(rows, "rows"), label, "_label")
    split = holdout_split(indexed, key, seed=seed)
    if balance is not None:
        split = balance(split.filter("part = 'train'")).unionByName(split.filter("part = 'test'"))
    bounds = fit_range(split.filter("part = 'train'"), features)
    scaled = [F.least(F.greatest(minmax_column(split, f, bounds[f]), F.lit(0.0)), F.lit(1.0)).alias(f"{f}_scaled") for f in features]
    data = materialize(_assembled(split.select("*", *scaled), F.col("_label"), [f"{f}_scaled" for f in features], ["part"]), "assembled")
    classes = int(data.agg(F.max(LABEL)).first()[0]) + 1
    models = {n: m for n, m in classifiers(classes, seed).items() if n not in exclude}
    scored, _ = _scored(models, data.filter("part = 'train'"), data.filter("part = 'test'"))
    return _ranked(classification_metrics(scored, ["model"]), F.col("accuracy").desc())


def clusterers(k: int, seed: int = 42) -> dict[str, Estimator]:
    return {
        "kmeans": KMeans(k=k, seed=seed),
        "bisecting_kmeans": BisectingKMeans(k=k, seed=seed),
        "gaussian_mixture": GaussianMixture(k=k, seed=seed),
    }


def compare_clusterers(df: DataFrame, features: Sequence[str], k: int = 4, seed: int = 42) -> DataFrame:
    """``(model, k, silhouette, rank)`` on standardised features."""
    scaled = scale(df, features)
    data = materialize(_assembled(scaled, F.lit(0.0), [f"{f}_scaled" for f in features]), "assembled")
    # rows are packed once; every round of a fit and the measures of all fits are passes over these
    with clusters.packed_rows(data, FEATURES) as packed:
        fits = {name: clusters.fit(data, packed, model) for name, model in clusterers(k, seed).items()}
        rows = [(name, k, measure) for name, measure in zip(fits, clusters.silhouettes(packed, list(fits.values())))]
    table = df.sparkSession.createDataFrame(rows, "model string, k int, silhouette double")
    return _ranked(table, F.col("silhouette").desc_nulls_last())


def _fitted(df: DataFrame, label: Column, features: Sequence[str], scaler: Estimator | None, estimator: Estimator) -> PipelineModel:
    """A pipeline from the feature columns to ``prediction``, fitted on all complete rows; rows with gaps get no prediction."""
    columns = [known_double(df, f).alias(f) for f in features]
    rows = skip_invalid_rows(df, features).select(*columns, label.alias("_label")).filter(F.col("_label").isNotNull())
    estimator = estimator.copy({estimator.labelCol: "_label"})
    plain = "_assembled" if scaler is not None else "_features"
    stages = [VectorAssembler(inputCols=list(features), outputCol=plain, handleInvalid="skip")]
    if scaler is not None:
        stages.append(scaler.copy({scaler.inputCol: plain, scaler.outputCol: "_features"}))
    stages.append(estimator.copy({estimator.featuresCol: "_features"}))
    return Pipeline(stages=stages).fit(materialize(rows, "training"))


def fit_regressor(df: DataFrame, label: str, features: Sequence[str], name: str, seed: int = 42) -> PipelineModel:
    """The named regressor on all rows, to be stored and applied to new ones."""
    return _fitted(df, known_double(df, label), features, None, regressors(seed)[name])


def fit_classifier(df: DataFrame, label: str, features: Sequence[str], name: str, seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    """The named classifier on all rows, and the table ``(label, label_index)`` that explains its predictions."""
    known_rows = df.filter(quoted(label).isNotNull())
    labels, size = label_table(known_rows, label)
    indexed = string_index(known_rows, label, "_index")
    model = _fitted(indexed, F.col("_index"), features, MinMaxScaler(), classifiers(size, seed)[name])
    return model, labels.select("label", "label_index")


def fit_clusterer(df: DataFrame, features: Sequence[str], name: str, k: int = 4, seed: int = 42) -> PipelineModel:
    """The named clustering on all rows."""
    columns = [known_double(df, f).alias(f) for f in features]
    rows = materialize(skip_invalid_rows(df, features).select(*columns), "training")
    assembler = VectorAssembler(inputCols=list(features), outputCol="_assembled", handleInvalid="skip")
    scaled = Pipeline(stages=[assembler, StandardScaler(withMean=True, inputCol="_assembled", outputCol="_features")]).fit(rows)
    data = scaled.transform(rows)
    estimator = clusterers(k, seed)[name]
    estimator.setFeaturesCol("_features")
    with clusters.packed_rows(data, "_features") as packed:
        found = clusters.fit(data, packed, estimator)
    return PipelineModel([*scaled.stages, clusters.spark_model(df.sparkSession, found, estimator)])


def kfold_cv(
    df: DataFrame, label: str, features: Sequence[str], key: Sequence[str], reg_params: Sequence[float] = (0.0, 0.1), folds: int = 5, seed: int = 42, fold: Column | None = None
) -> DataFrame:
    """``(reg_param, rmse)`` of ridge regressions, averaged over folds that depend on the key alone, or are given by ``fold``.

    One pass adds up the products of all columns per fold. What a model is fitted on are the sums of the other folds, and
    its error on its own fold follows from that fold's sums, so there is no training and no scoring pass per fold and parameter.
    """
    known_rows = df.filter(known_double(df, label).isNotNull())
    by_fold = gram.grams(known_rows, [*features, label], fold if fold is not None else fold_column(key, folds, seed))
    rows = []
    for reg in reg_params:
        errors = []
        for own, held_out in by_fold.items():
            rest = None
            for other, state in by_fold.items():
                if other != own:
                    rest = state if rest is None else rest.with_rows_of(state)
            if rest is not None:
                errors.append(float(np.sqrt(gram.squared_error(held_out, *gram.ridge(rest, reg)) / held_out.n)))
        rows.append((float(reg), float(np.mean(errors)) if errors else None))
    return df.sparkSession.createDataFrame(rows, "reg_param double, rmse double")


# --- anomalies -----------------------------------------------------------------------------------


def robust_z_anomalies(df: DataFrame, columns: Sequence[str], threshold: float = 3.5, chunk_rows: int | None = None) -> DataFrame:
    """Rows with a robust z-score beyond the threshold in some column, with ``<c>_z`` per column.

    z = 0.6745 (x - median) / MAD, both exact; a column with MAD 0 gets no score.
    """
    half = {"v": 0.5}
    medians = {r["column_name"]: r["v"] for r in exact_quantiles(df, columns, half, chunk_rows).collect()}
    apart = df.select(*[F.abs(known_double(df, c) - F.lit(medians.get(c)).cast("double")).alias(c) for c in columns])
    mads = {r["column_name"]: r["v"] for r in exact_quantiles(apart, columns, half, chunk_rows).collect()}
    scores = {
        c: F.try_divide((known_double(df, c) - F.lit(medians.get(c)).cast("double")) * 0.6745, F.lit(mads.get(c)).cast("double"))
        for c in columns
    }
    flagged = df.select("*", *[s.alias(f"{c}_z") for c, s in scores.items()])
    beyond = F.lit(False)
    for c in columns:
        beyond = beyond | F.coalesce(F.abs(quoted(f"{c}_z")) > threshold, F.lit(False))
    return flagged.filter(beyond)


def mahalanobis(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``distance``, the squared Mahalanobis distance; rows with a missing input are dropped.

    One pass gives means and covariances; only that small matrix is inverted on the driver.
    """
    state = gram.gram(df, columns)
    inverse = np.linalg.pinv(state.covariance())
    apart = [known_double(df, c) - F.lit(float(m)) for c, m in zip(columns, state.mean)]
    if len(columns) <= FORMULA_COLUMNS:
        distance = F.lit(0.0)
        for i, row in enumerate(inverse):
            for j in range(i, len(columns)):
                distance = distance + apart[i] * apart[j] * F.lit(float(row[j]) * (1 if i == j else 2))
    else:
        # the same sum as a loop over arrays: a formula of all products would be too long to compile
        matrix = F.lit([[float(x) for x in row] for row in inverse])
        dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        distance = dot(F.transform(matrix, lambda row: dot(row, F.col("_apart"))), F.col("_apart"))
    valid = skip_invalid_rows(df, columns).withColumn("_apart", F.array(*apart))
    return valid.select(*[quoted(c) for c in df.columns], distance.alias("distance"))


def centre_distance(df: DataFrame, columns: Sequence[str], k: int = 4, seed: int = 42) -> DataFrame:
    """Add ``cluster`` and ``distance`` to its k-means centre on standardised columns."""
    scaled = scale(df, columns)
    names = [f"{c}_scaled" for c in columns]
    data = VectorAssembler(inputCols=names, outputCol="_features").transform(scaled)
    fit = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster").fit(data)
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in fit.clusterCenters()])
    own = F.get(centres, F.col("cluster"))
    squares = F.lit(0.0)
    for i, name in enumerate(names):
        squares = squares + F.pow(quoted(name) - F.get(own, F.lit(i)), F.lit(2.0))
    return fit.transform(data).select(*[quoted(c) for c in df.columns], "cluster", F.sqrt(squares).alias("distance"))


# --- forecasts -----------------------------------------------------------------------------------


def _sequences(
    df: DataFrame, target: str, order_by, series_key, lookback: int, exogenous: Sequence[str], scaled: bool, test_size: float, chunk_rows
) -> DataFrame:
    """Look-back features (and aligned exogenous ones) with label and chronological part, written once."""
    table = minmax_exogenous(df, exogenous) if exogenous else df
    # the parts are known before the sequences are built, so only narrow rows are ordered for them
    table = materialize(chronological_split(table, order_by, series_key, test_size, skip=lookback, chunk_rows=chunk_rows), "split")
    table = lookback_sequences(table, target, order_by, series_key, lookback, scaled, chunk_rows)
    past = F.col("sequence")
    with_exogenous = F.concat(past, F.array(*[quoted(c) for c in exogenous])) if exogenous else past
    keep = list(dict.fromkeys([*series_key, *order_by]))
    return materialize(
        table.select(*[quoted(c) for c in keep], "part", LABEL, past, with_exogenous.alias("_all")), "sequences"
    )


def _forecast_models(seed: int) -> dict[str, Estimator]:
    return {"lookback_linear": LinearRegression(), "lookback_forest": RandomForestRegressor(numTrees=10, seed=seed), "lookback_gbt": GBTRegressor(maxIter=10, seed=seed)}


def score_and_compare(
    df: DataFrame,
    target: str,
    order_by: Sequence[str],
    series_key: Sequence[str] = (),
    lookback: int = 30,
    exogenous: Sequence[str] = (),
    test_size: float = 0.2,
    seed: int = 42,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Long table ``(series key, order columns, model, actual, predicted)`` on the test tail.

    One-step forecasts from the last ``lookback`` values, on the (0, 1) scale and mapped back; with
    exogenous columns a further linear model also sees those of the forecast row.
    """
    bounds = fit_range(df, [target])[target]
    data = _sequences(df, target, order_by, series_key, lookback, list(exogenous), True, test_size, chunk_rows)
    keep = list(dict.fromkeys([*series_key, *order_by]))

    def parts(column: str) -> tuple[DataFrame, DataFrame]:
        vectors = data.select(*[quoted(c) for c in keep], "part", LABEL, array_to_vector(F.col(column)).alias(FEATURES))
        return vectors.filter("part = 'train'"), vectors.filter("part = 'test'")

    scored, _ = _scored(_forecast_models(seed), *parts("sequence"), keep)
    if exogenous:
        more, _ = _scored({"hybrid_linear": LinearRegression()}, *parts("_all"), keep)
        scored = scored.unionByName(more)
    return scored.select(
        *[quoted(c) for c in keep],
        "model",
        minmax_inverse(F.col(LABEL), bounds).alias("actual"),
        minmax_inverse(F.col("prediction"), bounds).alias("predicted"),
    )


def lookback_regressors(df: DataFrame, target: str, order_by: Sequence[str], series_key: Sequence[str] = (), **settings) -> DataFrame:
    """``(model, mse, rmse, mae, rank)`` of the look-back forecasts on the original scale."""
    compared = score_and_compare(df, target, order_by, series_key, **settings)
    return _ranked(regression_metrics(compared, "actual", "predicted", ["model"]), F.col("rmse"))


def naive_mase(
    df: DataFrame, target: str, order_by: Sequence[str], series_key: Sequence[str] = (), period: int = 7, lookback: int = 30, test_size: float = 0.2, chunk_rows: int | None = None
) -> DataFrame:
    """``(model, mae, mase)`` of the seasonal naive forecast on the test tail."""
    data = _sequences(df, target, order_by, series_key, lookback, [], False, test_size, chunk_rows)
    return _mase(_naive(data, lookback, period), data, lookback, period)


def _naive(data: DataFrame, lookback: int, period: int) -> DataFrame:
    earlier = F.get(F.col("sequence"), F.lit(lookback - period))
    return data.filter("part = 'test'").select(LABEL, earlier.alias("prediction"), F.lit("seasonal_naive").alias("model"))


def _mase(scored: DataFrame, data: DataFrame, lookback: int, period: int) -> DataFrame:
    earlier = F.get(F.col("sequence"), F.lit(lookback - period))
    base = data.filter("part <> 'test'").agg(F.avg(F.abs(F.col(LABEL) - earlier))).first()[0]
    mae = F.avg(F.abs(F.col(LABEL) - F.col("prediction")))
    return scored.groupBy("model").agg(mae.alias("mae")).withColumn("mase", F.try_divide(F.col("mae"), F.lit(base).cast("double")))


def compare_forecasters(
    df: DataFrame,
    target: str,
    order_by: Sequence[str],
    series_key: Sequence[str] = (),
    period: int = 7,
    lookback: int = 30,
    test_size: float = 0.2,
    seed: int = 42,
    chunk_rows: int | None = None,
) -> DataFrame:
    """``(model, mae, mase, rank)``: seasonal naive, linear and boosted trees, best first by MASE.

    MASE is the mean absolute error divided by that of the seasonal naive forecast before the test.
    """
    if period > lookback:
        raise ValueError("the look-back must cover one period")
    data = _sequences(df, target, order_by, series_key, lookback, [], False, test_size, chunk_rows)
    vectors = data.select("part", LABEL, array_to_vector(F.col("sequence")).alias(FEATURES))
    models = {n: m for n, m in _forecast_models(seed).items() if n != "lookback_forest"}
    scored, _ = _scored(models, vectors.filter("part <> 'test'"), vectors.filter("part = 'test'"))
    return _ranked(_mase(scored.unionByName(_naive(data, lookback, period)), data, lookback, period), F.col("mase"))


# --- running several targets ---------------------------------------------------------------------


def prepare_ml(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Check the target, report NULL counts, turn infinities into NULL: ``(table, null counts)``."""
    if target not in df.columns:
        raise ValueError(f"target {target!r} is not a column")
    return inf_to_null(df), null_counts(df)


def per_target_runs(spark, targets: Sequence[str], body: Callable[[str], DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Results by target, and the status table ``(target, status, message, finished)``.

    Each result is written while its target runs, so a failure of the work itself is recorded; it does not stop the others. What
    else the target has written in between is deleted.
    """
    results, rows = {}, []
    for target in targets:
        try:
            with scratch_scope(spark):
                results[target] = materialize(body(target), "target", keep=True)
            rows.append((target, "ok", None, datetime.now()))
        except Exception as error:
            rows.append((target, "failed", str(error).splitlines()[0][:300], datetime.now()))
    return results, spark.createDataFrame(rows, "target string, status string, message string, finished timestamp")
