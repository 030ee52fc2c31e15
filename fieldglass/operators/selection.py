"""Scoring and choosing features. Tables here have one row per feature and target.

Model fits are Spark ML jobs; the driver holds column names and coefficients only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import (
    PCA,
    PolynomialExpansion,
    UnivariateFeatureSelector,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.missing import known_double, quoted, row_per
from ..sources.scratch import materialize
from . import gram
from .association import correlation_matrix, correlation_scores
from .encode import MAX_BROADCAST_LABELS
from .quality import skip_invalid_rows

SCORES = "target string, feature string, method string, score double"

# Vote weights of the combined selection.
VOTE_WEIGHTS = {"correlation": 0.8, "lasso": 0.5, "rfe": 0.3}


def _vectors(df: DataFrame, inputs: Sequence[str], output: str = "_features") -> DataFrame:
    """Double columns assembled to a vector, rows with a missing input dropped."""
    valid = skip_invalid_rows(df, inputs)
    plain = valid.select("*", *[known_double(df, c).alias(f"_in{i}") for i, c in enumerate(inputs)])
    assembler = VectorAssembler(inputCols=[f"_in{i}" for i in range(len(inputs))], outputCol=output, handleInvalid="skip")
    return assembler.transform(plain).drop(*[f"_in{i}" for i in range(len(inputs))])


# --- scores --------------------------------------------------------------------------------------


def lasso_importance(
    df: DataFrame, target: str, features: Sequence[str], alpha: float = 0.01, iterations: int = 100
) -> DataFrame:
    """``(target, feature, method, score)``: absolute lasso coefficients on the unscaled inputs."""
    spark = df.sparkSession
    if not features:
        return spark.createDataFrame([], SCORES)
    data = _vectors(skip_invalid_rows(df, [target]), features).select("_features", known_double(df, target).alias("_label"))
    fit = LinearRegression(
        featuresCol="_features", labelCol="_label", elasticNetParam=1.0, regParam=alpha, maxIter=iterations, standardization=True
    ).fit(data)
    scores = [(target, f, "lasso", abs(float(c))) for f, c in zip(features, fit.coefficients.toArray())]
    return spark.createDataFrame(scores, SCORES)


def rank_and_keep(scores: DataFrame, ratios: dict[str, float], methods: Sequence[str]) -> DataFrame:
    """``(target, feature, score, rank, kept)``.

    Each method's scores are divided by their largest, weighted by the method's ratio and summed. The
    best ``max(1, int(n * smallest ratio))`` features of a target are kept; equal scores go by name.
    """
    used = {m: r for m, r in ratios.items() if m in methods}
    share = min(used.values()) if used else 0.5
    weight = F.coalesce(*[F.when(F.col("method") == m, F.lit(float(r))) for m, r in used.items()], F.lit(0.0))
    largest = F.max("score").over(Window.partitionBy("target", "method"))
    relative = F.coalesce(F.try_divide(F.col("score"), largest), F.lit(0.0))
    summed = (
        scores.filter(F.col("method").isin(*methods))
        .select("target", "feature", (relative * weight).alias("part"))
        .groupBy("target", "feature")
        .agg(F.sum("part").alias("score"))
    )
    per_target = Window.partitionBy("target")
    rank = F.row_number().over(per_target.orderBy(F.col("score").desc(), "feature"))
    quota = F.greatest(F.lit(1).cast("bigint"), F.floor(F.count(F.lit(1)).over(per_target) * F.lit(float(share))))
    return summed.select("target", "feature", "score", rank.alias("rank"), (rank <= quota).alias("kept"))


def combine_methods(votes: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``(feature, score)`` from a table ``(method, feature)``: the weights of the methods naming it."""
    weights = weights or VOTE_WEIGHTS
    weight = F.coalesce(*[F.when(F.col("method") == m, F.lit(w)) for m, w in weights.items()], F.lit(0.0))
    return votes.select("method", "feature").distinct().groupBy("feature").agg(F.sum(weight).alias("score"))


def above_threshold(scores: DataFrame, threshold: float = 0.1) -> DataFrame:
    return scores.filter(F.col("score") >= threshold)


def kept_names(ranked: DataFrame, target: str) -> list[str]:
    rows = ranked.filter(F.col("kept") & (F.col("target") == target)).orderBy("rank").select("feature").collect()
    return [r["feature"] for r in rows]


def multi_target_selection(
    df: DataFrame,
    targets: Sequence[str],
    features: Sequence[str],
    ratios: dict[str, float],
    methods: Sequence[str] = ("correlation", "lasso"),
    correlation_method: str = "pearson",
    alpha: float = 0.01,
) -> DataFrame:
    """``(target, feature, method, score, kept)`` for all targets.

    Correlations of all targets come from one aggregate; each lasso sees the features its target's
    correlation step kept. A feature is selected if either method keeps it for any target.
    """
    features = [f for f in features if f not in targets]
    columns = ["target", "feature", "method", "score", "kept"]
    if "correlation" not in methods:
        return df.sparkSession.createDataFrame([], SCORES + ", kept boolean")
    correlations = correlation_scores(df, targets, features, correlation_method)
    rows = correlations.collect()  # targets x features numbers
    scores = df.sparkSession.createDataFrame(rows, SCORES)
    ranked = rank_and_keep(scores, ratios, [m for m in methods if m in ratios])
    marks = ranked.select("target", "feature", "kept")
    result = scores.join(F.broadcast(marks), ["target", "feature"]).select(*columns)
    if "lasso" in methods:
        kept: dict[str, list[str]] = {t: [] for t in targets}
        for row in ranked.filter("kept").orderBy("target", "rank").collect():
            kept[row["target"]].append(row["feature"])
        for target in targets:
            lasso = lasso_importance(df, target, kept[target], alpha)
            marks = rank_and_keep(lasso, ratios, methods).select("target", "feature", "kept")
            result = result.unionByName(lasso.join(F.broadcast(marks), ["target", "feature"]).select(*columns))
    return result


def bounded_sample(df: DataFrame, key: Sequence[str], share: float = 0.1, seed: int = 42, by: Column | None = None) -> DataFrame:
    """About ``share`` of the rows, chosen by a seeded hash of the key; ``approximate`` tells whether any may be left out.

    ``by``: a number from 0 to 1 per row in place of the hash.
    """
    resolution = 1 << 40
    draw = F.pmod(F.xxhash64(F.lit(seed), *[quoted(k) for k in key]), F.lit(resolution))
    kept = draw < int(resolution * share) if by is None else by < share
    return df.filter(kept).withColumn("approximate", F.lit(share < 1))


def recursive_elimination(df: DataFrame, target: str, features: Sequence[str], keep: int = 10) -> DataFrame:
    """``(feature, eliminated_at, kept)``: regress on standardised inputs, drop the smallest coefficient, and again.

    One pass over the rows gives all products of columns; the regressions are sweeps of that matrix. Of equal coefficients
    the feature named first goes first, and before all others those that are constant or follow from the ones named before them.
    """
    gone, left = gram.elimination_order(gram.gram(df, [*features, target]), keep)
    steps = [(features[k], i) for i, k in enumerate(gone, 1)] + [(features[k], None) for k in left]
    table = df.sparkSession.createDataFrame(steps, "feature string, eliminated_at int")
    return table.withColumn("kept", F.col("eliminated_at").isNull())


# --- principal components ------------------------------------------------------------------------


def component_count(features: int, components: float) -> int:
    """A fraction is a share of the feature count, at least one; otherwise the number itself."""
    wanted = int(features * components) if 0 < components < 1 else int(components)
    return max(1, min(features, wanted))


def fit_pca(df: DataFrame, features: Sequence[str], k: int):
    """The assembled data and the fitted Spark ML model."""
    data = _vectors(df, features)
    return data, PCA(k=k, inputCol="_features", outputCol="_pca").fit(data)


def pca(df: DataFrame, features: Sequence[str], components: float = 0.95):
    """``(df with pca_0.., names, model)``."""
    data, model = fit_pca(df, features, component_count(len(features), components))
    return _pca_columns(data, model, model.getK())


def _pca_columns(data: DataFrame, model, k: int):
    names = [f"pca_{i}" for i in range(k)]
    scores = vector_to_array(F.col("_pca"))
    out = model.transform(data).select("*", *[scores[i].alias(n) for i, n in enumerate(names)])
    return out.drop("_features", "_pca"), names, model


def pca_by_variance(df: DataFrame, features: Sequence[str], variance: float = 0.95):
    """The smallest number of components whose explained variance reaches ``variance``."""
    data, model = fit_pca(df, features, len(features))
    total, k = 0.0, 0
    for share in model.explainedVariance.toArray():
        total, k = total + float(share), k + 1
        if total >= variance:
            break
    return _pca_columns(data, model, k)


def explained_variance(model, spark) -> DataFrame:
    """``(component, ratio, cumulative)`` of a fitted model."""
    rows, total = [], 0.0
    for i, share in enumerate(model.explainedVariance.toArray()):
        total += float(share)
        rows.append((f"pca_{i}", float(share), total))
    return spark.createDataFrame(rows, "component string, ratio double, cumulative double")


# --- other choices -------------------------------------------------------------------------------


def top_exogenous(df: DataFrame, target: str, candidates: Sequence[str], count: int = 10) -> DataFrame:
    """``(feature, score, rank)``: the strongest features that are not derived from the target itself."""
    own = (f"{target}_lag_", f"{target}_rolling_")
    usable = [c for c in candidates if c != target and not c.startswith(own)]
    rank = F.row_number().over(Window.orderBy(F.col("score").desc(), "feature"))
    return (
        correlation_scores(df, [target], usable)
        .select("feature", "score", rank.alias("rank"))
        .filter(F.col("rank") <= count)
    )


def correlation_preview(df: DataFrame, target: str, numerical: Sequence[str], count: int | None = None) -> DataFrame:
    """Scores of all (the first ``count``) numerical columns against the primary target."""
    return correlation_scores(df, [target], [c for c in numerical if c != target][:count])


def feature_metadata(roles: DataFrame, scores: DataFrame, scaling: str = "standard") -> DataFrame:
    """One row per column and target that selected it: role, destination and score."""
    destination = (
        F.when(F.col("role") == "categorical", "categorical_features")
        .when(F.col("role") == "numerical", "scaled_features" if scaling != "none" else "numerical_features")
        .otherwise("other")
    )
    chosen = scores.filter("kept").select(F.col("feature").alias("column_name"), "target", "method", "score")
    return roles.select("column_name", "role", destination.alias("destination")).join(
        F.broadcast(chosen), "column_name", "left"
    )


def drop_multicollinear(df: DataFrame, features: Sequence[str], threshold: float = 0.9) -> tuple[DataFrame, list[str]]:
    """Walk the features in order; drop one that correlates with an already kept feature.

    The driver sees one number per pair of columns, never data rows.
    """
    close = {
        (r["a"], r["b"]) for r in correlation_matrix(df, features).filter(F.abs("r") >= threshold).collect()
    }
    kept: list[str] = []
    for name in features:
        if not any((other, name) in close for other in kept):
            kept.append(name)
    gone = set(features) - set(kept)
    return df.select(*[quoted(c) for c in df.columns if c not in gone]), kept


def low_variance_columns(df: DataFrame, columns: Sequence[str], threshold: float = 0.0) -> DataFrame:
    """``(feature, variance, dropped)`` by sample variance."""
    measured = df.agg(*[F.var_samp(known_double(df, c)).alias(f"v{i}") for i, c in enumerate(columns)])
    entries = [{"feature": F.lit(c), "variance": F.col(f"v{i}")} for i, c in enumerate(columns)]
    table = measured.select(row_per(entries)).select("r.*")
    return table.withColumn("dropped", F.coalesce(F.col("variance") <= threshold, F.lit(True)))


def drop_low_variance(df: DataFrame, columns: Sequence[str], threshold: float = 0.0) -> DataFrame:
    gone = {r[0] for r in low_variance_columns(df, columns, threshold).filter("dropped").select("feature").collect()}
    return df.select(*[quoted(c) for c in df.columns if c not in gone])


def polynomial_features(df: DataFrame, features: Sequence[str], degree: int = 2, output: str = "polynomial") -> DataFrame:
    """All monomials up to ``degree`` as ``ARRAY<DOUBLE>``; rows with a missing input are dropped."""
    expanded = PolynomialExpansion(degree=degree, inputCol="_features", outputCol="_poly").transform(_vectors(df, features))
    return expanded.select(*[quoted(c) for c in df.columns], vector_to_array(F.col("_poly")).alias(output))


def feature_interactions(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Products ``<a>_x_<b>`` of every two features."""
    products = [
        (known_double(df, a) * known_double(df, b)).alias(f"{a}_x_{b}")
        for i, a in enumerate(features)
        for b in features[i + 1 :]
    ]
    return df.select("*", *products)


def univariate_selection(
    df: DataFrame, label: str, features: Sequence[str], keep: int, label_type: str = "continuous"
) -> DataFrame:
    """``(feature, kept)`` by the univariate F-test of Spark ML."""
    data = _vectors(skip_invalid_rows(df, [label]), features).withColumn("_label", known_double(df, label))
    selector = UnivariateFeatureSelector(featuresCol="_features", labelCol="_label", outputCol="_out", selectionMode="numTopFeatures")
    selector.setFeatureType("continuous").setLabelType(label_type).setSelectionThreshold(keep)
    chosen = set(selector.fit(data).selectedFeatures)
    return df.sparkSession.createDataFrame([(f, i in chosen) for i, f in enumerate(features)], "feature string, kept boolean")


# --- class balance -------------------------------------------------------------------------------


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, weight)`` with weight ``N / (k * n)``."""
    counts = (
        df.filter(quoted(label).isNotNull()).groupBy(quoted(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    )
    total = counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes")).first()
    rows, classes = float(total["rows"] or 0), float(total["classes"])
    return counts.select("label", "n", F.try_divide(F.lit(rows), F.lit(classes) * F.col("n")).alias("weight"))


def oversample(df: DataFrame, label: str, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Repeat rows of smaller classes until all are about as large as the largest, repeatably; rows without a label stay once."""
    counts = materialize(class_weights(df, label).select(F.col("label").alias("_label"), "n"), "classes")
    sizes = counts.agg(F.count(F.lit(1)).alias("classes"), F.max("n").alias("largest")).first()
    factor = counts.select("_label", (F.lit(float(sizes["largest"] or 0)) / F.col("n")).alias("_factor"))
    if sizes["classes"] <= MAX_BROADCAST_LABELS:
        factor = F.broadcast(factor)
    draw = F.pmod(F.xxhash64(F.lit(seed), *[quoted(k) for k in key]), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.floor("_factor") + (draw < F.col("_factor") - F.floor("_factor")).cast("int")
    joined = df.join(factor, quoted(label) == F.col("_label"), "left")
    times = F.coalesce(copies, F.lit(1)).cast("bigint")
    return joined.select(
        *[quoted(c) for c in df.columns], F.explode(F.sequence(F.lit(1).cast("bigint"), times)).alias("copy")
    )
