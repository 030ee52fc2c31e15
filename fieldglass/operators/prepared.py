"""The preparation of features as pipeline stages that are fitted once, stored, and applied to new rows.

Every stage is an Estimator whose ``fitted(df)`` gives the model and the prepared table of the rows it was fitted on; ``fit`` gives the model
alone. A model keeps plain values (means, bounds, names) in its metadata, and tables of labels as Parquet beside them, so a
``PipelineModel`` of these stages is saved and loaded like any other. Nothing here depends on the number of rows or labels.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.missing import known_double, quoted
from ..sources.scratch import materialize
from ..config import ModelSetup
from . import encode, gram, impute, schema, series
from .encode import MAX_BROADCAST_LABELS
from .quality import skip_invalid_rows

LABELS = "column string, label string, n bigint, share double"


class FittedStage(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A model whose whole state is plain values."""

    state = Param(Params._dummy(), "state", "what was fitted, as plain values")

    def __init__(self, state: dict[str, Any] | None = None):
        super().__init__()
        if state is not None:
            self._set(state=state)

    def __getitem__(self, name: str) -> Any:
        return self.getOrDefault(self.state)[name]


class Stage(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Settings by name; ``fitted`` does the work."""

    settings = Param(Params._dummy(), "settings", "settings by name")

    def __init__(self, **settings: Any):
        super().__init__()
        if settings:
            self._set(settings=settings)

    def __getitem__(self, name: str) -> Any:
        return self.getOrDefault(self.settings)[name]

    def fitted(self, df: DataFrame) -> tuple[Model, DataFrame]:
        model = self.learned(df)
        return model, model.transform(df)

    def learned(self, df: DataFrame) -> Model:
        raise NotImplementedError

    def _fit(self, df: DataFrame) -> Model:
        return self.fitted(df)[0]


# --- names ---------------------------------------------------------------------------------------


class CleanNames(Stage):
    """Dots, spaces and hyphens of column names become ``_``."""

    def learned(self, df: DataFrame) -> CleanNamesModel:
        return CleanNamesModel({"names": schema.sanitize_names(df)[1]})


class CleanNamesModel(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.toDF(*[self["names"].get(c, c) for c in df.columns])


# --- missing values ------------------------------------------------------------------------------


class FillMissing(Stage):
    """``columns`` filled by ``method``: mean, zero, ffill_as_mean or ffill (by ``order_by`` within ``series_key``).

    New rows get the values of the fitted ones: their means, and, carried forward within the new rows, what remains at the start.
    """

    def fitted(self, df: DataFrame) -> tuple[FillMissingModel, DataFrame]:
        columns, method = self["columns"], self["method"]
        if method not in ("mean", "zero", "ffill_as_mean", "ffill"):
            raise ValueError(f"unknown imputation {method!r}")
        state = {"columns": columns, "method": method, "order_by": self["order_by"], "series_key": self["series_key"], "chunk_rows": self["chunk_rows"]}
        rows = df
        if method == "ffill" and columns:
            if not self["order_by"]:
                raise ValueError("forward fill needs order_by: rows of a DataFrame have no order of their own")
            rows = materialize(series.carry_forward(df, columns, self["order_by"], self["series_key"], self["chunk_rows"]), "filled")
        means = {} if method == "zero" else impute.fit_means(rows, columns)
        if method == "zero" or method == "ffill_as_mean":
            means = {c: means.get(c) or 0.0 for c in columns}
        model = FillMissingModel(state | {"means": means})
        return model, model.filled(rows)


class FillMissingModel(FittedStage):
    def filled(self, rows: DataFrame) -> DataFrame:
        return impute.fill_with(rows, self["means"])

    def _transform(self, df: DataFrame) -> DataFrame:
        if self["method"] == "ffill" and self["columns"]:
            df = series.carry_forward(df, self["columns"], self["order_by"], self["series_key"], self["chunk_rows"])
        return self.filled(df)


# --- categories ----------------------------------------------------------------------------------


class EncodeLabels(Stage):
    """Numbers for the categories in ``columns``, by one rule for any number of labels.

    A label that at least one in ``rows_per_indicator`` labelled rows has gets a 0/1 column ``<column>_<label>``. If a column has rarer labels
    too, ``<column>_frequency`` gives the share of the labelled rows that have the row's label. A label that was not there
    when fitting has frequency 0, and so has a missing one.
    """

    def learned(self, df: DataFrame) -> EncodeLabelsModel:
        columns = self["columns"]
        if not columns:
            return EncodeLabelsModel({"columns": [], "indicators": {}, "rare": {}})
        one = [F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("label")) for c in columns]
        long = df.select(F.explode(F.array(*one)).alias("r")).select("r.*").where("label IS NOT NULL")
        counts = materialize(long.groupBy("column", "label").agg(F.count(F.lit(1)).alias("n")), "labels")
        totals = counts.groupBy("column").agg(F.sum("n").alias("rows"))
        labels = materialize(counts.join(F.broadcast(totals), "column").select("column", "label", "n", (F.col("n") / F.col("rows")).alias("share")), "labels")
        frequent = F.col("share") * self["rows_per_indicator"] >= 1
        # At most rows_per_indicator labels of a column are frequent.
        indicators: dict[str, list] = {c: [] for c in columns}
        for row in labels.where(frequent).orderBy("column", F.desc("n"), "label").collect():
            indicators[row["column"]].append([row["label"], row["share"]])
        rare = {r["column"]: r["n"] for r in labels.where(~frequent).groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
        return EncodeLabelsModel({"columns": columns, "indicators": indicators, "rare": rare}, labels.where(~frequent))


class EncodeLabelsModel(FittedStage):
    """Frequent labels are plain values, the table of rare ones is stored as Parquet."""

    def __init__(self, state: dict[str, Any] | None = None, labels: DataFrame | None = None):
        super().__init__(state)
        self.labels = labels

    @property
    def names(self) -> list[str]:
        """The columns that are added."""
        out = []
        for c in self["columns"]:
            out += [f"{c}_{label}" for label, _ in self["indicators"][c]]
            out += [f"{c}_frequency"] if c in self["rare"] else []
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        for c in self["columns"]:
            text, known = quoted(c).cast("string"), self["indicators"][c]
            flags = [F.coalesce((text == label).cast("double"), F.lit(0.0)).alias(f"{c}_{label}") for label, _ in known]
            if c not in self["rare"]:
                df = df.select("*", *flags)
                continue
            share = F.coalesce(*[F.when(text == label, F.lit(float(s))) for label, s in known], F.lit(None).cast("double"))
            df = self._with_rare(df.select("*", *flags, share.alias(f"{c}_frequency")), c)
        return df

    def _with_rare(self, df: DataFrame, column: str) -> DataFrame:
        """Shares of rare labels: from a broadcast table if it is small, else by a shuffle of the rows that have one."""
        output = f"{column}_frequency"
        table = self.labels.where(F.col("column") == column).select(F.col("label").alias("_label"), F.col("share").alias("_share"))
        match = quoted(column).cast("string") == F.col("_label")

        def shaped(rows: DataFrame) -> DataFrame:
            share = F.coalesce(quoted(output), F.col("_share"), F.lit(0.0)).alias(output)
            return rows.select(*[share if c == output else quoted(c) for c in df.columns])

        if self["rare"][column] <= MAX_BROADCAST_LABELS:
            return shaped(df.join(F.broadcast(table), match, "left"))
        open_ = quoted(output).isNull() & quoted(column).isNotNull()
        settled = df.where(~open_).withColumn("_share", F.lit(None).cast("double"))
        return shaped(settled).unionByName(shaped(df.where(open_).join(table, match, "left")))

    def write(self) -> MLWriter:
        return _LabelsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _LabelsReader(cls)

    def copy(self, extra=None) -> EncodeLabelsModel:
        that = super().copy(extra)
        that.labels = self.labels
        return that


class _LabelsWriter(MLWriter):
    def __init__(self, instance: EncodeLabelsModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.active()
        DefaultParamsWriter.saveMetadata(self.instance, path, spark)
        labels = self.instance.labels
        (labels if labels is not None else spark.createDataFrame([], LABELS)).write.parquet(f"{path}/labels")


class _LabelsReader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> EncodeLabelsModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark, self.cls.__module__ + "." + self.cls.__name__)
        model = self.cls(labels=spark.read.schema(LABELS).parquet(f"{path}/labels"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


# --- scales, components, choice ------------------------------------------------------------------


class ScaleColumns(Stage):
    """``<c>_scaled`` for ``columns`` by ``method``, with the bounds of the fitted rows; rows with a missing input are dropped."""

    def learned(self, df: DataFrame) -> ScaleColumnsModel:
        columns, method = self["columns"], self["method"]
        bounds = {} if method == "none" or not columns else encode.fit_scale(skip_invalid_rows(df, columns), columns, method)
        return ScaleColumnsModel({"columns": columns, "method": method, "bounds": {c: list(b) for c, b in bounds.items()}})


class ScaleColumnsModel(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        if not self["bounds"]:
            return df
        valid = skip_invalid_rows(df, self["columns"])
        return valid.select("*", *encode.scaled_columns(df, self["bounds"], self["method"]))


class Components(Stage):
    """``pca_0..`` of the ``columns``; rows with a missing input are dropped."""

    def learned(self, df: DataFrame) -> ComponentsModel:
        from .selection import component_count, fit_pca

        columns = self["columns"]
        _, fit = fit_pca(df, columns, component_count(len(columns), self["components"]))
        return ComponentsModel({"columns": columns, "directions": fit.pc.toArray().T.tolist()})


class ComponentsModel(FittedStage):
    @property
    def names(self) -> list[str]:
        return [f"pca_{i}" for i in range(len(self["directions"]))]

    def _transform(self, df: DataFrame) -> DataFrame:
        values = [known_double(df, c) for c in self["columns"]]
        dot = lambda direction: sum((v * F.lit(w) for v, w in zip(values, direction)), F.lit(0.0))
        scores = [dot(d).alias(n) for n, d in zip(self.names, self["directions"])]
        return skip_invalid_rows(df, self["columns"]).select("*", *scores)


class ProductsModel(FittedStage):
    """``<a>_x_<b>`` for every pair in ``pairs``; missing where a factor is. A pair may name a column twice."""

    @property
    def names(self) -> list[str]:
        return [f"{a}_x_{b}" for a, b in self["pairs"]]

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.select("*", *[(known_double(df, a) * known_double(df, b)).alias(n) for n, (a, b) in zip(self.names, self["pairs"])])


class KeepColumnsModel(FittedStage):
    """The chosen ``columns`` in their order, and those of ``optional`` that are there: targets are not known for new rows."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return schema.project_features(df, self["columns"], [c for c in self["optional"] if c in df.columns])


def run_stages(df: DataFrame, stages: Sequence[Stage]) -> tuple[list[Model], DataFrame]:
    """Fit the stages one after another, each on what the one before made of the rows."""
    models = []
    for stage in stages:
        model, df = stage.fitted(df)
        models.append(model)
    return models, df


# --- set-up of model inputs ----------------------------------------------------------------------


def distinct_inputs(df: DataFrame, features: Sequence[str], least_variance: float | None, largest_r: float | None) -> list[str]:
    """The features whose variance is larger than ``least_variance``, and of two that correlate by ``largest_r`` or more the one named first.

    One pass gives all variances and correlations.
    """
    state = gram.gram(df, features)
    covariance = state.covariance()
    spread = np.sqrt(np.diag(covariance))
    kept: list[int] = []
    for k in range(len(features)):
        if least_variance is not None and not covariance[k, k] > least_variance:
            continue
        if largest_r is not None and any(abs(covariance[j, k]) >= largest_r * spread[j] * spread[k] > 0 for j in kept):
            continue
        kept.append(k)
    return [features[k] for k in kept]


def strongest_inputs(df: DataFrame, label: str, features: Sequence[str], share: float) -> list[str]:
    """The share of the features, at least one, that correlate most with a numeric label; of equal ones those named first."""
    state = gram.gram(df.filter(known_double(df, label).isNotNull()), [*features, label])
    spread = np.sqrt(np.diag(state.products))
    scale = spread[:-1] * spread[-1]
    r = np.divide(np.abs(state.products[:-1, -1]), scale, out=np.zeros(len(features)), where=scale > 0)
    keep = sorted(range(len(features)), key=lambda k: (-r[k], k))[: max(1, int(len(features) * share))]
    return [features[k] for k in sorted(keep)]


def model_inputs(df: DataFrame, features: Sequence[str], label: str | None, setup: ModelSetup) -> tuple[list[Model], DataFrame, list[str]]:
    """Stages that make the inputs of a model of the features, the prepared rows, and the names of the inputs.

    In this order: features that vary too little or follow from another one are left out; products are added; the inputs that tell most
    about the label stay; inputs are standardised; components take their place. Rows with a missing feature are dropped by the last two.
    """
    models: list[Model] = []
    chosen = list(features)
    if setup.ignore_low_variance or setup.remove_multicollinearity:
        least = setup.low_variance if setup.ignore_low_variance else None
        chosen = distinct_inputs(df, chosen, least, setup.multicollinearity if setup.remove_multicollinearity else None)
    if setup.polynomial_features or setup.feature_interaction:
        squares = [[c, c] for c in chosen] if setup.polynomial_features else []
        products = ProductsModel({"pairs": squares + [[a, b] for i, a in enumerate(chosen) for b in chosen[i + 1 :]]})
        models.append(products)
        df, chosen = products.transform(df), chosen + products.names
    if setup.feature_selection and label is not None:
        chosen = strongest_inputs(df, label, chosen, setup.selected_share)
    if setup.normalize and chosen:
        model, df = ScaleColumns(columns=chosen, method="standard").fitted(df)
        models.append(model)
        chosen = [f"{c}_scaled" for c in chosen]
    if setup.pca and chosen:
        model, df = Components(columns=chosen, components=setup.pca_components).fitted(df)
        models.append(model)
        chosen = model.names
    return models, df, chosen
