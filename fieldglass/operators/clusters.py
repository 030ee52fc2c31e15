"""Spark ML's clusterings by passes over packed rows.

Where a clustering starts is Spark ML's own choice: its estimators are fitted with no round, or with one. The rounds that follow are the
same as theirs, but a task works on matrices and not on one object per row. What leaves a task are sums per cluster, and the driver
holds these, whatever the number of rows. The outcome becomes a model of Spark ML, so that it can be stored and applied to new rows.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml import Model
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .states import SCHEMA, State, packed, tree_merged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of packed rows in a cell, about, and rows that a task works on at a time.
CELL, ROWS = 1 << 13, 1 << 14
#: States of tasks that come to the driver at once, in bytes; more are merged on the executors first.
COLLECTED = 16 << 20
EPSILON = float(np.finfo(float).eps)


# --- packed rows ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Packed:
    """Rows of ``width`` numbers in cells of bytes, and the number of tasks that read them."""

    cells: DataFrame
    width: int
    tasks: int


@contextmanager
def packed_rows(df: DataFrame, features: str) -> Iterator[Packed]:
    """The vectors of a column, written once. As they are read in every round, executors also keep them, on disk where memory is short."""
    width = df.select(features).first()[0].size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, CELL // (8 * width))
        for batch in batches:
            rows = np.ascontiguousarray(batch.column(0).flatten().to_numpy(zero_copy_only=False), float).reshape(-1, width)
            yield pa.RecordBatch.from_arrays([pa.array([rows[i : i + step].tobytes() for i in range(0, len(rows), step)], pa.binary())], names=["cell"])

    cells = materialize(df.select(vector_to_array(features).alias("x")).mapInArrow(run, "cell binary"), "packed").persist()
    try:
        yield Packed(cells, width, cells.rdd.getNumPartitions())
    finally:
        cells.unpersist()


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    """Matrices with a column per row of the table."""
    for batch in batches:
        cells = batch.column(0).cast(pa.binary())
        ends = np.frombuffer(cells.buffers()[1], np.int32)[cells.offset : cells.offset + len(cells) + 1]
        if len(cells) and ends[-1] > ends[0]:
            rows = np.frombuffer(cells.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(float).reshape(-1, width)
            for start in range(0, len(rows), ROWS):
                yield np.ascontiguousarray(rows[start : start + ROWS].T)


def _added(a: State, b: State) -> State:
    return [x + y for x, y in zip(a, b)]


def totals(rows: Packed, sums: Callable[[np.ndarray], State]) -> State:
    """The sums of all matrices, added up."""
    width, add = rows.width, _added

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for x in _matrices(batches, width):
            own = sums(x)
            held = own if held is None else add(held, own)
        if held is not None:
            yield packed({"all": held}, TaskContext.get().partitionId())

    states = rows.cells.mapInArrow(run, SCHEMA)
    size = sum(np.asarray(s).nbytes for s in sums(np.zeros((width, 1))))
    if size * rows.tasks > COLLECTED:
        return tree_merged(states, add)["all"]
    parts = [pickle.loads(r["state"]) for r in sorted(states.collect(), key=lambda r: r["node"])]
    out = parts[0]
    for part in parts[1:]:
        out = add(out, part)
    return out


# --- clusterings ---------------------------------------------------------------------------------


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of every column, the first of equally near ones."""
    near = centres @ x - (centres * centres).sum(axis=1)[:, None] / 2
    best, label = near[0].copy(), np.zeros(x.shape[1], np.int64)
    for j in range(1, len(centres)):
        label[near[j] > best] = j
        np.maximum(best, near[j], out=best)
    return label


def _member(label: np.ndarray, k: int) -> np.ndarray:
    return (label == np.arange(k)[:, None]).astype(float)


@dataclass(frozen=True)
class Centres:
    """k-means: a row belongs to the nearest centre."""

    centres: np.ndarray

    @property
    def k(self) -> int:
        return len(self.centres)

    def labels(self, x: np.ndarray) -> np.ndarray:
        return nearest(x, self.centres)

    def model(self, spark: SparkSession):
        jvm = spark._jvm
        parent = jvm.org.apache.spark.mllib.clustering.KMeansModel(_array(spark, jvm.org.apache.spark.mllib.linalg.Vector, [_vector(spark, c, "mllib") for c in self.centres]))
        return jvm.org.apache.spark.ml.clustering.KMeansModel("kmeans", parent)


def fit_centres(data: DataFrame, rows: Packed, estimator: KMeans) -> Centres:
    """Lloyd's rounds from Spark ML's first centres, until none moves further than the tolerance."""
    centres = np.array(estimator.copy({estimator.maxIter: 0}).fit(data).clusterCenters())
    for _ in range(estimator.getMaxIter()):
        at, k = centres, len(centres)

        def sums(x: np.ndarray) -> State:
            member = _member(nearest(x, at), k)
            return [member.sum(axis=1), member @ x.T]

        sizes, total = totals(rows, sums)
        full = sizes > 0
        moved = centres.copy()
        moved[full] = total[full] / sizes[full, None]
        done = (((moved - centres) ** 2).sum(axis=1) <= estimator.getTol() ** 2).all()
        centres = moved
        if done:
            break
    return Centres(centres)


@dataclass(frozen=True)
class Division:
    """A cluster of a bisecting k-means."""

    size: int
    centre: np.ndarray
    cost: float


@dataclass(frozen=True)
class Divisions:
    """Bisecting k-means: clusters by number, the children of ``i`` being ``2 i`` and ``2 i + 1``; a row goes down to the nearer child."""

    clusters: dict[int, Division]

    def leaves(self, index: int = 1) -> list[int]:
        """Numbers of the leaves in order. A cluster without a first child is one."""
        if 2 * index not in self.clusters:
            return [index]
        return [leaf for child in (2 * index, 2 * index + 1) if child in self.clusters for leaf in self.leaves(child)]

    @property
    def k(self) -> int:
        return len(self.leaves())

    def labels(self, x: np.ndarray) -> np.ndarray:
        place, leaves = np.ones(x.shape[1], np.int64), self.leaves()
        inner = [i for i in sorted(self.clusters) if 2 * i in self.clusters]
        _descend(x, place, inner, {i: c.centre for i, c in self.clusters.items()})
        order = np.argsort(leaves)
        return order[np.searchsorted(np.asarray(leaves)[order], place)]

    def model(self, spark: SparkSession):
        jvm, numbers = spark._jvm, {"leaf": 0, "inner": -1}
        node_class = jvm.org.apache.spark.mllib.clustering.ClusteringTreeNode

        def node(index: int):
            own = self.clusters[index]
            kind, step = ("inner", -1) if 2 * index in self.clusters else ("leaf", 1)
            number = numbers[kind]
            numbers[kind] += step
            below = [c for c in (2 * index, 2 * index + 1) if c in self.clusters] if kind == "inner" else []
            height = max((float(np.linalg.norm(own.centre - self.clusters[c].centre)) for c in below), default=0.0)
            children = _array(spark, node_class, [node(c) for c in below])
            centre = jvm.org.apache.spark.mllib.clustering.VectorWithNorm(_vector(spark, own.centre, "mllib"))
            return node_class(number, own.size, centre, own.cost, height, children)

        parent = jvm.org.apache.spark.mllib.clustering.BisectingKMeansModel(node(1))
        return jvm.org.apache.spark.ml.clustering.BisectingKMeansModel("bisecting", parent)


def _descend(x: np.ndarray, place: np.ndarray, divided: Sequence[int], centres: dict[int, np.ndarray]) -> None:
    """Rows of divided clusters go to the nearer child that there is, the first if both are equally near."""
    for index in divided:
        below = [c for c in (2 * index, 2 * index + 1) if c in centres]
        here = np.flatnonzero(place == index)
        if len(below) == 1:
            place[here] = below[0]
        elif below and len(here):
            first, second = centres[below[0]], centres[below[1]]
            apart = (second - first) @ x[:, here] - (second - first) @ (second + first) / 2
            place[here] = np.where(apart > 0, below[1], below[0])


def _summaries(rows: Packed, levels: list[tuple[list[int], dict[int, np.ndarray]]], wanted: list[int]) -> dict[int, Division]:
    """Size, centre and cost of the wanted clusters that have rows."""

    def sums(x: np.ndarray) -> State:
        place = np.ones(x.shape[1], np.int64)
        for divided, centres in levels:
            _descend(x, place, divided, centres)
        member = (place == np.array(wanted)[:, None]).astype(float)
        return [member.sum(axis=1), member @ x.T, member @ (x * x).sum(axis=0)]

    out = {}
    for index, size, total, squares in zip(wanted, *totals(rows, sums)):
        if size:
            centre = total / size
            out[index] = Division(int(size), centre, max(float(squares - size * (centre @ centre)), 0.0))
    return out


def fit_divisions(data: DataFrame, rows: Packed, estimator: BisectingKMeans) -> Divisions:
    """Clusters divided level by level. The first round of the first division is Spark ML's: centres of scaled columns are all but
    zero, so that rounding decides where it leads."""
    spark = data.sparkSession
    random = spark._jvm.java.util.Random(estimator.getSeed())
    parts = data.rdd.getNumPartitions()
    least, needed = estimator.getMinDivisibleClusterSize(), estimator.getK() - 1
    levels: list[tuple[list[int], dict[int, np.ndarray]]] = []
    active = _summaries(rows, levels, [1])
    least = np.ceil(least if least >= 1 else least * active[1].size)
    clusters = {}
    while active and needed > 0 and len(levels) < 62:
        clusters |= active
        # in the order in which Spark meets them, as each takes random numbers
        divided = [i for i in sorted(active, key=lambda i: (i % parts, i)) if active[i].size >= least and active[i].cost > EPSILON * active[i].size]
        if len(divided) > needed:
            divided = sorted(divided, key=lambda i: -active[i].size)[:needed]
        if not divided:
            active = {}
            break
        centres = {}
        for index in divided:
            noise = np.array([random.nextDouble() for _ in range(rows.width)])
            shift = 1e-4 * np.linalg.norm(active[index].centre) * noise
            centres |= {2 * index: active[index].centre - shift, 2 * index + 1: active[index].centre + shift}
        below = [c for i in divided for c in (2 * i, 2 * i + 1)]
        rounds = estimator.getMaxIter()
        if not levels and rounds > 1:
            first = estimator.copy({estimator.k: 2, estimator.maxIter: 1}).fit(data).clusterCenters()
            centres, rounds = dict(zip(below, map(np.array, first))), rounds - 1
        for _ in range(rounds):
            found = _summaries(rows, [*levels, (divided, centres)], below)
            centres = {i: s.centre for i, s in found.items()}
        levels.append((divided, centres))
        active, needed = found, needed - len(divided)
    return Divisions(clusters | active)


@dataclass(frozen=True)
class Mixture:
    """Gaussians with weights: a row belongs to the one that is most probable."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray

    @property
    def k(self) -> int:
        return len(self.weights)

    def forms(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Roots of the inverse covariances, the means by these, and the logarithms of the densities at the means."""
        roots, constants = [], []
        for covariance in self.covariances:
            values, vectors = np.linalg.eigh(covariance)
            kept = values > EPSILON * values.max() * len(values)
            if not kept.any():
                raise ValueError("a covariance matrix is zero")
            roots.append(np.where(kept, 1 / np.sqrt(np.where(kept, values, 1)), 0)[:, None] * vectors.T)
            constants.append(-0.5 * (len(values) * np.log(2 * np.pi) + np.log(values[kept]).sum()))
        roots = np.array(roots)
        return roots, np.einsum("kij,kj->ki", roots, self.means), np.array(constants)

    def labels(self, x: np.ndarray) -> np.ndarray:
        shares = densities(x, self.weights, *self.forms())
        best, label = shares[0].copy(), np.zeros(x.shape[1], np.int64)
        for j in range(1, len(shares)):
            label[shares[j] > best] = j
            np.maximum(best, shares[j], out=best)
        return label

    def model(self, spark: SparkSession):
        jvm = spark._jvm
        gaussian = jvm.org.apache.spark.ml.stat.distribution.MultivariateGaussian
        d = self.means.shape[1]
        matrices = [jvm.org.apache.spark.ml.linalg.Matrices.dense(d, d, _array(spark, jvm.double, c.ravel())) for c in self.covariances]
        gaussians = [gaussian(_vector(spark, m, "ml"), c) for m, c in zip(self.means, matrices)]
        return jvm.org.apache.spark.ml.clustering.GaussianMixtureModel("mixture", _array(spark, jvm.double, self.weights), _array(spark, gaussian, gaussians))


def densities(x: np.ndarray, weights: np.ndarray, roots: np.ndarray, shifts: np.ndarray, constants: np.ndarray) -> np.ndarray:
    """Weighted densities of all columns, a row per Gaussian."""
    out = np.empty((len(weights), x.shape[1]))
    for j, (root, shift) in enumerate(zip(roots, shifts)):
        apart = root @ x
        apart -= shift[:, None]
        np.multiply(apart, apart, out=apart)
        np.multiply(apart.sum(axis=0), -0.5, out=out[j])
    out += constants[:, None]
    np.exp(out, out=out)
    out *= weights[:, None]
    out += EPSILON
    return out


def fit_mixture(data: DataFrame, rows: Packed, estimator: GaussianMixture) -> Mixture:
    """Rounds of expectation and maximisation from Spark ML's first Gaussians, until the likelihood stays."""
    begin = estimator.copy({estimator.maxIter: 0}).fit(data)
    gaussians = begin.gaussians
    fit = Mixture(np.array(begin.weights), np.array([g.mean.toArray() for g in gaussians]), np.array([g.cov.toArray() for g in gaussians]))
    likelihood, before = -np.finfo(float).max, 0.0
    for _ in range(estimator.getMaxIter()):
        if abs(likelihood - before) <= estimator.getTol():
            break
        weights, forms = fit.weights, fit.forms()

        def sums(x: np.ndarray) -> State:
            shares = densities(x, weights, *forms)
            total = shares.sum(axis=0)
            shares /= total
            return [np.log(total).sum(), shares.sum(axis=1), shares @ x.T, np.stack([(x * s) @ x.T for s in shares])]

        before = likelihood
        likelihood, sizes, first, second = totals(rows, sums)
        means = first / sizes[:, None]
        fit = Mixture(sizes / sizes.sum(), means, second / sizes[:, None, None] - means[:, :, None] * means[:, None, :])
    return fit


Fit = Centres | Divisions | Mixture


def fit(data: DataFrame, rows: Packed, estimator: KMeans | BisectingKMeans | GaussianMixture) -> Fit:
    """``estimator`` on the vectors of ``data``, which ``rows`` holds packed."""
    kinds = {KMeans: fit_centres, BisectingKMeans: fit_divisions, GaussianMixture: fit_mixture}
    return kinds[type(estimator)](data, rows, estimator)


def spark_model(spark: SparkSession, found: Fit, estimator: KMeans | BisectingKMeans | GaussianMixture) -> Model:
    """The model that the estimator would have returned."""
    return estimator._copyValues(estimator._create_model(found.model(spark)))


def _array(spark: SparkSession, kind, values) -> object:
    out = spark.sparkContext._gateway.new_array(kind, len(values))
    for i, v in enumerate(values):
        out[i] = float(v) if isinstance(v, np.floating) else v
    return out


def _vector(spark: SparkSession, values: np.ndarray, package: str):
    return getattr(spark._jvm.org.apache.spark, package).linalg.Vectors.dense(_array(spark, spark._jvm.double, values))


# --- how good they are ---------------------------------------------------------------------------


def silhouettes(rows: Packed, fits: Sequence[Fit]) -> list[float | None]:
    """Mean silhouette of each clustering by squared distances; None for one that puts all rows into one cluster.

    Two passes for all of them: sizes and sums of the clusters, then the coefficients that follow from these.
    """

    def stats(x: np.ndarray) -> State:
        squares, out = (x * x).sum(axis=0), []
        for found in fits:
            member = _member(found.labels(x), found.k)
            out += [member.sum(axis=1), member @ x.T, member @ squares]
        return out

    known = totals(rows, stats)
    full = [known[3 * i] > 0 for i in range(len(fits))]

    def coefficients(x: np.ndarray) -> State:
        squares, out = (x * x).sum(axis=0), []
        for i, found in enumerate(fits):
            sizes, total, norms = (known[3 * i + j][full[i]] for j in range(3))
            if len(sizes) < 2:
                out.append(0.0)
                continue
            # numbers of the clusters that have rows
            own = (np.cumsum(full[i]) - 1)[found.labels(x)]
            apart = squares + (norms / sizes)[:, None] - 2 * (total / sizes[:, None]) @ x
            every = np.arange(x.shape[1])
            size = sizes[own]
            inner = np.where(size == 1, 0.0, apart[own, every] * size / np.maximum(size - 1, 1))
            apart[own, every] = np.inf
            outer = apart.min(axis=0)
            low, high = np.minimum(inner, outer), np.maximum(inner, outer)
            score = np.where(low == high, 0.0, 1 - low / np.where(high == 0, 1, high))
            out.append(float(np.where(size == 1, 0.0, np.where(inner < outer, score, -score)).sum()))
        return out

    means = totals(rows, coefficients)
    count = known[0].sum()
    return [float(m / count) if f.sum() > 1 else None for m, f in zip(means, full)]
