"""Whitening of embeddings by an eigendecomposition that is kept up to date vector by vector.

A task keeps the eigenvalues and eigenvectors of the scatter of the vectors it has seen. A new vector, centred on the running mean, is a
rank-one update: the eigenvalues become the roots of a secular equation between the old ones, the eigenvectors follow from them.
Components that the update does not touch, and equal eigenvalues, are deflated first. Spectra of tasks are merged in a tree of bounded fan-in:
the second one's components are added to the first as successive rank-one updates, and so is the difference of the means.

Rounding that has piled up is removed at the end: a pass over the vectors projects the covariance onto the merged basis
(Rayleigh-Ritz), and the small matrix that it leaves is diagonalised. Sums of the vectors are whole numbers throughout, so means are as exact as
a double can be, and everything is centred before it is multiplied. The driver holds matrices of the vectors' width, never vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglass.sources.scratch import materialize

from .reduce_tree import FAN_IN, State, task_states, tree_merged

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Largest absolute whole number a component may become, before the offset.
LARGEST = 1 << 40
EPS = np.finfo(np.float64).eps


def secular_roots(poles: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(z2 / (poles - x))`` for rising, distinct ``poles`` and positive ``z2``.

    There is one root right of each pole. It is given as the number of the pole next to it and the distance from there, which
    keeps differences to poles exact. All roots are refined together: each step replaces the poles on either side by one pole that has the
    same value and slope, and falls back to halving the bracket when the step leaves it.
    """
    n = len(poles)
    # Slightly beyond the last root, which may be all of the update right of its pole.
    end = poles[-1] + z2.sum() * (1 + 8 * EPS)
    right = np.append(poles[1:], end)
    middle = (poles + right) / 2
    value = 1 + (z2 / (poles - middle[:, None])).sum(axis=1)
    near = np.arange(n) + (value <= 0)
    near[-1] = n - 1
    delta = poles - poles[near][:, None]
    half = (right - poles) / 2
    low, high = np.where(value > 0, 0.0, -half), np.where(value > 0, half, 0.0)
    if value[-1] > 0:
        low[-1], high[-1] = 0.0, half[-1]
    else:
        low[-1], high[-1] = half[-1], z2.sum() * (1 + 8 * EPS)
    x = (low + high) / 2
    last = np.arange(n) == n - 1
    left_side = np.tri(n)
    for _ in range(80):
        gaps = delta - x[:, None]
        terms = z2 / gaps
        total, below = terms.sum(axis=1), np.einsum("ij,ij->i", terms, left_side)
        f = 1 + total
        # Terms of poles up to the root are negative, the others positive.
        open_ = np.abs(f) > EPS * (n + 4) * (1 + total - 2 * below)
        if not open_.any():
            break
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        slopes = terms / gaps
        own = gaps.diagonal()
        psi = np.einsum("ij,ij->i", slopes, left_side)
        phi = slopes.sum(axis=1) - psi
        # The pole right of a root; for the last root there is none.
        other = np.append(gaps.diagonal(1), 0.0)
        with np.errstate(all="ignore"):
            c = f - own * psi - other * phi
            a = (own + other) * f - own * other * (psi + phi)
            b = own * other * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step = np.where(last, own * f / (f - own * psi), step)
            new = x + step
        inside = np.isfinite(new) & (new > low) & (new < high)
        new = np.where(open_, np.where(inside, new, (low + high) / 2), x)
        if (np.abs(new - x) <= EPS * np.abs(x)).all():
            break
        x = new
    return near, x


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors (columns) after adding ``v v^T``."""
    z = vectors.T @ v
    size = float(z @ z)
    if size == 0:
        return values, vectors
    scale = max(float(np.abs(values).max()), size)
    # Equal eigenvalues: a reflection of their vectors leaves one that the update touches.
    start = 0
    gap = 8 * EPS * scale
    if (np.diff(values) <= gap).any():
        vectors = vectors.copy()
        while start < len(values):
            stop = int(np.searchsorted(values, values[start] + gap, side="right"))
            if stop - start > 1:
                part = z[start:stop]
                norm = float(np.linalg.norm(part))
                if norm > 0:
                    mirror = part.copy()
                    mirror[-1] += norm if mirror[-1] >= 0 else -norm
                    mirror /= np.linalg.norm(mirror)
                    vectors[:, start:stop] -= 2 * np.outer(vectors[:, start:stop] @ mirror, mirror)
                    z[start : stop - 1], z[stop - 1] = 0, -norm if part[-1] >= 0 else norm
            start = stop
    live = np.flatnonzero(np.abs(z) * np.sqrt(size) > 8 * EPS * scale)
    if not len(live):
        return values, vectors
    poles, z2 = values[live], z[live] ** 2
    near, x = secular_roots(poles, z2)
    # Differences of new and old eigenvalues, and from them the update they belong to exactly, so that the vectors are orthogonal.
    apart = (poles[near][:, None] - poles) + x[:, None]
    ratio = poles[:, None] - poles
    np.fill_diagonal(ratio, 1)
    # Row i: the roots' distances to pole i, each over that of a pole it interlaces with.
    tops = np.abs(apart.T)
    # Roots below the pole go with the poles below, roots above with the poles above; the last root has no partner.
    below = np.tri(len(live), k=-1, dtype=bool)
    partner = np.where(below, np.abs(ratio), np.hstack([np.abs(ratio[:, 1:]), np.ones((len(live), 1))]))
    whole = (tops / partner).prod(axis=1)
    exact = np.sqrt(whole) * np.sign(z[live])
    turn = (exact / apart).T
    turn /= np.linalg.norm(turn, axis=0)
    values = values.copy()
    values[live] = poles[near] + x
    vectors = vectors.copy() if len(live) < len(values) else vectors
    new = vectors[:, live] @ turn
    if len(live) == len(values):
        return values, new
    vectors[:, live] = new
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def spectrum_of(rows: Iterator[np.ndarray]) -> State | None:
    """Number, sums and spectrum of the scatter of whole-number vectors."""
    n, sums, values, vectors = 0, None, None, None
    for block in rows:
        if sums is None and len(block):
            width = block.shape[1]
            sums, values, vectors = np.zeros(width, np.int64), np.zeros(width), np.eye(width)
        for row in block:
            if n:
                values, vectors = rank_one(values, vectors, (row - sums / n) * np.sqrt(n / (n + 1)))
            n, sums = n + 1, sums + row
    return None if sums is None else {"n": n, "sums": sums, "values": values, "vectors": vectors}


def both_spectra(a: State, b: State) -> State:
    """The spectrum of two sets of vectors together."""
    values, vectors = a["values"], a["vectors"]
    for value, column in zip(b["values"], b["vectors"].T):
        if value > 0:
            values, vectors = rank_one(values, vectors, np.sqrt(value) * column)
    share = a["n"] / (a["n"] + b["n"]) * b["n"]
    apart = a["sums"] / a["n"] - b["sums"] / b["n"]
    values, vectors = rank_one(values, vectors, np.sqrt(share) * apart)
    return {"n": a["n"] + b["n"], "sums": a["sums"] + b["sums"], "values": values, "vectors": vectors}


def _matrix(batch: pa.RecordBatch, name: str = "whole") -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _added(a: State, b: State) -> State:
    return {"products": a["products"] + b["products"]}


def products(fit: DataFrame, mean: np.ndarray, basis: np.ndarray, fan_in: int = FAN_IN) -> np.ndarray:
    """Sum over ``fit`` of the outer products of vectors that are centred, then projected on ``basis``."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> State | None:
        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                y = (_matrix(batch.slice(start, 4096)) - mean) @ basis
                total = y.T @ y if total is None else total + y.T @ y
        return None if total is None else {"products": total}

    return tree_merged(task_states(fit, of_task), _added, fan_in)["products"]


class Whitening:
    """What is fitted: number, sums (whole numbers), components as columns, their variances, the trace, and how far whitened data are from white."""

    def __init__(self, n: int, sums: np.ndarray, components: np.ndarray, variances: np.ndarray, trace: float, error: float):
        self.n, self.sums, self.components, self.variances, self.trace, self.error = n, sums, components, variances, trace, error

    @property
    def turn(self) -> np.ndarray:
        return self.components / np.sqrt(self.variances)


def fit_whitening(fit: DataFrame, components: int = COMPONENTS, fan_in: int = FAN_IN) -> Whitening | None:
    """The leading components of a written table of distinct vectors ``whole``; None if it is empty.

    Directions without variance have no component, so there may be fewer than ``components``, for a single vector none.
    """

    def of_task(batches: Iterator[pa.RecordBatch]) -> State | None:
        return spectrum_of(_matrix(b) for b in batches)

    state = tree_merged(task_states(fit, of_task), both_spectra, fan_in)
    if state is None:
        return None
    n, sums, mean = state["n"], state["sums"], state["sums"] / state["n"]
    basis, _ = np.linalg.qr(state["vectors"])
    projected = products(fit, mean, basis, fan_in) / n
    variances, turn = np.linalg.eigh(projected)
    variances, found = variances[::-1], (basis @ turn)[:, ::-1]
    trace = float(np.trace(projected))
    kept = [i for i in range(min(components, len(variances))) if variances[i] > len(variances) * EPS * max(variances[0], 0)]
    variances, found = variances[kept], found[:, kept]
    # Either sign would do; the largest entry is positive.
    found = found * np.sign(found[np.abs(found).argmax(axis=0), np.arange(len(kept))])
    model = Whitening(n, sums, found, variances, trace, 0.0)
    if kept:
        model.error = float(np.abs(products(fit, mean, model.turn, fan_in) / n - np.eye(len(kept))).max())
    return model


def deviations(rows: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Squared distance of each vector times n from the sums, exact; null where a long cannot hold it."""
    largest = max(int(np.abs(rows).max(initial=0)), 1) * n + int(np.abs(sums).max())
    if largest * largest * rows.shape[1] < 1 << 62:
        return ((n * rows - sums) ** 2).sum(axis=1).tolist()
    exact = (((n * rows.astype(object)) - sums.astype(object)) ** 2).sum(axis=1)
    return [int(d) if d < 1 << 63 else None for d in exact]


def _whole(v: Column) -> Column:
    big = F.lit(float(LARGEST))
    entry = lambda c: F.when(F.abs(c.cast("double") * SCALE) <= big, F.floor(c.cast("double") * SCALE)).otherwise(
        F.raise_error(F.lit(f"an entry is larger than {LARGEST} after scaling")).cast("long")
    )
    return F.transform(v, entry)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, fan_in: int = FAN_IN) -> DataFrame:
    """A row per vector and component: id, component (from 1), n, deviation, whitened, explained, identity_error.

    An entry ``c`` counts as ``floor(64 * c) + 1000000``. The fit uses every distinct vector of whole numbers once. Vectors that are null or
    empty, or hold a null or non-finite entry, are left out, and so are those of another length than the most frequent one (of equally
    frequent ones the longest). Directions without variance have no component: a table with one distinct vector, like an empty
    one, gives no rows. Ids may be null or repeat. ``deviation`` is null where a long cannot hold it. Other columns are not read.
    """
    v = F.col(f"`{vector_col}`")
    good = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # The offset cancels in everything that is centred, so it is left out until the end, where it would only cost digits.
    rows = vectors.where(good).select(F.col(f"`{id_col}`").cast("long").alias("id"), _whole(v).alias("whole"))
    rows = materialize(rows, "whole-vectors")
    width = rows.groupBy(F.size("whole").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    names = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    kind = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if width is not None:
        rows = rows.where(F.size("whole") == width.width)
        model = fit_whitening(materialize(rows.select("whole").distinct(), "fit-list"), components, fan_in)
    if width is None or not len(model.variances):
        return vectors.sparkSession.createDataFrame([], kind).withColumnRenamed("id", id_col)
    mean, turn, count = model.sums / model.n, model.turn, len(model.variances)
    shares = model.variances / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                some = batch.slice(start, 1024)
                whole = _matrix(some)
                times = pa.array(np.repeat(np.arange(len(whole)), count))
                columns = [
                    some.column("id").take(times), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(whole))), pa.array(np.full(len(times), model.n, np.int64)),
                    pa.array(deviations(whole, model.n, model.sums), pa.int64()).take(times), pa.array(((whole - mean) @ turn).ravel()),
                    pa.array(np.tile(shares, len(whole))), pa.array(np.full(len(times), model.error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, kind).withColumnRenamed("id", id_col)
