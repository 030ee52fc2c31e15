"""Means and cross products of columns from one pass over the rows, in tiles, and what follows from them without another pass.

A task turns its Arrow batches into matrices and adds up, per group of rows and per tile of columns, the products of values centred on
the mean so far. Two such states are merged exactly (the difference of the means enters as one more product), in a tree on the
executors. The driver holds matrices of columns by columns, whatever the number of rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame

from ..functions.missing import known_double
from .quality import skip_invalid_rows
from .states import FAN_IN, task_states, tree_merged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Columns on either side of a tile.
TILE = 512
#: Rows made into a matrix at a time.
ROWS = 4096
#: Pivots below this share of a column's own variance count as zero when sweeping.
TOLERANCE = 1e-10


@dataclass
class Gram:
    """Number of rows, means of the columns, and sums of products of centred columns."""

    n: int
    mean: np.ndarray
    products: np.ndarray

    def covariance(self, sample: bool = True) -> np.ndarray:
        return self.products / max(self.n - sample, 1)

    def part(self, places: Sequence[int]) -> Gram:
        """Some of the columns only."""
        at = np.asarray(places)
        return Gram(self.n, self.mean[at], self.products[np.ix_(at, at)])

    def with_rows_of(self, other: Gram) -> Gram:
        """The state of both sets of rows."""
        if not self.n or not other.n:
            return self if self.n else other
        n, mean, _, products = merged((self.n, self.mean, self.mean, self.products), (other.n, other.mean, other.mean, other.products))
        return Gram(n, mean, products)


#: What travels: number of rows, means of a tile's rows and columns, products.
State = tuple[int, np.ndarray, np.ndarray, np.ndarray]


def merged(a: State, b: State) -> State:
    """The state of both sets of rows."""
    (n, rows, columns, products), (more, rows_b, columns_b, products_b) = a, b
    down, across = rows_b - rows, columns_b - columns
    share = more / (n + more)
    return n + more, rows + down * share, columns + across * share, products + products_b + np.outer(down, across) * (n * share)


def block_state(x: np.ndarray, y: np.ndarray | None = None) -> State:
    y = x if y is None else y
    rows, columns = x.mean(axis=0), y.mean(axis=0)
    return len(x), rows, columns, (x - rows).T @ (y - columns)


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)])


def tile_states(width: int, grouped: bool):
    """What a task makes of its rows: a state per group and tile, the group in the last column."""
    tiles = [(i, j) for i in range(0, width, TILE) for j in range(i, width, TILE)]

    def run(batches: Iterator[pa.RecordBatch]) -> dict[str, State]:
        held: dict[str, State] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                some = batch.slice(start, ROWS)
                x = _matrix(some, width)
                groups = some.column(width).to_numpy(zero_copy_only=False) if grouped else np.zeros(len(x), np.int64)
                for group in np.unique(groups):
                    own = x[groups == group]
                    for i, j in tiles:
                        state = block_state(own[:, i : i + TILE], own[:, j : j + TILE] if j != i else None)
                        key = f"{group}/{i}/{j}"
                        held[key] = merged(held[key], state) if key in held else state
        return held

    return run


def assembled(tiles: dict[str, State], width: int) -> dict[int, Gram]:
    """Whole matrices of their tiles, by group."""
    out: dict[int, Gram] = {}
    for key, (n, _, columns, products) in tiles.items():
        group, i, j = map(int, key.split("/"))
        whole = out.setdefault(group, Gram(n, np.zeros(width), np.zeros((width, width))))
        down, across = products.shape
        whole.mean[j : j + across] = columns
        whole.products[i : i + down, j : j + across] = products
        whole.products[j : j + across, i : i + down] = products.T
    return out


def tiles_of(df: DataFrame, columns: Sequence[str], group: Column | None = None) -> DataFrame:
    """The states of all tasks: rows without a missing value in ``columns``, read once."""
    valid = skip_invalid_rows(df, columns)
    values = [known_double(df, c).alias(f"c{i}") for i, c in enumerate(columns)]
    rows = valid.select(*values, *([group.cast("long").alias("g")] if group is not None else []))
    if group is not None:
        rows = rows.where("g IS NOT NULL")
    return task_states(rows, tile_states(len(columns), group is not None))


def grams(df: DataFrame, columns: Sequence[str], group: Column, fan_in: int = FAN_IN) -> dict[int, Gram]:
    """A state per value of ``group``, of which there must be few; rows without one are left out."""
    return assembled(tree_merged(tiles_of(df, columns, group), merged, fan_in), len(columns))


def gram(df: DataFrame, columns: Sequence[str], fan_in: int = FAN_IN) -> Gram:
    """The state of all complete rows."""
    width = len(columns)
    found = assembled(tree_merged(tiles_of(df, columns), merged, fan_in), width)
    return found.get(0) or Gram(0, np.zeros(width), np.zeros((width, width)))


# --- least squares -------------------------------------------------------------------------------


def sweep(matrix: np.ndarray, k: int) -> np.ndarray:
    """Column ``k`` becomes an input of the regression that the matrix stands for, or, if it is one, no longer is."""
    pivot = matrix[k, k]
    row, column = matrix[k] / pivot, matrix[:, k].copy()
    out = matrix - np.outer(column, row)
    out[k], out[:, k] = row, -column / pivot
    out[k, k] = 1 / pivot
    return out


def elimination_order(state: Gram, keep: int) -> tuple[list[int], list[int]]:
    """Features (all columns but the last, which is the label) in the order they are dropped, and those left.

    The label is regressed on all standardised features; the one with the smallest coefficient is swept out, and so on. Columns that the
    ones before them determine, and constant ones, have no coefficient and go first.
    """
    size = len(state.mean) - 1
    spread = np.sqrt(np.diag(state.products))
    live = np.where(spread > 0, spread, 1)
    matrix = state.products / np.outer(live, live)
    entered = []
    for k in range(size):
        if matrix[k, k] > TOLERANCE:
            matrix = sweep(matrix, k)
            entered.append(k)
    gone: list[int] = []
    out = [k for k in range(size) if k not in entered]
    while size - len(gone) > max(1, keep):
        if out:
            gone.append(out.pop(0))
            continue
        weakest = min(entered, key=lambda k: (abs(matrix[k, size]), k))
        matrix = sweep(matrix, weakest)
        entered.remove(weakest)
        gone.append(weakest)
    return gone, [k for k in range(size) if k not in gone]


def ridge(state: Gram, reg: float) -> tuple[float, np.ndarray]:
    """Intercept and coefficients of the last column on the others, the penalty on standardised ones relative to the label's deviation."""
    covariance = state.covariance(sample=False)
    spread = np.sqrt(np.diag(covariance))
    size = len(spread) - 1
    live = [k for k in range(size) if spread[k] > 0]
    coefficients = np.zeros(size)
    if live and spread[size] > 0:
        scaled = covariance / np.outer(np.where(spread > 0, spread, 1), np.where(spread > 0, spread, 1))
        left = scaled[np.ix_(live, live)] + np.eye(len(live)) * reg / spread[size]
        solved = np.linalg.lstsq(left, scaled[live, size], rcond=None)[0]
        coefficients[live] = solved * spread[size] / spread[live]
    return float(state.mean[size] - coefficients @ state.mean[:size]), coefficients


def squared_error(state: Gram, intercept: float, coefficients: np.ndarray) -> float:
    """Sum of squared residuals of the state's rows under a linear model."""
    weights = np.append(-coefficients, 1.0)
    middle = float(weights @ state.mean) - intercept
    return max(0.0, float(weights @ state.products @ weights)) + state.n * middle * middle
