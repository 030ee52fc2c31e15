"""What a task works out about pairs of columns: moments over pairwise complete rows, and weighted counts of ordered pairs.

Everything here runs on Arrow batches and on groups of bounded size; rows are dealt out and results added up by Spark.
The functions are pickled by value: workers need no package for them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Columns on either side of a tile.
TILE = 512
#: Rows made into a matrix at a time.
ROWS = 4096
#: A pair whose spread is a smaller share of its squares is worked out from its own rows.
CANCELLED = 1e-4

#: Per pair of columns: rows, both means, both sums of squares and the sum of products of centred values, rows with an infinite value.
Moments = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def merged_moments(a: Moments, b: Moments) -> Moments:
    """The moments of both sets of rows."""
    n, more = a[0], b[0]
    total = n + more
    share = more / np.maximum(total, 1)
    # the mean of no rows is none: the other's counts
    mean_x, mean_y = (np.where(n > 0, a[i], b[i]) for i in (1, 2))
    down, across = (np.where(more > 0, b[i] - m, 0.0) for i, m in ((1, mean_x), (2, mean_y)))
    weight = n * share
    with np.errstate(over="ignore", invalid="ignore"):
        return (
            total, mean_x + down * share, mean_y + across * share, a[3] + b[3] + down * down * weight, a[4] + b[4] + across * across * weight,
            a[5] + b[5] + down * across * weight, a[6] + b[6],
        )


def _centred(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Known finite values less their mean and 0 elsewhere, the mean, what is known, and what is infinite. Equal values become exact zeros."""
    known, endless = ~np.isnan(values), np.isinf(values)
    finite = known & ~endless
    first = values[np.argmax(finite, axis=0), np.arange(values.shape[1])]
    first = np.where(finite.any(axis=0), first, 0.0)
    apart = np.where(finite, values - first, 0.0)
    mean = apart.sum(axis=0) / np.maximum(finite.sum(axis=0), 1)
    return np.where(finite, apart - mean, 0.0), first + mean, known, endless


def block_moments(x: np.ndarray, y: np.ndarray) -> Moments:
    """Moments of every column of ``x`` with every column of ``y``; NaN is missing."""
    with np.errstate(over="ignore", invalid="ignore"):
        (a, shift_a, known_a, endless_a), (b, shift_b, known_b, endless_b) = _centred(x), _centred(y)
        ka, kb = known_a.astype(float), known_b.astype(float)
        n = ka.T @ kb
        least = np.maximum(n, 1)
        mean_a, mean_b = (a.T @ kb) / least, (ka.T @ b) / least
        square_a, square_b = (a * a).T @ kb, ka.T @ (b * b)
        spread_a, spread_b = square_a - mean_a * mean_a * n, square_b - mean_b * mean_b * n
        products = a.T @ b - mean_a * mean_b * n
        endless = endless_a.astype(float).T @ kb + ka.T @ endless_b.astype(float)
        # where most of the sums cancel, the pair's own rows are centred once more
        bad = (spread_a <= CANCELLED * square_a) & (square_a > 0) | (spread_b <= CANCELLED * square_b) & (square_b > 0)
        for i, j in zip(*np.nonzero(bad)):
            both = known_a[:, i] & known_b[:, j]
            (u, mu, *_), (v, mv, *_) = _centred(a[both, i : i + 1]), _centred(b[both, j : j + 1])
            mean_a[i, j], mean_b[i, j] = mu[0], mv[0]
            spread_a[i, j], spread_b[i, j], products[i, j] = (u * u).sum(), (v * v).sum(), (u * v).sum()
    return n, mean_a + shift_a[:, None], mean_b + shift_b[None, :], spread_a, spread_b, products, endless


def tile_moments(width: int, lefts: Sequence[int], rights: Sequence[int], wanted: set[tuple[int, int]]):
    """What a task makes of its rows of ``width`` columns: moments per tile ``i/j`` of left and right columns that holds a wanted pair of places."""
    tiles = sorted({(a // TILE * TILE, b // TILE * TILE) for a, b in wanted})

    def run(batches: Iterator[pa.RecordBatch]) -> dict[str, Moments]:
        held: dict[str, Moments] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                some = batch.slice(start, ROWS)
                rows = np.column_stack([some.column(c).to_numpy(zero_copy_only=False).astype(float) for c in range(width)])
                for i, j in tiles:
                    state = block_moments(rows[:, lefts[i : i + TILE]], rows[:, rights[j : j + TILE]])
                    key = f"{i}/{j}"
                    held[key] = merged_moments(held[key], state) if key in held else state
        return held

    return run


def correlation(state: Moments, i: int, j: int) -> float:
    """Pearson's r of a pair, 0 where it is undefined."""
    n, _, _, spread_x, spread_y, products, endless = (float(part[i, j]) for part in state)
    if not n or endless:
        return 0.0
    with np.errstate(all="ignore"):
        scale = np.sqrt(spread_x / n) * np.sqrt(spread_y / n)
        r = products / n / scale if scale else 0.0
    return 0.0 if np.isnan(r) else float(r)


# --- ordered pairs -------------------------------------------------------------------------------


def concordant(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> float:
    """Sum of ``n_i n_j`` over the pairs of rows ordered strictly alike in ``a`` and ``b``.

    Along ``a`` (equal ones by falling ``b``), two ranks of ``b`` first differ at one bit; so per bit and value of the bits above it,
    each row with the bit set meets the rows before it without.
    """
    if len(a) < 2:
        return 0.0
    rank = np.unique(b, return_inverse=True)[1].astype(np.int64)
    order = np.lexsort((-rank, a))
    rank, n = rank[order], n[order].astype(np.int64)
    # products of counts fit 64 bits up to some 3e9 rows
    exact = int(n.sum()) < 3_000_000_000
    total: float = 0
    for bit in range(int(rank.max()).bit_length() - 1, -1, -1):
        set_ = (rank >> bit) & 1
        above = rank >> (bit + 1)
        unset = np.cumsum(np.where(set_ == 0, n, 0))
        starts = np.flatnonzero(np.append(True, above[1:] != above[:-1]))
        before = np.append(0, unset)[starts]
        met = unset - np.repeat(before, np.diff(np.append(starts, len(rank))))
        rows = set_ == 1
        total += int(n[rows] @ met[rows]) if exact else float(n[rows].astype(float) @ met[rows].astype(float))
        # stable, so that rows stay in the order of a within equal bits
        order = np.argsort(rank >> bit, kind="stable")
        rank, n = rank[order], n[order]
    return float(total)


#: Cut points of x and of y, and the numbers of the parts that are one value.
Cuts = tuple[np.ndarray, frozenset[int], np.ndarray, frozenset[int]]


def cut_points(values: Sequence[float] | None) -> tuple[np.ndarray, frozenset[int]]:
    """Part bounds from quantiles, and which parts are one value: a value found twice gets a part of its own."""
    found, times = np.unique(np.asarray(values if values is not None else [], float), return_counts=True)
    alone = found[times > 1]
    bounds = np.unique(np.concatenate([found, np.nextafter(alone, np.inf)]))
    return bounds, frozenset(int(p) for p in np.searchsorted(bounds, alone, "right"))


PLACED = "pair_id int, x double, y double, n long, px int, py int, x_alone boolean, y_alone boolean"


def placed(cuts: dict[int, Cuts]):
    """Rows (pair_id, x, y, n) with the numbers of their parts along x and y."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, x, y, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("pair_id", "x", "y", "n"))
            parts = [np.zeros(len(pair), np.int32), np.zeros(len(pair), np.int32), np.zeros(len(pair), bool), np.zeros(len(pair), bool)]
            for one in np.unique(pair).tolist():
                own = pair == one
                bounds_x, alone_x, bounds_y, alone_y = cuts[one]
                for k, (values, bounds, alone) in enumerate(((x, bounds_x, alone_x), (y, bounds_y, alone_y))):
                    part = np.searchsorted(bounds, values[own], "right")
                    parts[k][own], parts[k + 2][own] = part, np.isin(part, list(alone))
            columns = [pa.array(c) for c in (pair.astype(np.int32), x, y, n, *parts)]
            yield pa.RecordBatch.from_arrays(columns, names=["pair_id", "x", "y", "n", "px", "py", "x_alone", "y_alone"])

    return run


MET = "pair_id int, conc double"


def group_concordant(a: str, b: str):
    """``(pair_id, conc)`` of a group of rows."""

    def run(rows: pa.Table) -> pa.Table:
        met = concordant(*(rows.column(c).to_numpy() for c in (a, b, "n")))
        return pa.table({"pair_id": pa.array([rows.column("pair_id")[0].as_py()], pa.int32()), "conc": pa.array([met], pa.float64())})

    return run
