"""Embedding near-duplicates by spherical-cap filters.

Filter directions form a random product code: after a random rotation a vector is cut into two halves, and a direction is a
pair of codewords, one of each half. A vector belongs to the filters whose caps it lies in, that is whose directions it exceeds a
threshold with; they are listed from the sorted scores of either half, without looking at the other directions. Vectors of one label
that share a filter meet in a bucket and are verified by their cosine.

The threshold is the vector's own, so that every vector is in the same number of caps, and this number is measured: pairs with just the
cosine asked for are drawn in the width at hand, and all but ``MISSED`` of them have a filter in common. Narrow vectors are padded with
zeros before the rotation: the halves of a vector of four components can be of very different lengths, and then no
direction is near it. Scores are compared with a tolerance, so parallel vectors always meet.

The number of filters grows with the largest label, so that buckets of unlike vectors keep their size. A bucket of many
alike vectors is cut into pages, and pairs of pages are tasks; a pair of vectors is counted only in its first common
bucket, and what leaves a task are counts and a spanning forest, never the pairs. Equal vectors are one point.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglass.sources.scratch import materialize

from .common import partitions
from .components import components
from .ngram_join import _column, _runs

THRESHOLD = 0.98
#: Share of the pairs just at the threshold that may have no filter in common, and pairs drawn to measure it.
MISSED, DRAWN = 0.0002, 16_384
#: Filters of a vector that are tried first, and that the number of directions is chosen for.
FILTERS = 12
#: Components that vectors are padded to, and differences of scores that come from rounding.
LEAST_WIDTH, TOLERANCE = 32, 1e-9
#: Unlike vectors of a bucket on average.
BUCKET = 16
PAGE = 1024
#: Large buckets are broadcast up to this number and joined by a shuffle beyond it.
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class Code:
    """Number of codewords per half and of the filters of a vector."""

    words: int
    filters: int


def code_for(vectors: int, width: int, threshold: float = THRESHOLD) -> Code:
    """The code for at most so many vectors of a label."""
    words = int(np.ceil(np.sqrt(max(4096, vectors * FILTERS // BUCKET))))
    return Code(words, _filters(words, width, threshold))


def pairs_at(threshold: float, width: int, count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of random unit vectors with this cosine (of one component: equal ones)."""
    first, other = np.random.Generator(np.random.PCG64([seed, width])).standard_normal((2, count, width))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    other -= (first * other).sum(axis=1, keepdims=True) * first
    length = np.linalg.norm(other, axis=1, keepdims=True)
    second = threshold * first + np.sqrt(max(0.0, 1 - threshold**2)) * np.where(length > 1e-9, other / np.where(length > 1e-9, length, 1), 0)
    return first, second / np.linalg.norm(second, axis=1, keepdims=True)


@cache
def _filters(words: int, width: int, threshold: float) -> int:
    """Filters per vector under which all but ``MISSED`` of the pairs just at the threshold have one in common."""
    first, second = pairs_at(threshold, width, DRAWN, words)
    depth = FILTERS
    while True:
        needed = []
        for start in range(0, DRAWN, 512):
            (a, ranks_a), (b, ranks_b) = (best_filters(x[start : start + 512], Code(words, depth)) for x in (first, second))
            worst = np.maximum(ranks_a[:, :, None], ranks_b[:, None, :])
            needed.append(np.where(a[:, :, None] == b[:, None, :], worst, depth).min(axis=(1, 2)) + 1)
        found = int(np.quantile(np.concatenate(needed), 1 - MISSED, method="higher"))
        if found <= depth or depth >= words:
            return min(found, depth)
        depth = min(2 * depth, words)


@cache
def _codebook(width: int, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    random = np.random.Generator(np.random.PCG64([width, words]))
    rotation, _ = np.linalg.qr(random.standard_normal((width, width)))
    halves = []
    for size in (width - width // 2, width // 2):
        code = random.standard_normal((words, size))
        halves.append(code / np.linalg.norm(code, axis=1, keepdims=True) * np.sqrt(size / width))
    return rotation, halves[0], halves[1]


def _top(scores: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest scores of each row, falling, and their places."""
    places = np.argpartition(-scores, count - 1, axis=1)[:, :count]
    best = np.take_along_axis(scores, places, 1)
    order = np.argsort(-best, axis=1, kind="stable")
    return np.take_along_axis(best, order, 1), np.take_along_axis(places, order, 1)


def best_filters(vectors: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray]:
    """The best filters of each unit vector, best first, and how many other filters are clearly better; -1 pads the filters.

    There are more than asked for only if several are as good as the last one.
    """
    vectors = np.pad(vectors, ((0, 0), (0, max(0, LEAST_WIDTH - vectors.shape[1]))))
    rotation, first, second = _codebook(vectors.shape[1], code.words)
    turned = vectors @ rotation
    left, right = turned[:, : first.shape[1]] @ first.T, turned[:, first.shape[1] :] @ second.T
    # A direction among the best has few better codewords in either half: numbers i and j with (i + 1) * (j + 1) <= filters, and ties.
    deep = min(code.words, code.filters + 1)
    (left, at), (right, bt) = _top(left, deep), _top(right, deep)
    i, j = np.nonzero(np.add.outer(np.arange(deep), np.arange(deep)) + np.multiply.outer(np.arange(deep), np.arange(deep)) < code.filters + 1)
    scores = left[:, i] + right[:, j]
    numbers = at[:, i].astype(np.int64) * code.words + bt[:, j]
    order = np.argsort(-scores, axis=1, kind="stable")
    scores, numbers = np.take_along_axis(scores, order, 1), np.take_along_axis(numbers, order, 1)
    ranks = np.stack([np.searchsorted(-s, -s - TOLERANCE, side="left") for s in scores])
    good = ranks < code.filters
    widest = int(good.sum(axis=1).max(initial=0))
    return np.where(good, numbers, -1)[:, :widest], ranks[:, :widest]


def decode_filters(vectors: np.ndarray, code: Code) -> list[np.ndarray]:
    """Numbers of the filters of each unit vector, rising."""
    return [np.sort(row[row >= 0]) for row in best_filters(vectors, code)[0]]


def _vectors(batch: pa.RecordBatch, name: str = "vector") -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _filtered(classes: DataFrame, code: Code, width: int, whole: bool) -> DataFrame:
    """A row per vector and filter: (label, filter), and if ``whole`` also id, weight, vector and all its filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                some = batch.slice(start, 512)
                x = _vectors(some)
                lists = decode_filters(x / np.linalg.norm(x, axis=1, keepdims=True), code)
                sizes = [len(f) for f in lists]
                row = pa.array(np.repeat(np.arange(len(lists)), sizes))
                columns = {"label": some.column("label").take(row), "filter": pa.array(np.concatenate(lists))}
                if whole:
                    own = pa.array([f.astype("<i8").tobytes() for f in lists], pa.binary())
                    columns |= {"id": some.column("id").take(row), "weight": some.column("weight").take(row), "vector": some.column("vector").take(row), "filters": own.take(row)}
                yield pa.RecordBatch.from_pydict(columns)

    same = classes.where(F.size("vector") == width).select("id", "label", "weight", "vector")
    kind = dict(classes.dtypes)
    more = f", id long, weight long, vector {kind['vector']}, filters binary" if whole else ""
    return same.mapInArrow(run, f"label {kind['label']}, filter long{more}")


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("count", pa.int64())])


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric adjacency matrix."""
    todo, edges = np.ones(len(linked), bool), []
    for root in range(len(linked)):
        if not todo[root]:
            continue
        todo[root] = False
        frontier = [root]
        while frontier:
            at = frontier.pop()
            new = np.flatnonzero(linked[at] & todo)
            todo[new] = False
            edges += [(at, int(j)) for j in new]
            frontier += new.tolist()
    return edges


def bucket_links(ids: np.ndarray, weights: np.ndarray, x: np.ndarray, lists: list[np.ndarray], own: int, page: np.ndarray | None, threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Weighted links per vector that belong to this bucket (its filter is the pair's first common one), and a forest of all links.

    ``page``: only pairs of different pages count, if given.
    """
    norm = np.linalg.norm(x, axis=1)
    linked = (x @ x.T) / (norm[:, None] * norm[None, :]) >= threshold
    np.fill_diagonal(linked, False)
    if page is not None:
        linked &= page[:, None] != page[None, :]
    if not linked.any():
        return np.zeros(len(ids), np.int64), []
    before = [f[f < own] for f in lists]
    values, at, seen = np.unique(np.concatenate(before), return_inverse=True, return_counts=True)
    shared = seen[at] > 1
    held = np.zeros((len(ids), len(values)), np.float32)
    held[np.repeat(np.arange(len(ids)), [len(f) for f in before])[shared], at[shared]] = 1
    held = held[:, seen > 1]
    owned = linked & ~((held @ held.T) > 0) if held.shape[1] else linked
    return owned @ weights, [(int(ids[a]), int(ids[b])) for a, b in _forest(linked)]


def _links(rows: DataFrame, threshold: float) -> DataFrame:
    """(a, b) edges of forests with null count, and (a, null, count) link counts, from filtered rows with pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for part in _runs(batches, ["bucket", "filter", "low", "high"]):
            ids = _column(part, "id")
            if len(ids) > 1:
                lists = [np.frombuffer(f, "<i8") for b in part for f in b.column("filters").to_pylist()]
                low, high = (int(part[0].column(c)[0].as_py()) for c in ("low", "high"))
                page = _column(part, "page") if low != high else None
                own = int(part[0].column("filter")[0].as_py())
                counts, edges = bucket_links(ids, _column(part, "weight"), np.concatenate([_vectors(b) for b in part]), lists, own, page, threshold)
                out += [(int(i), None, int(n)) for i, n in zip(ids, counts) if n]
                out += [(a, b, None) for a, b in edges]
            if len(out) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=LINKS)
                out = []
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 3, schema=LINKS)

    dealt = rows.repartition(partitions(rows), "bucket", "filter", "low", "high").sortWithinPartitions("bucket", "filter", "low", "high", "id")
    return dealt.mapInArrow(run, "a long, b long, count long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: id, n_links, component_id (smallest id reachable by links) and kept (the id is the component's).

    Only vectors of the same, not null label and of the same length are compared, in double precision. A vector that is null, empty or
    zero, or has a null or non-finite component, is linked with nothing. Null ids are never the smallest. Repeated rows are vectors of their own.
    Filters find all but ``MISSED`` of the links just at the threshold, and more of the closer ones; what is linked has been verified.
    """
    v = F.col(f"`{vector_col}`")
    usable = (
        v.isNotNull() & F.col(f"`{label_col}`").isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0)
    )
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec"), F.col(f"`{label_col}`").alias("label"), v.alias("vector"), F.coalesce(usable, F.lit(False)).alias("usable")
    ).withColumns({"id": F.xxhash64("label", "vector"), "second": F.hash("label", "vector")})
    classes = rows.where("usable").groupBy("id", "second").agg(F.min("vec").alias("first_vec"), F.count("*").alias("weight"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    classes = materialize(classes, "vectors")
    largest = classes.groupBy("label", F.size("vector").alias("width")).count().groupBy("width").agg(F.max("count").alias("most")).collect()
    found = [_bucketed(classes, code_for(r.most, r.width, threshold), r.width, threshold) for r in largest]
    links = None
    for part in found:
        links = part if links is None else links.unionByName(part)
    per_vector = rows.select("vec", "usable", "id", "second")
    if links is None:
        return per_vector.select(F.col("vec").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("vec").alias("component_id"), F.lit(True).alias("kept"))
    links = materialize(links, "vector-links")
    counts = links.where("b IS NULL").groupBy(F.col("a").alias("of")).agg(F.sum("count").alias("links"))
    roots = components(links.where("b IS NOT NULL").select("a", "b")).select(F.col("vertex").alias("child"), "root")
    named = classes.select("id", "second", "first_vec", "weight").join(counts, F.col("id") == F.col("of"), "left").join(roots, F.col("id") == F.col("child"), "left")
    named = materialize(named.select("id", "second", "first_vec", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "id").alias("root")), "vector-classes")
    smallest = named.groupBy("root").agg(F.min("first_vec").alias("component_id"))
    final = named.join(smallest, "root").select(F.col("id").alias("cid"), F.col("second").alias("csecond"), "n_links", "component_id")
    joined = per_vector.join(final, F.col("usable") & (F.col("id") == F.col("cid")) & (F.col("second") == F.col("csecond")), "left")
    component = F.when(F.col("cid").isNotNull(), F.col("component_id")).otherwise(F.col("vec"))
    return joined.select(
        F.col("vec").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec").eqNullSafe(component).alias("kept")
    )


def _bucketed(classes: DataFrame, code: Code, width: int, threshold: float) -> DataFrame:
    large = _filtered(classes, code, width, whole=False).groupBy("label", "filter").count().where(F.col("count") > PAGE)
    large = materialize(large.select(F.col("label").alias("of_label"), F.col("filter").alias("of_filter"), F.ceil(F.col("count") / PAGE).cast("int").alias("pages")), "large-buckets")
    side = F.broadcast(large) if large.count() <= BROADCAST_ROWS else large
    rows = _filtered(classes, code, width, whole=True)
    rows = rows.join(side, (rows["label"] == F.col("of_label")) & (rows["filter"] == F.col("of_filter")), "left")
    rows = rows.withColumn("pages", F.coalesce("pages", F.lit(1))).withColumn("page", F.pmod(F.xxhash64("id"), F.col("pages")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)))
    rows = rows.select(F.xxhash64("label").alias("bucket"), "filter", F.least("page", "other").alias("low"), F.greatest("page", "other").alias("high"), "page", "id", "weight", "vector", "filters")
    return _links(rows, threshold)
