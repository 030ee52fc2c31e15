"""Exact k-means over integer vectors by dictionaries of subvectors.

A task cuts its vectors into chunks and each chunk's dimensions into blocks. A block is stored as a dictionary of the
distinct subvectors it holds and one code per vector, without loss; neighbouring blocks are joined as long as their joint
dictionary stays small, so repeated vectors end in few, wide blocks. The encoded chunks are written once. In a round a chunk
computes the exact squared distances of its dictionary entries to the centroids' parts, once per entry, and a vector's distance is the
sum of the partial distances under its codes. Sums of clusters are counts of codes times dictionary entries.

What travels in a round are the centroids (number of clusters times width, whole numbers) and one sum per task and cluster, added by
Spark before they reach the driver. A chunk needs no other chunk, so nothing depends on how values are spread over the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglass.sources.scratch import materialize

from .common import record_batch

WIDTH, SCALE, CLUSTERS, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Vectors of a chunk; codes are 16 bits.
CHUNK = 16_384
#: Blocks are joined while a dictionary entry stands for so many vectors on average.
REUSE = 8
#: Largest component after scaling, so that a squared distance of up to 4096 dimensions fits a long.
LARGEST = 1 << 24


@dataclass
class Block:
    """Neighbouring dimensions of a chunk: distinct subvectors (rows of ``values``) and the code of each vector."""

    values: np.ndarray
    codes: np.ndarray


def _joined(a: Block, b: Block, most: int) -> Block | None:
    """Both blocks as one, or None if that has more than ``most`` distinct subvectors."""
    if max(len(a.values), len(b.values)) > most:
        return None
    pairs, codes = np.unique(a.codes.astype(np.int64) * len(b.values) + b.codes, return_inverse=True)
    if len(pairs) > most:
        return None
    first, second = np.divmod(pairs, len(b.values))
    return Block(np.hstack([a.values[first], b.values[second]]), codes)


def encoded(vectors: np.ndarray) -> list[Block]:
    """The blocks of a matrix of whole numbers, from the first dimension to the last."""
    blocks = []
    for column in vectors.T:
        values, codes = np.unique(column, return_inverse=True)
        blocks.append(Block(values[:, None], codes))
    most, before = len(vectors) // REUSE, -1
    while before != len(blocks):
        before, out = len(blocks), []
        for block in blocks:
            both = _joined(out[-1], block, most) if out else None
            if both is None:
                out.append(block)
            else:
                out[-1] = both
        blocks = out
    return blocks


def decoded(blocks: list[Block]) -> np.ndarray:
    return np.hstack([b.values[b.codes] for b in blocks])


def distances(blocks: list[Block], centroids: np.ndarray) -> np.ndarray:
    """Squared distance of every vector to every centroid."""
    total, at = np.zeros((len(blocks[0].codes), len(centroids)), np.int64), 0
    for block in blocks:
        part = centroids[:, at : at + block.values.shape[1]]
        of_entry = np.stack([((block.values - c) ** 2).sum(axis=1) for c in part], axis=1)
        total += of_entry[block.codes]
        at += block.values.shape[1]
    return total


def cluster_sums(blocks: list[Block], clusters: np.ndarray, k: int) -> np.ndarray:
    """Sums of the vectors of each cluster."""
    parts = []
    for block in blocks:
        entries = len(block.values)
        uses = np.bincount(clusters * entries + block.codes, minlength=k * entries).reshape(k, entries)
        parts.append(uses @ block.values)
    return np.hstack(parts)


CHUNKS = pa.schema([("ids", pa.list_(pa.int64())), ("widths", pa.list_(pa.int32())), ("entries", pa.list_(pa.int32())), ("values", pa.binary()), ("codes", pa.binary())])


def encoded_chunks(vectors: DataFrame, width: int, scale: int) -> DataFrame:
    """Encoded chunks of ``vectors`` (id, vector): one row per chunk."""

    def chunk(ids: list[pa.Array], parts: list[np.ndarray]) -> pa.RecordBatch:
        whole = np.floor(np.concatenate(parts).reshape(-1, width).astype(np.float64) * scale)
        if np.abs(whole).max() > LARGEST:
            raise ValueError(f"a component is larger than {LARGEST} after scaling: squared distances would not fit a long")
        blocks = encoded(whole.astype(np.int64))
        values = b"".join(b.values.astype("<i4").tobytes() for b in blocks)
        codes = b"".join(b.codes.astype("<u2").tobytes() for b in blocks)
        ids = pa.concat_arrays(ids).to_pylist()
        return record_batch(CHUNKS, [[ids], [[b.values.shape[1] for b in blocks]], [[len(b.values) for b in blocks]], [values], [codes]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held = [], [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                some = batch.slice(at, CHUNK - held)
                ids.append(some.column("id"))
                parts.append(some.column("vector").flatten().to_numpy(zero_copy_only=False))
                at, held = at + some.num_rows, held + some.num_rows
                if held == CHUNK:
                    yield chunk(ids, parts)
                    ids, parts, held = [], [], 0
        if held:
            yield chunk(ids, parts)

    return vectors.select("id", "vector").mapInArrow(run, "ids array<long>, widths array<int>, entries array<int>, values binary, codes binary")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[Block]]]:
    for batch in batches:
        for row in range(batch.num_rows):
            ids, widths, entries, values, codes = (column[row].as_py() for column in batch.columns)
            values, codes = np.frombuffer(values, "<i4").astype(np.int64), np.frombuffer(codes, "<u2").reshape(len(widths), -1)
            blocks, at = [], 0
            for width, count, own in zip(widths, entries, codes):
                blocks.append(Block(values[at : at + width * count].reshape(count, width), own.astype(np.intp)))
                at += width * count
            yield ids, blocks


def moved(chunks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of their vectors' means; those without vectors stay."""
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for _, blocks in _chunks(batches):
            clusters = distances(blocks, centroids).argmin(axis=1)
            counts += np.bincount(clusters, minlength=k)
            sums += cluster_sums(blocks, clusters, k)
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(range(k), pa.int32()), "n": pa.array(counts), "sums": pa.array(sums.tolist(), pa.list_(pa.int64()))})

    parts = chunks.mapInArrow(run, "cluster int, n long, sums array<long>")
    totals = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[i]) for i in range(width))).alias("sums"))
    out = centroids.copy()
    for row in totals.where("n > 0").collect():
        out[row.cluster] = [s // row.n for s in row.sums]
    return out


def assigned(chunks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(id, cluster, distance)`` of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, blocks in _chunks(batches):
            total = distances(blocks, centroids)
            clusters = total.argmin(axis=1)
            nearest = np.take_along_axis(total, clusters[:, None], 1)[:, 0]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(clusters.astype(np.int32)), pa.array(nearest)], names=["id", "cluster", "distance"])

    return chunks.mapInArrow(run, "id long, cluster int, distance long")


def first_centroids(usable: DataFrame, k: int, scale: int, seed: int) -> np.ndarray:
    """Vectors with the ``k`` smallest hashes of seed and id; of equal ids the smaller vector first, rows without an id last."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = usable.orderBy(order.asc_nulls_last(), "vector").limit(k).select("vector").collect()
    # Larger components are refused when the chunks are encoded.
    return np.floor(np.array([r.vector for r in rows], np.float64) * scale).clip(-LARGEST, LARGEST).astype(np.int64)


def _usable(v: Column, width: int) -> Column:
    good = (F.size(v) == width) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & good


def cluster(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", width: int = WIDTH, k: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED
) -> DataFrame:
    """One row per vector of ``width`` components: id, cluster, distance, cluster_inertia, inertia and centroid_sha256.

    A component ``x`` counts as ``floor(scale * x)`` in double precision. Vectors that are null, of another width, or have a null or
    non-finite component are left out; so there are no rows for an empty table. Fewer than ``k`` vectors make as many clusters.
    Ids may be null or repeat: every row is a vector. Ties of distance go to the smaller cluster number, so a centroid equal to an earlier
    one stays empty and unchanged. Other columns are not read. Components beyond ``LARGEST`` after scaling are refused.
    """
    v = F.col(f"`{vector_col}`")
    usable = vectors.where(_usable(v, width)).select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("vector"))
    centroids = first_centroids(usable, k, scale, seed)
    if not len(centroids):
        empty = usable.select(F.col("id").alias(id_col)).where(F.lit(False))
        return empty.selectExpr(f"`{id_col}`", "0 cluster", "0L distance", "0L cluster_inertia", "0L inertia", "'' centroid_sha256")
    chunks = materialize(encoded_chunks(usable, width, scale), "vector-chunks")
    for _ in range(rounds):
        centroids = moved(chunks, centroids)
    final = materialize(assigned(chunks, centroids), "clusters")
    # The sums are exact: decimals until they are known to fit.
    sums = final.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    whole = sum(int(r.s) for r in sums)
    facts = [(r.cluster, int(r.s), digests[r.cluster]) for r in sums]
    known = final.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, centroid_sha256 string")
    joined = final.join(F.broadcast(known), "cluster")
    return joined.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", F.lit(whole).cast("long").alias("inertia"), "centroid_sha256")
