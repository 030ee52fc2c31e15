"""Best-fit packing of documents into sequences of a fixed number of tokens.

Lengths lie between 1 and the capacity, so documents of one length form a run and so do gaps of one size: at most
twice the capacity of runs, whatever the number of documents. A sweep takes the runs from long to short; each run goes to its
successor, the smallest gap that holds it. Documents that compete for the same gaps are told apart by their rank in the run:
the lowest ranks get the first gaps. Gaps are updated and the sweep goes on; only a run without a successor opens
new sequences. The outcome is that of best-fit on the documents sorted by decreasing length, one after another.

The sweep needs the number of documents of each length only. Documents are range-sorted by length on the executors, ranked by
the counts of the partitions before them, and placed by looking their rank up in the plan; no document passes the driver.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglass.sources.scratch import materialize

from .bpe import Encoder
from .common import partitions, record_batch, row_slices

CAPACITY = 2048
#: Id written after every document.
END_ID = 0


@cache
def vocabulary(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a tokenizer file of byte-level BPE; its printable stand-ins of bytes are undone."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    return {bytes(map(byte_of.__getitem__, t)): i for t, i in model["vocab"].items() if not t.startswith("<|")}


def added_tokens(path: str) -> dict[str, int]:
    """Texts that the tokenizer file makes one token wherever they stand, with their ids."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens") or []
    if any(t.get(k) for t in added for k in ("lstrip", "rstrip", "single_word")):
        raise ValueError("added tokens that take in spaces or stand alone are not supported")
    return {t["content"]: t["id"] for t in added}


class PieceEncoder(Encoder):
    """The same memory of pieces with a library's encoder for the new ones; ids are those of the tokenizer file.

    Texts are cut at the file's added tokens first, and what lies between is encoded on its own.
    """

    def __init__(self, path: str):
        self.added = {t: np.array([i], "<u4").tobytes() for t, i in added_tokens(path).items()}
        self.cuts = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.pieces = {}
        self.library = tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary(path), special_tokens={})

    def _learn(self, pieces: set[str]) -> None:
        encode = self.library.encode_ordinary
        for p in pieces:
            self.pieces[p] = np.array(encode(p[:-1] if p[-1:] == " " else " " + p), "<u4").tobytes()

    def cut(self, text: str) -> list[str] | None:
        return None if any(map(text.__contains__, self.added)) else super().cut(text)

    def _whole(self, text: str) -> bytes:
        if self.cuts and len(parts := self.cuts.split(text)) > 1:
            return b"".join(self.added[p] if i % 2 else self._ordinary(p) for i, p in enumerate(parts))
        return self._ordinary(text)

    def _ordinary(self, text: str) -> bytes:
        return np.array(self.library.encode_ordinary(text), "<u4").tobytes()


@cache
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32())), ("part", pa.int32()), ("row", pa.int64())])
PIECES_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>, part int, row long"


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids: full ones after a first one that may be shorter."""
    first = n % capacity or capacity
    return [first] + [capacity] * ((n - first) // capacity)


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document with the checksum of their ids; ``ids`` is null unless asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, part, row = piece_encoder(path), TaskContext.get().partitionId(), 0
        end = np.array([END_ID], "<u4").tobytes()
        for ids, texts in row_slices(batches):
            out: list[tuple] = []
            for doc_id, encoded in zip(ids, own.encode_bytes([t or "" for t in texts])):
                data, start = encoded + end, 0
                for piece, length in enumerate(cut_lengths(len(data) // 4, capacity)):
                    some = data[4 * start : 4 * (start + length)]
                    out.append((doc_id, piece, start, length, zlib.crc32(some), np.frombuffer(some, "<i4") if keep_ids else None, part, row))
                    start, row = start + length, row + 1
            yield record_batch(PIECES, list(zip(*out)) or [[]] * len(PIECES))

    picked = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return picked.mapInArrow(run, PIECES_SQL)


def best_fit_plan(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Where the runs go, and the number of sequences.

    ``counts``: documents of each length below the capacity. Rows of the plan, sorted by the first two: length, first rank,
    first sequence, documents per sequence, place of the first one.
    """
    sizes: list[int] = []
    gaps: dict[int, deque[tuple[int, int]]] = {}
    plan, opened = [], 0

    def add_gap(size: int, first: int, count: int) -> None:
        if size and count:
            if size not in gaps:
                insort(sizes, size)
                gaps[size] = deque()
            gaps[size].append((first, count))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                size = sizes[at]
                first, count = gaps[size].popleft()
                if not gaps[size]:
                    del gaps[size], sizes[at]
            else:
                size, first, count = capacity, opened, -(-left // (capacity // length))
                opened += count
            each = size // length
            placed = min(left, each * count)
            full, rest = divmod(placed, each)
            plan.append((length, rank, first, each, capacity - size))
            add_gap(size - each * length, first, full)
            if rest:
                add_gap(size - rest * length, first + full, 1)
            add_gap(size, first + full + bool(rest), count - full - bool(rest))
            rank, left = rank + placed, left - placed
    return np.array(sorted(plan), np.int64).reshape(-1, 5), opened


PLACED_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>, sequence_id long, offset long"
PLACED = pa.schema([*list(PIECES)[:6], ("sequence_id", pa.int64()), ("offset", pa.int64())])


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece with its sequence and its place there; sequences are filled from 0 without gaps.

    A null or empty text is a document of the end id alone. Ids may be null or repeat: each row is packed for itself. An empty
    table gives an empty result. Other columns are not read.
    """
    pieces = materialize(token_pieces(docs, path, capacity, keep_ids, id_col, text_col), "pieces")
    short = pieces.where(F.col("length") < capacity)
    ordered = short.repartitionByRange(partitions(docs), "length", "part", "row").sortWithinPartitions("length", "part", "row")
    ranged = materialize(ordered.mapInArrow(_number, PIECES_SQL + ", range_part int, nth long"), "ranked-pieces")
    counted = sorted(map(tuple, ranged.groupBy("length", "range_part").count().collect()))
    totals: dict[int, int] = {}
    before = {}
    for length, part, count in counted:
        before[length, part] = totals.get(length, 0)
        totals[length] = before[length, part] + count
    plan, _ = best_fit_plan(totals, capacity)
    keys = plan[:, 0] << 44 | plan[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, part, nth = (batch.column(c).to_numpy() for c in ("length", "range_part", "nth"))
            rank = nth + np.array([before[key] for key in zip(length.tolist(), part.tolist())], np.int64)
            row = plan[np.searchsorted(keys, length << 44 | rank, side="right") - 1]
            turn, inside = np.divmod(rank - row[:, 1], row[:, 3])
            columns = [*batch.columns[:6], pa.array(row[:, 2] + turn), pa.array(row[:, 4] + inside * length)]
            yield pa.RecordBatch.from_arrays(columns, schema=PLACED)

    placed = ranged.mapInArrow(run, PLACED_SQL)
    alone = -1 - (F.col("part").cast("long") * F.lit(1 << 36) + F.col("row"))
    full = pieces.where(F.col("length") == capacity).select(*PIECES.names[:6], alone.alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.unionByName(full)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the range partition and each row's number among the rows of its length there; rows come sorted by length."""
    from pyspark import TaskContext

    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        nth = []
        for length in batch.column(3).to_pylist():
            seen = seen + 1 if length == last else 0
            last = length
            nth.append(seen)
        columns = [*batch.columns, pa.array([part] * len(nth), pa.int32()), pa.array(nth, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "range_part", "nth"])


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences: ``(sequence_id, ids)`` of placements made with ``keep_ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
