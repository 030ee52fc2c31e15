"""Order-dependent work without ever putting one series, or the whole table, into one task.

Rows are cut into *chunks*: contiguous ranges of the sort key ``(series key, order columns)``. The
cut points are literals, so the chunk of a row is a pure function of the row and stays the same when
a task is recomputed. A hot series is spread over as many chunks as it needs. What crosses a chunk
border travels through a small table with one row per chunk (at most ``MAX_CHUNKS``), which is
therefore safe to broadcast and to order in one task. Beyond ``MAX_CHUNKS`` chunks of the largest size
chunks grow; a task sorts its chunk with spilling.

The order columns, together with the series key, must identify a row.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import quoted

MAX_CHUNKS = 20_000
SAMPLES_PER_CHUNK = 16
MOST_CHUNK_ROWS = 1_000_000
LEAST_CHUNK_ROWS = 2_000

CHUNK = "_chunk"
GLOBAL_POSITION = "_gpos"
POSITION = "_pos"


# --- cutting into chunks -------------------------------------------------------------------------


def _sort_key(name: str, dtype: T.DataType) -> tuple[Column, T.DataType]:
    """The value compared with the cut points, and its type."""
    if isinstance(dtype, (T.BinaryType, T.MapType, T.ArrayType, T.StructType)):
        raise TypeError(f"{name}: {dtype.simpleString()} cannot be an order column")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(quoted(name)), T.LongType()
    return quoted(name), dtype


@dataclass(frozen=True)
class Chunking:
    """Sort key of a table and the cut points found for it.

    A cut point is written as short as it can be: keys that it leaves out stand for "before every value",
    ``None`` is the NULL key, which sorts before all others. A cut that names more than the series key lies
    inside a series, which is then too long for one chunk.
    """

    keys: tuple[str, ...]
    types: tuple[T.DataType, ...]
    cuts: tuple[tuple[str | None, ...], ...]
    chunk_rows: int

    @property
    def single(self) -> bool:
        return not self.cuts

    def split_chunks(self, depth: int) -> list[int]:
        """Chunks next to a cut that lies inside a group of the first ``depth`` keys."""
        inner = [i for i, cut in enumerate(self.cuts) if len(cut) > depth]
        return sorted({c for i in inner for c in (i, i + 1)})

    def splits(self, depth: int) -> bool:
        return bool(self.split_chunks(depth))

    def column(self) -> Column:
        """Chunk number of a row: how many cut points are <= its key, by binary search."""
        count = len(self.cuts)
        if not count:
            return F.lit(0)
        width = max(map(len, self.cuts))
        keys = [_sort_key(k, t) for k, t in zip(self.keys[:width], self.types)]
        # Before each key stands whether the cut has it, so that "before every value" differs from NULL.
        parts = [(f"h{i}", f"k{i}", dtype) for i, (_, dtype) in enumerate(keys)]
        texts = json.dumps([{n: v for i, (h, k, _) in enumerate(parts) for n, v in ((h, int(i < len(cut))), (k, cut[i] if i < len(cut) else None))} for cut in self.cuts])

        def row_type(of: Callable[[T.DataType], T.DataType]) -> T.ArrayType:
            return T.ArrayType(T.StructType([f for h, k, t in parts for f in (T.StructField(h, T.IntegerType()), T.StructField(k, of(t)))]))

        # one literal after constant folding; structs compare field by field, NULL first
        table = F.from_json(F.lit(texts), row_type(lambda _: T.StringType())).cast(row_type(lambda t: t))
        key = F.struct(*[c for (h, k, _), (value, _) in zip(parts, keys) for c in (F.lit(1).alias(h), value.alias(k))])
        strides = [1 << bit for bit in range(count.bit_length() - 1, -1, -1)]
        return F.aggregate(
            F.array(*[F.lit(s) for s in strides]),
            F.lit(0),
            lambda at, step: F.when(
                (at + step <= count) & (F.get(table, at + step - F.lit(1)) <= key), at + step
            ).otherwise(at),
        )


def _shortest(cuts: list[tuple]) -> tuple[tuple[str | None, ...], ...]:
    """Each cut reduced to the fewest leading keys that no other cut shares."""
    shared = [Counter(cut[:length] for cut in cuts) for length in range(len(cuts[0]) + 1)] if cuts else []
    out = []
    for cut in cuts:
        length = next((n for n in range(1, len(cut)) if shared[n][cut[:n]] == 1), len(cut))
        out.append(cut[:length])
    return tuple(dict.fromkeys(out))


def find_chunks(df: DataFrame, keys: Sequence[str], chunk_rows: int | None = None) -> Chunking:
    """Cut the key range of ``df`` into about ``rows / chunk_rows`` even parts.

    Without ``chunk_rows``, two parts per shuffle partition, none of them too small or too large.

    Two narrow jobs that read the key columns only: a count, then a hash-chosen sample of keys whose
    size is proportional to the number of chunks. The sample decides the balance, never the result.
    """
    types = [df.select(quoted(k)).schema[0].dataType for k in keys]
    compared = [_sort_key(k, t)[0] for k, t in zip(keys, types)]
    rows = df.count()
    if not chunk_rows:
        parts = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        chunk_rows = min(MOST_CHUNK_ROWS, max(LEAST_CHUNK_ROWS, ceil(rows / parts)))
    chunks = min(MAX_CHUNKS, ceil(rows / chunk_rows))
    if chunks == MAX_CHUNKS:
        chunk_rows = max(chunk_rows, ceil(rows / chunks))
    cuts: tuple = ()
    if chunks > 1:
        every = max(1, rows // (chunks * SAMPLES_PER_CHUNK))
        key_columns = [quoted(k) for k in keys]
        sample = (
            df.select(*key_columns)
            .filter(F.pmod(F.xxhash64(*key_columns), F.lit(every)) == 0)
            .distinct()
            .orderBy(*key_columns)
            .select(*[c.cast("string").alias(f"k{i}") for i, c in enumerate(compared)])
            .collect()
        )
        wanted = [sample[len(sample) * part // chunks] for part in range(1, chunks)] if sample else []
        cuts = _shortest(list(dict.fromkeys(tuple(row) for row in wanted)))
    return Chunking(tuple(keys), tuple(types), cuts, chunk_rows)


# --- what crosses chunk borders ------------------------------------------------------------------


def _group(keys: Sequence[str]) -> Column:
    return F.struct(*([quoted(k) for k in keys] or [F.lit(0).alias("all")]))


def offset_table(chunked: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """One row per chunk: ``before_<name>`` and ``after_<name>``, the sums over all other chunks."""
    per_chunk = chunked.groupBy(CHUNK).agg(*[F.sum(v).alias(f"s_{n}") for n, v in sums.items()])
    # at most MAX_CHUNKS rows
    line = Window.orderBy(CHUNK)
    earlier = line.rowsBetween(Window.unboundedPreceding, -1)
    later = Window.orderBy(F.col(CHUNK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    return per_chunk.select(
        CHUNK,
        *[F.coalesce(F.sum(f"s_{n}").over(earlier), F.lit(0)).alias(f"before_{n}") for n in sums],
        *[F.coalesce(F.sum(f"s_{n}").over(later), F.lit(0)).alias(f"after_{n}") for n in sums],
    )


def border_table(
    chunked: DataFrame,
    chunking: Chunking,
    keys: Sequence[str],
    sums: dict[str, Column] | None = None,
    nearest: dict[str, tuple[Column, Column]] | None = None,
) -> DataFrame:
    """One row per chunk that shares a series with a neighbour: what the others contribute.

    ``sums``: ``in_<name>`` is the sum over earlier chunks of the chunk's first series, ``out_<name>``
    the sum over later chunks of its last series.
    ``nearest``: ``name -> (value, position)``; ``in_``/``out_`` hold the closest non-NULL value.
    """
    sums, nearest = sums or {}, nearest or {}
    touched = chunking.split_chunks(len(keys))
    if len(touched) <= len(chunking.cuts) // 2:
        chunked = chunked.filter(F.col(CHUNK).isin(touched))
    # The position may be any orderable column; NULL values never take part.
    partial = [F.sum(value).alias(f"s_{n}") for n, value in sums.items()]
    for name, (value, position) in nearest.items():
        present = F.when(value.isNotNull(), position)
        partial.append(F.max_by(value, present).alias(f"l_{name}"))
        partial.append(F.min_by(value, present).alias(f"f_{name}"))
    summary = (
        chunked.groupBy(F.col(CHUNK), *[quoted(k) for k in keys])
        .agg(*partial)
        .withColumn("_g", _group(keys))
    )
    body = F.struct(*[F.col(f"s_{n}") for n in sums], *[F.col(f"{side}_{n}") for n in nearest for side in "lf"])
    per_chunk = summary.groupBy(CHUNK).agg(
        F.min("_g").alias("_first"),
        F.max("_g").alias("_last"),
        F.min_by(body, F.col("_g")).alias("_head"),
        F.max_by(body, F.col("_g")).alias("_tail"),
    )
    # at most MAX_CHUNKS rows from here on
    line = Window.orderBy(CHUNK)
    forward = Window.partitionBy("_last").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, 0)
    backward = (
        Window.partitionBy("_first").orderBy(F.col(CHUNK).desc()).rowsBetween(Window.unboundedPreceding, 0)
    )
    out = per_chunk
    for n in sums:
        out = out.withColumn(f"u_{n}", F.sum(f"_tail.s_{n}").over(forward))
        out = out.withColumn(f"v_{n}", F.sum(f"_head.s_{n}").over(backward))
    for n in nearest:
        out = out.withColumn(f"u_{n}", F.last(F.col(f"_tail.l_{n}"), ignorenulls=True).over(forward))
        out = out.withColumn(f"v_{n}", F.last(F.col(f"_head.f_{n}"), ignorenulls=True).over(backward))
    continues = F.lag("_last").over(line) == F.col("_first")
    continued = F.lead("_first").over(line) == F.col("_last")
    carried = []
    for n in [*sums, *nearest]:
        carried.append(F.when(continues, F.lag(f"u_{n}").over(line)).alias(f"in_{n}"))
        carried.append(F.when(continued, F.lead(f"v_{n}").over(line)).alias(f"out_{n}"))
    return out.select(CHUNK, "_first", "_last", *carried)


def _with_borders(chunked: DataFrame, borders: DataFrame) -> DataFrame:
    return chunked.join(F.broadcast(borders), CHUNK, "left")


def _plain_drop(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    return df.select(*[quoted(c) for c in keep])


# --- running sums and positions ------------------------------------------------------------------


def add_running(
    frame: DataFrame,
    chunking: Chunking,
    series_key: Sequence[str],
    order_by: Sequence[str],
    values: dict[str, Column],
    totals: Sequence[str] = (),
) -> DataFrame:
    """Running sums on a frame that already has its ``_chunk`` column; see ``running_sums``.

    Calls for nested keys (``[a]``, then ``[a, b]``) on one chunking share its shuffle and sort.
    """
    inside = Window.partitionBy(F.col(CHUNK), *[quoted(k) for k in series_key])
    upto = inside.orderBy(*[quoted(k) for k in order_by]).rowsBetween(Window.unboundedPreceding, 0)
    out = frame.select(
        "*",
        *[F.sum(v).over(upto).alias(f"_r_{n}") for n, v in values.items()],
        *[F.sum(values[n]).over(inside).alias(f"_t_{n}") for n in totals],
    )
    result = {n: F.col(f"_r_{n}") for n in values}
    result |= {f"{n}_total": F.col(f"_t_{n}") for n in totals}
    if not series_key and not chunking.single:
        out = _with_borders(out, offset_table(frame, values))
        for n in values:
            result[n] = result[n] + F.col(f"before_{n}")
        for n in totals:
            result[f"{n}_total"] = result[f"{n}_total"] + F.col(f"before_{n}") + F.col(f"after_{n}")
    elif chunking.splits(len(series_key)):
        out = _with_borders(out, border_table(frame, chunking, series_key, sums=values))
        group = _group(series_key)
        for n in values:
            earlier = F.coalesce(F.when(group == F.col("_first"), F.col(f"in_{n}")), F.lit(0))
            later = F.coalesce(F.when(group == F.col("_last"), F.col(f"out_{n}")), F.lit(0))
            result[n] = F.col(f"_r_{n}") + earlier
            if n in totals:
                result[f"{n}_total"] = F.col(f"_t_{n}") + earlier + later
    return out.select(*[quoted(c) for c in frame.columns], *[c.alias(n) for n, c in result.items()])


def running_sums(
    df: DataFrame,
    series_key: Sequence[str],
    order_by: Sequence[str],
    values: dict[str, Column],
    totals: Sequence[str] = (),
    chunk_rows: int | None = None,
) -> DataFrame:
    """Add, per name, the inclusive running sum ``<name>`` within the series.

    For names listed in ``totals`` also add ``<name>_total``, the sum over the whole series.
    """
    chunking = find_chunks(df, [*series_key, *order_by], chunk_rows)
    chunked = df.withColumn(CHUNK, chunking.column())
    return add_running(chunked, chunking, series_key, order_by, values, totals).drop(CHUNK)


def with_positions(
    df: DataFrame,
    series_key: Sequence[str],
    order_by: Sequence[str],
    chunk_rows: int | None = None,
    chunking: Chunking | None = None,
) -> DataFrame:
    """Add (or renew) dense 0-based positions: ``_pos`` in the series, ``_gpos`` in the whole table."""
    chunking = chunking or find_chunks(df, [*series_key, *order_by], chunk_rows)
    chunked = df.withColumn(CHUNK, chunking.column())
    keys = [quoted(k) for k in series_key]
    order = [quoted(k) for k in order_by]
    out = chunked.select(
        "*",
        F.row_number().over(Window.partitionBy(CHUNK).orderBy(*keys, *order)).alias("_rn"),
        F.row_number().over(Window.partitionBy(F.col(CHUNK), *keys).orderBy(*order)).alias("_srn"),
    )
    position = F.col("_srn").cast("bigint") - 1
    overall = F.col("_rn").cast("bigint") - 1
    if not chunking.single:
        out = _with_borders(out, offset_table(chunked, {"n": F.lit(1)}))
        overall = overall + F.col("before_n")
        if not series_key:
            position = overall
        elif chunking.splits(len(series_key)):
            out = _with_borders(out, border_table(chunked, chunking, series_key, sums={"n": F.lit(1)}))
            carried = F.when(_group(series_key) == F.col("_first"), F.col("in_n"))
            position = position + F.coalesce(carried, F.lit(0))
    kept = [quoted(c) for c in df.columns if c not in (POSITION, GLOBAL_POSITION)]
    return out.select(*kept, position.alias(POSITION), overall.alias(GLOBAL_POSITION))


# --- row-frame windows ---------------------------------------------------------------------------


def frame_windows(
    df: DataFrame,
    series_key: Sequence[str],
    order_by: Sequence[str],
    build: Callable[[Window], dict[str, Column]],
    back: int = 0,
    ahead: int = 0,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Add the window columns of ``build(window)`` whose frames reach at most ``back``/``ahead`` rows.

    ``build`` gets the partitioned and ordered window and returns named expressions. Large tables are
    cut by position into blocks; the ``back`` last (``ahead`` first) rows of a block are also handed
    to its neighbour, so every frame is complete. The copies are dropped afterwards.
    """
    keys = [quoted(k) for k in series_key]
    order = [quoted(k) for k in order_by]
    chunking = find_chunks(df, [*series_key, *order_by], chunk_rows)
    if chunking.single or (series_key and not chunking.splits(len(series_key))):
        # no series is longer than a task can hold
        window = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*order)
        return df.select("*", *[c.alias(n) for n, c in build(window).items()])
    size = max(chunking.chunk_rows, back, ahead)
    placed = with_positions(df, series_key, order_by, chunking=chunking)
    inside = F.pmod(F.col(GLOBAL_POSITION), F.lit(size))
    home = F.expr(f"{GLOBAL_POSITION} div {size}")
    copies = [home]
    if back:
        copies.append(F.when(inside >= F.lit(size - back), home + 1))
    if ahead:
        copies.append(F.when(inside < F.lit(ahead), home - 1))
    homes = F.array_compact(F.array(*copies))
    spread = placed.select("*", home.alias("_home"), F.explode(homes).alias("_block"))
    window = Window.partitionBy(F.col("_block"), *keys).orderBy(*order)
    computed = spread.select("*", *[c.alias(n) for n, c in build(window).items()])
    added = [c for c in computed.columns if c not in spread.columns]
    return _plain_drop(computed.filter(F.col("_block") == F.col("_home")), [*df.columns, *added])


# --- nearest known values ------------------------------------------------------------------------


def nearest_known(
    df: DataFrame,
    columns: Sequence[str],
    series_key: Sequence[str],
    order_by: Sequence[str],
    chunk_rows: int | None = None,
) -> DataFrame:
    """Add ``_prev_<c>`` and ``_next_<c>``: struct(value, at) of the closest non-missing value.

    ``at`` is the first order column. A row whose own value is present is its own neighbour on both
    sides. Columns must hold NULL, not NaN, where missing.
    """
    chunking = find_chunks(df, [*series_key, *order_by], chunk_rows)
    chunked = df.withColumn(CHUNK, chunking.column())
    keys = [quoted(k) for k in series_key]
    inside = Window.partitionBy(F.col(CHUNK), *keys)
    up = inside.orderBy(*[quoted(k) for k in order_by]).rowsBetween(Window.unboundedPreceding, 0)
    down = inside.orderBy(*[quoted(k).desc() for k in order_by]).rowsBetween(Window.unboundedPreceding, 0)
    known = {
        c: F.when(
            quoted(c).isNotNull(), F.struct(quoted(c).alias("value"), quoted(order_by[0]).alias("at"))
        )
        for c in columns
    }
    out = chunked.select("*", *[F.last(v, ignorenulls=True).over(up).alias(f"_p_{c}") for c, v in known.items()])
    out = out.select("*", *[F.last(known[c], ignorenulls=True).over(down).alias(f"_n_{c}") for c in columns])
    before = {c: quoted(f"_p_{c}") for c in columns}
    after = {c: quoted(f"_n_{c}") for c in columns}
    if chunking.splits(len(series_key)):
        position = F.struct(*[quoted(k) for k in order_by])
        numbered = {f"c{i}": (known[c], position) for i, c in enumerate(columns)}
        out = _with_borders(out, border_table(chunked, chunking, series_key, nearest=numbered))
        group = _group(series_key)
        for i, c in enumerate(columns):
            before[c] = F.coalesce(before[c], F.when(group == F.col("_first"), F.col(f"in_c{i}")))
            after[c] = F.coalesce(after[c], F.when(group == F.col("_last"), F.col(f"out_c{i}")))
    return out.select(
        *[quoted(c) for c in df.columns],
        *[before[c].alias(f"_prev_{c}") for c in columns],
        *[after[c].alias(f"_next_{c}") for c in columns],
    )
