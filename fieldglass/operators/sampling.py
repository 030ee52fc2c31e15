"""Repeatable splits and samples: rows are chosen by a seeded hash of a business key, so the choice
does not depend on partitioning and survives recomputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.missing import quoted
from ..sources.scratch import materialize
from .encode import MAX_BROADCAST_LABELS

BUCKET_BITS = 16
#: Rows at the border of a sample that one task ranks.
BORDER_ROWS = 10_000


def draw(key: Sequence[str], seed: int) -> Column:
    """A hash of the key as a non-negative BIGINT below 2**62."""
    return F.pmod(F.xxhash64(F.lit(seed), *[quoted(k) for k in key]), F.lit(1 << 62))


def holdout_split(df: DataFrame, key: Sequence[str], train: float = 0.8, seed: int = 42, by: Column | None = None) -> DataFrame:
    """Add ``part``: about ``train`` of the rows are ``train``, the rest ``test``. ``by``: a number from 0 to 1 per row in place of the key's hash."""
    share = draw(key, seed) / F.lit(float(1 << 62)) if by is None else by
    return df.withColumn("part", F.when(share < train, "train").otherwise("test"))


def fold_column(key: Sequence[str], folds: int = 5, seed: int = 42) -> Column:
    return F.pmod(draw(key, seed), F.lit(folds)).cast("int")


def calibration_sample(
    df: DataFrame, key: Sequence[str], share: float = 0.1, seed: int = 42, strata: str | None = None, least: int = 10
) -> DataFrame:
    """Exactly ``max(int(share * N), min(least, N))`` rows; with ``strata``, ``ceil(share * N_s)`` of each.

    The rows with the smallest hashes of the key are taken, of rows with the same key those with the smallest hashes of the whole row.
    Counts per bucket of the next bits show which bucket holds the last row to take, round by round, until it has at most
    ``BORDER_ROWS`` rows: only these are ranked, all others are decided by comparison. Rows that are still together after all
    bits are the same row, and are taken as often as needed.
    """
    group = quoted(strata) if strata else F.lit(0)
    plain = [quoted(f.name) for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    whole = F.pmod(F.xxhash64(F.lit(seed), *plain), F.lit(1 << 62))
    hashed = df.select("*", group.alias("_stratum"), draw(key, seed).alias("_d0"), whole.alias("_d1"))
    narrow = hashed.select("_stratum", "_d0", "_d1")
    total = narrow.groupBy("_stratum").agg(F.count(F.lit(1)).alias("_size"))
    if strata:
        quota = F.ceil(F.col("_size") * F.lit(share))
    else:
        quota = F.greatest(F.floor(F.col("_size") * F.lit(share)), F.least(F.lit(least).cast("bigint"), F.col("_size")))
    nothing, everything = F.lit(0).cast("bigint"), F.lit(1 << 62)
    # one row per stratum: the border from (_l0, _l1) up to (_u0, _u1), its size, and how many of its rows are still open
    edges = total.select(
        F.col("_stratum").alias("_s"), "_size", quota.cast("bigint").alias("_open"), nothing.alias("_l0"), nothing.alias("_l1"), everything.alias("_u0"), nothing.alias("_u1")
    )
    edges = materialize(edges, "edges")
    for place, shift in [(p, s) for p in (0, 1) for s in range(62 - BUCKET_BITS, -BUCKET_BITS, -BUCKET_BITS)]:
        wide = edges.where(F.col("_size") > BORDER_ROWS)
        if wide.isEmpty():
            break
        edges = materialize(edges.where(F.col("_size") <= BORDER_ROWS).unionByName(_narrowed(narrow, wide, place, max(shift, 0))), "edges")
    side = F.broadcast(edges) if edges.count() <= MAX_BROADCAST_LABELS else edges
    joined = hashed.join(side, F.col("_stratum").eqNullSafe(F.col("_s")))
    at = F.struct("_d0", "_d1")
    columns = [quoted(c) for c in df.columns]
    sure = joined.filter(at < F.struct("_l0", "_l1")).select(*columns)
    border = joined.filter((at >= F.struct("_l0", "_l1")) & (at < F.struct("_u0", "_u1")) & (F.col("_open") > 0))
    ranked = Window.partitionBy("_stratum").orderBy("_d0", "_d1")
    few = border.filter(F.col("_size") <= BORDER_ROWS).withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= F.col("_open"))
    same = border.filter(F.col("_size") > BORDER_ROWS).groupBy("_stratum").agg(F.first(F.struct(*columns)).alias("_row"), F.first("_open").alias("_open"))
    same = same.select("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_open")))).select("_row.*")
    return sure.unionByName(few.select(*columns)).unionByName(same)


def _narrowed(narrow: DataFrame, edges: DataFrame, place: int, shift: int) -> DataFrame:
    """The edges with their border cut down to the bucket, by bits from ``shift`` of hash ``place``, that holds the last row to take."""
    side = F.broadcast(edges) if edges.count() <= MAX_BROADCAST_LABELS else edges
    at = F.struct("_d0", "_d1")
    inside = narrow.join(side, F.col("_stratum").eqNullSafe(F.col("_s"))).filter((at >= F.struct("_l0", "_l1")) & (at < F.struct("_u0", "_u1")))
    bucket = F.shiftright(f"_d{place}", shift)
    sizes = inside.groupBy("_s", "_open", "_l0", bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    # at most 2**16 buckets per stratum
    upto = F.sum("_n").over(Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    last = sizes.withColumn("_upto", upto).filter((F.col("_upto") >= F.col("_open")) & (F.col("_upto") - F.col("_n") < F.col("_open")))
    low, high = F.shiftleft("_b", shift), F.shiftleft(F.col("_b") + 1, shift)
    zero = F.lit(0).cast("bigint")
    bounds = (low, zero, high, zero) if place == 0 else (F.col("_l0"), low, F.col("_l0"), high)
    names = ("_l0", "_l1", "_u0", "_u1")
    # a stratum of which nothing is open has no last row: its border is empty
    cut = last.select("_s", F.col("_n").alias("_size"), (F.col("_open") - (F.col("_upto") - F.col("_n"))).alias("_open"), *[b.alias(n) for b, n in zip(bounds, names)])
    none = edges.where("_open <= 0").select("_s", zero.alias("_size"), "_open", *[zero.alias(n) for n in names])
    return cut.unionByName(none)
