"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a prime-sized table, ``(offset + k * skip) mod size``.
The shards take turns; each turn claims the shard's next preferred slot that is still free, until the table is full. All
shards end up with nearly the same number of slots, and removing one shard moves few keys of the others.
The table has a fixed size, so it is broadcast; placing a row is one hash and one look-up, without a shuffle.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Default number of slots; a prime well above a hundred times the usual number of shards.
TABLE_SIZE = 65_537
#: Largest table that may be broadcast (rows of two integers).
MOST_SLOTS = 1_000_003


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _hashed(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def fill_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """For each slot the index of the shard that claimed it.

    ``shards`` are distinct names, ``size`` a prime of at least as many slots; anything else is refused.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, at least one")
    if not _is_prime(size) or not len(shards) <= size <= MOST_SLOTS:
        raise ValueError(f"the table needs a prime size from the number of shards to {MOST_SLOTS}")
    place = [_hashed(s, "offset") % size for s in shards]
    skip = [_hashed(s, "skip") % (size - 1) + 1 if size > 2 else 1 for s in shards]
    owner, free = [-1] * size, size
    while True:
        for shard in range(len(shards)):
            while owner[place[shard]] >= 0:
                place[shard] = (place[shard] + skip[shard]) % size
            owner[place[shard]] = shard
            free -= 1
            if not free:
                return owner


def slot_of(key: Column, size: int) -> Column:
    """Slot of a key; a null key has a slot of its own hash like any other value."""
    return F.pmod(F.xxhash64(key.cast("string"), key.isNull()), F.lit(size))


def place(df: DataFrame, key: str, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """``df`` with ``slot`` (long) and ``shard`` (name). Every row gets a shard, equal keys the same one.

    Null keys share one shard. Where ``df`` has a column called slot or shard, it stays, and the added one gets underscores until its name is free.
    """
    taken = {c.lower() for c in df.columns}
    slot, shard = (n + "_" * next(k for k in range(len(taken) + 1) if n + "_" * k not in taken) for n in ("slot", "shard"))
    rows = [(number, shards[owner]) for number, owner in enumerate(fill_table(shards, size))]
    table = df.sparkSession.createDataFrame(rows, f"{slot} long, {shard} string")
    return df.withColumn(slot, slot_of(F.col(f"`{key}`"), size)).join(F.broadcast(table), slot)


def write_shards(placed: DataFrame, path: str, files: int = 4) -> None:
    """Write one folder per shard. Rows go to ``files`` tasks per shard by slot, so a shard is never one task's work."""
    spread = F.pmod(F.xxhash64("slot"), F.lit(files))
    placed.repartition("shard", spread).write.partitionBy("shard").parquet(path)
