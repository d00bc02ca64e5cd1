"""Constant-time placement by a lookup table that shards fill by turns.

Every shard has a permutation of the table's slots, offset + k * skip modulo the table's prime
size, both from hashes of its name. Shards take turns: each claims the first slot of its
permutation that is still free, until none is. All shards get the same number of slots or one more,
and when a shard leaves, nearly all slots of the others stay. A row's slot is a hash of its id
modulo the size; the table of `size` rows is broadcast, and no row moves for it.

The table depends on the shard names alone, not on the data, and has at most MOST_SLOTS rows, so it
is made where the plan is made. An id of null hashes like the text "null". Repeated ids go to the
same shard. Columns pass through; `slot` and `shard` are added,
under other names if asked, in place of columns of these names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS_PER_SHARD = 100
MOST_SLOTS = 1 << 20


def table_size(shards: int) -> int:
    """The least prime with at least SLOTS_PER_SHARD slots for each shard."""
    n = max(3, shards * SLOTS_PER_SHARD) | 1
    while any(n % k == 0 for k in range(3, int(n ** 0.5) + 1, 2)):
        n += 2
    if n > MOST_SLOTS:
        raise ValueError(f"{shards} shards need a table of {n} slots; at most {MOST_SLOTS} are broadcast")
    return n


def fill(shards: list[str], size: int) -> list[int]:
    """For each slot the position of its shard."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need names of their own")
    steps = []
    for name in shards:
        a, b = (int(hashlib.md5(f"{k}:{name}".encode()).hexdigest()[:15], 16) for k in ("offset", "skip"))
        steps.append([a % size, b % (size - 1) + 1])
    table, free = [-1] * size, size
    while True:
        for shard, step in enumerate(steps):
            while table[step[0]] >= 0:
                step[0] = (step[0] + step[1]) % size
            table[step[0]] = shard
            free -= 1
            if not free:
                return table


def slot_of(key: Column, size: int) -> Column:
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null"))), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(size)).cast("int")


def place(docs: DataFrame, shards: list[str], slot: str = "slot", shard: str = "shard") -> DataFrame:
    """`docs` with the slot and the shard of each row's doc_id."""
    size = table_size(len(shards))
    owners = ",".join(map(str, fill(shards, size)))
    names = F.array(*[F.lit(s) for s in shards])
    table = docs.sparkSession.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias(slot, "owner"))
    table = table.select(slot, F.element_at(names, F.col("owner").cast("int") + 1).alias(shard))
    rest = [F.col(f"d.`{c}`") for c in docs.columns if c not in (slot, shard)]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))
    placed = packed.withColumn(slot, slot_of(F.col("d.doc_id"), size))
    return placed.join(F.broadcast(table), slot).select(*rest, slot, shard)
