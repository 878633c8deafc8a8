"""Sharding by a permutation-filled lookup table.

Every shard prefers the slots of a prime-sized table in an order of its own, (offset + turn * skip) modulo the prime.
The shards take turns; at its turn each claims the first free slot of its order. So shards differ by one slot at
most, and a shard that leaves or joins moves little beyond its own share. A key goes to the slot of its hash.

The table depends on the shards' names and the prime alone. It is a relation of ``slots`` rows, broadcast under that
proven bound; placing rows needs no shuffle and reads a key column only.

Defined cases: a null key has a slot of its own like any other value; equal keys share a shard; an empty table stays
empty; other columns are kept, but for those named like the two results, which are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SLOTS = 65_537
MOST_SLOTS = 1 << 20  # broadcast: 16 bytes a slot


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def preference(shard: str, slots: int) -> tuple[int, int]:
    """Offset and skip of a shard's order of the slots."""
    digest = hashlib.md5(shard.encode()).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:], "big") % (slots - 1) + 1


def lookup(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The shard's place in ``shards`` for every slot."""
    if not is_prime(slots) or not len(shards) <= slots <= MOST_SLOTS:
        raise ValueError(f"slots must be a prime from the number of shards to {MOST_SLOTS}")
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names")
    # Turns follow the names, so that the order of the list plays no part.
    turns = sorted(range(len(shards)), key=lambda i: shards[i])
    nexts = {i: preference(shards[i], slots) for i in turns}
    owner, free = [-1] * slots, slots
    while True:
        for i in turns:
            at, skip = nexts[i]
            while owner[at] >= 0:
                at = (at + skip) % slots
            owner[at] = i
            nexts[i] = ((at + skip) % slots, skip)
            free -= 1
            if not free:
                return owner


def lookup_table(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``slot long, shard string``; the shard numbers travel as one binary literal, four bytes each."""
    packed = F.lit(b"".join(i.to_bytes(4, "big") for i in lookup(shards, slots)))
    names = F.array(*map(F.lit, shards))
    number = F.conv(F.hex(F.substring(packed, (F.col("id") * 4 + 1).cast("int"), F.lit(4))), 16, 10).cast("int")
    return spark.range(slots).select(F.col("id").alias("slot"), F.element_at(names, number + 1).alias("shard"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """60 bits of the key's MD5 as text, modulo the table's size; null has the slot of the word null."""
    text = F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("null"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % F.lit(slots)


def assign_shards(df: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` of each row's key."""
    rows = df.drop(*[c for c in ("slot", "shard") if c != key]).withColumn("slot", slot_of(F.col(key), slots))
    return rows.join(F.broadcast(lookup_table(df.sparkSession, shards, slots)), "slot")
