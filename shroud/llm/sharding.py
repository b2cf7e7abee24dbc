"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table: offset +
k * skip modulo the size, both from a hash of the shard's name. The shards take turns; at its
turn a shard claims the first slot it prefers that is still free, until the table is full. So
shards hold nearly equal numbers of slots, and adding or removing a shard moves few keys. A row
is placed by hashing its key to a slot: the table is broadcast (its size is a parameter, never
the data's) and a lookup takes constant time, with no shuffle.

Defined cases: null keys hash like any value, null ids fall back on the text, so rows that lack an
id still spread; equal rows share a shard; an empty table gives an empty result; other columns
pass through, and a column named ``shard`` or ``slot`` of the input is replaced.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_SLOTS = 1 << 20  # bound of what is broadcast


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], size: int) -> list[int]:
    """Slot -> index of the shard that claimed it."""
    if not _is_prime(size) or not len(shards) <= size <= MOST_SLOTS:
        raise ValueError(f"table size {size}: a prime from {len(shards)} to {MOST_SLOTS} is needed")
    start = [zlib.crc32(f"offset:{s}".encode()) % size for s in shards]
    skip = [zlib.crc32(f"skip:{s}".encode()) % (size - 1) + 1 for s in shards]
    table, turn = [-1] * size, [0] * len(shards)
    left = size
    while left:
        for i in range(len(shards)):
            while table[slot := (start[i] + turn[i] * skip[i]) % size] >= 0:
                turn[i] += 1
            table[slot] = i
            left -= 1
            if not left:
                break
    return table


def table_frame(spark: SparkSession, shards: list[str], size: int) -> DataFrame:
    """(slot, shard) from the table as one literal; no RDD."""
    csv = ",".join(map(str, lookup_table(shards, size)))
    return spark.range(1, numPartitions=1).select(F.posexplode(F.split(F.lit(csv), ",")).alias("slot", "s")).select(
        F.col("slot").cast("long"), F.col("s").cast("int").alias("shard"))


def slot_of(key: list[Column], size: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(9), *key), F.lit(size))


def place(docs: DataFrame, n_shards: int = 64, size: int = 16381, key: list[str] | None = None) -> DataFrame:
    """docs with ``slot`` and ``shard``. Key: doc_id, or the text where that is null."""
    cols = [F.col(c) for c in key] if key else [F.col("doc_id"), F.when(F.col("doc_id").isNull(), F.col("text"))]
    docs = docs.drop("slot", "shard").withColumn("slot", slot_of(cols, size))
    at = table_frame(docs.sparkSession, [f"shard-{i:05d}" for i in range(n_shards)], size)
    return docs.join(F.broadcast(at), "slot").select(*[c for c in docs.columns if c != "slot"], "slot", "shard")
