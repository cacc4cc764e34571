"""Sharding by a permutation-filled lookup table.

Every shard ranks all slots of a prime-sized table by its own permutation (offset and skip taken from hashes of its
name); shards take turns, in proportion to their weights, claiming the first free slot of their ranking. A key's slot
is its hash modulo the table size, so placement is one look-up, and adding or losing a shard moves few keys. Columns called like the operator's own keep their values under
``<name>_input``.

Null handling: a null key is hashed as null (a fixed slot). Rows are never dropped; repeated keys share a shard.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm.chunks import set_aside

TABLE_SIZE = 65_537
MAX_TABLE_SIZE = 1_000_003


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], size: int = TABLE_SIZE, weights: dict[str, int] | None = None) -> list[int]:
    """Index into ``shards`` for each slot. Shares differ by at most one turn per unit of weight."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and distinct")
    if not _is_prime(size) or not len(shards) <= size <= MAX_TABLE_SIZE:
        raise ValueError("the table size must be a prime between the number of shards and MAX_TABLE_SIZE")
    turns = [int((weights or {}).get(s, 1)) for s in shards]
    if min(turns) < 1:
        raise ValueError("weights are positive integers")
    place = []
    for name in shards:
        digest = hashlib.sha256(name.encode()).digest()
        place.append([int.from_bytes(digest[:8], "little") % size, int.from_bytes(digest[8:16], "little") % (size - 1) + 1])
    owner, free = [-1] * size, size
    while free:
        for k, (slot, skip) in enumerate(place):
            for _ in range(min(turns[k], free)):
                while owner[slot] >= 0:
                    slot = (slot + skip) % size
                owner[slot] = k
                free -= 1
            place[k][0] = slot
    return owner


def table_frame(spark: SparkSession, shards: list[str], size: int = TABLE_SIZE, weights: dict[str, int] | None = None) -> DataFrame:
    owner = lookup_table(shards, size, weights)
    return spark.createDataFrame([(i, k, shards[k]) for i, k in enumerate(owner)], "slot long, shard_id int, shard string")


def assign_shards(df: DataFrame, key: str, shards: list[str], size: int = TABLE_SIZE, weights: dict[str, int] | None = None) -> DataFrame:
    """Add ``slot, shard_id, shard``. The table (at most MAX_TABLE_SIZE rows) is broadcast; there is no shuffle."""
    table = F.broadcast(table_frame(df.sparkSession, shards, size, weights)).withColumnRenamed("slot", "_slot")
    aside = set_aside(df, ["slot", "shard_id", "shard"])
    key = dict(zip(df.columns, aside.columns, strict=True))[key]
    placed = aside.withColumn("slot", F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(size)))
    return placed.join(table, placed["slot"] == table["_slot"]).drop("_slot")


def write_shards(df: DataFrame, path: str, key: str, shards: list[str], files_per_shard: int = 8, **kw) -> None:
    """Write one folder per shard; a shard's rows are salted over ``files_per_shard`` tasks so that none is hot."""
    placed = assign_shards(df, key, shards, **kw)
    salted = placed.repartition(F.col("shard_id"), F.pmod(F.xxhash64(*[c for c, kind in placed.dtypes if "map<" not in kind and "variant" not in kind]), F.lit(files_per_shard)))
    salted.write.mode("overwrite").partitionBy("shard").parquet(path)
