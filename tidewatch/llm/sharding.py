"""Placement of rows on shards by a lookup table that the shards fill in turn."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slots of the table: a prime, about a thousand for each of 64 shards. The
#: broadcast holds so many pairs of small numbers, whatever the input's size.
TABLE_SIZE = 65_537
MOST_SLOTS = 2_000_003


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def preference(shard: str, size: int) -> tuple[int, int]:
    """First slot and step of the order in which a shard asks for slots."""
    digest = hashlib.sha256(shard.encode()).digest()
    return (
        int.from_bytes(digest[:8], "big") % size,
        int.from_bytes(digest[8:16], "big") % (size - 1) + 1,
    )


def lookup_table(shards: Sequence[str], size: int = TABLE_SIZE) -> np.ndarray:
    """The number of the shard that holds each slot.

    A shard's order of preference runs through all slots, as its step and the
    prime size have no common factor. In each round every shard claims the
    first slot of its order that is still free.
    """
    if not is_prime(size) or size > MOST_SLOTS:
        raise ValueError(f"the table needs a prime number of slots up to {MOST_SLOTS}")
    if not 0 < len(shards) <= size or len(set(shards)) < len(shards):
        raise ValueError("shards must be distinct, at least one, and no more than slots")
    orders = [preference(shard, size) for shard in shards]
    at = [first for first, _ in orders]
    steps = [step for _, step in orders]
    table = [-1] * size
    free = size
    while free:
        for number in range(len(orders)):
            slot = at[number]
            while table[slot] >= 0:
                slot = (slot + steps[number]) % size
            table[slot] = number
            at[number] = (slot + steps[number]) % size
            free -= 1
            if not free:
                break
    return np.array(table, dtype=np.int32)


def place(df: DataFrame, key: str, shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    """Every row with slot, shard_no and shard; input columns of these names are replaced.

    The slot is the key's hash modulo the table's size. Null keys have one
    hash and so one place; equal keys share theirs; an empty table gives no
    rows. Removing a shard moves its own rows and few others.
    """
    spark = df.sparkSession
    table = lookup_table(shards, size)
    entries = spark.createDataFrame(
        [(slot, int(no), shards[no]) for slot, no in enumerate(table.tolist())],
        "slot int, shard_no int, shard string",
    )
    rows = df.withColumn("_slot_of_key", F.pmod(F.xxhash64(F.col(key)), F.lit(size)).cast("int"))
    rows = rows.drop("slot", "shard_no", "shard")
    placed = rows.join(F.broadcast(entries), rows["_slot_of_key"] == entries["slot"], "inner")
    return placed.drop("_slot_of_key")


def loads(placed: DataFrame) -> DataFrame:
    """Rows of each shard."""
    return placed.groupBy("shard_no", "shard").agg(F.count("*").alias("n_rows"))


def write_shards(placed: DataFrame, path: str, salts: int = 8) -> None:
    """One folder for each shard, in several files, so that no task writes a whole shard."""
    spread = F.pmod(F.xxhash64(*[c for c, t in placed.dtypes if "map" not in t and "variant" not in t]), F.lit(salts))
    placed.repartition("shard_no", spread).write.partitionBy("shard").parquet(path)
