"""Sharding by a permutation-filled lookup table.

Every shard has a preference order over the slots of a table of prime size (a start and a step from
its name's hash); shards take turns, each claiming its first free slot, until the table is full. A
key's hash picks a slot and the slot names the shard. Turns differ by one slot at most, and
when shards come or go few slots change hands.

The table depends on the shards alone, never on the data: size rows (PRIME by default, LARGEST at most) are
broadcast, and placement is one hash and one lookup for each row, without a shuffle, so that no key, source or group can weigh
on a task.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Over 100 slots for each of some 600 shards.
PRIME = 65_537
#: Tables beyond this are refused, which bounds the broadcast to some 20 MB.
LARGEST = 1_000_003


ADDED = ("_slot", "_shard_id", "_shard")


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def number(name: str) -> int:
    """60 bits of the SHA-256 of a name."""
    return int(hashlib.sha256(name.encode()).hexdigest()[:15], 16)


def fill_table(shards: Sequence[str], size: int = PRIME, weights: Sequence[int] | None = None) -> list[int]:
    """The shard index of each slot. weights: turns a shard takes in each round, 1 by default."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be named, each once")
    if not is_prime(size) or size > LARGEST or size < len(shards):
        raise ValueError(f"size must be a prime from the number of shards up to {LARGEST}")
    turns = list(weights) if weights is not None else [1] * len(shards)
    if len(turns) != len(shards) or min(turns) < 1:
        raise ValueError("weights must be 1 or more, one for each shard")
    # size is prime, so any step from 1 to size - 1 walks over every slot
    at = [number(f"start:{s}") % size for s in shards]
    step = [number(f"step:{s}") % (size - 1) + 1 for s in shards]
    owner, left = [-1] * size, size
    while left:
        for shard, n in enumerate(turns):
            for _ in range(min(n, left)):
                while owner[at[shard]] >= 0:
                    at[shard] = (at[shard] + step[shard]) % size
                owner[at[shard]] = shard
                left -= 1
    return owner


def lookup(spark: SparkSession, shards: Sequence[str], size: int = PRIME, weights: Sequence[int] | None = None) -> DataFrame:
    """The table as (slot, shard_id, shard) rows."""
    owners = fill_table(shards, size, weights)
    slots = F.from_json(F.lit(json.dumps(owners)), "array<int>")
    names = F.from_json(F.lit(json.dumps(list(shards))), "array<string>")
    return spark.range(1).select(names.alias("names"), F.posexplode(slots).alias("slot", "shard_id")).select("slot", "shard_id", F.element_at("names", F.col("shard_id") + 1).alias("shard"))


def slot_of(key: Column, size: int) -> Column:
    """0 to size - 1 from the SHA-256 of the key as text; a null key counts as the empty text."""
    digits = F.substring(F.sha2(F.coalesce(key.cast("string"), F.lit("")), 256), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(size)).cast("int")


def shard(docs: DataFrame, shards: Sequence[str], key_col: str = "doc_id", size: int = PRIME, weights: Sequence[int] | None = None) -> DataFrame:
    """docs with _slot, _shard_id and _shard.

    Equal keys meet in one shard, whatever their number; null and empty keys share one. Other columns pass through; columns of docs
    that are named like the three are replaced.
    """
    table = lookup(docs.sparkSession, shards, size, weights)
    named = table.select(F.col("slot").alias("_slot"), F.col("shard_id").alias("_shard_id"), F.col("shard").alias("_shard"))
    whole = docs.select(F.struct("*").alias("row"), slot_of(F.col(key_col), size).alias("_slot"))  # own columns of any name stay apart
    return whole.join(F.broadcast(named), "_slot").select(*(F.col("row").getField(c).alias(c) for c in docs.columns if c not in ADDED), *ADDED)


def write_shards(docs: DataFrame, path: str, shards: Sequence[str], key_col: str = "doc_id", files_per_shard: int = 1, **options) -> str:
    """Write docs as Parquet, a folder for each shard; returns the name of the folders' column: shard, or with underscores before it if docs has that column.

    Rows are dealt by (shard, part), where the part comes from the key and the input partition: a shard fills files_per_shard tasks, and a key or row that is repeated
    without end is spread over them as it is over the input. Columns of any name and type are written as they are.
    """
    column = "shard"
    while column in docs.columns:
        column = f"_{column}"
    size = options.get("size", PRIME)
    named = lookup(docs.sparkSession, shards, **options).select("slot", "shard")
    part = F.pmod(F.xxhash64(F.coalesce(F.col(key_col).cast("string"), F.lit("")), F.spark_partition_id()), F.lit(files_per_shard))
    dealt = docs.select(F.struct("*").alias("row"), slot_of(F.col(key_col), size).alias("slot"), part.alias("part")).join(F.broadcast(named), "slot")
    dealt = dealt.repartition(len(shards) * files_per_shard, "shard", "part")
    dealt.select(*(F.col("row").getField(c).alias(c) for c in docs.columns), F.col("shard").alias(column)).write.mode("overwrite").partitionBy(column).parquet(path)
    return column
