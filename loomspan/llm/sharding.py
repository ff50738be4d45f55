"""Shard placement by a permutation-filled lookup table (Maglev hashing, Eisenbud et al., 2016).

Every shard has its own order of preference over the slots of a prime-sized
table, given by an offset and a skip drawn from its name. The shards take turns,
each claiming the first slot of its order that is still free, until the table is
full. A row goes to the shard that owns slot hash(key) mod table size. Adding or
removing a shard moves few other slots, and every shard owns nearly the same number.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.plans.ranks import fresh

#: A prime over 100 times the default number of shards keeps their shares within a percent.
TABLE_SIZE = 16411
SHARDS = 64
#: Slots are the broadcast's rows, so this bounds its size (some 16 MB).
MAX_TABLE_SIZE = 1 << 20


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _hash(text: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{text}".encode()).hexdigest()[:12], 16)


def fill_table(names: list[str], size: int = TABLE_SIZE) -> list[int]:
    """The owner (index into names) of each slot. Depends on names and size alone.

    names must be distinct and no more than size, which must be a prime of at
    most MAX_TABLE_SIZE; this is the plan's parameter, filled before it runs.
    """
    if not names or len(set(names)) != len(names) or len(names) > size:
        raise ValueError("shard names must be distinct, at least one and no more than slots")
    if size > MAX_TABLE_SIZE or not _is_prime(size):
        raise ValueError(f"table size must be a prime of at most {MAX_TABLE_SIZE}")
    at = [_hash(name, "offset") % size for name in names]
    skip = [_hash(name, "skip") % max(1, size - 1) + 1 for name in names]
    owner = [-1] * size
    free = size
    while free:
        for shard in range(len(names)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + skip[shard]) % size
            owner[at[shard]] = shard
            free -= 1
            if not free:
                break
    return owner


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """The slot of a key: the first 48 bits of its text's MD5, modulo the table size. A null key counts as an empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("long"), F.lit(size)).cast("int")


def lookup_table(spark: SparkSession, names: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """(slot, shard) rows of the filled table, made from one literal."""
    owners = F.from_json(F.lit(json.dumps(fill_table(names, size), separators=(",", ":"))), "array<int>")
    return spark.range(1).select(F.posexplode(owners).alias("slot", "shard"))


def place(df: DataFrame, key: str, shards: int = SHARDS, size: int = TABLE_SIZE, names: list[str] | None = None) -> DataFrame:
    """df with ``shard`` (int, replaced if present): the owner of each row's slot.

    One map-side join with a broadcast of ``size`` rows and no shuffle, so a hot
    key costs nothing here; rows that repeat a key share its shard by design.
    Null keys are placed as the empty text. Other columns pass through,
    whatever their names; an empty table gives an empty result.
    """
    names = names or [f"shard-{i:05d}" for i in range(shards)]
    kept = df.drop("shard")
    (slot,) = fresh([*kept.columns, "shard"], "_slot")
    table = lookup_table(df.sparkSession, names, size).select(F.col("slot").alias(slot), "shard")
    return kept.withColumn(slot, slot_of(kept[key], size)).join(F.broadcast(table), slot).drop(slot)


def write_sharded(df: DataFrame, path: str, key: str, shards: int = SHARDS, files_per_shard: int = 1) -> None:
    """Write df partitioned by shard, a shard's rows dealt over files_per_shard tasks."""
    placed = place(df, key, shards)
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_shard))  # of the whole row, so that one hot key is dealt too
    placed.repartition(shards * files_per_shard, "shard", salt).write.partitionBy("shard").parquet(path)


def query(docs: DataFrame) -> DataFrame:
    """Every document's slot and shard."""
    rows = docs.select("doc_id")
    return place(rows, "doc_id").select("doc_id", slot_of(F.col("doc_id")).cast("long").alias("slot"), F.col("shard").cast("long").alias("shard"))


def oracle() -> str:
    owners = ",".join(map(str, fill_table([f"shard-{i:05d}" for i in range(SHARDS)])))
    return f"""
    WITH t AS (SELECT [{owners}] AS owner),
    d AS (SELECT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12))::BIGINT % {TABLE_SIZE} AS slot FROM documents)
    SELECT doc_id, slot, CAST(owner[slot + 1] AS BIGINT) AS shard FROM d, t
    """
