"""Shard placement by a permutation-filled lookup table.

Each shard has a permutation of the slots of a prime-sized table (an offset
and a stride, both from a digest of its name).  Shards take turns, each
claiming the first slot of its permutation that is still free, until the table
is full.  All shards hold equal numbers of slots (within one), and when a
shard leaves, few keys of the others move.

Placement is one hash and one lookup in the broadcast table: no shuffle, no
state, the same answer on every executor.  The table has SLOTS rows whatever
the data's size, so its broadcast has a fixed bound.

Edge cases: a null key is placed like the text ``\\N``.  Repeated keys get
equal shards; other columns pass through, very long keys are hashed whole.  No
shards is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A prime; more than 100 slots for each of some hundred shards keep shares within 1 %.
SLOTS = 16381


def preference(name: str, slots: int = SLOTS) -> tuple[int, int]:
    """(offset, stride) of a shard's permutation of the slots."""
    d = hashlib.md5(name.encode()).hexdigest()
    return int(d[:15], 16) % slots, int(d[15:30], 16) % (slots - 1) + 1


def fill(names: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The index of the shard that holds each slot."""
    if not names or len(set(names)) < len(names):
        raise ValueError("shards need distinct names")
    if slots < len(names) or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime, and not below that of the shards")
    at, step = map(list, zip(*(preference(n, slots) for n in names), strict=True))
    owner, left = [-1] * slots, slots
    while True:
        for i in range(len(names)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % slots
            owner[at[i]] = i
            left -= 1
            if not left:
                return owner


def lookup_table(spark: SparkSession, names: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard, shard_name): SLOTS rows, from a literal."""
    owner = F.split(F.lit(",".join(map(str, fill(names, slots)))), ",")
    named = F.split(F.lit("\n".join(names)), "\n")
    rows = spark.range(1).select(F.posexplode(owner).alias("slot", "owner")).select("slot", F.col("owner").cast("int").alias("shard"))
    return rows.withColumn("shard_name", F.element_at(named, F.col("shard") + 1))


def slot_of(key, slots: int = SLOTS):
    """The slot of a key column: the first 60 bits of its MD5 digest, modulo the number of slots."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("\\N")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % F.lit(slots)).cast("int")


def place(df: DataFrame, key: str, names: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``df`` with slot, shard and shard_name of each row; columns of these names are replaced, the key too if it has one of them."""
    rows = df.withColumn("_slot_of_key", slot_of(F.col(key), slots)).drop("slot", "shard", "shard_name").withColumnRenamed("_slot_of_key", "slot")
    return rows.join(F.broadcast(lookup_table(df.sparkSession, names, slots)), "slot")


def write_shards(df: DataFrame, key: str, names: Sequence[str], path: str, slots: int = SLOTS, files: int = 1) -> None:
    """Writes one folder per shard, ``files`` files each; a hot shard is dealt over its files by a digest of the key."""
    placed = place(df, key, names, slots)
    salt = F.pmod(F.xxhash64(key), F.lit(files))
    placed.repartition(len(names) * files, "shard", salt).write.mode("overwrite").partitionBy("shard_name").parquet(path)
