"""Sharding by a permutation-filled lookup table.

A table of prime size is filled by the shards in turns: each shard has its own
preference order of slots (offset and skip from hashes of its name) and claims,
on its turn, the first slot of its order that nobody holds. Each shard ends with
``size // shards`` or one slot more, and when a shard goes, few slots of the
others change. A row's place is its key's hash modulo the table size, looked up
in the broadcast table.

The table's size depends on parameters only (never on the data), so filling it
is a short loop on the driver and its broadcast is of a known size. Placing rows is
one projection and a broadcast hash join; nothing is shuffled, so a hot source
or a group of copies costs nothing extra, and the balance is that of the hash.

Edge cases: a null key is placed by the row's text, null text as empty; equal
keys get equal shards; an empty table gives no rows; input columns named
``slot`` or ``shard`` are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots: a prime well over 100 times the usual number of shards.
SLOTS = 65537


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big")


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def filled(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Shard index of every slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names")
    if not is_prime(slots) or slots < len(shards):
        raise ValueError("the number of slots must be a prime of at least the number of shards")
    offset = [_number(s, "offset") % slots for s in shards]
    skip = [_number(s, "skip") % (slots - 1) + 1 if slots > 1 else 1 for s in shards]
    tried = [0] * len(shards)
    table, free = [-1] * slots, slots
    while free:
        for s in range(len(shards)):
            while True:
                slot = (offset[s] + tried[s] * skip[s]) % slots
                tried[s] += 1
                if table[slot] < 0:
                    break
            table[slot] = s
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, text: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: 60 bits of its md5 modulo the table size."""
    seed = F.coalesce(key.cast("string"), text.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(seed.cast("binary")), 1, 15), 16, 10).cast("long") % slots).cast("int")


def lookup(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard): the filled table."""
    names = F.array(*map(F.lit, shards))
    text = ",".join(map(str, filled(shards, slots)))
    return (spark.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias("_g_slot", "_g_index"))
            .select("_g_slot", F.element_at(names, F.col("_g_index").cast("int") + 1).alias("_g_shard")))


def place(df: DataFrame, shards: list[str], key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """All rows and columns of ``df`` plus ``slot`` and ``shard``."""
    base = df.drop("slot", "shard")
    base = base.withColumn("slot", slot_of(F.col(key), F.col(text) if text in df.columns else F.lit(None), slots))
    table = lookup(df.sparkSession, shards, slots)
    return base.join(F.broadcast(table), base["slot"] == F.col("_g_slot")).drop("_g_slot").withColumnRenamed("_g_shard", "shard")


def write_shards(df: DataFrame, shards: list[str], folder: str, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> None:
    """Write each shard under ``folder/shard=...``. Rows are rebalanced by
    shard, so a large shard is split over several files and tasks."""
    place(df, shards, key, text, slots).hint("rebalance", "shard").write.partitionBy("shard").parquet(folder)
