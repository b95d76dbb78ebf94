"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table. The shards take
turns; each claims the first slot of its order that is still free, until the table is full. A row
goes to the shard that owns slot ``hash(key) mod slots``. Adding or removing a shard moves little
more than that shard's share of the rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest table; the broadcast lookup has one (int, int) row per slot.
MAX_SLOTS = 5_000_011

#: Hex digits of md5 that fit a non-negative long.
DIGITS = 15


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:DIGITS], 16)


def lookup_table(shards: list[str], slots: int) -> list[int]:
    """The index in ``shards`` of the owner of each slot.

    ``slots`` must be a prime not below the number of shards, so that each step width visits
    every slot; 100 slots per shard keep the shares within a few percent. Names must differ.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names, one at least")
    if not len(shards) <= slots <= MAX_SLOTS:
        raise ValueError(f"slots must lie between the number of shards and {MAX_SLOTS}")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime")
    start = [_number(f"{name}/start") % slots for name in shards]
    width = [_number(f"{name}/width") % (slots - 1) + 1 for name in shards]
    owner, free = [-1] * slots, slots
    while free:
        for shard in range(len(shards)):
            if not free:
                break
            while owner[start[shard]] >= 0:
                start[shard] = (start[shard] + width[shard]) % slots
            owner[start[shard]] = shard
            free -= 1
    return owner


def place(df: DataFrame, key: str, shards: list[str], slots: int) -> DataFrame:
    """``df`` with the columns ``slot`` and ``shard`` (index in ``shards``), both int.

    The table is broadcast: its size is the parameter ``slots``, whatever the data. A null key
    counts as the empty text, so those rows share a slot; equal keys share one too. Columns of
    ``df`` named ``slot`` or ``shard`` are replaced. An empty ``df`` gives an empty result.
    """
    spark = df.sparkSession
    owners = spark.createDataFrame(
        list(enumerate(lookup_table(shards, slots))), "slot int, shard int"
    )
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    slot = (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long") % slots).cast("int")
    # the key is read before a column of that name is replaced
    rows = df.withColumn("slot", slot).drop("shard")
    return rows.join(F.broadcast(owners), "slot").select(
        *(c for c in rows.columns if c != "slot"), "slot", "shard"
    )


def write_shards(
    df: DataFrame, key: str, shards: list[str], slots: int, path: str, rows_per_file: int = 1_000_000
) -> None:
    """Write each shard to a folder ``shard=<index>`` of parquet files below ``path``.

    Rows are dealt by (shard, slot), so a large shard is written by many tasks; a rebalance, so that
    AQE splits a slot with too many rows, such as that of null keys or of one frequent key. Columns
    named slot or shard are replaced, equal rows are all written, an empty table gives no files.
    """
    placed = place(df, key, shards, slots)
    (
        placed.hint("rebalance", "shard", "slot")
        .drop("slot")
        .write.option("maxRecordsPerFile", rows_per_file)
        .partitionBy("shard")
        .parquet(path)
    )
