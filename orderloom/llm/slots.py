"""Sharding by fixed virtual slots.

A record hashes into one of thousands of slots for good; only the table that maps
slots to shards changes. Each change is a new version of that table, stored beside
the earlier ones, and moves as few slots as evening out the bytes needs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import stored

SLOTS = 4096
PARTS = 64  # of a slot; only to number the records of a slot in more than one task


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and the slot and part that a record hashes into.

    Size is the UTF-8 length plus 1; a null text has no bytes and the checksum of the
    empty text. The id, the checksum and the size are the key, so only rows that repeat id
    and text share a slot.
    """
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(1)).cast("long")
    checksum = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long")
    key = F.xxhash64(F.col("doc_id"), checksum, size)
    return docs.select(
        "doc_id",
        size.alias("size"),
        checksum.alias("text_crc32"),
        F.pmod(key, F.lit(slots)).cast("int").alias("virtual_slot"),
        F.pmod(F.shiftrightunsigned(key, 40), F.lit(PARTS)).cast("int").alias("part"),
    )


def even(shard_of: np.ndarray, size: np.ndarray, shards: int, slack: float = 1e-5) -> np.ndarray:
    """Edit a map: move or swap slots between the fullest and the emptiest shard.

    Each step takes what brings the two closest; it ends when nothing helps any more
    or they differ by `slack` of a shard. Both arguments have one entry per slot.
    """
    shard_of = shard_of.copy()
    total = np.bincount(shard_of, size, shards)
    for _ in range(8 * len(size)):
        full, empty = int(total.argmax()), int(total.argmin())
        gap = total[full] - total[empty]
        if gap <= slack * total.mean():
            break
        a, b = np.flatnonzero(shard_of == full), np.flatnonzero(shard_of == empty)
        b = b[np.argsort(size[b], kind="stable")]
        have = np.concatenate([[0.0], size[b]])  # giving nothing back is a move
        want = size[a] - gap / 2
        at = np.clip(np.searchsorted(have, want), 1, len(have)) - 1
        at = np.where((at + 1 < len(have)) & (np.abs(have[np.minimum(at + 1, len(have) - 1)] - want) < np.abs(have[at] - want)), at + 1, at)
        shift = size[a] - have[at]
        left = np.abs(gap - 2 * shift)
        best = int(left.argmin())
        if left[best] >= gap:
            break
        shard_of[a[best]] = empty
        if at[best]:
            shard_of[b[at[best] - 1]] = full
        total[full] -= shift[best]
        total[empty] += shift[best]
    return shard_of


def slot_map(sizes: DataFrame, shards: int, slots: int = SLOTS, before: DataFrame | None = None) -> DataFrame:
    """The stored map (version, slot, shard) with one more version.

    `sizes` has `virtual_slot` and `bytes`, a row per slot at most, so what the driver
    holds is bounded by the number of slots. The first version deals the slots out in
    turn; each later one edits the one before for the sizes given.
    """
    spark = sizes.sparkSession
    size = np.zeros(slots)
    for row in sizes.collect():
        size[row["virtual_slot"]] = row["bytes"]
    schema = "version int, virtual_slot int, shard int"
    if before is None:
        dealt = [(1, s, s % shards) for s in range(slots)]
        before = spark.createDataFrame(dealt, schema)
    version = before.agg(F.max("version")).first()[0]
    last = np.zeros(slots, np.int64)
    for row in before.filter(F.col("version") == version).collect():
        last[row["virtual_slot"]] = row["shard"] % shards
    new = even(last, size, shards)
    rows = [(version + 1, s, int(new[s])) for s in range(slots)]
    return stored(before.unionByName(spark.createDataFrame(rows, schema)).coalesce(1), "slot-map")


def shard(docs: DataFrame, shards: int = 8, slots: int = SLOTS) -> DataFrame:
    """Every document with its shard and its place there, shards near equal in bytes.

    Two shuffles: bytes per slot (pre-aggregated) and the numbering. `slot` is the
    place in the shard, gapless from 0; `virtual_slot` is where the record hashed to.
    An empty table gives an empty result.
    """
    rows = stored(records(docs, slots), "records")
    counts = rows.groupBy("virtual_slot", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    counts = stored(counts, "slot-bytes")
    maps = slot_map(counts.groupBy("virtual_slot").agg(F.sum("bytes").alias("bytes")), shards, slots)
    current = maps.filter(F.col("version") == maps.agg(F.max("version")).first()[0]).drop("version")
    # at most slots * PARTS rows, whatever the input
    order = Window.partitionBy("shard").orderBy("virtual_slot", "part")
    starts = counts.join(current, "virtual_slot").select(
        "virtual_slot", "part", "shard", (F.sum("n").over(order) - F.col("n")).alias("first")
    )
    within = Window.partitionBy("virtual_slot", "part").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("rank", F.row_number().over(within) - 1)
    return numbered.join(starts, ["virtual_slot", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first") + F.col("rank")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
