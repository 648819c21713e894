"""Sharding by jump consistent hashing.

The shard of a row depends on its doc_id and the number of shards alone. With one more shard a
row either stays or moves into the new one, and 1 of n + 1 rows moves; there is no ring
table to keep.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gavlake.llm.scratch import ship_by_value, small_batches, staged

SHARDS = 16
#: Largest table of offsets that is broadcast; above it the join shuffles.
MAX_BROADCAST_ROWS = 1_000_000


def jump(keys, shards):
    """Shard of each 64-bit key: the last bucket that its pseudo-random jumps reach."""
    state = np.asarray(keys).astype(np.int64).view(np.uint64).copy()
    out = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state), np.int64)
    going = np.arange(len(state))
    while len(going):
        out[going] = ahead[going]
        state[going] = state[going] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((state[going] >> np.uint64(33)).astype(np.float64) + 1)
        ahead[going] = ((out[going] + 1) * step).astype(np.int64)
        going = going[ahead[going] < shards]
    return out


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 1 and a null text has none of them; its checksum is 0, as
    an empty text's. ``grown_shard`` is the shard with one shard more. Slots number a shard's
    rows from 0 without gaps: a task numbers its own rows, which are written, and the tasks'
    counts give the offsets; so a shard of any size is never in one task, and only narrow
    rows are moved. Rows with the same doc_id, null ones too, share a shard and have
    a slot each. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("doc_id").alias("key"))

    def number(batches):
        task = TaskContext.get().partitionId()
        used = np.zeros(shards, np.int64)
        for batch in batches:
            key = batch.column("key").to_numpy()
            shard, grown = jump(key, shards), jump(key, shards + 1)
            place = np.empty(len(shard), np.int64)
            order = np.argsort(shard, kind="stable")
            counts = np.bincount(shard, minlength=shards)
            begin = np.cumsum(counts) - counts
            place[order] = np.arange(len(shard)) - np.repeat(begin - used, counts)
            used += counts
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("size"), batch.column("text_crc32"),
                 pa.array(shard.astype(np.int32)), pa.array(grown.astype(np.int32)),
                 pa.array(np.full(len(shard), task, np.int32)), pa.array(place)],
                ["doc_id", "size", "text_crc32", "shard", "grown_shard", "task", "place"])

    numbered = staged(rows.mapInArrow(
        number, "doc_id bigint, size bigint, text_crc32 bigint, shard int, grown_shard int, "
                "task int, place bigint"), "numbered")
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(
        numbered.groupBy("shard", "task").agg(F.count("*").alias("c"))
        .select("shard", "task", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset")),
        "offsets")
    if offsets.count() <= MAX_BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    return numbered.join(offsets, ["shard", "task"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("place") + F.col("offset")).alias("slot"), "grown_shard")


ship_by_value(__name__)
