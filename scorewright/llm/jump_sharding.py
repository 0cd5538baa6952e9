"""Operator 2: jump consistent hashing.

Each stable key is mapped to a shard by the jump hash of Lamping and Veach: no ring table, and when shards are
appended a row either stays or moves into one of the new shards.  Slots number the rows of a shard without gaps.

Defined results: a null id is a key of its own; a null text counts as empty; equal rows get different slots of the
same shard; an empty table gives an empty result; other columns of the input are ignored, whatever their names.

Scale: equal (id, size, checksum) rows are counted before any shuffle, so a hot id costs one counter a task, and are
written out again in chunks that all tasks share.  Slots
come from counts of ``shards x buckets`` cells (a fixed number) plus a rank inside a cell, so no task holds a shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewright.llm.common import each_copy, store

JUMP = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every unsigned 64-bit key; vectorised over the keys that still jump."""
    if shards < 1:
        raise ValueError("shards must be positive")
    key = keys.astype(np.uint64, copy=True)
    at = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    nxt = np.zeros(len(key), np.int64)
    while len(live):
        at[live] = nxt
        k = key[live] * JUMP + np.uint64(1)
        key[live] = k
        step = float(1 << 31) / ((k >> np.uint64(33)).astype(np.float64) + 1.0)
        nxt = ((at[live] + 1) * step).astype(np.int64)
        on = nxt < shards
        live, nxt = live[on], nxt[on]
    return at.astype(np.int32)


def jump_shard(key: Column, shards: int) -> Column:
    """Column form: ``key`` is a long."""
    @F.pandas_udf("int")
    def shard(k: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(k.to_numpy(np.int64).view(np.uint64), shards))
    return shard(key)


def stable_key(*columns: Column) -> Column:
    return F.xxhash64(*columns)


def shard_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 24,
               buckets: int = 1024) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, shard, slot, grown_shard``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                     F.crc32(text.cast("binary")).cast("long").alias("text_crc32"))
    same = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    key = stable_key(F.col("doc_id"))
    cell = F.pmod(F.xxhash64("doc_id", "size", "text_crc32", F.lit(5)), F.lit(buckets)).cast("int")
    placed = store(same.select("*", jump_shard(key, shards).alias("shard"),
                               jump_shard(key, shards + 1).alias("grown_shard"), cell.alias("cell")), "shards")
    # at most shards x buckets rows, whatever the input
    cells = placed.groupBy("shard", "cell").agg(F.sum("n").alias("rows"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("shard", "cell", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = (Window.partitionBy("shard", "cell").orderBy("doc_id", "size", "text_crc32")
              .rowsBetween(Window.unboundedPreceding, -1))
    ranked = placed.select("*", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("local"))
    return each_copy(ranked.join(starts, ["shard", "cell"]), "n", "copy").select(
        "doc_id", "size", "text_crc32", "shard", "grown_shard", (F.col("start") + F.col("local") + F.col("copy")).alias("slot"))
