"""Sharding by jump consistent hashing: no ring table, and appended shards only receive rows."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostra.llm.common import cut, numbered


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key, all keys jumping together; the expected number of jumps is ln(shards)."""
    state = keys.astype(np.uint64).copy()
    at = np.full(len(state), -1, np.int64)
    ahead = np.zeros(len(state), np.int64)
    live = np.flatnonzero(ahead < shards)
    while len(live):
        at[live] = ahead[live]
        state[live] = state[live] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((state[live] >> np.uint64(33)).astype(np.float64) + 1.0)
        ahead[live] = ((at[live] + 1).astype(np.float64) * step).astype(np.int64)
        live = live[ahead[live] < shards]
    return at


def stable_key(ids: pd.Series) -> np.ndarray:
    """First 64 bits of the MD5 of each id as text; a null id counts as the empty text."""
    return np.array([int.from_bytes(hashlib.md5(("" if x is None else x).encode()).digest()[:8], "big") for x in ids], np.uint64)


def shard_of(key: Column, shards: int) -> Column:
    """Shard 0..shards-1 of a key column; depends on nothing but the key's text and the number of shards."""

    @F.pandas_udf("int")
    def jump(ids: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(stable_key(ids), shards).astype(np.int32))

    return jump(key.cast("string"))


def with_shard(df: DataFrame, shards: int, key: str = "doc_id", into: str = "shard") -> DataFrame:
    """df and its shard, without a shuffle; a column that is already called so is replaced."""
    return df.withColumn(into, shard_of(df[key], shards))


def shard_manifest(docs: DataFrame, shards: int = 24, spread: int = 256) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of docs.

    The law is `key`: doc_id and the number of shards alone decide. Slots count the rows of a shard from 0
    without gaps, in the order of (spread bucket of doc_id and text_crc32, doc_id, text_crc32, size); rows alike in these three are
    counted before any shuffle of rows, so neither a repeated id nor a repeated row fills one task. Null
    texts count as empty, null ids as one key; an empty table gives no rows; other columns are ignored.
    The table of offsets that is broadcast has at most shards * spread rows.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    rows = cut(
        docs.select("doc_id", (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text).alias("text_crc32"))
        .groupBy("doc_id", "size", "text_crc32")
        .agg(F.count("*").alias("rows"))
        .select("*", shard_of(F.col("doc_id"), shards).alias("shard"), shard_of(F.col("doc_id"), shards + 1).alias("grown_shard"))
        .withColumn("part", (F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 17, 8), 16, 10).cast("long") + F.col("text_crc32")) % F.lit(spread))
    )
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("shard", "part")
        .agg(F.sum("rows").alias("held"))
        .select("shard", "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))
    )
    within = Window.partitionBy("shard", "part").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rows.withColumn("ahead", F.coalesce(F.sum("rows").over(within), F.lit(0)))
        .join(F.broadcast(offsets), ["shard", "part"]).withColumn("first", F.col("offset") + F.col("ahead"))
    )
    return numbered(placed, "first", "rows", "slot").select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
