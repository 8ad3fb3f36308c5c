"""A reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows are numbered in the order of a hash of their key columns. The number is then
put through a keyed Feistel network over the least even number of bits that holds
all rows; a result past the last row is put through again until it falls among
them (cycle walking), so all numbers from 0 to N - 1 occur once. A row's shard is
its shuffled number modulo the number of shards, and its slot the quotient. Both
can be worked out for any row number without the table, and shards differ by one
row at most.

Numbers come from counts by ``BUCKETS`` ranges of the hash, at most that many rows
and so broadcast, and from row numbers within each range: no task orders the whole
table.

Cases: rows that are equal in all key columns may swap places among themselves, which
changes nothing in the result. NULLs are values as any other. Empty tables give
empty results. All columns are kept; the added ones replace columns of their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spintally.llm.text import mixed

SHARDS = 8
SEED = 20240607
BUCKETS = 4096
FEISTEL_ROUNDS = 4


def permuted(numbers: np.ndarray, total: int, seed: int = SEED) -> np.ndarray:
    """The place of each row number in the shuffle of ``total`` rows."""
    half = max(1, (max(total - 1, 1).bit_length() + 1) // 2)
    mask, width = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mixed(np.arange(1, FEISTEL_ROUNDS + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(0x9E37))
    out = np.asarray(numbers, np.uint64).copy()
    walking = np.ones(len(out), bool)
    while walking.any():
        now = out[walking]
        left, right = now >> width, now & mask
        for key in keys:
            left, right = right, left ^ (mixed(right + key) & mask)
        out[walking] = (left << width) | right
        walking = out >= np.uint64(total)
    return out


def numbered(df: DataFrame, keys: tuple[str, ...]) -> tuple[DataFrame, int]:
    """``df`` with ``row_number`` from 0, and the number of rows."""
    df = df.withColumn("_hash", F.xxhash64(*keys)).withColumn("_bucket", F.pmod("_hash", F.lit(BUCKETS)))
    counts = df.groupBy("_bucket").agg(F.count("*").alias("rows"))
    ends = Window.orderBy("_bucket")
    offsets = counts.select("_bucket", (F.sum("rows").over(ends) - F.col("rows")).alias("_before"), "rows")
    found = offsets.collect()  # one row a bucket
    total = sum(row.rows for row in found)
    rows = [(row[0], row[1]) for row in found]
    before = df.sparkSession.createDataFrame(rows, "_bucket bigint, _before bigint")
    order = Window.partitionBy("_bucket").orderBy("_hash", *keys)
    numbers = df.withColumn("row_number", F.row_number().over(order)).join(F.broadcast(before), "_bucket")
    number = (F.col("row_number") - 1 + F.col("_before")).cast("bigint")
    return numbers.withColumn("row_number", number).drop("_hash", "_bucket", "_before"), total


def shard(df: DataFrame, keys: tuple[str, ...], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``df`` with ``shard`` and ``slot``, by a shuffle of all its rows."""
    rows, total = numbered(df, keys)

    @F.pandas_udf("bigint")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permuted(numbers.to_numpy(np.uint64), total, seed).view(np.int64))

    placed = rows.withColumn("_place", place("row_number"))
    placed = placed.withColumn("shard", F.pmod("_place", F.lit(shards)).cast("int"))
    return placed.withColumn("slot", F.floor(F.col("_place") / shards).cast("bigint")).drop("_place", "row_number")


def report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every document's size and checksum, and its shard and slot."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    sized = docs.select("doc_id", (F.length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = shard(sized, ("doc_id", "size", "text_crc32"), shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def shard_docs(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The documents with ``shard`` and ``slot``."""
    columns = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), "doc_id", F.xxhash64("text").alias("text_hash")
    )
    return shard(packed, ("doc_id", "text_hash"), shards).select("doc.*", "shard", "slot")
