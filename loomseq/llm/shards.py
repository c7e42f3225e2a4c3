"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows are numbered from 0 in the order of ``doc_id`` and of a hash of the text, so numbers don't depend on files or splits. A
keyed Feistel network permutes the numbers below the next power of four; a number that lands at or beyond the number of rows
walks on until it is below, which makes it a permutation of the rows. The permuted number q gives the shard ``q mod shards``
and the slot ``q div shards``: counts differ by one at most, slots have no gaps, and ``place`` and ``row_at`` compute either
from the other without data.

Null keys come first; a null text counts as none and is hashed as such. Rows that repeat key and text get numbers of their
own, which of them is which doesn't show. Fewer rows than shards leave shards empty. No documents: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import documents, mapped, new_path, written

SHARDS, SEED, ROUNDS = 40, 13, 8
#: Bytes that a document counts besides those of its text.
OVERHEAD = 16
#: Rows of a partition have numbers below this within it, as Spark's increasing ids have.
WITHIN = 1 << 33


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """The round function: a 64-bit mix of a half and the round's key."""
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _keys(seed: int) -> list[int]:
    return [int(k) for k in np.random.default_rng(seed).integers(0, 1 << 63, ROUNDS)]


def permuted(rows: np.ndarray, n: int, seed: int = SEED, back: bool = False) -> np.ndarray:
    """The permutation of the numbers below ``n``, or its inverse."""
    half = max(1, ((max(n, 1) - 1).bit_length() + 1) // 2)
    bits, mask = np.uint64(half), np.uint64((1 << half) - 1)
    keys = _keys(seed)
    if back:
        keys.reverse()

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> bits, x & mask
        for key in keys:
            if back:
                left, right = right ^ (_mixed(left, key) & mask), left
            else:
                left, right = right, left ^ (_mixed(right, key) & mask)
        return left << bits | right

    out = once(np.asarray(rows).astype(np.uint64))
    while len(beyond := np.flatnonzero(out >= np.uint64(n))):  # the cycle of a number below n comes back below n
        out[beyond] = once(out[beyond])
    return out.astype(np.int64)


def place(row: int, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple[int, int]:
    """Shard and slot of a row number."""
    q = int(permuted(np.array([row]), n, seed)[0])
    return q % shards, q // shards


def row_at(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """The row number in a shard's slot."""
    return int(permuted(np.array([slot * shards + shard]), n, seed, back=True)[0])


def numbered(rows: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """``rows`` with their numbers from 0 in the given order as ``row``, and how many they are.

    Rows are range-partitioned by the order and by where they were read, so that equal rows are spread as well, and written
    with their places in their partitions. One number for each partition, the rows before it, is all that is gathered.
    """
    spark = rows.sparkSession
    path = new_path(spark, "numbered_rows")
    by = [*order, "read_at"]
    rows = rows.withColumn("read_at", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    rows = rows.drop("read_at").withColumn("within", F.monotonically_increasing_id())
    rows.write.parquet(path)
    back = spark.read.schema(rows.schema).parquet(path).withColumn("part", F.expr(f"within div {WITHIN}"))
    counts = back.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()  # one row a partition
    upto = np.append(0, np.cumsum([r.n for r in counts], dtype=np.int64)).tolist()
    starts = spark.createDataFrame([(r.part, b) for r, b in zip(counts, upto, strict=False)], "part long, base long")
    return back.join(F.broadcast(starts), "part").withColumn("row", F.col("base") + F.col("within") % WITHIN).drop("part", "base", "within"), upto[-1]


def dealt(rows: DataFrame, n: int, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows``, numbered by their column ``row`` below ``n``, with ``shard`` and ``slot``."""

    def run(batches):
        for batch in batches:
            q = permuted(batch.column("row").to_numpy(), n, seed)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((q % shards).astype(np.int32)), pa.array(q // shards)], [*batch.schema.names, "shard", "slot"])

    return mapped(rows, run, StructType([*rows.schema.fields, StructField("shard", IntegerType()), StructField("slot", LongType())]))


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """All columns of ``docs`` with ``shard`` and ``slot``; own columns of these names are replaced."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "slot")])
    rows, n = numbered(docs.select(own.alias("own"), F.col("doc_id").alias("key"), text_hash().alias("h")), "key", "h")
    return dealt(rows.select("own", "row"), n, shards, seed).select("own.*", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """A folder ``shard=i`` of Parquet files for each shard; a large shard is written by many tasks, each a range of its slots in order."""
    rows = sharded(docs, shards, seed)
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def placed(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The query's columns, by the law ``rows``; only keys, sizes and digests of texts are sorted, not texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = documents(docs, "doc_id", "text").select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), text_hash().alias("h"))
    rows, n = numbered(written(narrow, "shard_rows"), "doc_id", "h")
    return dealt(rows.drop("h"), n, shards).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
