"""Packing by powers of two: each document is cut into pieces whose lengths are the binary digits of its own length.

A document of n ids gives n // 4096 pieces of 4096 and one piece for each binary digit of the rest, longest first. A piece
is a sequence by itself, its length is a power of two, and sequences of equal length are numbered one after another
(longest first), so a batch takes its sequences from one bucket: no padding, and no sequence crosses documents.

Numbering takes two steps. Pieces are written with their rank among the pieces of the same length in their partition;
the counts of each partition and length (a few rows for each partition) then give every such run its first number.

Null or empty text: the end id alone, one piece. Rows that repeat a key are packed one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, mapped, sliced, utf8_of, written
from .word_bpe import word_bpe

LONGEST = 4096
#: Runs (about twenty bytes each) that are sent to every executor; more of them are joined by a shuffle.
MOST_RUNS = 200_000


def piece_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Powers of two that sum to n, descending; only the longest repeats."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in reversed(range(longest.bit_length() - 1)) if rest >> b & 1]


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, longest: int = LONGEST) -> DataFrame:
    """``(doc_id, start, length, ids binary, doc_tokens, part, rank)``; ids are little-endian unsigned 32-bit."""
    if longest < 1 or longest & longest - 1:
        raise ValueError("the longest sequence must be a power of two")
    key_type = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, tail = word_bpe(tokenizer).encode_all, int(end_id).to_bytes(4, "little")
        part, ranks = TaskContext.get().partitionId(), dict.fromkeys((1 << b for b in range(longest.bit_length())), 0)
        for batch in sliced(batches):
            rows, starts, sizes, blobs, totals, numbers = [], [], [], [], [], []
            for row, ids in enumerate(encode(utf8_of(batch))):
                ids, at = ids + tail, 0
                for size in piece_lengths(len(ids) // 4, longest):
                    rows.append(row)
                    starts.append(at)
                    sizes.append(size)
                    blobs.append(ids[4 * at : 4 * (at + size)])
                    totals.append(len(ids) // 4)
                    numbers.append(ranks[size])
                    ranks[size] += 1
                    at += size
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int32())), *[pa.array(x, pa.int64()) for x in (starts, sizes)], pa.array(blobs, pa.binary()), pa.array(totals, pa.int64()), pa.array(np.full(len(rows), part, "i4")), pa.array(numbers, pa.int64())],
                ["doc_id", "start", "length", "ids", "doc_tokens", "part", "rank"],
            )

    return mapped(documents(docs, "doc_id", "text"), cut, f"doc_id {key_type}, start bigint, length bigint, ids binary, doc_tokens bigint, part int, rank bigint")


def with_crc32(df: DataFrame) -> DataFrame:
    return df.withColumn("ids_crc32", F.crc32("ids"))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, longest: int = LONGEST) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset`` (always 0: a piece is a sequence)."""
    cut = written(pieces(docs, tokenizer, end_id, longest), "pieces")
    runs = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.orderBy(F.desc("length"), "part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    runs = written(runs, "runs")
    if runs.count() <= MOST_RUNS:
        runs = F.broadcast(runs)
    return cut.join(runs, ["part", "length"]).select("doc_id", "start", "length", "ids", "doc_tokens", (F.col("base") + F.col("rank")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def packed_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The query's columns."""
    return with_crc32(pack(docs, tokenizer)).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
