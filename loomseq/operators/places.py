"""Symbols by their place in reads, counted within tasks; and reads that are frequent, found by mergeable summaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written

#: Places from the start of reads that a task keeps a table for (of 128 counts each); further ones are counted batch by batch.
KEPT_PLACES = 16_384
#: Samples whose tables a task keeps at once.
KEPT_SAMPLES = 8
#: Bases whose keys are in memory at once.
SLICE = 1 << 22


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[str | None, np.ndarray, np.ndarray]]:
    """Sample, places and symbols of a batch's reads, of at most ``SLICE`` symbols and one sample at once."""
    texts = batch.column(column).cast(pa.binary())
    codes = batch.column("sample").dictionary_encode()
    names = codes.dictionary.to_pylist()
    which = codes.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    for s in np.unique(which).tolist():
        held, size = [], 0
        for i in np.flatnonzero(which == s).tolist():
            text = texts[i].as_buffer()
            if text is None:
                continue
            raw = np.frombuffer(text, np.uint8)
            for at in range(0, len(raw), SLICE):
                part = raw[at : at + SLICE]
                held.append((at, part))
                size += len(part)
                if size >= SLICE:
                    yield None if s < 0 else names[s], np.concatenate([np.arange(a, a + len(p)) for a, p in held]), np.concatenate([p for _, p in held])
                    held, size = [], 0
        if held:
            yield None if s < 0 else names[s], np.concatenate([np.arange(a, a + len(p)) for a, p in held]), np.concatenate([p for _, p in held])


def place_counts(reads: DataFrame, column: str) -> DataFrame:
    """``(sample, pos, code, n)``: how many reads have the symbol of a byte's ``code`` at each 0-based place of ``column``.

    Tasks count in arrays, so what is shuffled is a row for each sample, place and symbol of a task, not for each base.
    """
    schema = "sample string, pos int, code int, n bigint"

    def rows(sample, pos, code, n):
        return pa.RecordBatch.from_arrays([pa.array([sample] * len(pos), pa.string()), pa.array(pos, pa.int32()), pa.array(code, pa.int32()), pa.array(n, pa.int64())], ["sample", "pos", "code", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str | None, np.ndarray] = {}

        def flush(sample):
            table = tables.pop(sample)
            pos, code = np.nonzero(table)
            return rows(sample, pos, code, table[pos, code])

        for batch in batches:
            for sample, place, symbol in _slices(batch, column):
                near = (place < KEPT_PLACES) & (symbol < 128)
                if not near.all():
                    keys, n = np.unique(place[~near] << 8 | symbol[~near], return_counts=True)
                    yield rows(sample, keys >> 8, keys & 255, n)
                counts = np.bincount(place[near] << 7 | symbol[near])
                if sample not in tables and len(tables) >= KEPT_SAMPLES:
                    yield flush(next(iter(tables)))
                table = tables.setdefault(sample, np.zeros((0, 128), np.int64))
                places = -(-len(counts) // 128)
                if places > len(table):
                    table = tables[sample] = np.concatenate([table, np.zeros((min(max(places, 2 * len(table)), KEPT_PLACES) - len(table), 128), np.int64)])
                table.ravel()[: len(counts)] += counts
        for sample in list(tables):
            yield flush(sample)

    found = reads.select("sample", column).mapInArrow(run, schema)
    return found.groupBy("sample", "pos", "code").agg(F.sum("n").alias("n"))


def digest(seq: str = "seq"):
    """256 bits that stand for a sequence, so that no whole reads are shuffled."""
    return F.unhex(F.sha2(F.col(seq).cast("binary"), 256))


class Frequent:
    """Misra and Gries: with ``size`` counters, every key of more than one in ``size + 1`` of the keys added has one; a counter is too low by ``lost`` at most."""

    def __init__(self, size: int) -> None:
        self.size, self.counts, self.lost = size, {}, 0

    def add(self, keys: list) -> None:
        """Adds a batch of keys: their counts first, then as many as the least beyond ``size`` have are taken from all."""
        counts = self.counts
        for k in keys:
            counts[k] = counts.get(k, 0) + 1
        if len(counts) > self.size:
            cut = sorted(counts.values(), reverse=True)[self.size]
            self.counts, self.lost = {k: n - cut for k, n in counts.items() if n > cut}, self.lost + cut


def frequent_candidates(reads: DataFrame, min_share: float) -> DataFrame:
    """``(sample, d)``: digests that may have ``min_share`` of a sample's reads or more, among them all that have."""
    size = int(np.ceil(1 / min_share))
    schema = "sample string, d binary, n bigint, lost bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, Frequent] = {}
        for batch in batches:
            samples, keys = batch.column("sample").to_pylist(), batch.column("d").to_pylist()
            of: dict[str | None, list] = {}
            for s, k in zip(samples, keys, strict=True):
                of.setdefault(s, []).append(k)
            for s, ks in of.items():
                held.setdefault(s, Frequent(size)).add(ks)
        for s, summary in held.items():
            # a row without a digest says what any digest may have lost in this task
            found = [*summary.counts.items(), (None, 0)]
            yield pa.RecordBatch.from_arrays([pa.array([s] * len(found), pa.string()), pa.array([k for k, _ in found], pa.binary()), pa.array([n for _, n in found], pa.int64()), pa.array([summary.lost if k is None else 0 for k, _ in found], pa.int64())], ["sample", "d", "n", "lost"])

    rows = written(reads.where("seq is not null").select("sample", digest().alias("d")).mapInArrow(run, schema), "frequent")
    total = reads.where("seq is not null").groupBy("sample").agg(F.count("*").alias("whole"))
    lost = rows.groupBy("sample").agg(F.sum("lost").alias("lost"))
    least = written(total.join(lost, "sample").select("sample", (F.col("whole") * min_share - F.col("lost")).alias("least")), "least_counts")
    return rows.where("d is not null").groupBy("sample", "d").agg(F.sum("n").alias("n")).join(F.broadcast(least), "sample").where("n >= least").select("sample", "d")  # one row a sample
