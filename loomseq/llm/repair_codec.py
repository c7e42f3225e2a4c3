"""Token-ID output in shards compressed by a grammar (Re-Pair).

File format: a Parquet table with one row for each shard and four columns.

* ``shard``: its place in the order of the documents, as (range of keys, number within the range).
* ``n_ids``: ids that it decodes to.
* ``index``: one struct per document: key, first id within the shard, number of ids, first symbol in ``body``.
* ``body``: little-endian 32-bit integers: magic, version, R rules, S symbols; R left sides, R right sides, R expansion
  lengths; S symbols. A symbol below ``FIRST_RULE`` is an id, others are rules; rules refer to earlier rules only.

Each round of a shard counts adjacent pairs of symbols. Where frequent pairs overlap, the more frequent one is replaced by
its nonterminal, in runs of one pair every second from the left. Rounds go on until no pair occurs ``LEAST`` times in the
shard. A nonterminal never crosses documents, so a document is decoded from its own symbols, and expansion lengths lead to
any id of it without decoding what stands before.

Documents are dealt out by ranges of the key and sorted, so no task or shard holds more than its range; ranges are cut
into shards of at most ``SHARD_IDS`` ids (a longer document has its own). Null or empty text: only the end id. Rows that repeat a key are
kept, ordered by text. Null keys come first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, mapped, new_path, sliced, utf8_of
from .word_bpe import word_bpe

MAGIC, VERSION, FIRST_RULE = 0x52504952, 1, 1 << 20
#: Ids of one shard, and how often a pair must occur in a shard to become a rule.
SHARD_IDS, LEAST = 1 << 20, 8


def _counted(pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the places whose pair may be frequent: their indices, the number of their pair, and for each number its pair and count.

    Places are counted in slots of a hash table first; of pairs in one slot, all but one wait for a later round. A
    pair without number has the number -1.
    """
    bits = max(8, min(21, len(pair).bit_length() + 1))
    slot = ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)
    at = np.flatnonzero(np.bincount(slot, minlength=1 << bits)[slot] >= LEAST)
    pair, slot = pair[at], slot[at]
    values = np.zeros(1 << bits, np.int64)
    values[slot] = pair
    same = values[slot] == pair
    counts = np.bincount(slot[same], minlength=1 << bits)
    number = np.where(same & (counts[slot] >= LEAST), slot, -1)
    if len(at) and (number < 0).all():  # the pairs that had the slots are rare, so what waits is counted exactly
        values, number, counts = np.unique(pair, return_inverse=True, return_counts=True)
        number = np.where(counts[number] >= LEAST, number, -1)
    return at, number, values, counts


def compress(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, rules (left, right; one row each), expansion lengths, and each document's first symbol.

    ``starts``: where documents begin, ascending.
    """
    seq = ids.astype(np.int64)
    first = np.zeros(len(seq) + 1, bool)
    first[starts] = True
    first = first[:-1]
    rules, lengths = [np.zeros((2, 0), np.int64)], np.zeros(0, np.int64)
    live = np.ones(len(seq), bool)  # a pair may begin here that is frequent; one that is rare stays so
    while True:
        at = np.flatnonzero(live[:-1] & ~first[1:])
        may, number, values, counts = _counted(seq[at] << 32 | seq[at + 1])
        at = at[may]
        live[:] = False
        live[at] = True
        at, number = at[number >= 0], number[number >= 0]
        if not len(at):
            break
        # where two frequent pairs overlap the more frequent one wins
        rank = counts[number] << 22 | number
        next_to = np.diff(at) == 1
        win = np.ones(len(at), bool)
        win[:-1] &= ~(next_to & (rank[1:] > rank[:-1]))
        win[1:] &= ~(next_to & (rank[:-1] > rank[1:]))
        hit, number = at[win], number[win]
        # what is left side by side is a run of one pair
        new_run = np.append(True, np.diff(hit) > 1)
        place = np.arange(len(hit))
        taken = (place - np.maximum.accumulate(np.where(new_run, place, 0))) % 2 == 0
        hit, number = hit[taken], number[taken]
        hits = np.bincount(number, minlength=len(values))
        used = hits >= LEAST // 2  # a pair that loses more often than that waits; the most frequent one never does
        hit, number = hit[used[number]], number[used[number]]
        rule = np.cumsum(used) - 1
        values = values[used]
        sides = np.stack([values >> 32, values & 0xFFFFFFFF])
        sizes = sum(np.where(x < FIRST_RULE, 1, lengths[(x - FIRST_RULE).clip(0)] if len(lengths) else 1) for x in sides)
        seq[hit] = FIRST_RULE + len(lengths) + rule[number]
        rules.append(sides)
        lengths = np.append(lengths, sizes)
        live[hit] = True
        live[hit[hit > 0] - 1] = True
        stay = np.ones(len(seq), bool)
        stay[hit + 1] = False
        seq, first, live = seq[stay], first[stay], live[stay]
    return seq, np.concatenate(rules, 1), lengths, np.flatnonzero(first)


def to_body(seq: np.ndarray, rules: np.ndarray, lengths: np.ndarray) -> bytes:
    return np.concatenate([[MAGIC, VERSION, len(lengths), len(seq)], *rules, lengths, seq]).astype("<u4").tobytes()


def from_body(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, rules, expansion lengths."""
    words = np.frombuffer(body, "<u4").astype(np.int64)
    if len(words) < 4 or words[0] != MAGIC or words[1] != VERSION or len(words) != 4 + 3 * words[2] + words[3]:
        raise ValueError("not a shard of this format")
    r = int(words[2])
    return words[4 + 3 * r :], words[4 : 4 + 2 * r].reshape(2, r), words[4 + 2 * r : 4 + 3 * r]


def expand(seq: np.ndarray, rules: np.ndarray) -> np.ndarray:
    """The ids of some symbols."""
    while len(at := np.flatnonzero(seq >= FIRST_RULE)):
        rule = seq[at] - FIRST_RULE
        out = np.repeat(seq, np.where(seq >= FIRST_RULE, 2, 1))
        where = at + np.arange(len(at))  # each earlier expansion moves it by one
        out[where], out[where + 1] = rules[0][rule], rules[1][rule]
        seq = out
    return seq


def read_ids(body: bytes, first_symbol: int, skip: int, count: int) -> np.ndarray:
    """Random access: ``count`` ids of the document that begins at ``first_symbol``, after ``skip`` ids of it."""
    seq, rules, lengths = from_body(body)
    seq = seq[first_symbol : first_symbol + skip + count]  # a symbol stands for one id at least
    size = np.where(seq < FIRST_RULE, 1, lengths[(seq - FIRST_RULE).clip(0)] if len(lengths) else 1)
    begins = np.cumsum(size) - size
    a = int(np.searchsorted(begins, skip, "right")) - 1
    b = int(np.searchsorted(begins, skip + count, "left"))
    return expand(seq[a:b], rules)[skip - int(begins[a]) :][:count] if count else seq[:0]


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """Writes every document's ids, ``end_id`` behind them, in ascending order of ``doc_id``."""
    key_type = docs.schema["doc_id"].dataType.simpleString()
    item = f"struct<doc_id:{key_type},start:bigint,n_tokens:bigint,symbol:bigint>"

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, tail = word_bpe(tokenizer).encode_all, int(end_id).to_bytes(4, "little")
        part, number = TaskContext.get().partitionId(), 0
        keys: list = []
        packed: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal keys, packed, held, number
            ids = np.frombuffer(b"".join(packed), "<u4")
            counts = np.array([len(x) // 4 for x in packed], np.int64)
            starts = np.cumsum(counts) - counts
            seq, rules, lengths, symbols = compress(ids, starts)
            index = [{"doc_id": k, "start": int(s), "n_tokens": int(n), "symbol": int(y)} for k, s, n, y in zip(keys, starts, counts, symbols, strict=True)]
            row = {"part": [part], "number": [number], "n_ids": [len(ids)], "index": [index], "body": [to_body(seq, rules, lengths)]}
            keys, packed, held, number = [], [], 0, number + 1
            return pa.RecordBatch.from_arrays([pa.array(row["part"], pa.int32()), pa.array(row["number"], pa.int32()), pa.array(row["n_ids"], pa.int64()), pa.array(row["index"], pa.list_(pa.struct([("doc_id", key_arrow), ("start", pa.int64()), ("n_tokens", pa.int64()), ("symbol", pa.int64())]))), pa.array(row["body"], pa.binary())], ["part", "number", "n_ids", "index", "body"])

        for batch in batches:
            key_arrow = batch.schema.field("doc_id").type
            for few in sliced([batch]):
                for k, ids in zip(few.column("doc_id").to_pylist(), encode(utf8_of(few)), strict=True):
                    ids += tail
                    if held and held + len(ids) // 4 > SHARD_IDS:
                        yield flush()
                    keys.append(k)
                    packed.append(ids)
                    held += len(ids) // 4
        if keys:
            yield flush()

    rows = documents(docs, "doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    mapped(rows, shards, f"part int, number int, n_ids bigint, index array<{item}>, body binary").select(F.struct("part", "number").alias("shard"), "n_ids", "index", "body").write.parquet(path)


def read(spark: SparkSession, path: str, key_type: str = "bigint") -> DataFrame:
    """``(shard, doc_id, local_start, n_tokens, ids_crc32)`` of each document, decoded from the files."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                seq, rules, _ = from_body(batch.column("body")[i].as_py())
                ids = memoryview(expand(seq, rules).astype("<u4").tobytes())
                index = batch.column("index")[i].values
                starts, counts = index.field("start").to_numpy(), index.field("n_tokens").to_numpy()
                crc = [zlib.crc32(ids[4 * s : 4 * (s + n)]) for s, n in zip(starts.tolist(), counts.tolist(), strict=True)]
                part, number = (pa.array([batch.column("shard")[i][k].as_py()] * len(crc), pa.int32()) for k in ("part", "number"))
                yield pa.RecordBatch.from_arrays([part, number, index.field("doc_id"), index.field("start"), index.field("n_tokens"), pa.array(crc, pa.int64())], ["part", "number", "doc_id", "local_start", "n_tokens", "ids_crc32"])

    files = spark.read.parquet(path).select("shard", "index", "body")
    return files.mapInArrow(decoded, f"part int, number int, doc_id {key_type}, local_start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the files, reads them back; the place of a document is its shard's place plus its place within the shard."""
    spark = docs.sparkSession
    path = new_path(spark, "token_shards")
    write(docs, path, tokenizer)
    # one row for each shard of about a million ids; ranges of keys, far fewer, are added up first
    shards = spark.read.parquet(path).select("shard.part", "shard.number", "n_ids")
    upto = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", upto(Window.orderBy("part"), "n").alias("before"))
    within = shards.select("part", "number", upto(Window.partitionBy("part").orderBy("number"), "n_ids").alias("within"))
    shards = within.join(parts, "part").select("part", "number", (F.col("before") + F.col("within")).alias("base"))
    rows = read(spark, path, docs.schema["doc_id"].dataType.simpleString())
    return rows.join(shards, ["part", "number"]).select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
