"""Byte-level BPE by a bitmap rank queue.

A piece of text (one match of the split pattern) is a linked list of byte spans. Every adjacent pair whose bytes are in
the vocabulary waits in the bucket of its merge rank; a bitmap of two levels marks the ranks whose buckets hold
anything, so the lowest pending rank is found by find-first-set. Entries made stale by a neighbour's merge are skipped
when they are popped. Work on a piece of n bytes is O(n log n), whatever its length.

Short pieces that a worker meets for the first time share one queue: they lie one behind the other in one linked list, no
pair crosses from one to the next, and what waits in a bucket is merged at once, one entry of each piece.

Texts are cut where white space begins, as no match of the pattern crosses there, and each segment is encoded once and
remembered.

Rows: one for each input row, repeated ones included. Null or empty text: no ids. Other columns are not carried.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator
from hashlib import sha256
from heapq import heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents, kept, mapped, per_slice, sliced, utf8_of
from .segments import WIDTH, Memo, gathered, in_parts, joined

#: White space of Unicode, as the split pattern's ``\s`` means it.
SPACE = "\t-\r \x85\xa0  -     　"
#: Segments and pieces of text that a worker remembers with their ids, and the longest one remembered (bytes).
CACHE_ENTRIES, CACHE_PIECES, CACHE_BYTES = 1_000_000, 100_000, 48
#: The characters of ``SPACE`` beyond ASCII, as integers of their UTF-8 bytes.
WIDE_SPACE = [int.from_bytes(c.encode(), "big") for c in map(chr, range(0x80, 0x3001)) if re.match(f"[{SPACE}]", c)]
#: Tokens that are decoded at once.
DECODED = 1 << 18
LEAF = 8  # a leaf of the bitmap covers 2**LEAF ranks
#: Bytes of the texts whose new pieces share a queue (rows are added in such numbers), and the longest piece that does.
GROUP_BYTES, GROUP_ROWS, SHORT = 2_500_000, 128, 64
NONE = np.int32(2**31 - 1)  # no rank


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int], size: list[int]) -> list[int]:
    """Ids of one piece: always the pair of lowest rank first, the leftmost of equals. ``size``: bytes of each rank.

    The four steps that put an entry into a bucket are written out three times, as a call costs more than they do.
    """
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n, rank_of, low = len(piece), ranks.get, (1 << LEAF) - 1
    after, before, live = list(range(1, n + 2)), list(range(-1, n)), bytearray(b"\1") * n
    buckets: dict[int, list[int]] = {}
    leaves: dict[int, int] = {}
    top, parts = 0, n
    for i in range(n - 1):
        if (rank := rank_of(piece[i : i + 2])) is not None:
            if rank in buckets:
                buckets[rank].append(i)
            else:
                buckets[rank] = [i]
                leaves[rank >> LEAF] = leaves.get(rank >> LEAF, 0) | 1 << (rank & low)
                top |= 1 << (rank >> LEAF)
    while top and parts > 1:
        high = (top & -top).bit_length() - 1
        word = leaves[high]
        rank = high << LEAF | (word & -word).bit_length() - 1
        bucket = buckets[rank]
        start = heappop(bucket)
        if not bucket:
            del buckets[rank]
            leaves[high] = word = word & (word - 1)
            if not word:
                top &= top - 1
        if not live[start] or (middle := after[start]) >= n or (stop := after[middle]) - start != size[rank]:
            continue  # a neighbour's merge has made the entry stale
        after[start], live[middle] = stop, 0
        parts -= 1
        if stop < n:
            before[stop] = start
            if (rank := rank_of(piece[start : after[stop]])) is not None:
                if rank in buckets:
                    heappush(buckets[rank], start)
                else:
                    buckets[rank] = [start]
                    leaves[rank >> LEAF] = leaves.get(rank >> LEAF, 0) | 1 << (rank & low)
                    top |= 1 << (rank >> LEAF)
        if (left := before[start]) >= 0 and (rank := rank_of(piece[left:stop])) is not None:
            if rank in buckets:
                heappush(buckets[rank], left)
            else:
                buckets[rank] = [left]
                leaves[rank >> LEAF] = leaves.get(rank >> LEAF, 0) | 1 << (rank & low)
                top |= 1 << (rank >> LEAF)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Pairs:
    """Rank of two neighbouring tokens' joint bytes, for arrays of tokens."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        rank_of = ranks.get
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                if (left := rank_of(token[:i])) is not None and (right := rank_of(token[i:])) is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.int64(2**63 - 1))
        self.values = np.append(np.array(values, np.int32)[order], NONE)

    def __call__(self, left: np.ndarray | int, right: np.ndarray | int) -> np.ndarray:
        key = np.left_shift(left, 32, dtype=np.int64) | right
        at = self.keys.searchsorted(key)
        return np.where(self.keys[at] == key, self.values[at], NONE)


def merge_many(pieces: list[bytes], single: np.ndarray, pairs: Pairs) -> list[bytes]:
    """Ids of each piece, as ``merge`` has them, in little-endian 32-bit integers. ``single``: each byte's rank."""
    lengths = np.array([len(x) for x in pieces])
    n = int(lengths.sum())
    owner = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
    ends = np.cumsum(lengths)
    token = np.append(single[np.frombuffer(b"".join(pieces), np.uint8)], np.int64(-1))  # of the span that begins there
    after, before, live = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32), np.ones(n, bool)
    after[ends - 1] = n  # n stands for no neighbour
    before[ends - lengths] = n
    waits = np.full(n + 1, NONE)  # the rank in whose bucket the span and the next one wait
    waits[:n] = pairs(token[:n], token[after[:n]])
    buckets: dict[int, list[np.ndarray]] = {}
    leaves: dict[int, int] = {}
    top, low = 0, (1 << LEAF) - 1

    def push(at: np.ndarray) -> None:
        nonlocal top
        new = waits[at]
        at, new = at[new != NONE], new[new != NONE]
        if not len(at):
            return
        order = np.argsort(new, kind="stable")
        at, new = at[order], new[order]
        begins = np.flatnonzero(np.append(True, new[1:] != new[:-1]))
        cuts = begins.tolist()
        for r, i, j in zip(new[begins].tolist(), cuts, [*cuts[1:], len(at)], strict=True):
            if r in buckets:
                buckets[r].append(at[i:j])
            else:
                buckets[r] = [at[i:j]]
                leaves[r >> LEAF] = leaves.get(r >> LEAF, 0) | 1 << (r & low)
                top |= 1 << (r >> LEAF)

    push(np.arange(n, dtype=np.int32))
    while top:
        high = (top & -top).bit_length() - 1
        word = leaves[high]
        rank = high << LEAF | (word & -word).bit_length() - 1
        bucket = buckets.pop(rank)
        at = np.concatenate(bucket) if len(bucket) > 1 else bucket[0]
        leaves[high] = word = word & (word - 1)
        if not word:
            top &= top - 1
        at = at[waits[at] == rank]  # others are stale
        if not len(at):
            continue
        again = at[:0]
        if len(at) > 1:
            at.sort()
            own = owner[at]
            leftmost = np.append(True, own[1:] != own[:-1])
            if not leftmost.all():
                again, at = at[~leftmost], at[leftmost]
        middle = after[at]
        stop = after[middle]
        token[at] = rank
        live[middle] = False
        waits[middle] = NONE
        after[at] = stop
        before[stop] = at
        left = before[at]
        waits[at] = pairs(rank, token[stop])
        waits[left] = pairs(token[left], rank)
        push(np.concatenate((again, at, left)))
    ids = token[:n][live].astype("<i4").tobytes()
    cuts = (4 * np.cumsum(np.bincount(owner[live], minlength=len(pieces)))).tolist()
    return [ids[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]


def segments_of(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where segments begin and end: at each text, and at each blank of ASCII behind a character that is no white space."""
    body = raw[: len(raw) - WIDTH]
    blank = (body == 32) | (body >= 9) & (body <= 13)
    at = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    odd = at[(body[at - 1] >= 0x80) & (at >= 3)]  # behind other characters: is it one of Unicode's white space?
    if len(odd):
        one, two, three = (body[odd - i].astype(np.int64) for i in (1, 2, 3))
        pair = two << 8 | one
        space = np.isin(pair, WIDE_SPACE) | np.isin(three << 16 | pair, WIDE_SPACE)
        at = np.setdiff1d(at, odd[space], assume_unique=True)
    begin = np.zeros(len(body) + 1, bool)
    begin[at[(body[at - 1] < 0x80) | (at >= 3)]] = True
    begin[bounds] = True
    begins = np.flatnonzero(begin[:-1])
    return begins, np.append(begins[1:], bounds[-1])[: len(begins)]


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex

        self.ranks = load_ranks(path)
        vocabulary = {rank: token for token, rank in self.ranks.items()}
        self.size = [len(vocabulary.get(i, b"")) for i in range(max(vocabulary, default=-1) + 1)]
        self.token_bytes = np.frombuffer(b"".join(vocabulary.get(i, b"") for i in range(len(self.size))), np.uint8)
        self.token_sizes = np.array(self.size, np.int64)
        self.token_begins = np.cumsum(self.token_sizes) - self.token_sizes
        # ``\s`` differs between libraries at the separators U+001C to U+001F; the class says what is meant
        self.pieces = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")).findall
        self.memo = Memo(self._segment_ids, CACHE_ENTRIES, CACHE_BYTES)
        self.known_pieces: dict[str, bytes] = {}
        # a byte without a rank, which no usual vocabulary has, sends every piece to the lone queue
        self.single = np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        self.short = SHORT if (self.single >= 0).all() else 0

    @functools.cached_property
    def pairs(self) -> Pairs:
        return Pairs(self.ranks)

    def _merged(self, piece: str) -> bytes:
        ids = merge(piece.encode(), self.ranks, self.size)
        return pack(f"<{len(ids)}i", *ids)

    def _learnt(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of pieces that the worker does not know."""
        out: dict[str, bytes] = {}
        short: dict[str, bytes] = {}
        for piece in pieces:
            raw = piece.encode()
            if (whole := self.ranks.get(raw)) is not None:
                out[piece] = pack("<i", whole)
            elif len(raw) <= self.short:
                short[piece] = raw
            else:
                out[piece] = self._merged(piece)
        if short:
            out.update(zip(short, merge_many(list(short.values()), self.single, self.pairs), strict=True))
        return out

    def _segment_ids(self, segments: list[bytes]) -> list[bytes]:
        """Ids of segments that the worker does not know."""
        known = self.known_pieces
        split = [self.pieces(x.decode()) for x in segments]
        new = {p for found in split for p in found if p not in known}
        parts = list(new.intersection(p for found in split if len(found) > 1 for p in found))  # may be known as segments
        ids = {p: x for p, x in zip(parts, self.memo.get([p.encode() for p in parts]), strict=True) if x is not None}
        ids |= self._learnt(new.difference(ids))
        room = len(known) < CACHE_PIECES  # frequent ones come early
        known.update(ids)
        out = [known[found[0]] if len(found) == 1 else b"".join(map(known.__getitem__, found)) for found in split]
        several = {p for found in split if len(found) > 1 for p in found}  # others are remembered as segments
        for p in ids:
            if not room or len(p) > CACHE_BYTES or p not in several:
                del known[p]
        return out

    def _group(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        raw, bounds = joined(texts)
        begins, ends = segments_of(raw, bounds)
        ids, counts = self.memo.encode(raw, begins, ends)
        return ids.view(np.int32), np.append(0, np.cumsum(counts))[np.searchsorted(begins, bounds)]

    def encode_group(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one behind the other, and where each text's begin and the last one's end."""
        return in_parts(texts, self._group)

    def encode(self, text: str) -> bytes:
        return self.encode_group([text.encode()])[0].tobytes()

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all tokens, one behind the other, and where each token's begin and the last one's end."""
        return _spelt(ids, self.token_bytes, self.token_begins, self.token_sizes)

    @functools.cached_property
    def decimals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each id in decimal digits with a blank behind them: bytes, begins, sizes."""
        said = [b"%d " % i for i in range(len(self.size))]
        sizes = np.array([len(x) for x in said], np.int64)
        return np.frombuffer(b"".join(said), np.uint8), np.cumsum(sizes) - sizes, sizes

    def spelt(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids in decimal digits, a blank behind each, and where each begins and the last one ends."""
        return _spelt(ids, *self.decimals)


def _spelt(ids: np.ndarray, flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts = [ids[i : i + DECODED] for i in range(0, len(ids), DECODED)]
    return np.concatenate([np.zeros(0, np.uint8), *[gathered(flat, begins[x], sizes[x]) for x in parts]]), np.append(0, np.cumsum(sizes[ids]))


def _codec(path: str, pattern: str) -> ByteBpe:
    return kept(("byte_bpe", path, pattern), lambda: ByteBpe(path, pattern))


def _grouped(batches: Iterator[pa.RecordBatch], codec: ByteBpe, key: str, text: str) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Keys of some rows, the ids of their texts one behind the other, and where each text's begin and the last one's end."""
    keys: list[pa.Array] = []
    texts: list[bytes] = []
    held = 0
    for batch in batches:
        for few in sliced([batch], GROUP_ROWS):
            keys.append(few.column(key))
            texts += utf8_of(few, text)
            held += sum(map(len, texts[-few.num_rows :]))
            if held >= GROUP_BYTES:
                yield pa.concat_arrays(keys), *codec.encode_group(texts)
                keys, texts, held = [], [], 0
    if texts:
        yield pa.concat_arrays(keys), *codec.encode_group(texts)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, ids array<int>)`` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids, at in _grouped(batches, _codec(path, pattern), key, text):
            yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))], [key, "ids"])

    rows = documents(docs, key, text)
    return mapped(rows, run, f"`{key}` {rows.schema[key].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """``(key, ids, bytes binary)``; the bytes of a whole text are its UTF-8 form. Null ids: no bytes."""

    def make():
        codec = _codec(path, pattern)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            lists = batch.column("ids").fill_null([])
            ids = lists.flatten().to_numpy()
            said, at = codec.decode(ids)
            at = at[np.append(0, np.cumsum(lists.value_lengths().to_numpy()))]
            back = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(at.astype("<i8")), pa.py_buffer(said)])
            return pa.RecordBatch.from_arrays([batch.column(key), batch.column("ids"), back.cast(pa.binary())], [key, "ids", "bytes"])

        return work

    rows = documents(encoded, key, "ids")
    return per_slice(rows, make, f"`{key}` {rows.schema[key].dataType.simpleString()}, ids array<int>, bytes binary", keeps=True)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: counts and digests of each text's ids and of what they decode to.

    Texts are encoded, and their ids decoded, by the codec of ``encode`` and ``decode`` in one pass of one worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for keys, ids, at in _grouped(batches, codec, "doc_id", "text"):
            digests = []
            for (said, places), end in ((codec.spelt(ids), 1), (codec.decode(ids), 0)):
                view, ends = memoryview(said), places[at].tolist()
                digests.append([sha256(view[a : max(a, b - end)]).hexdigest() for a, b in zip(ends, ends[1:], strict=False)])
            yield pa.RecordBatch.from_arrays([keys, pa.array(np.diff(at)), *map(pa.array, digests)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = documents(docs, "doc_id", "text")
    return mapped(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
