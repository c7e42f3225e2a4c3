"""Ids of texts that are cut into segments, most of which occur again and again: each is encoded once and remembered.

A group of texts is one array of bytes. Segments of up to ``WIDTH`` bytes are their own keys, as two 64-bit integers, in a
hash table of arrays that is asked for all segments of a group at once; longer ones go through a dictionary. What is new
is learnt together. All results are exact: keys are the segments' bytes, never just their hashes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np

WIDTH = 16
_MASK = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of some texts, with ``WIDTH`` zeros behind them, and where each text begins and the last one ends."""
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) for x in texts], out=bounds[1:])
    return np.frombuffer(b"".join(texts) + bytes(WIDTH), np.uint8), bounds


def _keys(raw: np.ndarray, begins: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of segments of up to ``WIDTH`` bytes."""
    words = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))  # the eight bytes from each place on
    return words[begins] & _MASK[np.minimum(size, 8)], words[np.minimum(begins + 8, len(raw) - 8)] & _MASK[np.clip(size - 8, 0, 8)]


def gathered(flat: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Stretches of ``flat``, one behind the other."""
    ends = np.cumsum(lengths)
    n = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(n, len(flat)) < 1 << 31 else np.int64
    return flat[np.repeat((begins - (ends - lengths)).astype(kind), lengths) + np.arange(n, dtype=kind)]


class Memo:
    """Ids of segments, by their bytes. ``learn`` gives the ids of new segments as little-endian 32-bit integers.

    The first ``most`` segments of up to ``longest`` bytes are remembered (frequent ones come early), others only within
    their group.
    """

    def __init__(self, learn: Callable[[list[bytes]], list[bytes]], most: int, longest: int) -> None:
        self.learn, self.most, self.longest = learn, most, longest
        self.bits = max(4, (2 * most).bit_length())
        self.low, self.high = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.uint64)
        self.entry = np.full(1 << self.bits, -1, np.int32)
        self.long: dict[bytes, int] = {}
        self.n = 0  # entries; what lies behind them belongs to one group only
        self.begins, self.lengths, self.flat = np.zeros(1 << 12, np.int32), np.zeros(1 << 12, np.int32), np.zeros(1 << 12, np.uint32)

    def _slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        h = (low ^ (high * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The entry of each key, -1 where it is unknown."""
        slot, todo = self._slots(low, high), np.arange(len(low))
        out = np.full(len(low), -1, np.int32)
        while len(todo):
            entry = self.entry[slot]
            hit = (entry >= 0) & (self.low[slot] == low[todo]) & (self.high[slot] == high[todo])
            out[todo[hit]] = entry[hit]
            on = (entry >= 0) & ~hit
            todo, slot = todo[on], slot[on] + 1 & (1 << self.bits) - 1
        return out

    def _insert(self, low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> None:
        """Distinct keys that the table doesn't have."""
        slot, todo = self._slots(low, high), np.arange(len(low))
        while len(todo):
            free = self.entry[slot] < 0
            self.entry[slot[free]] = entries[todo[free]]  # of several one stays
            won = free & (self.entry[slot] == entries[todo])
            self.low[slot[won]], self.high[slot[won]] = low[todo[won]], high[todo[won]]
            todo, slot = todo[~won], slot[~won] + 1 & (1 << self.bits) - 1

    def _store(self, ids: list[bytes]) -> None:
        """Adds entries behind the ``n`` first ones."""
        lengths = np.fromiter(map(len, ids), np.int32, len(ids)) >> 2
        words = np.frombuffer(b"".join(ids), "<u4")
        used = int(self.begins[self.n - 1] + self.lengths[self.n - 1]) if self.n else 0
        while self.n + len(ids) > len(self.begins):
            self.begins, self.lengths = np.append(self.begins, np.zeros_like(self.begins)), np.append(self.lengths, np.zeros_like(self.lengths))
        while used + len(words) > len(self.flat):
            self.flat = np.append(self.flat, np.zeros_like(self.flat))
        self.flat[used : used + len(words)] = words
        self.begins[self.n : self.n + len(ids)] = used + np.cumsum(lengths) - lengths
        self.lengths[self.n : self.n + len(ids)] = lengths

    def get(self, pieces: list[bytes]) -> list[bytes | None]:
        """Ids of those pieces that are remembered and no longer than a key."""
        raw, bounds = joined(pieces)
        low, high = _keys(raw, bounds[:-1], np.minimum(np.diff(bounds), WIDTH))
        found = self._find(low, high).tolist()
        return [self.flat[(b := self.begins[i]) : b + self.lengths[i]].tobytes() if i >= 0 and len(x) <= WIDTH and 0 not in x else None for x, i in zip(pieces, found, strict=True)]

    def encode(self, raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the segments of ``raw`` (bytes as ``joined`` gives them), one behind the other, and how many each has."""
        size = ends - begins
        blob = raw.tobytes()
        brief = size <= WIDTH
        if not raw[: len(raw) - WIDTH].all():  # a zero byte could not be told from the end of a key
            zeros = np.append(np.int32(0), np.cumsum(raw == 0, dtype=np.int32))
            brief &= zeros[begins] == zeros[ends]
        entry = np.full(len(begins), -1, np.int64)
        at = np.flatnonzero(brief)
        low, high = _keys(raw, begins[at], size[at])
        entry[at] = self._find(low, high)

        gone = np.flatnonzero(entry[at] < 0)
        order = gone[np.lexsort((high[gone], low[gone]))]
        first = np.append(True, (low[order[1:]] != low[order[:-1]]) | (high[order[1:]] != high[order[:-1]]))[: len(order)]
        new = order[first]
        pieces = [blob[b:e] for b, e in zip(begins[at[new]].tolist(), ends[at[new]].tolist(), strict=True)]
        n_brief = len(pieces)
        fresh: dict[bytes, int] = {}
        rest = np.flatnonzero(~brief)
        for i, b, e in zip(rest.tolist(), begins[rest].tolist(), ends[rest].tolist(), strict=True):
            piece = blob[b:e]
            known = self.long.get(piece)
            if known is None and (known := fresh.get(piece)) is None:
                known = fresh[piece] = self.n + len(pieces)
                pieces.append(piece)
            entry[i] = known
        entry[at[order]] = self.n + np.cumsum(first) - 1
        if pieces:
            self._store(self.learn(pieces))
        counts = self.lengths[entry]
        ids = gathered(self.flat, self.begins[entry], counts)
        if pieces and self.n + len(pieces) <= self.most:
            self._insert(low[new], high[new], np.arange(self.n, self.n + n_brief, dtype=np.int32))
            self.long |= {x: i for x, i in fresh.items() if len(x) <= self.longest}
            self.n += len(pieces)
        return ids, counts


#: Bytes of a text that are encoded at once; a longer one is cut before blanks that follow a visible character.
PART = 4_000_000
_CUT = re.compile(rb"[!-~](?= )")


def parts_of(text: bytes, size: int = PART) -> Iterator[bytes]:
    at = 0
    while len(text) - at > size and (m := _CUT.search(text, at + size)):
        yield text[at : m.end()]
        at = m.end()
    yield text[at:]


def in_parts(texts: list[bytes], encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], size: int = PART) -> tuple[np.ndarray, np.ndarray]:
    """What ``encode`` gives for the texts, ids and where each text's begin and the last one's end, in bounded memory for long texts."""
    if max(map(len, texts), default=0) <= size:
        return encode(texts)
    found = [np.concatenate([encode([part])[0] for part in parts_of(text, size)]) for text in texts]
    return np.concatenate(found), np.cumsum([0, *map(len, found)])
