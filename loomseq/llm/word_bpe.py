"""Ids of whole texts by a word-level BPE of the tokenizers library, in Python workers.

The tokenizer drops white space and its normaliser and merges never reach across it, and it splits a word's letters from the
marks behind them; the strings of its special tokens hold no blank. So each word between blanks, without its marks, is encoded by the library once and then remembered. The
ids of a text are those of its words and marks one after another. Every word
of letters ends with an id whose token ends in the vocabulary's end-of-word mark, which tells words of one text apart.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np

from .common import kept
from .segments import WIDTH, Memo, in_parts, joined

#: Words that a worker remembers, and the longest one remembered (bytes).
CACHE_ENTRIES, CACHE_BYTES = 500_000, 48
#: Bytes of the texts that are encoded together.
GROUP_BYTES = 800_000
MARKS = b"!#$%&*,.:;?|+-"

_IS_MARK, _IS_LETTER = np.zeros(256, bool), np.zeros(256, bool)
_IS_MARK[list(MARKS)] = True
_IS_LETTER[[*range(65, 91), *range(97, 123), 0xC3]] = True  # with the first byte of U+00C0 to U+00FF


def words_of(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words and the marks behind words of letters begin and end, in the texts that begin at ``bounds``."""
    body = raw[: len(raw) - WIDTH]
    inside = (body != 32) & (body != 10)
    breaks = np.zeros(len(body) + 1, bool)  # a word ends or begins here whatever stands on either side
    breaks[bounds] = True
    before, after = np.append(False, inside[:-1]), np.append(inside[1:], False)
    if not len(body):
        return bounds[:0], bounds[:0]
    begins = np.flatnonzero(inside & (~before | breaks[:-1]))
    ends = np.flatnonzero(inside & (~after | breaks[1:])) + 1
    places = np.arange(len(body), dtype=np.int32)
    head = np.maximum.accumulate(np.where(_IS_MARK[body], np.int32(-1), places))[ends - 1] + 1  # behind the last byte that is no mark
    letter = _IS_LETTER[body]
    letter[1:] |= (body[:-1] == 0xC3) & (body[1:] != 0x97) & (body[1:] != 0xB7)
    others = np.append(np.int32(0), np.cumsum(~letter, dtype=np.int32))
    head = np.maximum(head, begins)
    cut = (head > begins) & (head < ends) & (others[head] == others[begins])
    order = np.arange(len(begins)) + np.cumsum(cut) - cut  # each cut word takes two places
    out = np.zeros((2, len(begins) + int(cut.sum())), np.int64)
    out[0, order], out[1, order] = begins, np.where(cut, head, ends)
    out[0, order[cut] + 1], out[1, order[cut] + 1] = head[cut], ends[cut]
    return out[0], out[1]


class WordBpe:
    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.memo = Memo(self._ids, CACHE_ENTRIES, CACHE_BYTES)

    def _ids(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each word; plain ones go to the library as one text and are cut after the ids that end a word."""
        words = [x.decode() for x in pieces]
        plain = [w for w in words if w.isalpha() and w.lower().isalpha()]
        found: dict[str, bytes] = {}
        if plain:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
            if len(ends) == len(plain):
                blob = ids.tobytes()
                found = {w: blob[a:b] for w, a, b in zip(plain, [0, *ends], ends, strict=False)}
        rest = [w for w in words if w not in found]
        got = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        found.update((w, np.array(x.ids, "<u4").tobytes()) for w, x in zip(rest, got, strict=True))
        return [found[w] for w in words]

    def _group(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        raw, bounds = joined(texts)
        begins, ends = words_of(raw, bounds)
        ids, counts = self.memo.encode(raw, begins, ends)
        return ids, np.append(0, np.cumsum(counts))[np.searchsorted(begins, bounds)]

    def encode_group(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one behind the other, and where each text's begin and the last one's end."""
        return in_parts(texts, self._group)

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text.encode()]))

    def encode_all(self, texts: Iterable[bytes | None]) -> Iterator[bytes]:
        """The ids of each text in turn as little-endian unsigned 32-bit integers, null as the empty text; texts are
        gathered to groups of bounded size.
        """
        group: list[bytes] = []
        held = 0

        def flush() -> Iterator[bytes]:
            ids, at = self.encode_group(group)
            blob, at = ids.astype("<u4").tobytes(), (4 * at).tolist()
            return (blob[a:b] for a, b in zip(at, at[1:], strict=False))

        for text in texts:
            group.append(text or b"")
            held += len(group[-1])
            if held >= GROUP_BYTES:
                yield from flush()
                group, held = [], 0
        if group:
            yield from flush()


def word_bpe(path: str) -> WordBpe:
    return kept(("word_bpe", path), lambda: WordBpe(path))
