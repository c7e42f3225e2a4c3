"""Putative barcodes behind adapters with errors: bit-parallel approximate matching over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions.seq import ADAPTER, COMPLEMENT, IUPAC, KITS

#: What stands behind the UMI. Fixed values of the chemistry: poly-T of 3' kits, the switch oligo of 5' kits.
SWITCH_OLIGO = "TTTCTTATATGGG"
#: Places of a read that one column of the matching answers for, and columns that are matched side by side.
WINDOW, COLUMNS = 256, 4096
_TURNED = np.arange(256, dtype=np.uint8)
_TURNED[np.frombuffer(IUPAC.encode(), np.uint8)] = np.frombuffer(COMPLEMENT.encode(), np.uint8)


def tail_of(kit: str) -> str:
    return SWITCH_OLIGO if "_5v" in kit else "T" * KITS[kit][2]


def match_ends(raw: np.ndarray, bounds: np.ndarray, pattern: str, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Read, end and edit distance of all places of reads where the pattern ends with ``most`` errors or fewer.

    ``raw`` holds the reads one behind the other, ``bounds`` where they begin and the last one's end; an end is counted from
    the read's start and is the place behind the match. Reads are cut into windows that overlap by what a match can span, and
    one step of the bit-vector recurrence moves all windows by one base: a 64-bit word is a window's column of the table of
    edit distances, as differences of neighbours. Patterns have up to 64 letters.
    """
    m = len(pattern)
    if not 0 < m <= 64:
        raise ValueError("patterns have 1 to 64 letters")
    letters = np.zeros(256, np.uint64)
    for i, c in enumerate(pattern.encode()):
        letters[c] |= np.uint64(1 << i)
    sizes = np.diff(bounds)
    windows = -(-sizes // WINDOW)
    read = np.repeat(np.arange(len(sizes)), windows)
    first = (np.arange(len(read)) - np.repeat(np.cumsum(windows) - windows, windows)) * WINDOW
    before, one, top = m + most, np.uint64(1), np.uint64(m - 1)
    found: list[tuple] = [(np.zeros(0, np.int64),) * 3]
    for at in range(0, len(read), COLUMNS):
        r, f = read[at : at + COLUMNS], first[at : at + COLUMNS]
        place = f - before + np.arange(WINDOW + before)[:, None]
        inside = (place >= 0) & (place < sizes[r])
        marks = letters[np.where(inside, raw[np.clip(place + bounds[r], 0, max(len(raw) - 1, 0))], 0)]
        marks[~inside] = 0
        up, down = np.full(len(r), ~np.uint64(0)), np.zeros(len(r), np.uint64)
        score = np.full(len(r), m, np.int16)
        scores = np.empty((WINDOW + before, len(r)), np.int16)
        for t, eq in enumerate(marks):
            across = eq | down
            diagonal = (((eq & up) + up) ^ up) | eq
            more, less = down | ~(diagonal | up), up & diagonal
            score = score + ((more >> top) & one).astype(np.int16) - ((less >> top) & one).astype(np.int16)
            scores[t] = score
            more, less = more << one, less << one
            up, down = less | ~(across | more), more & across
        t, column = np.nonzero((scores[before:] <= most) & inside[before:])
        found.append((r[column], f[column] + t + 1, scores[before + t, column].astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def best_barcodes(seqs: list[bytes], pattern: str, tail: str, width: int, umi: int, most: int) -> tuple[np.ndarray, ...]:
    """Read, orientation, end and distance of each read's best place, in the order of reads; reads without one are left out."""
    raw = np.frombuffer(b"".join(seqs), np.uint8)
    bounds = np.append(0, np.cumsum([len(x) for x in seqs])).astype(np.int64)
    turned, mirrored = _TURNED[raw][::-1], bounds[-1] - bounds[::-1]
    sides = []
    for side, (text, cuts) in enumerate(((raw, bounds), (turned, mirrored))):
        read, end, distance = match_ends(text, cuts, pattern, most)
        room = end + width <= np.diff(cuts)[read]
        read, end, distance = read[room], end[room], distance[room]
        at = end[:, None] + width + umi + np.arange(len(tail))
        inside = at < np.diff(cuts)[read][:, None]
        bases = text[np.where(inside, at + cuts[read][:, None], 0)] if len(text) else np.zeros(at.shape, np.uint8)
        wrong = (~inside | (bases != np.frombuffer(tail.encode(), np.uint8))).sum(1)
        sides.append((len(seqs) - 1 - read if side else read, np.full(len(read), side), end, distance, wrong))
    read, side, end, distance, wrong = (np.concatenate(x) for x in zip(*sides, strict=True))
    order = np.lexsort((end, side, wrong, distance, read))
    order = order[np.append(True, np.diff(read[order]) > 0)[: len(order)]]
    return read[order], side[order], end[order], distance[order]


def approximate_barcodes(reads: DataFrame, kit: str = "10X_3v3", most: int = 4, adapter: str = ADAPTER) -> DataFrame:
    """``(sample, read_id, putative_bc, min_q, errors)``: the barcode behind the adapter, which may have up to ``most`` errors.

    Of all places in both orientations where the adapter ends and a whole barcode follows, the one with the fewest errors
    counts, then the one with the fewest wrong letters in what the kit has behind the UMI (poly-T, or the switch oligo of 5'
    kits), then the read as it is before its reverse complement, then the first. Null, where there is none. ``min_q`` is the
    least quality of the barcode. Whole reads are searched, however long.
    """
    width, umi, _ = KITS[kit]
    tail = tail_of(kit)
    schema = "sample string, read_id string, putative_bc string, min_q int, errors int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs, quals = ([x or b"" for x in batch.column(c).cast(pa.binary()).to_pylist()] for c in ("seq", "qual"))
            barcode, least, errors = [None] * len(seqs), [None] * len(seqs), [None] * len(seqs)
            for i, turned, end, distance in zip(*(x.tolist() for x in best_barcodes(seqs, adapter, tail, width, umi, most)), strict=True):
                s = _TURNED[np.frombuffer(seqs[i], np.uint8)][::-1].tobytes() if turned else seqs[i]
                q = (quals[i][::-1] if turned else quals[i])[end : end + width]
                barcode[i], errors[i] = s[end : end + width].decode("ascii", "replace"), distance
                least[i] = min(q) - 33 if q else None
            yield pa.RecordBatch.from_arrays([batch.column("sample"), batch.column("read_id"), pa.array(barcode, pa.string()), pa.array(least, pa.int32()), pa.array(errors, pa.int32())], ["sample", "read_id", "putative_bc", "min_q", "errors"])

    return reads.select("sample", "read_id", "seq", "qual").mapInArrow(run, schema)
