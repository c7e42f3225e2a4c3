"""Filter interaction audit: truth-table survival words and their positional popcounts.

With filters A to E there are 32 subsets of filters. A document becomes one 32-bit word: bit s is set where it survives the
subset s (bit i of s: the i-th filter). Counting the ones of each bit position over the words of a part, with carry-save
adders on whole arrays, gives the survivors of all subsets at once; every order of the filters, and what each filter would
remove elsewhere in it, is arithmetic on these 32 counts.

Only narrow rows (key, part, digest, four bits) are shuffled, never texts. The first row of each text is found by partial
aggregates, and rows meet it on digest and key together, so that a text with a third of all rows is no hot key; repeated
rows are counted into one before. Texts are the same where their SHA-256 is.

Nulls: a null text is the empty text, a null ``source`` the part ``''``. A row with a null key has no smaller key, so it
never fails E, and no label. A document labelled more than once has a label where any of its rows has it. Rows that repeat a
key are documents of their own; of equal texts all rows of the smallest key pass E. No documents: no rows. Other columns are
not read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, mapped, written

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
#: Bit s of the word of a document with the failures f: whether it survives subset s, that is, fails none of its filters.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & f) for f in range(SUBSETS)], np.uint32)
#: Parts and label classes whose counters (32 integers each) a task holds before it sends them on.
HELD = 4096
WORD = r"[^\x20\x09-\x0D]+"


def failures(text: Column) -> list[Column]:
    """Whether a text fails A, B, C, D; E needs the other texts."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [F.size(words) < 50, 100 * F.size(F.array_distinct(words)) < 65 * F.size(words), 100 * capitals > 5 * F.length(text), text.rlike(r"[#$%&*|]")]


def bits(conditions: list[Column]) -> Column:
    """Bit i: the i-th condition."""
    out = F.lit(0)
    for i, c in enumerate(conditions):
        out = out + F.when(c, 1 << i).otherwise(0)
    return out


def failing(docs: DataFrame) -> DataFrame:
    """``(doc_id, part, fails, n)``: the failures of each document as five bits, equal rows once with their number."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents(docs, "doc_id", "text", "source").select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), bits(failures(text)).cast("int").alias("own"))
    rows = written(rows, "failures")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    rows = rows.groupBy("digest", "doc_id", "part", "own").agg(F.count("*").alias("n"))
    later = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return rows.join(first, ["digest", "doc_id"], "left").select("doc_id", "part", (F.col("own") + F.when(later, 16).otherwise(0)).alias("fails"), "n")


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit, from bit 0 on.

    Three words of one weight become a sum of that weight and a carry of twice it, so the words shrink to two for each
    weight, and only these are taken apart into bits.
    """
    found, weight = np.zeros(32, np.int64), 1
    while len(words):
        carries = []
        while len(words) > 2:
            third = len(words) // 3
            a, b, c = words[: 3 * third].reshape(3, third)
            either = a ^ b
            carries.append(a & b | either & c)
            words = np.concatenate([either ^ c, words[3 * third :]])
        found += weight * ((words[:, None] >> np.arange(32, dtype=np.uint32)) & np.uint32(1)).sum(0, dtype=np.int64)
        words, weight = np.concatenate([words[:0], *carries]), 2 * weight
    return found


def weighted_popcount(words: np.ndarray, times: np.ndarray) -> np.ndarray:
    """``positional_popcount`` of words that each stand for several, one call for each binary digit of the numbers."""
    found = np.zeros(32, np.int64)
    for digit in range(int(times.max(initial=0)).bit_length()):
        found += positional_popcount(words[times >> digit & 1 == 1]) << digit
    return found


def survivors(rows: DataFrame) -> DataFrame:
    """``(part, good, toxic, counts)`` from ``(part, good, toxic, fails, n)``: of each class, the survivors of all subsets."""
    schema = "part string, good boolean, toxic boolean, counts array<bigint>"

    def run(batches):
        held: dict[tuple, np.ndarray] = {}

        def flush():
            keys = list(held)
            columns = [[k[i] for k in keys] for i in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.bool_()), pa.array([held[k].tolist() for k in keys], pa.list_(pa.int64()))], ["part", "good", "toxic", "counts"])
            held.clear()

        for batch in batches:
            words, times = WORDS[batch.column("fails").to_numpy()], batch.column("n").to_numpy()
            coded = batch.column("part").dictionary_encode()
            names, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            kind = 4 * code.astype(np.int64) + 2 * batch.column("good").to_numpy(zero_copy_only=False) + batch.column("toxic").to_numpy(zero_copy_only=False)
            order = np.argsort(kind, kind="stable")
            cuts = np.flatnonzero(np.diff(kind[order])) + 1
            for own in np.split(order, cuts) if len(order) else []:
                k = int(kind[own[0]])
                key = names[k >> 2], bool(k >> 1 & 1), bool(k & 1)
                held[key] = held.get(key, 0) + weighted_popcount(words[own], times[own])
            if len(held) >= HELD:
                yield from flush()
        yield from flush()

    return mapped(rows.select("part", "good", "toxic", "fails", "n"), run, schema)


def orders(counts: DataFrame) -> DataFrame:
    """All orders of the filters with their steps, from ``(part, good, toxic, counts)``: 600 rows a part."""
    total = lambda c, i: F.coalesce(F.sum(F.when(c, F.col("counts")[i])), F.lit(0).cast("long"))
    kinds = {"n": F.lit(True), "g": F.col("good"), "x": F.col("toxic")}
    per = counts.groupBy("part").agg(*[F.array(*[total(c, i) for i in range(SUBSETS)]).alias(name) for name, c in kinds.items()])
    # what filter i removes after the filters of s, times the orders that begin with s and go on with i
    size = [s.bit_count() for s in range(SUBSETS)]
    share = lambda i: sum((factorial(size[s]) * factorial(len(FILTERS) - 1 - size[s]) * (F.col("n")[s] - F.col("n")[s | 1 << i]) for s in range(SUBSETS) if not s >> i & 1), F.lit(0))
    per = per.withColumn("shares", F.array(*[share(i) for i in range(len(FILTERS))]))
    all_orders = F.split(F.lit(",".join(map("".join, permutations(FILTERS)))), ",")
    rows = per.select("*", F.explode(all_orders).alias("filter_order")).select("*", F.explode(F.array(*map(F.lit, range(1, len(FILTERS) + 1)))).alias("step"))
    rows = rows.withColumn("i", F.expr("ascii(substr(filter_order, step, 1)) - ascii('A')")).withColumn("own", F.expr("shiftleft(1, i)"))
    rows = rows.withColumn("upto", F.expr("aggregate(sequence(1, step), 0, (s, k) -> s | shiftleft(1, ascii(substr(filter_order, k, 1)) - ascii('A')))"))
    fewer = lambda c, a, b: F.col(c)[a] - F.col(c)[b]
    upto, own = F.col("upto"), F.col("own")
    before, others = upto - own, F.lit(SUBSETS - 1) - own
    return rows.select(
        "part", "filter_order", "step", F.col("n")[upto].alias("kept"), fewer("n", before, upto).alias("removed"), (fewer("n", F.lit(0), own) - fewer("n", before, upto)).alias("redundant"),
        fewer("n", others, F.lit(SUBSETS - 1)).alias("unique_fails"), fewer("g", before, upto).alias("good_lost"), fewer("x", before, upto).alias("toxic_lost"), F.col("shares")[F.col("i")].cast("long").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``."""
    marks = documents(labels, "doc_id", "quality", "toxic").groupBy("doc_id").agg(*[F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]).where("good or toxic")
    rows = failing(docs).join(marks, "doc_id", "left").na.fill(False, ["good", "toxic"])
    return orders(survivors(rows))
