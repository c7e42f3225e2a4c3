"""Quality classifier: hashed word n-grams, logistic regression trained by follow-the-regularised-leader.

A text's words are its runs of letters, of digits and of other marks; features are the hashed words and pairs of
neighbouring words that occur in it, each with the root of its share as value. Training runs over at most
``TRAIN_ROWS`` labelled rows, those of smallest hash, ``EPOCHS`` times, one update of the touched coordinates per row; the L1 term
keeps the weights sparse. Scoring is one sparse dot product per whole text.

Only ``text`` is an input of a score. Null or empty text: the score of the bias alone. A document labelled more than once
takes its largest label; null labels are passed over. Without labels every score is 0.5. Repeated rows get equal scores.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import documents, per_slice, texts_of, trimmed

TRAIN_ROWS, EPOCHS, BITS = 4000, 5, 18
ALPHA, BETA, L1, L2 = 3.0, 1.0, 0.01, 0.05
ACCEPT = 0.7
#: A word next to itself, and next but one, is the same n-gram whatever the word.
SAME = np.array([0x5851F42D4C957F2D, 0x14057B7EF767814F], np.uint64)
WORDS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def features(text: str, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed n-grams, ascending, and their values: each the root of its share of all n-grams of the text."""
    from xxhash import xxh3_64_intdigest

    words = WORDS.findall(text)
    one = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ (one[1:] >> np.uint64(7))
    two[one[:-1] == one[1:]] = SAME[0]
    again = np.full(int((one[:-2] == one[2:]).sum()), SAME[1], np.uint64)
    grams = np.concatenate([one, two * np.uint64(0xD6E8FEB86659FD93), again]) >> np.uint64(64 - bits)
    at, counts = np.unique(grams.astype(np.int32), return_counts=True)
    return at, np.sqrt(counts / max(1, len(grams)))


class Ftrl:
    """Per-coordinate FTRL-proximal for the logistic loss; the last coordinate is the bias, not penalised by L1."""

    def __init__(self, bits: int = BITS) -> None:
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.bias = 1 << bits

    def _weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == self.bias, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        at, x = with_bias(at, x, self.bias)
        w = self._weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g

    def weights(self) -> np.ndarray:
        return self._weights(np.arange(self.bias + 1)).astype(np.float32)


def with_bias(at: np.ndarray, x: np.ndarray, bias: int) -> tuple[np.ndarray, np.ndarray]:
    return np.append(at, bias), np.append(x, 1.0)


def bucket(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 4


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, label: str = "quality") -> np.ndarray:
    """Weights, learnt from at most ``rows`` documents whose bucket isn't 2; of rows that repeat a key the one with the smallest hash of its text."""
    known = documents(labels, "doc_id", label).where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (bucket(F.col("doc_id")) != 2))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # at most ``rows`` keys, with one text each, however many rows repeat them
    sample = documents(docs, "doc_id", "text").join(F.broadcast(known), "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first")).select("doc_id", "label", "first.text")

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            at, x = zip(*[features(t) for t in texts_of(batch)], strict=True) if batch.num_rows else ((), ())
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(at, pa.list_(pa.int32())), pa.array([v.astype("f4") for v in x], pa.list_(pa.float32()))], ["doc_id", "label", "at", "x"])

        return work

    key = docs.schema["doc_id"].dataType.simpleString()
    weights = trained(per_slice(sample.select("doc_id", "label", "text"), make, f"doc_id {key}, label int, at array<int>, x array<float>").toArrow())
    trimmed()  # the driver needs no more of the sample
    return weights


def trained(got: pa.Table) -> np.ndarray:
    """Weights learnt from rows of ``(doc_id, label, at, x)``."""
    from xxhash import xxh3_64_intdigest

    keys = [xxh3_64_intdigest(str(k)) for k in got.column("doc_id").to_pylist()]  # an order that no executor's timing changes
    marks = got.column("label").to_pylist()
    # as arrays: lists of Python's numbers would take ten times the memory
    parts = [(c.flatten().to_numpy(), c.value_lengths().to_numpy()) for name in ("at", "x") for c in [pa.concat_arrays([pa.array([], got.schema.field(name).type), *got.column(name).chunks])]]
    (at, sizes), (x, _) = parts
    ends = np.cumsum(sizes)
    order = np.lexsort((sizes, np.array(keys, np.uint64))) if keys else []
    model = Ftrl()
    for _ in range(EPOCHS):
        for i in order:
            own = slice(ends[i] - sizes[i], ends[i])
            model.learn(at[own], x[own], marks[i])
    return model.weights()


def scorer(docs: DataFrame, weights: np.ndarray):
    """A function that each task calls once, for one that gives the scores of a batch's texts."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)  # 2 ** BITS + 1 floats, whatever the input

    def make():
        w = sent.value
        bias = len(w) - 1

        def one(text: str) -> float:
            at, x = with_bias(*features(text), bias)
            return float(1 / (1 + np.exp(-float(w[at] @ x))))

        return lambda batch: pa.array([one(t) for t in texts_of(batch)], pa.float64())

    return make


def scores(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """The rows of ``docs`` with a new last column ``score``; ``docs`` must not have one."""
    made = scorer(docs, weights)

    def make():
        score = made()
        return lambda batch: batch.append_column("score", score(batch))

    return per_slice(docs, make, StructType([*docs.schema.fields, StructField("score", DoubleType())]))


def accepted(docs: DataFrame, weights: np.ndarray, least: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` whose score is ``least`` or more, as they are, whatever columns they have."""
    made = scorer(docs, weights)

    def make():
        score = made()
        return lambda batch: batch.filter(pc.greater_equal(score(batch), least))

    return per_slice(docs, make, docs.schema)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's columns."""
    rows = scores(documents(docs, "doc_id", "text"), fit(docs, labels))
    return rows.select("doc_id", (bucket(F.col("doc_id")) == 2).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
