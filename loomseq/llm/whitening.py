"""Embedding whitening: distributed centred covariance, its leading eigenvectors, and a broadcast projection.

Vectors that are null, or hold null or non-finite entries, are dropped, as are those of another length than most (of equally
frequent lengths the longest counts) and those with an entry whose size is 2^46 or more, which has no exact integer here.
Entries become integers ``floor(64 c) + 1000000``. Their sums are exact; the covariance is summed over each task's centred
rows, and the tasks' matrices row by row of the matrix, so no task holds all of them. Only the d x d matrix, which doesn't
grow with the rows, comes to the driver: Householder reflections make it tridiagonal, Sturm counts bisect for the leading
eigenvalues, and inverse iteration, orthogonalised again within clusters, gives their vectors. The d x k projection is
broadcast.

Defined results: no vectors, or vectors of no entries, give no rows. A component whose eigenvalue is not above the rounding
error of the covariance (equal vectors, fewer vectors than dimensions) has no whitened values and is left out. Repeated rows
and null ids get rows of their own. ``deviation`` is null where it is beyond 64 bits. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, mapped

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: Entries of this size or more are not exact as integers.
MOST = float(1 << 46)
#: Doubles of a block of rows that a task turns to a matrix at once.
BLOCK = 1 << 20


def integers(batch: pa.RecordBatch, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a batch remain, and their integers."""
    vectors = batch.column("embedding")
    sizes = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    right = np.flatnonzero(sizes == d)
    if not len(right):
        return right, np.zeros((0, d), np.int64)
    flat = vectors.take(pa.array(right)).flatten().cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False).reshape(len(right), d)  # null entries become nan
    good = (np.abs(values) < MOST).all(1)
    return right[good], np.floor(values[good] * SCALE).astype(np.int64) + SHIFT


def blocks(batches, d: int):
    """Rows' integers in blocks of bounded size."""
    rows = max(1, BLOCK // max(1, d))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            kept, x = integers(part, d)
            if len(kept):
                yield part, kept, x


def dimension(rows: DataFrame) -> int:
    """The most frequent length of the vectors, 0 where there are none."""
    usable = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < MOST, F.lit(False)))
    sizes = rows.where(usable).groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"))
    found = sizes.agg(F.max(F.struct("n", "d")).alias("m")).first().m
    return found.d if found else 0


def exact_sums(rows: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """The number of vectors, and the sum of each dimension's integers."""

    def run(batches):
        n, total = 0, np.zeros(d, object)
        for _, kept, x in blocks(batches, d):
            n += len(kept)
            total = total + x.sum(0).astype(object)  # a block's sum fits 64 bits, all blocks' need not
        at = pa.array(range(d + 1), pa.int32())
        yield pa.RecordBatch.from_arrays([at, pa.array([str(v) for v in [*total, n]], pa.string())], ["i", "v"])

    got = mapped(rows, run, "i int, v string").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38, 0)")).alias("v")).collect()  # d + 1 rows
    values = {r.i: int(r.v) for r in got}
    return values.get(d, 0), np.array([values.get(i, 0) for i in range(d)], object)


def covariance(rows: DataFrame, make, d: int, n: int) -> np.ndarray:
    """The covariance, divisor ``n``, of the centred rows of ``d`` doubles that ``make()`` makes of a task's batches.

    Each task sums its own rows; the matrices of tasks are then summed by their rows, which are dealt to all tasks.
    """

    def own(batches):
        total = np.zeros((d, d))
        for y in make()(batches):
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], ["i", "v"])

    def summed(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            values = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, d)
            for i, v in zip(batch.column("i").to_pylist(), values, strict=True):
                held[i] = held.get(i, 0) + v
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(list(held.values()), pa.list_(pa.float64()))], ["i", "v"])

    schema = "i int, v array<double>"
    got = mapped(mapped(rows, own, schema).repartition(min(d, rows.sparkSession.sparkContext.defaultParallelism), "i"), summed, schema).toArrow()
    out = np.zeros((d, d))
    for i, v in zip(got.column("i").to_pylist(), got.column("v").to_pylist(), strict=True):
        out[i] += v
    return (out + out.T) / 2 / max(1, n)


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the Householder vectors that make a symmetric matrix tridiagonal."""
    a, d = a.copy(), len(a)
    reflectors = []
    for j in range(d - 2):
        v = a[j + 1 :, j].copy()
        size = np.linalg.norm(v)
        v[0] += np.copysign(size, v[0])
        length = np.linalg.norm(v)
        if length == 0:
            reflectors.append(v)
            continue
        v /= length
        reflectors.append(v)
        part = a[j + 1 :, j + 1 :]
        p = part @ v
        w = 2 * (p - (v @ p) * v)
        part -= np.outer(v, w) + np.outer(w, v)
        a[j + 1, j] = a[j, j + 1] = a[j + 1, j] - 2 * v[0] * (v @ a[j + 1 :, j])
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def sturm(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix are below each of ``x``: the negative pivots of its factorisation."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    q = np.ones_like(x)
    below = np.zeros(len(x), np.int64)
    squares = np.append(0.0, off * off)
    for a, b in zip(diagonal, squares, strict=True):
        q = a - x - b / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection of all their intervals at once, to the last bit that counts."""
    d = len(diagonal)
    reach = np.append(np.abs(off), 0) + np.append(0, np.abs(off))
    bound = (np.abs(diagonal) + reach).max() * (1 + 1e-12) + np.finfo(float).tiny
    low, high = np.full(k, -bound), np.full(k, bound)
    wanted = d - np.arange(k)  # of the i-th largest, so many are at or below it
    least = bound * np.finfo(float).eps ** 2  # values about zero could be halved a thousand times
    while True:
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high) | (high - low <= least)).all():
            return middle
        under = sturm(diagonal, off, middle) >= wanted
        low, high = np.where(under, low, middle), np.where(under, middle, high)


def shifted_solve(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solves ``(T - e) y = b`` for each eigenvalue and column by elimination with row exchanges, all columns side by side."""
    d, k = right.shape
    scale = np.abs(diagonal).max(initial=0) + np.abs(off).max(initial=0)
    least = np.finfo(float).eps * scale + np.finfo(float).tiny
    u0, u1, u2, b = np.zeros((d, k)), np.zeros((d, k)), np.zeros((d, k)), right.copy()
    top, beside = diagonal[0] - values, np.full(k, off[0] if d > 1 else 0.0)
    for i in range(d - 1):
        lower, following, last = np.full(k, off[i]), diagonal[i + 1] - values, np.full(k, off[i + 1] if i + 2 < d else 0.0)
        swap = np.abs(lower) > np.abs(top)
        u0[i], u1[i], u2[i] = np.where(swap, lower, top), np.where(swap, following, beside), np.where(swap, last, 0.0)
        other, second, third = np.where(swap, top, lower), np.where(swap, beside, following), np.where(swap, 0.0, last)
        u0[i] = np.where(np.abs(u0[i]) < least, least, u0[i])
        first, rest = np.where(swap, b[i + 1], b[i]), np.where(swap, b[i], b[i + 1])
        factor = other / u0[i]
        b[i], b[i + 1] = first, rest - factor * first
        top, beside = second - factor * u1[i], third - factor * u2[i]
    u0[d - 1] = np.where(np.abs(top) < least, least, top)
    y = np.zeros((d + 2, k))
    for i in range(d - 1, -1, -1):
        y[i] = (b[i] - u1[i] * y[i + 1] - u2[i] * y[i + 2]) / u0[i]
    return y[:d]


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 5, near: float = 1e-3) -> np.ndarray:
    """Unit eigenvectors as columns: inverse iteration from a fixed start; those of a cluster of near values are made orthogonal in each round."""
    d, k = len(diagonal), len(values)
    norm = np.abs(diagonal).max(initial=0) + 2 * np.abs(off).max(initial=0)
    # equal values are moved apart by a rounding error, so that their systems differ
    apart = values - np.finfo(float).eps * norm * np.arange(k)
    first = np.zeros(k, np.int64)
    for i in range(1, k):
        first[i] = first[i - 1] if values[i - 1] - values[i] <= near * norm else i
    y = np.random.default_rng(1).standard_normal((d, k))
    for _ in range(rounds):
        y = shifted_solve(diagonal, off, apart, y / np.linalg.norm(y, axis=0))
        for i in range(k):
            y[:, i] /= np.linalg.norm(y[:, i])
            for _ in range(2):  # the second time takes what the first left by rounding
                others = y[:, first[i] : i]
                y[:, i] -= others @ (others.T @ y[:, i])
                y[:, i] /= np.linalg.norm(y[:, i])
    return y


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    diagonal, off, reflectors = tridiagonal(a)
    values = leading_values(diagonal, off, k)
    y = leading_vectors(diagonal, off, values)
    for j in range(len(reflectors) - 1, -1, -1):
        v = reflectors[j]
        y[j + 1 :] -= 2 * np.outer(v, v @ y[j + 1 :])
    return values, y


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``, a row for each vector and component."""
    rows = documents(vectors, "vec_id", "embedding")
    key = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {key}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    spark = rows.sparkSession
    empty = spark.createDataFrame([], schema)
    d = dimension(rows)
    if d == 0:
        return empty
    n, sums = exact_sums(rows, d)
    floors = np.array([int(s) // n for s in sums], np.int64)
    rests = np.array([float((int(s) % n) / n) for s in sums])  # the mean is a whole number and this rest

    def centred():
        return lambda batches: (((x - floors) - rests) for _, _, x in blocks(batches, d))

    v = covariance(rows, centred, d, n)
    trace = float(np.trace(v))
    if trace <= 0:  # all vectors are equal
        return empty
    values, found = leading(v, min(components, d))
    k = int((values > trace * d * np.finfo(float).eps).sum())
    values, project = values[:k], found[:, :k] / np.sqrt(values[:k])
    sent = spark.sparkContext.broadcast((project, sums, values / trace))  # d times k doubles, whatever the rows

    def projected():
        project = sent.value[0]
        # the mean of what is projected is zero but for rounding, which is far below the entries themselves
        return lambda batches: ((((x - floors) - rests) @ project) for _, _, x in blocks(batches, d))

    error = float(np.abs(covariance(rows, projected, k, n) - np.eye(k)).max())
    widest = (1 << 63) - 1

    def run(batches):
        project, sums, explained = sent.value
        each = max(1, BLOCK // (8 * k))  # rows of a batch that goes out
        for part, kept, x in blocks(batches, d):
            ids = part.column("vec_id").take(pa.array(kept))
            for at in range(0, len(kept), each):
                own = x[at : at + each]
                m = len(own)
                y = ((own - floors) - rests) @ project
                away = own.astype(object) * n - sums if n * float(np.abs(own).max(initial=0)) > 2**52 else own * n - sums.astype(np.int64)
                away = (away.astype(object) ** 2).sum(1) if float(np.abs(away).max()) ** 2 * d > 2**62 else (away.astype(np.int64) ** 2).sum(1)
                away = pa.array([int(a) if a <= widest else None for a in away], pa.int64())
                repeat = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, m).take(repeat), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), away.take(repeat), pa.array(y.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return mapped(rows, run, schema)
