"""Filter audit, whitening and shards against plain Python and numpy, with nulls, ties, repeats, empty tables and clashing names."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from loomseq.llm import shards, survival, whitening

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_failures(rows: list[tuple]) -> list[set[str]]:
    out = []
    for i, t in rows:
        t, words = t or "", WORD.findall(t or "")
        same = [j for j, u in rows if j is not None and (u or "") == t]
        failed = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and min(same) < i}
        out.append({k for k, v in failed.items() if v})
    return out


def plain_audit(docs: list[tuple], labels: list[tuple]) -> list[tuple]:
    failed = plain_failures([(i, t) for i, t, _ in docs])
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    out = []
    for part in {s or "" for *_, s in docs}:
        own = [(i, f) for (i, _, s), f in zip(docs, failed, strict=True) if (s or "") == part]
        rows, total = [], Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                gone, stay = [r for r in left if x in r[1]], [r for r in left if x not in r[1]]
                total[x] += len(gone)
                rows.append((part, order, step, len(stay), len(gone), sum(x in f for _, f in own) - len(gone), sum(f == {x} for _, f in own), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), x))
                left = stay
        out += [(*r[:-1], total[r[-1]]) for r in rows]
    return sorted(out)


def test_audit_against_plain_reading(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(300)] + ["X&Y", "LOUD", "héé x", "\x0b"]
    texts = [None, "", " \t\x0b", "a b " * 60, "Word " * 20000] + [" ".join(rng.choice(vocabulary, int(n))) for n in rng.integers(1, 90, 60)]
    docs = [(int(i) if i < 95 else None, texts[int(rng.integers(len(texts)))], ["a", "b", "", None][int(rng.integers(4))]) for i in range(100)]
    docs += [docs[7]] * 5 + [(docs[7][0], "another text", "b"), (-1, docs[40][1], "a")]
    labels = [(int(i), int(rng.integers(2)), int(rng.integers(2))) for i in rng.integers(0, 95, 60)] + [(3, None, None), (None, 1, 1), (4, 1, None), (7, 1, 1)]
    frame = spark.createDataFrame([(*r, "n", 1) for r in docs], "doc_id long, text string, source string, part string, n int")
    marks = spark.createDataFrame([(*r, True) for r in labels], "doc_id long, quality int, toxic int, good boolean")
    assert sorted(map(tuple, survival.audit(frame.repartition(5), marks).collect())) == plain_audit(docs, labels)
    assert sorted(map(tuple, survival.audit(frame, marks.limit(0)).collect())) == plain_audit(docs, [])
    assert survival.audit(frame.limit(0), marks).count() == 0


def test_positional_popcounts():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 1000, 4099):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        times = rng.integers(1, 1 << 20, n)
        bits = words[:, None] >> np.arange(32, dtype=np.uint32) & np.uint32(1)
        assert survival.positional_popcount(words).tolist() == bits.sum(0, dtype=np.int64).tolist()
        assert survival.weighted_popcount(words, times).tolist() == (bits * times[:, None]).sum(0, dtype=np.int64).tolist()


@pytest.mark.parametrize("made", ["random", "equal", "clusters", "low rank", "tiny"])
def test_leading_eigenvectors(made):
    rng = np.random.default_rng(5)
    d = 1 if made == "tiny" else 60
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    spectrum = {"random": rng.random(d), "equal": np.full(d, 2.0), "clusters": np.repeat([3.0, 3.0 + 1e-13, 1.0], 20), "low rank": np.append(np.ones(5), np.zeros(55)), "tiny": np.array([4.0])}[made]
    a = q @ np.diag(spectrum) @ q.T
    a = (a + a.T) / 2
    k = min(32, d)
    values, vectors = whitening.leading(a, k)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:k]).max() < 1e-13 * spectrum.max()
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * spectrum.max() and np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13


def plain_whitening(vectors: list[list[float]], k: int):
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(0)
    deviation = [int(((n * r - s) ** 2).sum()) for r in x]
    y = ((x * n - s) / n).astype(float)
    values, found = np.linalg.eigh(y.T @ y / n)
    values, found = values[::-1], found[:, ::-1]
    return deviation, y @ found[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(7)
    vectors = (rng.standard_normal((300, 6)) * [5, 4, 3, 2, 1, 0.5]).astype(np.float32).tolist()
    vectors += [vectors[0]] * 40
    odd = [None, [], [1.0] * 5 + [None], [float("nan")] * 6, [float("inf")] + [0.0] * 5, [1.0, 2.0], [3e38] + [0.0] * 5]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(1000 + i, v) for i, v in enumerate(odd)]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, n int, component string")
    got = whitening.whiten(frame.repartition(7), 4).collect()
    deviation, want, explained = plain_whitening(vectors, 4)
    assert len(got) == 4 * len(vectors) and {r.n for r in got} == {len(vectors)} and max(r.identity_error for r in got) < 1e-9
    assert {(r.vec_id, r.deviation) for r in got} == set(enumerate(deviation))
    mine = np.zeros_like(want)
    for r in got:
        mine[r.vec_id, r.component - 1] = r.whitened
        assert abs(r.explained - explained[r.component - 1]) < 1e-12
    signs = np.sign((mine * want).sum(0))
    assert np.abs(mine * signs - want).max() < 1e-9


def test_whitening_of_little(spark):
    schema = "vec_id long, embedding array<float>"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    for rows in ([], [(1, None)], [(1, [])], [(1, [2.0, 3.0])] * 5, [(None, [float("nan")])]):
        assert whitening.whiten(frame(rows)).count() == 0
    got = whitening.whiten(frame([(None, [0.0, 1.0]), (None, [1.0, 1.0]), (2, [1.0, 1.0])])).collect()
    assert [r.component for r in got] == [1, 1, 1] and sorted(str(r.vec_id) for r in got) == ["2", "None", "None"] and abs(got[0].explained - 1) < 1e-12
    wide = whitening.whiten(frame([(1, [0.0]), (2, [2.0**45])])).collect()  # deviations beyond 64 bits
    assert [r.deviation for r in wide] == [None, None] and sorted(round(r.whitened, 9) for r in wide) in ([-1.0, 1.0],)


def test_permutation_and_its_inverse():
    for n in (1, 2, 3, 5, 16, 17, 1000, 4097):
        q = shards.permuted(np.arange(n), n)
        assert sorted(q.tolist()) == list(range(n)) and shards.permuted(q, n, back=True).tolist() == list(range(n))
        assert all(shards.row_at(*shards.place(i, n), n) == i for i in range(0, n, 7))
    assert shards.permuted(np.array([0, 10**12 - 1]), 10**12).max() < 10**12
    assert shards.permuted(np.arange(1000), 1000, seed=1).tolist() != shards.permuted(np.arange(1000), 1000, seed=2).tolist()


def test_shards_of_documents(spark, tmp_path):
    texts = [None, "", "ünï\U0001f600", "x" * 100000]
    rows = [(i, f"text {i}" if i % 7 else texts[i % 4], "a", 9) for i in range(500)] + [(3, "same", "b", 1)] * 200 + [(None, "no key", "c", 2), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, row int")
    got = shards.placed(docs.repartition(5)).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    size = lambda t: len((t or "").encode())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, size(t) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    slots = {s: sorted(r.slot for r in got if r.shard == s) for s in range(40)}
    assert all(v == list(range(len(v))) for v in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = shards.placed(docs.repartition(3)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))  # however the rows are dealt
    whole = shards.sharded(docs, 4)
    assert whole.columns == ["doc_id", "text", "row", "shard", "slot"] and whole.count() == len(rows)
    shards.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, back.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
    assert shards.placed(docs.limit(0)).count() == 0 and shards.sharded(docs.limit(1), 4).select("shard", "slot").first() is not None
