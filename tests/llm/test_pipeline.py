"""The pipeline's stages against plain Python, and clashing columns in every operator."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomseq.llm import byte_bpe, cascade, exact_dedup, ftrl, minhash, packing, repair_codec, secrets
from loomseq.llm.queries import split_pattern, tokenizer_path
from loomseq.llm.word_bpe import WordBpe

from . import brute

SF = "/root/testdata/sf0.001"
SENTENCE = " ".join(f"word{i}" for i in range(80))
ODD = [
    (10**6, None), (10**6 + 1, ""), (10**6 + 2, SENTENCE), (10**6 + 3, SENTENCE.upper()), (10**6 + 4, SENTENCE + " more"), (10**6 + 4, "another text under a repeated key"), (10**6 + 5, "w " * 30_000),
    (10**6 + 6, "see token = " + "0a1b2c3d" * 5 + " and " + "9f8e7d6c" * 5 + " here"), (10**6 + 2, SENTENCE), (None, "a text without a key"), (None, SENTENCE),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with odd rows, and columns whose names operators use themselves."""
    path = tmp_path_factory.mktemp("corpus")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(ODD, "doc_id long, text string").select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars"))
    clash = {c: F.lit("clash") for c in ("score", "h", "n", "digest", "row_id", "file", "host", "key", "spans", "ids", "part")}
    docs.unionByName(odd).withColumns(clash).repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return str(path)


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def key(rows):
    return sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))


def exact(rows):
    """The rows that the exact stage keeps."""
    lower = lambda t: (t or "").encode().lower()
    most: dict = {}
    for i, t in rows:
        most[lower(t)] = max(most.get(lower(t), -1), -1 if i is None else i)
    return [(i, t) for i, t in rows if (-1 if i is None else i) == most[lower(t)]]


def near(rows):
    """The rows that the near stage keeps: of each component those of its smallest key (and of its smallest set there)."""
    keyed = [(n, x) for n, x in enumerate(rows) if x[0] is not None]
    order = sorted(keyed, key=lambda x: (x[1][0], x[0]))
    found = brute.components([(j, x[1][1]) for j, x in enumerate(order)], 5)
    stay = [x[1] for j, x in enumerate(order) if found[j][0] == 0 or found[j][1] == j or (x[1][0] == order[found[j][1]][1][0] and brute.shingles(x[1][1], 5) == brute.shingles(order[found[j][1]][1][1], 5))]
    return stay + [x for x in rows if x[0] is None]


def test_stages(spark, folder, docs):
    rows = rows_of(docs)
    kept = corpus_pipeline.quality(spark, docs, folder)
    judged = {(r.doc_id, r.score) for r in ftrl.judged(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect() if r.predicted}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in judged}
    assert key(rows_of(corpus_pipeline.exact(spark, docs, folder))) == key(exact(rows))
    assert key(rows_of(corpus_pipeline.near(spark, docs, folder))) == key(near(rows))
    clean = corpus_pipeline.redaction(spark, docs, folder)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    for r in clean.collect():
        assert (r.text is None and r.doc_id == 10**6) or (r.n_chars == len(r.text) and not secrets.find(r.text))
    (found,) = [r.text for r in clean.collect() if r.doc_id == 10**6 + 6]
    assert found == "see [secret] and [secret] here"


def test_run(spark, folder, docs):
    """All stages, one after the other, on what the one before it kept."""
    first = rows_of(corpus_pipeline.quality(spark, docs, folder))
    left = spark.createDataFrame(key(near(exact(first))), "doc_id long, text string")
    want: dict = {}
    tokenizer = WordBpe(tokenizer_path("word_bpe_49k.json")).tokenizer
    for i, text in rows_of(secrets.redact(left)):
        want.setdefault(i, []).append(len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1)
    got: dict = {}
    rows = corpus_pipeline.run(spark, folder).collect()
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == {i: sum(x) for i, x in want.items()} and len({r.sequence_id for r in rows}) == len(rows)


def test_clashing_columns(spark, docs):
    """Columns of any name beside the two that are read change nothing."""
    plain = docs.select("doc_id", "text")
    word, path, pattern = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.tiktoken"), split_pattern()
    runs = {
        "secrets": lambda d: secrets.digests(secrets.scan(d)),
        "bytes": lambda d: byte_bpe.round_trip(d, path, pattern),
        "pieces": lambda d: packing.packed_digests(d, word).select("doc_id", "start", "length", "ids_crc32"),
        "exact": exact_dedup.grouped,
        "rules": cascade.judged,
        "sets": lambda d: minhash.groups(d, 2),
        "shards": lambda d: repair_codec.round_trip(d, word),
    }
    for name, run in runs.items():
        a, b = (sorted(map(str, run(d).collect())) for d in (docs, plain))
        assert a == b, name


def test_exact_digests(spark, docs):
    import hashlib

    want = sorted((str(i), hashlib.sha256((t or "").encode().lower()).hexdigest()) for i, t in rows_of(docs))
    assert sorted((str(r.doc_id), r.text_sha256) for r in exact_dedup.grouped(docs).collect()) == want


def test_long_texts_in_parts():
    """Texts over the size of a part have the same ids, whatever is cut where."""
    from loomseq.llm import segments

    ours = WordBpe(tokenizer_path("word_bpe_49k.json"))
    text = ("it's a test, no more!  éà one\ntwo " * 3000 + "x" * 5000 + " end").encode()
    want = ours.encode_group([text, b"", b"short one"])
    got = segments.in_parts([text, b"", b"short one"], ours._group, 1000)
    assert (want[0] == got[0]).all() and (want[1] == got[1]).all()
    codec = byte_bpe.ByteBpe(tokenizer_path("byte_bpe_50k.tiktoken"), split_pattern())
    one, two = codec.encode_group([text, b"\0zero \0"]), segments.in_parts([text, b"\0zero \0"], codec._group, 1000)
    assert (one[0] == two[0]).all() and codec.decode(one[0])[0].tobytes() == text + b"\0zero \0"


def test_workers_give_memory_back():
    """What an operator keeps in a worker leaves the process with it, before the next operator's first slice."""
    code = f"""
import re
import pyarrow.parquet as pq
from loomseq.llm import common
from loomseq.llm.queries import tokenizer_path
from loomseq.llm.word_bpe import word_bpe
def held():
    return sum(map(int, re.findall(r"Anonymous: +(\\d+)", open("/proc/self/smaps_rollup").read())))
class Rows:  # stands for a table: what per_slice makes of it is the task itself
    sparkSession = type("Session", (), {{"conf": {{"spark.sql.execution.arrow.maxRecordsPerBatch": "1"}}}})
    def mapInArrow(self, run, schema):
        return run
table = pq.read_table("{SF}/documents.parquet", columns=["text"])
for batch in table.to_batches(max_chunksize=50):
    word_bpe(tokenizer_path("word_bpe_49k.json")).encode_group(common.utf8_of(batch))
before = held()
list(common.per_slice(Rows(), lambda: lambda batch: batch, "text string")(iter(table.to_batches())))
print(before, held())
assert before - held() > 30_000
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).parents[2])


def test_repair_leaves_no_frequent_pair():
    draw = np.random.default_rng(4)
    passage = draw.integers(0, 40_000, 3000)
    ids = np.concatenate([np.concatenate([draw.integers(0, 40_000, 500), passage]) for _ in range(30)] + [np.full(70_000, 5)]).astype("<u4")
    starts = np.arange(0, len(ids), 7000)
    seq, rules, lengths, symbols = repair_codec.compress(ids, starts)
    assert (repair_codec.expand(seq, rules) == ids).all() and lengths.max() > 1000
    first = np.zeros(len(seq) + 1, bool)
    first[symbols] = True
    pairs = (seq[:-1] << 32 | seq[1:])[~first[1:-1]]
    assert np.unique(pairs, return_counts=True)[1].max() < repair_codec.LEAST
