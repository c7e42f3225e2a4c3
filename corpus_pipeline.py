"""A corpus pipeline: quality, exact and near duplicates, secrets, packing; each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomseq.llm import exact_dedup, ftrl, minhash, packing, secrets
from loomseq.llm.common import table, written
from loomseq.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels of all documents, accepts."""
    return ftrl.accepted(docs, ftrl.fit(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, null as empty; rows that repeat a key are judged by their own texts."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates: five-word shingles, a similarity of 0.8 or more.

    Null and empty texts, and rows without a key, are in no component and stay.
    """
    return minhash.deduplicate(docs)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids with their sequences."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("secret_redaction", redaction), ("packing", pack)]

#: No SQL: the classifier, the learnt automata and the tokenizer are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
