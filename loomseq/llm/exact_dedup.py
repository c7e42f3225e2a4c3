"""Exact deduplication by a stateful stream.

Each row's digest, key and content locator (length of the text and the file it came from) are written to the shared folder
and streamed from there. The stream keeps one state per digest, on the executors' disks in RocksDB and without watermark
or expiry: the number of rows, and the largest key with its locator, which is the stable identifier of the group.
Partial aggregation within each task comes first, so a hot text reaches its state as one row per task. A later batch of rows
streamed under the same checkpoint finds the state of all before it.

A digest that occurs twice is a hit, and the full bytes of all rows that hit are compared: the least and the greatest text of
a digest are equal exactly when all are. Digests whose texts differ are regrouped by the full bytes.

Texts are equal when identical after lower-casing A-Z only; null counts as empty. The row with the largest key stays. Rows that repeat a
key count one by one: each is judged by its own text, and equal rows stay or go together. A null key is smaller than any other.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, matched_rows, new_path, per_slice, utf8_of, written

STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",  # else an executor keeps the databases of all its partitions open, outside the heap
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each partition's files take megabytes ahead
}


def digests(docs: DataFrame, keep_bytes: bool = False, size: int = 32) -> DataFrame:
    """``(doc_id, h, digest binary, length, file)`` of each row, ``h`` a hash of the text as it stands, with ``bytes``, the normalised text, if asked for.

    ``size``: bytes of the digest that count as key; fewer than 32 only in tests of colliding digests.
    """
    key = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "h", "digest", "length", "file", *["bytes"] * keep_bytes]

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [x.lower() for x in utf8_of(batch)]  # of bytes: A-Z only
            columns = [batch.column("doc_id"), batch.column("h"), pa.array([hashlib.sha256(x).digest()[:size] for x in texts], pa.binary()), pa.array(list(map(len, texts)), pa.int64()), batch.column("file"), *[pa.array(texts, pa.binary())] * keep_bytes]
            return pa.RecordBatch.from_arrays(columns, names)

        return work

    return per_slice(docs.select("doc_id", "text", "file", F.xxhash64("text").alias("h")), make, f"doc_id {key}, h bigint, digest binary, length bigint, file string" + ", bytes binary" * keep_bytes)


def located(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, file)``; the file is empty where rows come from more than one source."""
    rows = documents(docs, "doc_id", "text")
    try:
        return rows.withColumn("file", F.input_file_name())
    except AnalysisException:
        return rows.withColumn("file", F.lit(""))


def stream_groups(spark: SparkSession, source: str, schema, checkpoint: str, sink: str) -> None:
    """Brings the state under ``checkpoint`` up to date with the files in ``source``; changed groups go to ``sink``."""
    session = spark.newSession()  # its settings are its own
    for k, v in STATE.items():
        session.conf.set(k, v)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    state = session.readStream.schema(schema).parquet(source).groupBy("digest").agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", "length", "file")).alias("kept_row"))
    query = state.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, i: df.withColumn("batch", F.lit(i)).write.mode("overwrite").parquet(f"{sink}/of_batch={i}")).start()
    query.awaitTermination()


def groups(docs: DataFrame, size: int = 32) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, digest, h)`` for each row."""
    spark = docs.sparkSession
    docs = located(docs)
    rows = digests(docs, size=size)
    base = new_path(spark, "exact")
    rows.write.parquet(f"{base}/rows")
    rows = spark.read.schema(rows.schema).parquet(f"{base}/rows")
    if rows.isEmpty():
        return rows.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"), F.lit(False).alias("kept"), "digest", "h")
    stream_groups(spark, f"{base}/rows", rows.schema, f"{base}/state", f"{base}/groups")
    found = spark.read.schema(f"digest binary, group_size bigint, kept_row struct<doc_id:{docs.schema['doc_id'].dataType.simpleString()},length:bigint,file:string>, batch bigint").parquet(f"{base}/groups/*")
    # a digest has a row for each batch that changed it; the last one holds
    found = found.groupBy("digest").agg(F.max_by(F.struct("group_size", "kept_row"), "batch").alias("s")).select("digest", "s.group_size", F.col("s.kept_row.doc_id").alias("keep_id"), F.col("s.kept_row.length").alias("length"))
    found = written(found, "groups")
    out = rows.join(found.drop("length"), "digest")

    hits = written(out.where("group_size > 1").select("doc_id", "h").distinct(), "hits")
    bytes_of = digests(matched_rows(docs, hits, "left_semi"), keep_bytes=True, size=size)
    differ = written(bytes_of.groupBy("digest").agg(F.min("bytes").alias("a"), F.max("bytes").alias("b")).where("a <> b").select("digest"), "differ")
    if not differ.isEmpty():
        split = bytes_of.join(differ, "digest", "left_semi")
        parts = split.groupBy("digest", "bytes").agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
        again = split.join(parts, ["digest", "bytes"]).select("digest", "doc_id", "h", "length", "file", "group_size", "keep_id")
        out = out.join(differ, "digest", "left_anti").unionByName(again)
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest", "h")


def grouped(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    return groups(docs).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    gone = written(groups(docs).where("not kept").select("doc_id", "h").distinct(), "exact_dropped")
    return matched_rows(docs, gone, "left_anti")
