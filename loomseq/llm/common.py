"""Shared helpers: table paths, the shared folder, written intermediate tables."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow slice that a Python worker holds as Python objects at once.
SLICE_ROWS = 512

_local_dirs: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a local session gets a temporary folder; a cluster without the setting is refused.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="loomseq-")
    return _local_dirs[sc.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/loomseq/{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends there, and it survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.written_path = path
    return back


def dropped(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` once all that was made of them is itself written."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(df.written_path)
        path.getFileSystem(conf).delete(path, True)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in small slices, so that a worker's Python objects stay bounded."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts, with null as the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def utf8_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of texts, with null as the empty text."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def documents(docs: DataFrame, *columns: str) -> DataFrame:
    """Just the named columns, so that others of any name can't clash with what an operator adds."""
    return docs.select(*[F.col(f"`{c}`") for c in columns])


#: Rows of an Arrow batch between Spark and a Python worker; Spark's own 10,000 texts would be tens of megabytes at least.
BATCH_ROWS = 1000

_kept: dict[tuple, object] = {}


def kept(key: tuple, make: Callable[[], object]):
    """What a worker keeps from task to task, such as a codec: one thing at a time."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def trimmed() -> None:
    """Gives memory that this process has freed back to the machine; the allocators would keep it for what comes next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def let_go() -> None:
    """A worker lets go of what operators keep there."""
    if _kept:
        _kept.clear()
        gc.collect()  # a codec and its memo refer to each other
        trimmed()


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with batches of ``BATCH_ROWS`` rows, unless the session has a setting of its own; what a task has freed at its end goes back to the machine."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if df.sparkSession.conf.get(name) == "10000":
        df.sparkSession.conf.set(name, str(BATCH_ROWS))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        trimmed()

    return df.mapInArrow(task, schema)


def per_slice(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema, keeps: bool = False) -> DataFrame:
    """Maps slices of Arrow rows; ``make`` runs once for each task and loads what the task needs.

    A worker lets go of what other operators keep there, unless this one ``keeps`` something itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            let_go()
        work = make()
        for part in sliced(batches):
            yield work(part)

    return mapped(df, run, schema)


#: Ids (up to some tens of bytes each) that are sent to every executor; more of them are joined by a shuffle.
MOST_IDS = 300_000


def matched(df: DataFrame, ids: DataFrame, on: str, how: str, most: int = MOST_IDS) -> DataFrame:
    """``left_semi`` or ``left_anti`` join with a written table of ids, broadcast only when it is counted to be small."""
    return df.join(F.broadcast(ids) if ids.count() <= most else ids, on, how)


def with_hash(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, h)``; key and hash of the text together tell rows of different texts apart."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("h"))


def matched_rows(docs: DataFrame, rows: DataFrame, how: str, most: int = MOST_IDS) -> DataFrame:
    """``left_semi`` or ``left_anti`` join with a written table ``(doc_id, h)`` of rows; null keys match null keys."""
    rows = rows.toDF("row_id", "row_h")
    rows = F.broadcast(rows) if rows.count() <= most else rows
    return docs.join(rows, docs["doc_id"].eqNullSafe(rows["row_id"]) & (F.xxhash64(docs["text"]) == rows["row_h"]), how)
