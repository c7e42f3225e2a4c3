"""Tables and paths in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; only a local session without that setting gets a temporary folder."""
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
    """A path of its own in the shared folder; ``clear`` deletes what is written there."""
    folder = f"{shared_dir(spark)}/loomseq/{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return f"{folder}/{name}"


#: Whether shuffle files go when the query that made them has ended, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries run within leave no shuffle files behind: what they write is read from its folder afterwards."""
    was = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if was is None else spark.conf.set(CLEANUP, was)


def save(df: DataFrame, path: str) -> None:
    """``df`` as Parquet; zstd takes half as much disk as snappy for bases and qualities."""
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path, compression="zstd")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, and it survives lost executors."""
    path = new_path(df.sparkSession, name)
    save(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> int:
    """Deletes all that this application's operators have written to the shared folder, and says how many folders it was.

    Results read from there, so they must be saved first.
    """
    made = _made.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in made:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    return len(made)
