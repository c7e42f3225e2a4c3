"""FASTQ as tables and as streams: records of four lines, found where a file is cut at line ends before ``@``.

Spark cuts files at ``\\n@``, which begins every record but also stands before a quality line that begins with ``@``. A piece of
four lines is a record; one of three is a record whose quality is the next piece. So records are known from the pieces alone,
and tasks look at each byte once, piece by piece and not line by line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import spread_join
from .shared import written

WHOLE, HEAD, TAIL, BROKEN = 0, 1, 2, 3
#: Kinds of pieces by their line ends; the last piece of a file may have one more.
KIND = "case when n = 3 or (n = 4 and ends) then 0 when n = 2 and not ends then 1 when n = 0 or (n = 1 and ends) then 2 else 3 end"


def _pieces(reader, path: str | list[str]) -> DataFrame:
    return reader.format("text").option("lineSep", "\n@").load(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _records(pieces: DataFrame) -> DataFrame:
    """``(file, block, i, kind, value)``: the i-th record of a block of a file; only one that blocks share comes as its head and its tail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, i, waiting = None, 0, None  # the block, its next record's number, and a head that waits for its tail

        def rows(file, block, values, numbers, kinds):
            k = len(numbers)
            return pa.RecordBatch.from_arrays([pa.array([file] * k, pa.string()), pa.array(np.full(k, block, np.int64)), pa.array(numbers, pa.int64()), pa.array(kinds, pa.int32()), pa.array(values, pa.string()) if isinstance(values, list) else values], ["file", "block", "i", "kind", "value"])

        for batch in batches:
            files, blocks = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
            codes = files.indices.to_numpy()
            edges = np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                if a == b:
                    continue
                file, block = files.dictionary[int(codes[a])].as_py(), int(blocks[a])
                values = batch.column("value").slice(int(a), int(b - a))
                if of != (file, block):
                    if waiting is not None:
                        yield rows(*of, [waiting], [i - 1], [HEAD])
                    of, i, waiting = (file, block), 0, None
                    if block == 0:  # a file begins with "@", not with a line's end before it
                        first = values[0].as_py()
                        values = pa.concat_arrays([pa.array([first.removeprefix("@")], values.type), values.slice(1)])
                n = pc.count_substring(values, "\n").to_numpy(zero_copy_only=False)
                ends = pc.ends_with(values, "\n").to_numpy(zero_copy_only=False)
                cut = ends & ((n == 4) | (n == 1))
                if cut.any():
                    values = pc.if_else(pa.array(cut), pc.utf8_slice_codeunits(values, 0, -1), values)
                kind = np.full(len(n), BROKEN)
                kind[n - cut == 3], kind[(n == 2) & ~ends], kind[n - cut == 0] = WHOLE, HEAD, TAIL
                if (kind == BROKEN).any():
                    raise ValueError(f"{file} has lines that make no whole records")
                number = i + np.cumsum(kind != TAIL) - 1
                i = int(number[-1]) + 1
                whole = np.flatnonzero(kind == WHOLE)
                if len(whole):
                    yield rows(file, block, values.take(pa.array(whole)), number[whole], np.full(len(whole), WHOLE))
                texts, numbers, kinds = [], [], []
                for p in np.flatnonzero(kind != WHOLE).tolist():
                    text = values[p].as_py()
                    if kind[p] == HEAD:
                        if waiting is not None or not text.rsplit("\n", 1)[1].startswith("+"):
                            raise ValueError(f"{file} has lines that make no whole records")
                        waiting = text
                    elif waiting is not None:
                        texts, numbers, kinds = [*texts, f"{waiting}\n@{text}"], [*numbers, int(number[p])], [*kinds, WHOLE]
                        waiting = None
                    else:
                        texts, numbers, kinds = [*texts, text], [*numbers, int(number[p])], [*kinds, TAIL]
                if texts:
                    yield rows(file, block, texts, numbers, kinds)
        if waiting is not None:
            yield rows(*of, [waiting], [i - 1], [HEAD])

    return pieces.mapInArrow(run, "file string, block long, i long, kind int, value string")


def _fields(records: DataFrame, ordinal) -> DataFrame:
    lines = F.split("value", "\r?\n", 4)
    rows = records.select("file", ordinal.alias("ordinal"), lines.alias("f"))
    head = F.col("f")[0]
    return rows.select("file", "ordinal", F.regexp_extract(head, r"^(\S*)", 1).alias("read_id"), F.regexp_extract(head, r"^\S*\s?(.*)$", 1).alias("description"), F.col("f")[1].alias("seq"), F.regexp_replace(F.col("f")[3], "\r$", "").alias("qual"))


def scan_fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, ordinal, read_id, description, seq, qual)`` of the records of four lines.

    Gzip files can't be split, so their records are numbered as they are read, and a broken file ends the job that reads it. Other
    files may be read in blocks: the pieces of each are counted first, which numbers every record and refuses files whose lines
    don't make whole records at once; a record that two blocks share is put together from its head and its tail.
    """
    pieces = _pieces(spark.read, path)
    records = _records(pieces)
    if all(name.endswith(".gz") for name in pieces.inputFiles()):
        return _fields(records, F.col("i"))
    n = pieces.select("file", "block", (F.length("value") - F.length(F.translate("value", "\n", ""))).alias("n"), F.endswith("value", F.lit("\n")).alias("ends"), F.length("value").alias("size"))
    per = n.withColumn("kind", F.expr(KIND)).groupBy("file", "block").agg(*[F.count_if(F.col("kind") == k).alias(name) for k, name in enumerate(("wholes", "heads", "tails", "broken"))])
    blocks = written(per, "fastq_blocks")
    total = blocks.groupBy("file").agg(F.sum("broken").alias("broken"), F.sum("heads").alias("heads"), F.sum("tails").alias("tails"))
    if (bad := total.where("broken > 0 or heads <> tails").first()) is not None:
        raise ValueError(f"{bad.file} has lines that make no whole records")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = written(blocks.select("file", "block", F.coalesce(F.sum(F.col("wholes") + F.col("heads")).over(before), F.lit(0)).alias("base")), "fastq_bases")
    numbered = spread_join(records, base, ["file", "block"]).withColumn("ordinal", F.col("base") + F.col("i"))
    whole = numbered.where(F.col("kind") == WHOLE).select("file", "ordinal", "value")
    if not blocks.where("block > 0").isEmpty():
        # a block has one head at its end and one tail at its start at most
        w = Window.partitionBy("file").orderBy("block", F.desc("kind"))
        shared = numbered.where(F.col("kind") != WHOLE).withColumn("tail", F.lead("value").over(w)).where(F.col("kind") == HEAD)
        whole = whole.unionByName(shared.select("file", "ordinal", F.concat_ws("\n@", "value", "tail").alias("value")))
    return _fields(whole, F.col("ordinal"))


def fastq_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The same columns on a stream over a folder of FASTQ files, such as a sequencer fills; ``options`` are those of a stream of files.

    Records are numbered within their files. A plain file that is cut in two within a record whose quality begins with ``@``
    ends the stream with an error: gzip files, and files below ``spark.sql.files.maxPartitionBytes``, are never cut.
    """
    records = _records(_pieces(spark.readStream.options(**options), path))
    broken = F.raise_error(F.concat(F.lit("a record is cut in two in "), F.col("file")))
    whole = records.where(F.when(F.col("kind") == WHOLE, True).otherwise(broken.cast("boolean")))
    apart = F.when(F.col("block") == 0, F.col("i"))  # further blocks of a file don't know what is before them
    return _fields(whole, apart)
