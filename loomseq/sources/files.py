"""Readers and writers of sequencing files; missing values are empty strings there and null here."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.alignments import with_aln_id
from ..operators.joins import spread_join
from .fasta import scan_contigs, scan_tiles  # noqa: F401  part of this module's interface
from .fastq import fastq_stream, scan_fastq  # noqa: F401
from .shared import new_path, save, shuffles_freed, written

BC_TABLES = {
    "calls": ("read_id string, putative_bc string, min_q int, c3 string, c4 string, c5 string, c6 string", ","),
    "putative": ("sample string, read_id string, putative_bc string", ","),
    "corrected": ("sample string, read_id string, bc string, bc_qual string, umi string, umi_qual string, corrected_bc string", "\t"),
    "info": ("sample string, read_id string, bc string, bc_qual string, umi string, umi_qual string", "\t"),
    "counts": ("sample string, bc string, n bigint", ","),
}


def _nulls(df: DataFrame) -> DataFrame:
    return df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def scan_samplesheet(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Samples with their first cell count and all FASTQ files, and the rows that break the sheet's rules."""
    rows = spark.read.csv(path, schema="sample string, fastq string, cell_count int", header=True)
    bad = ~F.coalesce(F.col("sample").rlike(r"^\S+$"), F.lit(False)) | ~F.coalesce(F.col("fastq").rlike(r"^\S+\.f(ast)?q\.gz$"), F.lit(False)) | F.col("cell_count").isNull()
    rows = rows.withColumn("ordinal", F.monotonically_increasing_id())
    twice = rows.groupBy("fastq").agg(F.count("*").alias("k")).where("k > 1").select("fastq")
    samples = rows.where(~bad).groupBy("sample").agg(F.min_by("cell_count", "ordinal").alias("cell_count"), F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "fastq"))), lambda x: x["fastq"]).alias("fastqs"))
    return samples, rows.where(bad).drop("ordinal").unionByName(rows.drop("ordinal").join(twice, "fastq", "left_semi"))


def write_fastq(reads: DataFrame, path: str) -> None:
    reads.select(F.concat_ws("\n", F.concat(F.lit("@"), "read_id"), "seq", F.lit("+"), "qual").alias("value")).write.text(path, compression="gzip")


def merge_replicates(samples: DataFrame, reads: DataFrame) -> DataFrame:
    """All reads of each sample's files as one table; reads of files that no sample lists are left out.

    A listed path and a file's belong together where they end in the same folders and name, further up than either does with
    any other: a listed path may be whole, relative or of another place, and files of different folders may share their names.
    A file that two samples have equal claims to is refused.
    """
    ends = lambda path: F.transform(F.sequence(F.lit(1), F.size(path)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(path, F.size(path) - k + 1, k), "/").alias("end")))
    parts = lambda c: F.filter(F.split(F.regexp_replace(c, "^[A-Za-z][A-Za-z0-9+.-]*:", ""), "/"), lambda x: (x != "") & (x != "."))
    found = reads.select("file").distinct().select("file", F.explode(ends(parts(F.col("file")))).alias("x")).select("file", "x.*")
    listed = samples.select("sample", F.explode("fastqs").alias("fastq")).distinct().select("sample", "fastq", F.explode(ends(parts(F.col("fastq")))).alias("x")).select("sample", "fastq", "x.end")
    shared = written(found.join(listed, "end").groupBy("file", "sample", "fastq").agg(F.max("depth").alias("depth")), "shared_paths")
    best = lambda *c: shared.groupBy(*c).agg(F.max("depth").alias("depth"))
    pairs = written(shared.join(best("file"), ["file", "depth"]).join(best("sample", "fastq"), ["sample", "fastq", "depth"]).select("file", "sample").distinct(), "files_of_samples")
    if (unclear := pairs.groupBy("file").agg(F.count("*").alias("n"), F.min("sample").alias("a"), F.max("sample").alias("b")).where("n > 1").first()) is not None:
        raise ValueError(f"{unclear.file} may belong to {unclear.a} or {unclear.b}: list more of its path")
    return spread_join(reads, pairs, ["file"]).select("sample", "file", "ordinal", "read_id", "description", "seq", "qual")


def scan_gtf(spark: SparkSession, path: str) -> DataFrame:
    """GTF rows, 0-based half-open, with a map of attributes; values with or without quotes, of a repeated key the first."""
    rows = spark.read.csv(path, sep="\t", comment="#", quote="", schema="chrom string, source string, feature string, s int, e int, score string, strand string, frame string, attributes string")
    part = lambda i: F.regexp_extract_all("attributes", F.lit(r'([^\s;]+)\s+("[^"]*"|[^;"]+)'), F.lit(i))
    rows = rows.withColumns({"keys": part(1), "said": F.transform(part(2), lambda x: F.regexp_replace(F.trim(x), '^"|"$', ""))})
    once = F.filter(F.transform("keys", lambda k, i: F.struct(k.alias("k"), F.get("said", i).alias("v"), i.alias("i"))), lambda x: F.array_position("keys", x["k"]) == x["i"] + 1)
    entries = F.transform(F.coalesce(once, F.array().cast("array<struct<k:string,v:string,i:int>>")), lambda x: F.struct(x["k"], x["v"]))
    return rows.select("chrom", "source", "feature", (F.col("s") - 1).alias("start"), F.col("e").alias("end"), "score", "strand", "frame", F.map_from_entries(entries).alias("attrs"))


def exons_of(gtf: DataFrame) -> DataFrame:
    """``(ref, gene, transcript, strand, start_, end_)``: the exons that the operators take."""
    return gtf.where("feature = 'exon'").select(F.col("chrom").alias("ref"), F.col("attrs")["gene_id"].alias("gene"), F.col("attrs")["transcript_id"].alias("transcript"), "strand", F.col("start").alias("start_"), F.col("end").alias("end_"))


def scan_whitelist(spark: SparkSession, path: str | None = None, kit: str | None = None, kits: dict[str, str] | None = None) -> DataFrame:
    """The barcodes of a list: that of ``path``, else the one that ``kits`` names for the kit."""
    path = path or (kits or {}).get(kit or "")
    if not path:
        raise ValueError("give a path, or a kit and the paths of the kits' lists")
    return spark.read.text(path).select(F.trim("value").alias("bc")).where("bc <> ''").distinct()


def scan_sam(spark: SparkSession, path: str, sample: str | None = None) -> DataFrame:
    """SAM text: 0-based positions, tags as a map, the barcode tags and edit distance as columns, and the alignment's own ``aln_id``.

    The sample is ``sample``, else the name of the file up to its first dot. ``*`` is null.
    """
    f = F.split("value", "\t")
    tags = F.map_from_entries(F.transform(F.slice(f, F.lit(12), F.greatest(F.size(f) - 11, F.lit(0))), lambda x: F.struct(F.substring(x, 1, 2), x.substr(F.lit(6), F.length(x)))))
    name = F.lit(sample) if sample is not None else F.regexp_extract(F.col("_metadata.file_name"), r"^[^.]*", 0)
    rows = spark.read.text(path).where("value not like '@%' and value <> ''").select(name.alias("sample"), f.alias("f"), tags.alias("tags"))
    at = lambda i: F.nullif(F.col("f")[i], F.lit("*"))
    return with_aln_id(rows.select("sample", F.col("f")[0].alias("qname"), F.col("f")[1].cast("int").alias("flag"), at(2).alias("ref"), (F.col("f")[3].cast("int") - 1).alias("pos"), F.col("f")[4].cast("int").alias("mapq"), at(5).alias("cigar"), at(6).alias("mate_ref"), at(9).alias("seq"), at(10).alias("qual"), F.col("tags")["NM"].cast("int").alias("nm"), *[F.col("tags")[x].alias(x.lower()) for x in ("CR", "CY", "UR", "UY", "CB")], "tags"))


def scan_bc_table(spark: SparkSession, path: str, kind: str, sample: str | None = None) -> DataFrame:
    """A table of ``BC_TABLES``; empty fields are null.

    ``calls`` are a caller's files as they are: seven columns by position, of which read, barcode and least quality are named,
    and no sample, which is ``sample`` here, else the name of the file up to its first dot. A first line of names, with no
    number in the third column, is passed over.
    """
    schema, sep = BC_TABLES[kind]
    rows = spark.read.csv(path, schema=schema, sep=sep, quote="", escape="")
    if kind != "calls":
        return _nulls(rows)
    name = F.lit(sample) if sample is not None else F.regexp_extract(F.col("_metadata.file_name"), r"^[^.]*", 0)
    rows = spark.read.csv(path, schema=schema.replace("min_q int", "min_q string"), sep=sep, quote="", escape="").select(name.alias("sample"), "read_id", "putative_bc", "min_q")
    return _nulls(rows.where("min_q is null or min_q rlike '^-?[0-9]*$'")).withColumn("min_q", F.col("min_q").cast("int"))


def write_table(df: DataFrame, path: str, sep: str = "\t", header: bool = False) -> None:
    df.write.csv(path, sep=sep, header=header, quote="", escape="", emptyValue="")


def split_by_reference(aln: DataFrame, path: str) -> DataFrame:
    """One folder for each sample and reference, and the table read back from them.

    Nothing is shuffled: each task writes its own files, so a reference that holds much of the data is written by many.
    Rows without a reference have their own folder. The schema is given, so names that look like numbers stay strings.
    """
    aln.write.partitionBy("sample", "ref").parquet(path)
    return aln.sparkSession.read.schema(aln.schema).parquet(path).select(*aln.columns)


def numbered_names(counts: DataFrame, side: str) -> DataFrame:
    """``(i, name)`` of the distinct names of a side in their order, from 1: a range sort, and one row for each of its partitions."""
    spark = counts.sparkSession
    path = new_path(spark, f"{side}_names")
    save(counts.select(F.col(side).alias("name")).distinct().repartitionByRange("name").sortWithinPartitions("name").withColumn("k", F.monotonically_increasing_id()), path)
    names = spark.read.schema("name string, k long").parquet(path).select("name", F.expr("shiftright(k, 33)").alias("part"), (F.col("k") % (1 << 33)).alias("row"))
    parts = names.groupBy("part").agg(F.count("*").alias("n"))
    base = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return names.join(F.broadcast(base), "part").select((F.col("base") + F.col("row") + 1).alias("i"), "name")


def write_mex(counts: DataFrame, path: str) -> None:
    """``matrix.mtx`` with its header and line of sizes, ``features.tsv`` and ``barcodes.tsv``, each a folder of text parts in order.

    Indices begin at 1 and are the lines' numbers in the two lists.
    """
    rows, cells = numbered_names(counts, "feature"), numbered_names(counts, "cell")
    for names, file in ((rows, "features.tsv"), (cells, "barcodes.tsv")):
        names.orderBy("i").select("name").write.text(f"{path}/{file}")
    entries = counts.join(rows.toDF("f", "feature"), "feature").join(cells.toDF("c", "cell"), "cell").groupBy("f", "c").agg(F.sum("n").alias("n"))
    head = entries.sparkSession.createDataFrame([(0, 0, f"%%MatrixMarket matrix coordinate real general\n{rows.count()} {cells.count()} {entries.count()}")], "f long, c long, value string")
    body = entries.select("f", "c", F.concat_ws(" ", "f", "c", "n").alias("value"))
    body.unionByName(head).orderBy("f", "c").select("value").write.text(f"{path}/matrix.mtx")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(folder, i, value)``: lines with their numbers, from 1, over the parts of each folder in the order of their names."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value").withColumn("k", F.monotonically_increasing_id())
    held = new_path(spark, "lines")
    save(lines, held)
    folder = F.regexp_replace("file", "/[^/]*$", "").alias("folder")
    lines = spark.read.schema("file string, block long, value string, k long").parquet(held)
    parts = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("k").alias("first"))
    before = Window.partitionBy("folder").orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("*", folder).select("folder", "file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return lines.join(base, ["file", "block"]).select("folder", (F.col("base") + F.col("k") - F.col("first") + 1).alias("i"), "value")


def scan_mex(spark: SparkSession, path: str) -> DataFrame:
    """``(feature, cell, n)``: indices are the lines' numbers in ``features.tsv`` and ``barcodes.tsv``, whose first column names."""
    name = F.split("value", "\t")[0]
    features, cells = (numbered_lines(spark, f"{path}/{x}.tsv").select("i", name.alias(y)) for x, y in (("features", "feature"), ("barcodes", "cell")))
    lines = numbered_lines(spark, f"{path}/matrix.mtx").where("value not like '%\\%%'")
    sizes = lines.agg(F.min("i").alias("i")).first().i  # the first line that is no comment
    f = F.split(F.trim("value"), r"\s+")
    entries = lines.where(F.col("i") != F.lit(sizes)).select(f[0].cast("long").alias("f"), f[1].cast("long").alias("c"), f[2].cast("double").alias("n"))
    return entries.join(features, entries["f"] == features["i"]).drop("i").join(cells, F.col("c") == cells["i"]).select("feature", "cell", "n")


#: Cells whose counts stand side by side in one file.
BLOCK_CELLS = 8192


def write_dense(counts: DataFrame, path: str, block_cells: int = BLOCK_CELLS) -> None:
    """A line for each feature with the counts of the cells, 0.0 where there is none, below a line of the cells' names.

    Cells are in the order of their names. More than ``block_cells`` of them make a folder ``block=0``, ``block=1`` ... each, with
    all features in the same order, so that blocks stand side by side and no row has more than a block's cells; fewer make one
    folder of parts.
    """
    cells = numbered_names(counts, "cell").select(F.expr(f"(i - 1) div {block_cells}").alias("block"), F.expr(f"(i - 1) % {block_cells}").alias("c"), F.col("name").alias("cell"))
    blocks = written(cells.groupBy("block").agg(F.count("*").alias("k"), F.transform(F.array_sort(F.collect_list(F.struct("c", "cell"))), lambda x: x["cell"]).alias("names")), "dense_blocks")
    n = blocks.count()
    entries = counts.join(cells, "cell").groupBy("block", "feature", "c").agg(F.sum("n").alias("n"))
    known = entries.groupBy("block", "feature").agg(F.collect_list(F.struct("c", "n")).alias("xs"))
    rows = counts.select("feature").distinct().withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(n, 1) - 1)).cast("array<bigint>")))
    rows = rows.join(known, ["block", "feature"], "left").join(F.broadcast(blocks.select("block", "k")), "block")  # two integers a block

    def lines(frames):
        for f in frames:
            out = []
            for block, feature, k, xs in zip(f["block"], f["feature"], f["k"], f["xs"], strict=True):
                dense = ["0.0"] * k
                for x in xs if xs is not None else ():
                    dense[x["c"]] = repr(float(x["n"]))
                out.append((block, 1, feature, "\t".join([feature, *dense])))
            yield pd.DataFrame(out, columns=["block", "place", "feature", "value"])

    body = rows.select("block", "feature", "k", "xs").mapInPandas(lines, "block long, place int, feature string, value string")
    head = blocks.select("block", F.lit(0).alias("place"), F.lit("").alias("feature"), F.concat_ws("\t", F.lit("feature"), "names").alias("value"))
    whole = body.unionByName(head)
    if n <= 1:
        whole.orderBy("place", "feature").select("value").write.text(path)
    else:
        order = ["block", "place", "feature"]
        whole.repartitionByRange(*order).sortWithinPartitions(*order).select("block", "value").write.partitionBy("block").text(path)


def scan_dense(spark: SparkSession, path: str) -> DataFrame:
    """``(feature, cell, n)`` of a dense matrix, in one folder or in blocks of cells. A table whose only data column is ``count`` counts as empty."""
    lines = numbered_lines(spark, path)
    head = lines.where("i = 1").select("folder", F.split("value", "\t").alias("names")).where("not (size(names) = 2 and names[1] = 'count')")
    head = head.select("folder", F.posexplode("names").alias("j", "cell")).where("j > 0")
    f = F.split("value", "\t")
    # the feature is named before its counts are exploded; beside them, the line would be split anew for each count
    rows = lines.where("i > 1").select("folder", f[0].alias("feature"), "value").select("folder", "feature", F.posexplode(f).alias("j", "n")).where("j > 0")
    return rows.join(head, ["folder", "j"]).select("feature", "cell", F.col("n").cast("double").alias("n"))
