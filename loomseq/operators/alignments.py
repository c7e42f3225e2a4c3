"""Operators over alignments: filters, tags, duplicates, blocks, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.seq import mean_quality

UNMAPPED, REVERSE, SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = 4, 16, 256, 512, 1024, 2048


def has(flag: int):
    return F.col("flag").bitwiseAND(F.lit(flag)) != 0


def filter_mapped(aln: DataFrame) -> DataFrame:
    return aln.where(~has(UNMAPPED))


def filter_duplicates(aln: DataFrame) -> DataFrame:
    return aln.where(~has(DUPLICATE))


def select_alignments(aln: DataFrame, keep_secondary: bool = False) -> DataFrame:
    return aln if keep_secondary else aln.where(~has(SECONDARY))


def select_contigs(aln: DataFrame, contigs: DataFrame) -> DataFrame:
    return filter_mapped(aln).join(contigs.select("ref"), "ref", "left_semi")


#: What tagging adds to a read's name: raw barcode and UMI.
TAGGED_NAME = "_[ACGTN]{16}_[ACGTN]{0,12}$"


def tag_alignments(aln: DataFrame, info: DataFrame, suffix: str = TAGGED_NAME) -> DataFrame:
    """The alignments whose read has a corrected barcode, with its tags: a tag that an alignment has already stays.

    The read's name is the alignment's without the ``suffix`` that tagging adds, whatever other ``_`` it has; it becomes read,
    raw barcode and UMI. Of rows that repeat a read the last by ``ordinal`` counts, where there is such a column, else the
    greatest.
    """
    order = [F.col("ordinal")] if "ordinal" in info.columns else []
    last = info.where("corrected_bc is not null and corrected_bc <> ''").groupBy("sample", "read_id").agg(F.max(F.struct(*order, "bc", "bc_qual", "umi", "umi_qual", "corrected_bc")).alias("i"))
    rows = aln.withColumn("read_id", F.regexp_replace("qname", suffix, "")).join(last, ["sample", "read_id"])
    tags = {"cr": "bc", "cy": "bc_qual", "ur": "umi", "uy": "umi_qual", "cb": "corrected_bc"}
    said = [F.coalesce(F.col(t), F.col(f"i.{c}")).alias(t) if t in aln.columns else F.col(f"i.{c}").alias(t) for t, c in tags.items()]
    return rows.select(*[F.concat_ws("_", "read_id", "i.bc", "i.umi").alias("qname") if c == "qname" else c for c in aln.columns if c not in tags], *said)


def tag_barcodes(aln: DataFrame, info: DataFrame) -> DataFrame:
    """Barcode tags from corrected barcodes; the name gets raw barcode and UMI. The greatest row of a key wins; see ``tag_alignments``."""
    info = info.where("corrected_bc is not null and corrected_bc <> ''").groupBy("sample", "read_id").agg(F.max(F.struct("bc", "bc_qual", "umi", "umi_qual", "corrected_bc")).alias("i"))
    rows = aln.withColumnRenamed("qname", "read_id").join(info, ["sample", "read_id"])
    return rows.select("sample", F.concat_ws("_", "read_id", "i.bc", "i.umi").alias("qname"), "flag", "ref", "pos", F.col("i.bc").alias("cr"), F.col("i.bc_qual").alias("cy"), F.col("i.umi").alias("ur"), F.col("i.umi_qual").alias("uy"), F.col("i.corrected_bc").alias("cb"))


def sort_coordinate(aln: DataFrame) -> DataFrame:
    return aln.repartitionByRange("ref", "pos").sortWithinPartitions("ref", "pos", "qname")


def sort_by_cell(aln: DataFrame) -> DataFrame:
    return aln.repartitionByRange("cb", "ref", "pos").sortWithinPartitions("cb", "ref", "pos", "qname")


def merge_alignments(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return sort_coordinate(out)


def group_transcripts(transcripts: DataFrame, annotation: DataFrame) -> DataFrame:
    """Chromosome of each transcript: the smallest that the annotation has, else ``chr_Unknown``."""
    chrom = annotation.groupBy("transcript").agg(F.min("ref").alias("chrom"))
    return transcripts.join(chrom, "transcript", "left").select("transcript", F.coalesce("chrom", F.lit("chr_Unknown")).alias("chrom"))


def strand(): return F.when(has(REVERSE), "-").otherwise("+")  # noqa: E704


def five_prime() -> Column:
    """Where the molecule begins on the reference: the start before clipping, of reverse alignments the end after it."""
    length = F.aggregate(F.expr("regexp_extract_all(cigar, '([0-9]+)[MDN=X]', 1)"), F.lit(0), lambda n, x: n + x.cast("int"))
    clipped = lambda pattern: F.coalesce(F.try_to_number(F.nullif(F.regexp_extract("cigar", pattern, 1), F.lit("")), F.lit("999999999")).cast("int"), F.lit(0))
    return F.when(has(REVERSE), F.col("pos") + length + clipped("([0-9]+)S(?:[0-9]+H)?$")).otherwise(F.col("pos") - clipped("^(?:[0-9]+H)?([0-9]+)S"))


def umi_dedup_exact(aln: DataFrame, cell: str = "cr", place: str = "pos") -> DataFrame:
    """The best read of each (sample, reference, strand, place, cell, UMI): highest mapping quality, then name."""
    rows = filter_mapped(aln)
    best = rows.groupBy("sample", "ref", strand().alias("strand"), place, cell, "ur").agg(F.min(F.struct(-F.col("mapq"), "qname")).alias("b"))
    return best.select("sample", "ref", "strand", place, cell, "ur", F.col("b.qname").alias("qname"))


def umi_stats(aln: DataFrame, cell: str = "cr") -> DataFrame:
    """Reads and positions of each UMI, before and after exact deduplication."""
    before = filter_mapped(aln).groupBy("sample", "ur").agg(F.count("*").alias("reads_before"), F.count_distinct("ref", "pos").alias("positions"))
    after = umi_dedup_exact(aln, cell).groupBy("sample", "ur").agg(F.count("*").alias("reads_after"))
    return before.join(after, ["sample", "ur"], "left").na.fill(0)


def mark_duplicates(aln: DataFrame, cell: str = "cb", place: str = "pos") -> DataFrame:
    """Per (sample, reference, place, strand, cell) the read of most quality stays; others get the duplicate flag.

    The survivor and the size come from an aggregate that is joined back, so a hot set needs no window in one task.
    """
    total = F.aggregate(F.filter(F.split("qual", ""), lambda c: c != ""), F.lit(0), lambda s, c: s + F.ascii(c) - 33)
    keys = ["sample", "ref", place, "strand", cell]
    rows = filter_mapped(aln).withColumns({"strand": strand(), "total": total})
    sets = rows.groupBy(*keys).agg(F.min(F.struct(-F.col("total"), "qname")).alias("b"), F.count("*").alias("dup_set_size"), F.min("qname").alias("dup_set_id"))
    out = rows.join(sets, keys).withColumn("is_dup", F.col("qname") != F.col("b.qname"))
    return out.select("sample", "qname", "ref", "pos", F.when(F.col("is_dup"), F.col("flag").bitwiseOR(F.lit(DUPLICATE))).otherwise(F.col("flag")).alias("flag"), "is_dup", "dup_set_size", "dup_set_id")


def duplicate_metrics(marked: DataFrame) -> DataFrame:
    return marked.groupBy("sample").agg(F.count("*").alias("examined"), F.count_if("is_dup").alias("duplicates"), F.round(F.count_if("is_dup") / F.count("*"), 6).alias("share"))


def with_aln_id(aln: DataFrame) -> DataFrame:
    """``aln_id`` tells the alignments of one read name apart; one that is there stays."""
    return aln if "aln_id" in aln.columns else aln.withColumn("aln_id", F.xxhash64("sample", "qname", "flag", "ref", "pos", "cigar"))


OPS = "transform(regexp_extract_all(cigar, '([0-9]+)([MIDNSHP=X])', 0), x -> struct(cast(regexp_extract(x, '^[0-9]+', 0) as int) as n, right(x, 1) as op))"


#: The blocks of a row's operations.
BLOCKS = """aggregate(ops, struct(pos as at, pos as first, cast(array() as array<struct<s:int,e:int>>) as done),
  (a, x) -> case when x.op in ('M', '=', 'X', 'D') then struct(a.at + x.n as at, a.first as first, a.done as done)
                 when x.op = 'N' then struct(a.at + x.n as at, a.at + x.n as first, concat(a.done, array(struct(a.first as s, a.at as e))) as done) else a end,
  a -> concat(a.done, array(struct(a.first as s, a.at as e))))"""


def with_blocks(aln: DataFrame) -> DataFrame:
    """``aln`` with ``blocks``, the array of each row's reference blocks ``(start_, end_)`` that are not empty."""
    return aln.withColumn("ops", F.expr(OPS)).withColumn("blocks", F.expr(f"transform(filter({BLOCKS}, b -> b.e > b.s), b -> struct(b.s as start_, b.e as end_))")).drop("ops")


def aligned_blocks(aln: DataFrame) -> DataFrame:
    """Reference blocks of each alignment, with its ``aln_id``, split at skipped regions. Only M, =, X, D and N move along the reference."""
    own = ["sample", "qname", "aln_id"]
    rows = with_aln_id(filter_mapped(aln)).withColumn("ops", F.expr(OPS)).withColumn("blocks", F.expr(BLOCKS))
    return rows.select(*own, "ref", strand().alias("strand"), F.posexplode("blocks").alias("blk", "b")).select(*own, "ref", "strand", "blk", F.col("b.s").alias("start_"), F.col("b.e").alias("end_")).where("end_ > start_")


def alignment_lengths(aln: DataFrame) -> DataFrame:
    """``(sample, qname, aln_id, aligned, inserted, deleted, skipped, soft_clipped, hard_clipped)`` of mapped alignments: bases by what the CIGAR does with them."""
    kinds = {"aligned": "M=X", "inserted": "I", "deleted": "D", "skipped": "N", "soft_clipped": "S", "hard_clipped": "H"}
    sums = [F.expr(f"aggregate(filter(ops, x -> instr('{ops}', x.op) > 0), 0, (s, x) -> s + x.n)").alias(name) for name, ops in kinds.items()]
    return with_aln_id(filter_mapped(aln)).withColumn("ops", F.coalesce(F.expr(OPS), F.expr("array()").cast("array<struct<n:int,op:string>>"))).select("sample", "qname", "aln_id", *sums)


def flagstat(aln: DataFrame) -> DataFrame:
    n = lambda c: F.count_if(c)
    return aln.groupBy("sample").agg(F.count("*").alias("total"), n(~has(SECONDARY) & ~has(SUPPLEMENTARY)).alias("primary_n"), n(has(SECONDARY)).alias("secondary"), n(has(SUPPLEMENTARY)).alias("supplementary"), n(has(DUPLICATE)).alias("duplicates"), n(~has(UNMAPPED)).alias("mapped"), n(has(1)).alias("paired"), n(has(QC_FAIL)).alias("qc_failed"))


def idxstats(aln: DataFrame, contigs: DataFrame) -> DataFrame:
    per = aln.groupBy("sample", "ref").agg(F.count_if(~has(UNMAPPED)).alias("mapped"), F.count_if(has(UNMAPPED)).alias("unmapped"))
    return contigs.join(per, ["sample", "ref"], "left").na.fill(0, ["mapped", "unmapped"])


def alignment_stats(aln: DataFrame) -> DataFrame:
    rows = aln.withColumns({"len": F.length("seq"), "up": ~has(UNMAPPED)})
    bases = F.sum(F.when(F.col("up"), F.col("len")).otherwise(0))
    nm = F.sum(F.when(F.col("up"), F.col("nm")).otherwise(0))
    return rows.groupBy("sample").agg(F.count("*").alias("reads"), F.sum("len").alias("bases"), bases.alias("bases_mapped"), nm.alias("mismatches"), F.round(nm / bases, 6).alias("error_rate"), F.max("len").alias("max_length"))


def percent_identity(blocks: DataFrame, aln: DataFrame) -> DataFrame:
    """``(sample, qname, aln_id, identity)`` of each alignment: 100 less the share of its blocks' bases that differ."""
    keys = ["sample", "qname", "aln_id"]
    size = blocks.groupBy(*keys).agg(F.sum(F.col("end_") - F.col("start_")).alias("aligned"))
    return size.join(with_aln_id(aln).select(*keys, "nm"), keys).select(*keys, F.round(100 * (1 - F.col("nm") / F.col("aligned")), 6).alias("identity"))


def identity_distribution(identity: DataFrame) -> DataFrame:
    """``(sample, percent, n)``: alignments by whole percent of identity."""
    return identity.groupBy("sample", F.floor("identity").cast("int").alias("percent")).agg(F.count("*").alias("n"))


def flagstat_by_quality(aln: DataFrame) -> DataFrame:
    """``flagstat`` apart for alignments that pass and fail quality checks, with what pairs add to it."""
    n = lambda c: F.count_if(c)
    paired, mapped, mate = has(1) & ~has(SECONDARY) & ~has(SUPPLEMENTARY), ~has(UNMAPPED), ~has(8)
    return aln.groupBy("sample", F.when(has(QC_FAIL), "failed").otherwise("passed").alias("qc")).agg(
        F.count("*").alias("total"), n(~has(SECONDARY) & ~has(SUPPLEMENTARY)).alias("primary_n"), n(mapped).alias("mapped"), n(mapped & ~has(SECONDARY) & ~has(SUPPLEMENTARY)).alias("primary_mapped"), n(has(DUPLICATE)).alias("duplicates"),
        n(paired).alias("paired"), n(paired & has(64)).alias("read1"), n(paired & has(128)).alias("read2"), n(paired & has(2) & mapped).alias("proper"), n(paired & mapped & mate).alias("both_mapped"), n(paired & mapped & ~mate).alias("singletons"),
    )


def idxstats_shares(stats: DataFrame) -> DataFrame:
    """``idxstats`` with each contig's share of the mapped reads, and that over its share of the bases; null where nothing is mapped."""
    whole = stats.groupBy("sample").agg(F.sum("mapped").alias("all_mapped"), F.sum("length").alias("all_length"))  # one row a sample
    share = F.try_divide(F.col("mapped"), F.col("all_mapped"))
    return stats.join(F.broadcast(whole), "sample").select("sample", "ref", "length", "mapped", "unmapped", F.round(share, 6).alias("share"), F.round(F.try_divide(share, F.try_divide(F.col("length"), F.col("all_length"))), 6).alias("observed_expected"))


def alignment_histograms(aln: DataFrame) -> DataFrame:
    """``(sample, kind, value, n)``: mapping qualities of mapped alignments, and lengths and rounded mean qualities of reads."""
    kinds = F.array(
        F.struct(F.lit("mapq").alias("kind"), F.when(~has(UNMAPPED), F.col("mapq").cast("long")).alias("value")),
        F.struct(F.lit("length").alias("kind"), F.length("seq").cast("long").alias("value")),
        F.struct(F.lit("quality").alias("kind"), F.floor(mean_quality(F.col("qual")) + 1e-9).cast("long").alias("value")),
    )
    return aln.select("sample", F.explode(kinds).alias("x")).where("x.value is not null").groupBy("sample", "x.kind", "x.value").agg(F.count("*").alias("n"))


def flagstat_mates(aln: DataFrame) -> DataFrame:
    """``(sample, mate_elsewhere, mate_elsewhere_q5)``: primary pairs, both mapped, whose mate is on another reference, and those of
    a mapping quality of 5 or more. ``mate_ref`` is ``=`` for the alignment's own reference."""
    away = has(1) & ~has(SECONDARY) & ~has(SUPPLEMENTARY) & ~has(UNMAPPED) & ~has(8) & (F.col("mate_ref") != "=") & (F.col("mate_ref") != F.col("ref"))
    return aln.groupBy("sample").agg(F.count_if(away).alias("mate_elsewhere"), F.count_if(away & (F.col("mapq") >= 5)).alias("mate_elsewhere_q5"))


def alignment_averages(aln: DataFrame) -> DataFrame:
    """``(sample, average_length, average_quality)``: bases for each read, and the mean Phred value of all bases with a quality."""
    total = F.aggregate(F.transform(F.split("qual", ""), lambda c: F.when(c == "", 0).otherwise(F.ascii(c) - 33)), F.lit(0).cast("long"), lambda s, x: s + x)
    return aln.groupBy("sample").agg(F.round(F.sum(F.length("seq")) / F.count("*"), 6).alias("average_length"), F.round(F.sum(total) / F.sum(F.length("qual")), 6).alias("average_quality"))
