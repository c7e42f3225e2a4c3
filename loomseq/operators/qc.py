"""Quality control of reads, cells and matrices. Windows run over bins or barcodes, never over raw reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.seq import mean_quality
from ..sources.shared import written
from .joins import spread_join
from .places import digest, frequent_candidates, place_counts


def length_distribution(reads: DataFrame) -> DataFrame:
    return reads.groupBy("sample", F.length("seq").alias("len")).agg(F.count("*").alias("n"))


def n50(reads: DataFrame) -> DataFrame:
    w = Window.partitionBy("sample")
    bases = F.col("len") * F.col("n")
    rows = length_distribution(reads).withColumns({"upto": F.sum(bases).over(w.orderBy(F.desc("len"))), "whole": F.sum(bases).over(w)})
    return rows.where("2 * upto >= whole").groupBy("sample").agg(F.max("len").alias("n50"))


def read_stats(reads: DataFrame, cuts: tuple[int, ...] = (10, 12, 15)) -> DataFrame:
    rows = reads.select("sample", F.length("seq").alias("len"), mean_quality(F.col("qual")).alias("q"))
    over = [F.count_if(F.col("q") > c).alias(f"reads_over_q{c}") for c in cuts]
    main = rows.groupBy("sample").agg(F.count("*").alias("reads"), F.sum("len").alias("bases"), F.round(F.avg("len"), 6).alias("mean_length"), F.round(F.percentile("len", F.lit(0.5)), 6).alias("median_length"), F.round(F.stddev_samp("len"), 4).alias("stdev_length"), *over)
    return main.join(n50(reads), "sample")


def compare_samples(reads: DataFrame, width: int = 10) -> DataFrame:
    """Length histogram of each sample with its share."""
    rows = reads.groupBy("sample", F.expr(f"length(seq) div {width}").alias("bin")).agg(F.count("*").alias("n"))
    return rows.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("sample")), 6))


def compare_log_lengths(reads: DataFrame, per_decade: int = 10) -> DataFrame:
    """``(sample, bin, n, bases, share, base_share)``: reads and bases by the logarithm of their length, with the shares that lay samples of any size over each other."""
    rows = length_distribution(reads).where("len > 0").groupBy("sample", F.floor(F.log10("len") * per_decade + 1e-9).cast("long").alias("bin")).agg(F.sum("n").alias("n"), F.sum(F.col("len") * F.col("n")).alias("bases"))
    w = Window.partitionBy("sample")
    return rows.withColumns({"share": F.round(F.col("n") / F.sum("n").over(w), 6), "base_share": F.round(F.col("bases") / F.sum("bases").over(w), 6)})


def per_read_quality(reads: DataFrame) -> DataFrame:
    return reads.groupBy("sample", F.floor(mean_quality(F.col("qual")) + 1e-9).cast("long").alias("q")).agg(F.count("*").alias("n"))


def per_base_quality(reads: DataFrame) -> DataFrame:
    bins = place_counts(reads, "qual").withColumn("q", F.col("code") - 33)
    return bins.groupBy("sample", "pos").agg(F.round(F.sum(F.col("q") * F.col("n")) / F.sum("n"), 6).alias("mean_q"), F.min("q").alias("min_q"), F.max("q").alias("max_q"))


def per_base_content(reads: DataFrame, bases: str = "ACGTN") -> DataFrame:
    share = lambda b: F.round(F.sum(F.when(F.col("code") == ord(b), F.col("n")).otherwise(0)) / F.sum("n"), 6).alias(f"{b.lower()}_share")
    return place_counts(reads, "seq").groupBy("sample", "pos").agg(*[share(b) for b in bases])


def n_content(reads: DataFrame) -> DataFrame:
    return per_base_content(reads, "N")


def gc_content(reads: DataFrame) -> DataFrame:
    return reads.groupBy("sample", F.expr("100 * length(regexp_replace(seq, '[^GCgc]', '')) div length(seq)").alias("gc")).agg(F.count("*").alias("n"))


def duplication_levels(reads: DataFrame) -> DataFrame:
    """``(sample, level, distinct_seqs)``; sequences are told apart by 256-bit digests, so no whole reads are shuffled."""
    copies = reads.groupBy("sample", digest().alias("d")).agg(F.count("*").alias("level"))
    return copies.groupBy("sample", "level").agg(F.count("*").alias("distinct_seqs"))


def overrepresented(reads: DataFrame, min_share: float = 0.001) -> DataFrame:
    """``(sample, seq, n, pct)``: sequences of ``min_share`` of a sample's reads or more.

    Each task's summary has all digests that may be so frequent; only reads of these candidates, at most some thousands of
    digests, are then counted, whole.
    """
    candidates = written(frequent_candidates(reads, min_share), "candidates")
    total = reads.groupBy("sample").agg(F.count("*").alias("all"))  # one row a sample
    rows = spread_join(reads.select("sample", "seq", digest().alias("d")), candidates, ["sample", "d"], "left_semi")
    seqs = rows.groupBy("sample", "seq").agg(F.count("*").alias("n")).join(F.broadcast(total), "sample")
    return seqs.where(F.col("n") >= min_share * F.col("all")).select("sample", "seq", "n", F.round(100 * F.col("n") / F.col("all"), 6).alias("pct"))


def adapter_content(reads: DataFrame, adapters: dict[str, str]) -> DataFrame:
    """Share of reads that have an adapter up to a place."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("adapter"), F.locate(v, F.col("seq")).alias("at")) for k, v in adapters.items()]))
    hits = reads.select("sample", pairs.alias("x")).groupBy("sample", "x.adapter", F.col("x.at").alias("pos")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("sample", "adapter")
    rows = hits.withColumns({"whole": F.sum("n").over(w), "absent": F.sum(F.when(F.col("pos") == 0, F.col("n")).otherwise(0)).over(w), "upto": F.sum("n").over(w.orderBy("pos"))})
    return rows.where("pos > 0").select("sample", "adapter", "pos", F.round(100 * (F.col("upto") - F.col("absent")) / F.col("whole"), 6).alias("pct"))


def cell_qc(counts: DataFrame, barcodes: DataFrame) -> DataFrame:
    per = counts.groupBy("sample", "cell").agg(F.sum("n").alias("n_count"), F.count_if(F.col("n") > 0).alias("n_feature"))
    return barcodes.select("sample", F.col("bc").alias("cell")).join(per, ["sample", "cell"], "left").na.fill(0)


def cell_summary(qc: DataFrame, features: DataFrame, stats: DataFrame, feature_type: str | None = None) -> DataFrame:
    """Cells, reads a cell to two places (halves to even, in whole numbers), the interpolated median of features, and all features.

    With ``feature_type``, such as ``gene`` or ``transcript``, a column says so, that tables of several may be stacked.
    """
    cells = qc.groupBy("sample").agg(F.count("*").alias("cells"), F.percentile("n_feature", F.lit(0.5)).alias("median_features"))
    per = features.groupBy("sample").agg(F.count_distinct("feature").alias("total_features"))
    rows = cells.join(per, "sample").join(stats.select("sample", "total"), "sample")
    up = "case when 2 * ((100 * total) % cells) > cells or (2 * ((100 * total) % cells) = cells and ((100 * total) div cells) % 2 = 1) then 1 else 0 end"
    kind = [F.lit(feature_type).alias("feature_type")] if feature_type else []
    return rows.select("sample", *kind, "cells", F.expr(f"((100 * total) div cells + {up}) / 100.0D").alias("mean_reads_per_cell"), "median_features", "total_features")


def qc_density(qc: DataFrame) -> DataFrame:
    bin_of = lambda c: F.floor(F.log10(F.col(c) + 1) * 4 + 1e-9).cast("long")
    return qc.groupBy("sample", bin_of("n_count").alias("count_bin"), bin_of("n_feature").alias("feature_bin")).agg(F.count("*").alias("cells"))


def concat_stats(*stats: DataFrame) -> DataFrame:
    out = stats[0]
    for x in stats[1:]:
        out = out.unionByName(x, allowMissingColumns=True)
    return out


def read_funnel(raw: DataFrame, trimmed: DataFrame, extracted: DataFrame, corrected: DataFrame) -> DataFrame:
    out = None
    for name, df in (("base_fastq_counts", raw), ("trimmed_read_counts", trimmed), ("extracted_read_counts", extracted), ("corrected_read_counts", corrected)):
        n = df.groupBy("sample").agg(F.count("*").alias(name))
        out = n if out is None else out.join(n, "sample", "full")
    return out


def idxstats_summary(stats: DataFrame) -> DataFrame:
    """One row a sample: references, those with reads, and the share of mapped reads that the fullest one has."""
    rows = stats.groupBy("sample").agg(F.count("*").alias("refs"), F.count_if(F.col("mapped") > 0).alias("refs_with_reads"), F.max("mapped").alias("most"), F.sum("mapped").alias("all"))
    return rows.select("sample", "refs", "refs_with_reads", F.round(F.try_divide("most", "all"), 6).alias("fullest_ref_share"))


def distribution_summary(distribution: DataFrame, groups: tuple[str, ...] = ("cds_exons", "utr5_exons", "utr3_exons", "introns")) -> DataFrame:
    """One row a sample with the tags of each group of regions; 0 where there are none."""
    return distribution.groupBy("sample").agg(*[F.coalesce(F.sum(F.when(F.col("group") == g, F.col("tag_count"))), F.lit(0).cast("long")).alias(f"{g}_tags") for g in groups])


def qc_report(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for x in tables[1:]:
        out = out.join(x, "sample", "left")
    return out


def yield_over_time(reads: DataFrame, minutes: int = 60) -> DataFrame:
    """``(sample, bin, reads, bases, cum_bases, channels)`` by time since the sample's first read.

    ``start_time=`` and ``ch=`` are read from the descriptions; reads without a time are left out.
    """
    at = F.try_to_timestamp(F.nullif(F.regexp_extract("description", r"start_time=([0-9T:-]+)", 1), F.lit("")), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    rows = reads.select("sample", F.unix_timestamp(at).alias("t"), F.nullif(F.regexp_extract("description", r"\bch=([0-9]+)", 1), F.lit("")).alias("ch"), F.length("seq").alias("len")).where("t is not null")
    first = rows.groupBy("sample").agg(F.min("t").alias("first"))  # one row a sample
    bins = rows.join(F.broadcast(first), "sample").groupBy("sample", F.expr(f"(t - first) div {60 * minutes}").alias("bin")).agg(F.count("*").alias("reads"), F.sum("len").alias("bases"), F.count_distinct("ch").alias("channels"))
    return bins.withColumn("cum_bases", F.sum("bases").over(Window.partitionBy("sample").orderBy("bin")))


def quality_quantiles(reads: DataFrame, shares: tuple[float, ...] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """``(sample, pos, q10, q25, ...)``: at each place the least quality that this share of its bases doesn't exceed, from a histogram."""
    bins = place_counts(reads, "qual").withColumn("q", F.col("code") - 33)
    w = Window.partitionBy("sample", "pos")
    bins = bins.withColumns({"upto": F.sum("n").over(w.orderBy("q")), "whole": F.sum("n").over(w)})
    return bins.groupBy("sample", "pos").agg(*[F.min(F.when(F.col("upto") >= s * F.col("whole"), F.col("q"))).alias(f"q{round(100 * s)}") for s in shares])


def exact_median(values: DataFrame, column: str, width: float = 0.01) -> DataFrame:
    """``(sample, median)``: the middle value, or the mean of the two middle ones, of each sample's values that are not null.

    A histogram of bins tells in which bin or bins the middle is; only the distinct values of these are then ordered.
    """
    rows = values.where(F.col(column).isNotNull()).select("sample", F.col(column).alias("v"), F.floor(F.col(column) / width).alias("bin"))
    w = Window.partitionBy("sample")
    bins = rows.groupBy("sample", "bin").agg(F.count("*").alias("n")).withColumns({"upto": F.sum("n").over(w.orderBy("bin")), "whole": F.sum("n").over(w)})
    bins = bins.withColumns({"before": F.col("upto") - F.col("n"), "low": F.expr("(whole + 1) div 2"), "high": F.expr("(whole + 2) div 2")})
    bins = bins.where("(before < low and low <= upto) or (before < high and high <= upto)").select("sample", "bin", "before", "low", "high")  # two rows a sample at most
    inside = rows.join(F.broadcast(bins), ["sample", "bin"]).groupBy("sample", "bin", "before", "low", "high", "v").agg(F.count("*").alias("n"))
    run = F.col("before") + F.sum("n").over(Window.partitionBy("sample", "bin").orderBy("v"))
    ranked = inside.withColumn("upto", run).withColumn("from", F.col("upto") - F.col("n"))
    at = lambda r: F.max(F.when((F.col("from") < F.col(r)) & (F.col(r) <= F.col("upto")), F.col("v")))
    return ranked.groupBy("sample").agg(((at("low") + at("high")) / 2).alias("median"))


def read_quality_stats(reads: DataFrame, cuts: tuple[int, ...] = (10, 12, 15), top: int = 5) -> DataFrame:
    """Per sample mean and median quality, megabases over the cuts, and the ``top`` longest and best reads as ``length:quality``."""
    rows = written(reads.select("sample", "read_id", F.length("seq").alias("len"), F.round(mean_quality(F.col("qual")), 6).alias("q")), "read_qualities")
    main = rows.groupBy("sample").agg(F.round(F.avg("q"), 4).alias("mean_q"), *[F.round(F.sum(F.when(F.col("q") > c, F.col("len")).otherwise(0)) / 1e6, 6).alias(f"mb_over_q{c}") for c in cuts])
    main = main.join(exact_median(rows, "q").select("sample", F.round("median", 4).alias("median_q")), "sample", "left")
    # partial heaps of a few rows for each task, not a sort of all reads
    for name, order in (("longest", ("len", "q")), ("best", ("q", "len"))):
        rank = F.row_number().over(Window.partitionBy("sample").orderBy(*map(F.desc, order), "read_id"))
        best = rows.withColumn("r", rank).where(F.col("r") <= top).groupBy("sample").agg(F.array_sort(F.collect_list(F.struct("r", F.concat_ws(":", F.col("len").cast("string"), F.round("q", 1).cast("string")).alias("said")))).alias("x"))
        main = main.join(best.select("sample", F.concat_ws(",", F.col("x.said")).alias(name)), "sample")
    return main
