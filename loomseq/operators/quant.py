"""Interval joins, assignment to genes and transcripts, count matrices, annotation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written
from .alignments import aligned_blocks  # noqa: F401
from .splice import assign_transcripts, introns, own_keys, with_splicing  # noqa: F401  part of this module's interface

BIN = 16384


def overlaps(blocks: DataFrame, regions: DataFrame, bin_size: int = BIN) -> DataFrame:
    """Pairs of a block and a region on one reference that overlap: an equi-join on bins, then the exact test.

    A pair that shares several bins comes out once, in the first bin that both touch.
    """
    bins = lambda: F.explode(F.sequence(F.expr(f"start_ div {bin_size}"), F.expr(f"(end_ - 1) div {bin_size}")))
    a = blocks.withColumn("bin", bins())
    b = regions.select(*[F.col(c).alias(f"r_{c}") for c in regions.columns], bins().alias("r_bin"))
    first = F.greatest(F.col("start_"), F.col("r_start_"))
    return a.join(b, (F.col("ref") == F.col("r_ref")) & (F.col("bin") == F.col("r_bin"))).where((F.col("start_") < F.col("r_end_")) & (F.col("r_start_") < F.col("end_")) & (F.col("bin") == F.floor(first / bin_size)))


#: Regions of an annotation (up to some hundred bytes each) that are sent to every executor; more are joined by a shuffle.
MOST_REGIONS = 1_000_000


def merged_exons(exons: DataFrame, keys: list[str]) -> DataFrame:
    """``(*keys, start_, end_)``: the stretches that exons of one gene cover, each base once. A window holds a gene's exons."""
    w = Window.partitionBy(*keys).orderBy("start_", "end_")
    reached = F.max("end_").over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = exons.withColumn("fresh", F.when(F.col("start_") <= reached, 0).otherwise(1)).withColumn("island", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*keys, "island").agg(F.min("start_").alias("start_"), F.max("end_").alias("end_")).drop("island")


def gene_regions(exons: DataFrame, strand: list[str]) -> DataFrame:
    """Merged exons of genes, and whole genes as regions that are no ``exon``."""
    bodies = exons.groupBy("ref", "gene", *strand).agg(F.min("start_").alias("start_"), F.max("end_").alias("end_"))
    return merged_exons(exons, ["ref", "gene", *strand]).withColumn("exon", F.lit(True)).unionByName(bodies.withColumn("exon", F.lit(False)))


def assign_genes(blocks: DataFrame, exons: DataFrame, stranded: str = "none", delta: int | None = None) -> DataFrame:
    """``(sample, qname, [aln_id,] gene, class)``: the gene with most overlapped bases, each counted once however many
    of its transcripts have it; ``ambiguous`` where several have as many.

    Blocks with an ``aln_id`` are assigned by alignment, and the result has it too. ``stranded`` is the library's:
    ``forward`` takes only genes on the alignment's strand, ``reverse`` only those on the other, ``none`` both. With ``delta``
    an alignment whose introns no transcript of its unique gene has, within so many bases, is ``inconsistent``.

    Exons and whole genes are one table of regions, so blocks are expanded and joined once, and everything that an alignment
    overlaps is gathered by one aggregate. A small annotation is broadcast, so that a gene with most reads is no hot key.
    """
    if stranded not in ("none", "forward", "reverse"):
        raise ValueError("stranded is none, forward or reverse")
    own = own_keys(blocks)
    strand = [] if stranded == "none" else ["strand"]
    regions = gene_regions(exons, strand)
    regions = written(regions.select(*[F.col(c).alias(f"r_{c}") for c in regions.columns]), "regions")
    small = regions.count() <= MOST_REGIONS
    bins = lambda p: F.explode(F.sequence(F.expr(f"{p}start_ div {BIN}"), F.expr(f"({p}end_ - 1) div {BIN}")))
    regions = regions.withColumn("r_bin", bins("r_"))
    a, b = blocks.withColumn("bin", bins("")), F.broadcast(regions) if small else regions
    met = (F.col("ref") == F.col("r_ref")) & (F.col("bin") == F.col("r_bin")) & (F.col("start_") < F.col("r_end_")) & (F.col("r_start_") < F.col("end_")) & (F.col("bin") == F.floor(F.greatest("start_", "r_start_") / BIN))
    if strand:
        met = met & ((F.col("strand") == F.col("r_strand")) if stranded == "forward" else (F.col("strand") != F.col("r_strand")))
    shared = F.when(F.col("r_exon"), F.least("end_", "r_end_") - F.greatest("start_", "r_start_")).otherwise(0)
    per = a.join(b, met, "left").groupBy(*own).agg(F.collect_list(F.when(F.col("r_gene").isNotNull(), F.struct(F.col("r_gene").alias("gene"), shared.alias("n")))).alias("hits"))
    bases = lambda g: F.aggregate(F.filter("hits", lambda h: h["gene"] == g), F.lit(0).cast("long"), lambda s, h: s + h["n"])
    sums = F.transform(F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["gene"]))), lambda g: F.struct(bases(g).alias("n"), g.alias("gene")))
    per = per.select(*own, sums.alias("sums")).withColumn("top", F.array_max(F.transform("sums", lambda x: x["n"])))
    # genes are in the order of their names, so the first of those with most bases is the smallest
    per = per.withColumn("tops", F.filter("sums", lambda x: (x["n"] == F.col("top")) & (F.col("top") > 0)))
    kind = F.when(F.size("tops") == 1, "unique").when(F.size("tops") > 1, "ambiguous").when(F.size("sums") > 0, "intronic").otherwise("none")
    genes = per.select(*own, F.coalesce(F.get("tops", F.lit(0))["gene"], F.get("sums", F.lit(0))["gene"]).alias("gene"), kind.alias("class"))
    if delta is None:
        return genes
    return with_splicing(written(genes, "genes"), blocks, exons, delta)


def count_matrix(assigned: DataFrame, cells: DataFrame | None = None, feature: str = "gene", classes: tuple[str, ...] = ("unique",), weight: str | None = None) -> DataFrame:
    """``(sample, feature, cell, n)`` over the classes that count: alignments, or the sum of a column of weights.

    Without ``cells`` the cell is the rows' own ``cb``, and nothing is joined.
    """
    n = F.sum(F.col(weight)) if weight else F.count("*")
    if cells is None:
        return assigned.where(F.col("class").isin(*classes)).groupBy("sample", F.col(feature).alias("feature"), F.col("cb").alias("cell")).agg(n.cast("double").alias("n"))
    keys = [c for c in ("sample", "qname", "aln_id") if c in assigned.columns and c in cells.columns]
    return assigned.where(F.col("class").isin(*classes)).join(cells, keys).groupBy("sample", F.col(feature).alias("feature"), F.col("cb").alias("cell")).agg(n.cast("double").alias("n"))


def shared_weights(assigned: DataFrame) -> DataFrame:
    """``assigned`` with ``weight``: an alignment's several features share its one evenly."""
    own = own_keys(assigned)
    return assigned.withColumn("weight", 1.0 / F.count("*").over(Window.partitionBy(*own)))


def em_quantify(compatible: DataFrame, rounds: int = 10, tol: float | None = None) -> DataFrame:
    """``(sample, cell, transcript, n)``: the estimates of ``em_run``."""
    return em_run(compatible, rounds, tol)[0]


def em_run(compatible: DataFrame, rounds: int = 10, tol: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Expected molecules per (sample, cell, transcript) by expectation maximisation over compatible transcripts, and how each cell's run went.

    The second table is ``(sample, cell, reads, transcripts, rounds, change, settled)``: a cell's rounds, the largest change of an
    estimate in the last, and whether it was ``tol`` or less before ``rounds`` were over. Without ``tol`` all cells make all
    rounds.

    ``compatible`` has a row for each alignment and ``transcript``, or one an alignment with the array ``transcripts``.

    Reads of a cell with the same set of transcripts are one equivalence class with a weight and a number, so the loop runs
    over classes and joins on integers. Each round is written; cells that have settled leave the loop with their classes, so
    rounds that few cells need are rounds over few rows.
    """
    keys = ["sample", "cell"]
    own = [*keys, *[c for c in ("qname", "aln_id") if c in compatible.columns]]
    if "transcripts" in compatible.columns:  # a row an alignment, with all its transcripts
        sets = compatible.where("size(transcripts) > 0").select(*keys, F.array_sort(F.array_distinct("transcripts")).alias("txs"))
    else:
        sets = compatible.groupBy(*own).agg(F.array_sort(F.collect_set("transcript")).alias("txs"))
    weights = written(sets.groupBy(*keys, "txs").agg(F.count("*").alias("w")).withColumn("class", F.monotonically_increasing_id()), "em_weights")
    classes = written(weights.select(*keys, "class", "w", F.size("txs").alias("k"), F.explode("txs").alias("transcript")), "em_classes")
    whole = weights.groupBy(*keys).agg(F.sum("w").alias("reads"))
    theta = written(classes.groupBy(*keys, "transcript").agg(F.sum(F.col("w") / F.col("k")).alias("n")), "em_round")
    done, runs = [], []
    for i in range(1, rounds + 1):
        joined = classes.join(theta, [*keys, "transcript"])
        total = joined.groupBy("class").agg(F.sum("n").alias("all"))
        after = joined.join(total, "class").groupBy(*keys, "transcript").agg(F.sum(F.col("w") * F.col("n") / F.col("all")).alias("n"), F.first("n").alias("was"))
        after = written(after, "em_round")
        last = i == rounds
        if tol is None and not last:
            theta = after.drop("was")
            continue
        cells = after.groupBy(*keys).agg(F.max(F.abs(F.col("n") - F.col("was"))).alias("change"), F.count("*").alias("transcripts"))
        settled = F.col("change") <= tol if tol is not None else F.lit(False)
        cells = written(cells.select("*", F.lit(i).alias("rounds"), settled.alias("settled")), "em_cells")
        leave = cells if last else cells.where("settled")
        runs.append(leave)
        if last or not leave.isEmpty():
            done.append(after.join(leave.select(*keys), keys, "left_semi").drop("was"))
            stay = cells.where("not settled").select(*keys)
            if last or stay.isEmpty():
                break
            theta = written(after.join(stay, keys, "left_semi").drop("was"), "em_round")
            classes = written(classes.join(stay, keys, "left_semi"), "em_classes")
        else:
            theta = after.drop("was")
    estimates, cells = done[0], runs[0]
    for x in done[1:]:
        estimates = estimates.unionByName(x)
    for x in runs[1:]:
        cells = cells.unionByName(x)
    return estimates, cells.join(whole, keys).select(*keys, "reads", "transcripts", "rounds", "change", "settled")


def transpose_matrix(counts: DataFrame) -> DataFrame:
    return counts.select("sample", F.col("cell").alias("feature"), F.col("feature").alias("cell"), "n")


def merge_matrices(*counts: DataFrame) -> DataFrame:
    out = counts[0]
    for x in counts[1:]:
        out = out.unionByName(x)
    return out.groupBy("feature", "cell").agg(F.sum("n").alias("n"))


def gtf_to_genepred(exons: DataFrame) -> DataFrame:
    return exons.groupBy("transcript", "gene", "ref", "strand").agg(F.min("start_").alias("tx_start"), F.max("end_").alias("tx_end"), F.array_sort(F.collect_list(F.struct(F.col("start_").alias("start"), F.col("end_").alias("end")))).alias("exons"))


def genepred_to_bed(pred: DataFrame) -> DataFrame:
    join = lambda e: F.array_join(F.transform("exons", e), ",")
    return pred.select(F.col("ref").alias("chrom"), "tx_start", "tx_end", F.col("transcript").alias("name"), "strand", F.size("exons").cast("long").alias("block_count"), join(lambda x: (x["end"] - x["start"]).cast("string")).alias("block_sizes"), join(lambda x: (x["start"] - F.col("tx_start")).cast("string")).alias("block_starts"))


def refflat(pred: DataFrame) -> DataFrame:
    join = lambda k: F.array_join(F.transform("exons", lambda x: x[k].cast("string")), ",")
    return pred.select("gene", "transcript", F.col("ref").alias("chrom"), "strand", "tx_start", "tx_end", F.size("exons").cast("long").alias("exon_count"), join("start").alias("exon_starts"), join("end").alias("exon_ends"))


def refflat_cds(pred: DataFrame) -> DataFrame:
    """All eleven columns: gene and transcript names, then those of a genePred with its coding part."""
    join = lambda k: F.array_join(F.transform("exons", lambda x: x[k].cast("string")), ",")
    return pred.select("gene", "transcript", F.col("ref").alias("chrom"), "strand", "tx_start", "tx_end", "cds_start", "cds_end", F.size("exons").cast("long").alias("exon_count"), join("start").alias("exon_starts"), join("end").alias("exon_ends"))


def with_cds(pred: DataFrame, cds: DataFrame) -> DataFrame:
    """``pred`` with ``cds_start`` and ``cds_end`` from ``cds (transcript, start_, end_)``; both the end where there is none."""
    span = cds.groupBy("transcript").agg(F.min("start_").alias("cds_start"), F.max("end_").alias("cds_end"))
    return pred.join(span, "transcript", "left").withColumns({"cds_start": F.coalesce("cds_start", "tx_end"), "cds_end": F.coalesce("cds_end", "tx_end")})


def bed12(pred: DataFrame) -> DataFrame:
    """All twelve columns of BED, with the coding part as the thick one."""
    join = lambda e: F.array_join(F.transform("exons", e), ",")
    return pred.select(F.col("ref").alias("chrom"), "tx_start", "tx_end", F.col("transcript").alias("name"), F.lit(0).alias("score"), "strand", F.col("cds_start").alias("thick_start"), F.col("cds_end").alias("thick_end"), F.lit("0").alias("rgb"), F.size("exons").cast("long").alias("block_count"), join(lambda x: (x["end"] - x["start"]).cast("string")).alias("block_sizes"), join(lambda x: (x["start"] - F.col("tx_start")).cast("string")).alias("block_starts"))


#: Classes of regions, the first that covers a place counts, and how far the outer ones reach.
REGIONS = ("cds_exons", "utr5_exons", "utr3_exons", "introns", "tss_up_1kb", "tss_up_5kb", "tss_up_10kb", "tes_down_1kb", "tes_down_5kb", "tes_down_10kb")
REACH = {"1kb": 1000, "5kb": 5000, "10kb": 10000}


def feature_regions(pred: DataFrame) -> DataFrame:
    """``(ref, class, start_, end_)``: disjoint regions of transcripts with exons and coding part.

    Each region adds one at its start and takes one away at its end; running sums over a reference's places then say which
    classes cover a stretch, and neighbouring stretches of one class are joined. Windows run over the places of a
    reference's annotation, never over reads.
    """
    forward = F.col("strand") != "-"
    exon = lambda s, e, name: F.transform("exons", lambda x: F.struct(F.greatest(x["start"], s).alias("s"), F.least(x["end"], e).alias("e"), name.alias("class")))
    low, high = F.when(forward, "utr5_exons").otherwise("utr3_exons"), F.when(forward, "utr3_exons").otherwise("utr5_exons")
    gaps = F.expr("transform(slice(exons, 2, size(exons)), (x, i) -> struct(exons[i].end as s, x.start as e, 'introns' as class))")
    outer = []
    for name, d in REACH.items():
        left, right = (F.when(forward, f"{a}_{name}").otherwise(f"{b}_{name}") for a, b in (("tss_up", "tes_down"), ("tes_down", "tss_up")))
        outer += [F.struct(F.greatest(F.col("tx_start") - d, F.lit(0)).alias("s"), F.col("tx_start").alias("e"), left.alias("class")), F.struct(F.col("tx_end").alias("s"), (F.col("tx_end") + d).alias("e"), right.alias("class"))]
    kinds = [exon(F.col("cds_start"), F.col("cds_end"), F.lit("cds_exons")), exon(F.col("tx_start"), F.col("cds_start"), low), exon(F.col("cds_end"), F.col("tx_end"), high), gaps, F.array(*outer)]
    kinds = [F.transform(x, lambda y: F.struct(y["s"].cast("long").alias("s"), y["e"].cast("long").alias("e"), y["class"].alias("class"))) for x in kinds]
    rows = pred.select("ref", F.explode(F.concat(*kinds)).alias("x")).select("ref", "x.*").where("s < e").distinct()
    ends = rows.select("ref", "class", F.explode(F.array(F.struct(F.col("s").alias("at"), F.lit(1).alias("d")), F.struct(F.col("e").alias("at"), F.lit(-1).alias("d")))).alias("x")).select("ref", "class", "x.*")
    places = ends.groupBy("ref", "at").agg(*[F.sum(F.when(F.col("class") == c, F.col("d")).otherwise(0)).alias(c) for c in REGIONS])
    w = Window.partitionBy("ref").orderBy("at")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    covered = F.coalesce(*[F.when(F.sum(c).over(upto) > 0, c) for c in REGIONS])
    parts = places.select("ref", F.col("at").alias("start_"), F.lead("at").over(w).alias("end_"), covered.alias("class"))
    v = Window.partitionBy("ref").orderBy("start_")
    parts = parts.withColumn("new", (~F.col("class").eqNullSafe(F.lag("class").over(v))).cast("int")).withColumn("island", F.sum("new").over(v.rowsBetween(Window.unboundedPreceding, 0)))
    return parts.where("class is not null and end_ is not null").groupBy("ref", "class", "island").agg(F.min("start_").alias("start_"), F.max("end_").alias("end_")).drop("island")


def read_distribution(blocks: DataFrame, regions: DataFrame, bin_size: int = BIN) -> DataFrame:
    """``(sample, group, total_bases, tag_count, tags_per_kb)``: blocks by the region of their middle.

    A group of 5 or 10 kb holds what the nearer ones of its side hold.
    """
    mids = blocks.select("sample", "ref", F.expr("cast((start_ + end_) div 2 as bigint)").alias("mid")).groupBy("sample", "ref", "mid").agg(F.count("*").alias("n")).withColumn("bin", F.expr(f"mid div {bin_size}"))
    binned = regions.withColumn("bin", F.explode(F.sequence(F.expr(f"start_ div {bin_size}"), F.expr(f"(end_ - 1) div {bin_size}"))))
    tags = mids.join(binned, ["ref", "bin"]).where("start_ <= mid and mid < end_").groupBy("sample", "class").agg(F.sum("n").alias("n"))
    bases = regions.groupBy("class").agg(F.sum(F.col("end_") - F.col("start_")).alias("bases"))
    side = lambda c: F.regexp_replace(c, "_[0-9]+kb$", "")
    reach = lambda c: F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(c, "_([0-9]+)kb$", 1), F.lit("")), F.lit("99")).cast("int"), F.lit(0))
    groups = bases.select("class").withColumns({"side": side(F.col("class")), "reach": reach(F.col("class"))})
    inner = groups.select(F.col("class").alias("group"), "side", F.col("reach").alias("upto")).join(groups, "side").where("reach <= upto").select("group", "class")
    total = inner.join(bases, "class").groupBy("group").agg(F.sum("bases").alias("total_bases"))
    found = inner.join(tags, "class").groupBy("sample", "group").agg(F.sum("n").alias("tag_count"))
    return found.join(total, "group").select("sample", "group", "total_bases", "tag_count", F.round(1000 * F.col("tag_count") / F.col("total_bases"), 6).alias("tags_per_kb"))
