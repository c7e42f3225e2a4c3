"""Introns of alignments and transcripts: which transcripts a read's chain of introns fits, and genes whose splicing it contradicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written
from .joins import spread_join

#: Gaps between ordered blocks ``b`` of one alignment or transcript.
GAPS = "transform(slice(b, 2, size(b)), (x, i) -> struct(b[i].end_ as s, x.start_ as e))"


def own_keys(rows: DataFrame) -> list[str]:
    """What tells alignments apart: ``aln_id`` as well, where there is such a column."""
    return ["sample", "qname", *["aln_id"] * ("aln_id" in rows.columns)]


def introns(blocks: DataFrame) -> DataFrame:
    """``(sample, qname, [aln_id,] ref, chain)``: the gaps between an alignment's blocks on one reference, in order; empty for one block."""
    own = [*own_keys(blocks), "ref"]
    ordered = blocks.groupBy(*own).agg(F.array_sort(F.collect_list(F.struct("start_", "end_"))).alias("b"))
    return ordered.select(*own, F.expr(GAPS).alias("chain"))


def transcript_introns(exons: DataFrame) -> DataFrame:
    """``(ref, gene, transcript, chain)`` of each transcript."""
    ordered = exons.groupBy("ref", "gene", "transcript").agg(F.array_sort(F.collect_set(F.struct("start_", "end_"))).alias("b"))
    return ordered.select("ref", "gene", "transcript", F.expr(GAPS).alias("chain"))


def fitting(chains: DataFrame, exons: DataFrame, delta: int = 6) -> DataFrame:
    """``(ref, gene, chain, transcripts)``: the transcripts of the gene whose introns contain the chain in order, from distinct ``(ref, gene, chain)``.

    Introns meet annotated ones on reference, gene and bin of their start; bins are ``delta`` wide or more, so an annotated
    intron stands in three of them. An intron i of the chain that is the transcript's intron j votes for the offset j - i; the
    chain fits where an offset has the votes of all its introns. A chain without introns fits all transcripts.
    """
    width = max(delta, 1)
    known = transcript_introns(exons)
    index = known.select("ref", "gene", "transcript", F.posexplode("chain").alias("j", "t")).withColumn("bin", F.explode(F.sequence(F.expr(f"floor(t.s / {width})") - 1, F.expr(f"floor(t.s / {width})") + 1)))
    parts = chains.select("ref", "gene", "chain", F.posexplode("chain").alias("i", "c")).withColumn("bin", F.expr(f"floor(c.s / {width})"))
    met = parts.join(index, ["ref", "gene", "bin"]).where(f"abs(c.s - t.s) <= {delta} and abs(c.e - t.e) <= {delta}")
    votes = met.groupBy("ref", "gene", "chain", "transcript", (F.col("j") - F.col("i")).alias("offset")).agg(F.count("*").alias("votes"))
    spliced = votes.where("votes = size(chain)").select("ref", "gene", "chain", "transcript")
    plain = chains.where("size(chain) = 0").join(known.select("ref", "gene", "transcript"), ["ref", "gene"]).select("ref", "gene", "chain", "transcript")
    return spliced.unionByName(plain).groupBy("ref", "gene", "chain").agg(F.array_sort(F.collect_set("transcript")).alias("transcripts"))


def compatible(blocks: DataFrame, genes: DataFrame, exons: DataFrame, delta: int = 6) -> DataFrame:
    """``(sample, qname, [aln_id,] ref, gene, chain, transcripts)`` of alignments whose gene is unique; null where none fits.

    Each distinct chain of a gene is looked up once, however many reads have it; what it fits goes back to the reads by a join
    that spreads frequent chains. Alignments of one name stay apart by ``aln_id``, where blocks and genes have it, and always
    by reference: a gene counts on its own reference only.
    """
    own = own_keys(blocks)
    places = exons.select("ref", "gene").distinct()
    rows = introns(blocks).join(genes.where("class = 'unique'").select(*own, "gene"), own).join(places, ["ref", "gene"], "left_semi")
    rows = written(rows, "chains")
    found = written(fitting(rows.select("ref", "gene", "chain").distinct(), exons, delta), "fitting_chains")
    return spread_join(rows, found, ["ref", "gene", "chain"], "left").select(*own, "ref", "gene", "chain", "transcripts")


def assign_transcripts(blocks: DataFrame, genes: DataFrame, exons: DataFrame, delta: int = 6) -> DataFrame:
    """``(sample, qname, [aln_id,] transcript, class)``: transcripts of an alignment's unique gene whose introns contain its chain in
    order, within ``delta`` bases at either end; ``unique`` where there is one, else ``ambiguous``."""
    rows = compatible(blocks, genes, exons, delta).where("transcripts is not null")
    kind: Column = F.when(F.size("transcripts") == 1, "unique").otherwise("ambiguous")
    return rows.select(*own_keys(blocks), F.explode("transcripts").alias("transcript"), kind.alias("class"))


def with_splicing(genes: DataFrame, blocks: DataFrame, exons: DataFrame, delta: int = 6) -> DataFrame:
    """``genes`` with the class ``inconsistent`` for alignments of a unique gene, none of whose transcripts has their chain of introns."""
    own = own_keys(blocks)
    against = compatible(blocks, genes, exons, delta).where("transcripts is null").select(*own, F.lit(True).alias("against"))
    rows = genes.join(against, own, "left")
    return rows.select(*genes.columns[: genes.columns.index("class")], F.when(F.col("against"), "inconsistent").otherwise(F.col("class")).alias("class"))
