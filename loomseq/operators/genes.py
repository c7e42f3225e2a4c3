"""Genes of alignments, each by its own row: the annotation goes to the tasks as sorted arrays, so no alignment is shuffled."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written
from .alignments import filter_mapped, strand, with_aln_id, with_blocks
from .joins import spread_join
from .splice import GAPS, fitting

#: Pairs of a block and a region that are looked at at once.
PAIRS = 1 << 20
#: Places of one reference; further ones lie behind.
REACH = 1 << 40


class Index:
    """Regions in the order of their starts. Of those that begin before a block's end the ones from the first that anything up to
    it outreaches the block's start may overlap it."""

    def __init__(self, ref: np.ndarray, start: np.ndarray, end: np.ndarray, gene: np.ndarray, sign: np.ndarray) -> None:
        order = np.argsort(ref * REACH + start, kind="stable")
        self.starts, self.ends, self.gene, self.sign = (ref * REACH + start)[order], (ref * REACH + end)[order], gene[order], sign[order]
        self.reach = np.maximum.accumulate(self.ends) if len(order) else self.ends

    def pairs(self, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks and regions that overlap, by their numbers, some at a time."""
        low = np.searchsorted(self.reach, start, "right")
        n = np.maximum(np.searchsorted(self.starts, end, "left") - low, 0)
        upto = np.cumsum(n)
        cuts = np.unique(np.searchsorted(upto, np.arange(0, (upto[-1] if len(upto) else 0) + PAIRS, PAIRS), "left").clip(0, len(n)))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            some = n[a:b]
            block = np.repeat(np.arange(a, b), some)
            region = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some) + low[block]
            met = self.ends[region] > start[block]
            yield block[met], region[met]


def _finder(regions: pa.Table, stranded: str):
    """Gene and class of alignments ``(ref, strand, blocks)`` in Arrow batches, as ``quant.assign_genes`` says them."""
    names = pa.array(sorted(set(regions["gene"].to_pylist()), key=str.encode), pa.string())
    refs, signs = (pa.array(sorted(set(regions[c].to_pylist())), pa.string()) for c in ("ref", "strand"))
    code = lambda xs, known: pc.fill_null(pc.index_in(xs, known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    whole = lambda x: x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    parts = [code(whole(regions["ref"]), refs), *(regions[c].to_numpy().astype(np.int64) for c in ("start_", "end_")), code(whole(regions["gene"]), names), code(whole(regions["strand"]), signs)]
    exon = regions["exon"].to_numpy().astype(bool)
    exons, bodies = Index(*[p[exon] for p in parts]), Index(*[p[~exon] for p in parts])
    genes = max(len(names), 1)

    def sums(index: Index, row, start, end, sign):
        """Rows, genes and bases in common, in the order of rows and genes."""
        keys, bases = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for block, region in index.pairs(start, end):
            if stranded != "none":
                same = (index.sign[region] == sign[block]) == (stranded == "forward")
                block, region = block[same], region[same]
            key, at = np.unique(row[block] * genes + index.gene[region], return_inverse=True)
            shared = np.minimum(end[block], index.ends[region]) - np.maximum(start[block], index.starts[region])
            keys.append(key)
            bases.append(np.bincount(at, shared, len(key)).astype(np.int64))
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        return key // genes, key % genes, np.bincount(at, np.concatenate(bases), len(key)).astype(np.int64)

    def find(ref: pa.Array, sign: pa.Array, blocks: pa.Array) -> pa.Array:
        n = len(ref)
        size = pc.fill_null(pc.list_value_length(blocks), 0).to_numpy(zero_copy_only=False)
        row, values = np.repeat(np.arange(n), size), blocks.flatten()
        of, signed = code(ref, refs)[row], code(sign, signs)[row]
        start, end = (of * REACH + pc.struct_field(values, i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        gene, kind = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        for index, picked in ((exons, of >= 0), (bodies, None)):
            keep = picked if picked is not None else (of >= 0) & (kind[row] == 0)
            at, g, bases = sums(index, *[x[keep] for x in (row, start, end, signed)])
            if not len(at):
                continue
            first = np.flatnonzero(np.diff(at, prepend=-1))
            best = np.maximum.reduceat(bases, first)
            top = bases == np.repeat(best, np.diff(first, append=len(at)))
            if index is bodies:
                gene[at[first]], kind[at[first]] = np.minimum.reduceat(g, first), 3
            else:
                found = best > 0
                gene[at[first][found]] = np.minimum.reduceat(np.where(top, g, genes), first)[found]
                kind[at[first][found]] = np.minimum(np.add.reduceat(top.astype(np.int64), first), 2)[found]
        said = pa.array(["none", "unique", "ambiguous", "intronic"], pa.string()).take(pa.array(kind))
        return pa.StructArray.from_arrays([names.take(pa.array(gene, mask=gene < 0)), said], names=["gene", "class"])

    return find


#: Regions of an annotation that are gathered for the tasks (some tens of bytes each); with more, blocks are joined by shuffles.
MOST_REGIONS = 1_000_000


def place_alignments(aln: DataFrame, exons: DataFrame, stranded: str = "none", most: int = MOST_REGIONS) -> DataFrame:
    """Mapped alignments, one row each, with ``chain``, ``gene`` and ``class`` as ``introns`` and ``assign_genes`` say them by alignment.

    Whatever else a row has, such as its cell, stays with it. Alignments without blocks are left out.
    """
    from . import quant

    if stranded not in ("none", "forward", "reverse"):
        raise ValueError("stranded is none, forward or reverse")
    rows = with_blocks(filter_mapped(aln)).where("size(blocks) > 0")
    rows = rows.withColumn("chain", F.expr(re.sub(r"\bb\b", "blocks", GAPS)))  # a CIGAR's blocks are in order
    regions = written(quant.gene_regions(exons, [] if stranded == "none" else ["strand"]), "regions")
    if regions.limit(most + 1).count() > most:
        rows = with_aln_id(rows.drop("blocks"))
        return rows.join(quant.assign_genes(quant.aligned_blocks(rows), exons, stranded), ["sample", "qname", "aln_id"])
    table = regions if stranded != "none" else regions.withColumn("strand", F.lit("."))
    found = F.arrow_udf(_finder(table.where("gene is not null and ref is not null").select("ref", "strand", "start_", "end_", "gene", "exon").toArrow(), stranded), "gene string, class string")
    return rows.withColumn("found", found("ref", strand(), "blocks")).select(*[c for c in rows.columns if c != "blocks"], "found.gene", "found.class")


def with_transcripts(placed: DataFrame, exons: DataFrame, delta: int = 6) -> DataFrame:
    """``placed`` with ``transcripts``: those of an alignment's unique gene whose introns contain its chain; null where none does.

    Only distinct chains are looked up, so alignments are shuffled only where these are many. ``placed`` is written first, as
    it is read twice; give it without columns that aren't needed.
    """
    placed = written(placed, "placed")
    unique = F.col("class") == "unique"
    found = written(fitting(placed.where(unique).select("ref", "gene", "chain").distinct(), exons, delta), "fitting_chains")
    rows = spread_join(placed, found, ["ref", "gene", "chain"], "left")
    return rows.select(*placed.columns, F.when(unique, F.col("transcripts")).alias("transcripts"))


def by_splicing(placed: DataFrame) -> DataFrame:
    """Rows of ``with_transcripts`` with the class ``inconsistent`` where no transcript of the unique gene has the chain."""
    return placed.withColumn("class", F.when((F.col("class") == "unique") & F.col("transcripts").isNull(), "inconsistent").otherwise(F.col("class")))
