"""Queries of splicing, directional deduplication and what rests on them, with their SQL.

Alignments here have up to two introns, and most reads have a second alignment: to the next gene on another reference, to a
place without genes, or within a gene's intron. Every tenth gene has a twin on the other strand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import alignments as al
from ..operators import dedup, genes, qc, quant
from ..sources.shared import written
from . import fixtures as fx
from . import registry
from .registry import STRAND, Tables, query
from .registry_files import CLIPPED

MAPPED = "flag & 4 = 0"
CUT = "CASE WHEN substr(m, 13, 1) < '4' THEN concat('10M400N', cast(length(ins) - 10 AS string), 'M') WHEN substr(m, 13, 1) < '8' THEN concat('10M350N', cast(length(ins) - 10 AS string), 'M') WHEN substr(m, 13, 1) < 'a' THEN concat('4M30N6M380N', cast(length(ins) - 10 AS string), 'M') ELSE concat(cast(length(ins) AS string), 'M') END"
SPLICED = f"""first_aln AS (SELECT *, {CUT} AS cut FROM fx WHERE {MAPPED}),
spliced AS (SELECT sample, read_id AS qname, flag, ref, pos, cut AS cigar, tb AS cb FROM first_aln
 UNION ALL SELECT sample, read_id, cast(flag | 256 AS int), CASE WHEN substr(m, 14, 1) < '8' THEN concat('chr', cast((gene_no + 1) % 5 AS string)) ELSE ref END, cast(pos + CASE WHEN substr(m, 14, 1) < '8' THEN 1000 WHEN substr(m, 14, 1) < 'c' THEN 2500 ELSE 100 END AS int), cut, tb FROM first_aln WHERE flag & 256 = 0)"""
#: Three transcripts a gene, from its place on.
PARTS = "SELECT '1' AS k, -20 AS a, 60 AS b UNION ALL SELECT '1', 405, 520 UNION ALL SELECT '1', 600, 700 UNION ALL SELECT '2', -20, 45 UNION ALL SELECT '2', 450, 520 UNION ALL SELECT '2', 640, 700 UNION ALL SELECT '3', -20, 5 UNION ALL SELECT '3', 35, 45 UNION ALL SELECT '3', 440, 700"
EXON3 = f"""{fx.GENES}, spots AS (SELECT ref, g, 'G' AS gene_kind, 'T' AS tx_kind, g % 2 = 0 AS ahead FROM genes UNION ALL SELECT ref, g, 'H', 'U', g % 2 = 1 FROM genes WHERE g % 10 = 3),
exon3 AS (SELECT ref, concat(gene_kind, cast(g AS string)) AS gene, concat(tx_kind, cast(g AS string), '.', k) AS transcript, CASE WHEN ahead THEN '+' ELSE '-' END AS strand, cast(g * 1000 + a AS int) AS start_, cast(g * 1000 + b AS int) AS end_ FROM spots CROSS JOIN ({PARTS}) e)"""
registry.CTE.update({"spliced": SPLICED, "exon3": EXON3})
DELTA = 49

# SQL: operations of a CIGAR with their places, blocks, chains, and the genes that blocks overlap
OPS = """, numbered_aln AS (SELECT *, row_number() OVER (ORDER BY sample, qname, flag, ref, pos, cigar) AS a, {strand} AS strand, list_transform(regexp_extract_all(cigar, '[0-9]+[MN]'), lambda x: cast(left(x, -1) AS int)) AS ns, regexp_extract_all(cigar, '[MN]') AS os FROM {aln} WHERE flag & 4 = 0),
 ops AS (SELECT a, i, os[i] AS op, cast(pos + coalesce(list_sum(ns[1 : i - 1]), 0) AS int) AS s, cast(pos + list_sum(ns[1 : i]) AS int) AS e FROM (SELECT *, unnest(range(1, len(ns) + 1)) AS i FROM numbered_aln)),
 chains AS (SELECT a, coalesce(list({{'s': s, 'e': e}} ORDER BY i) FILTER (op = 'N'), []) AS chain FROM ops GROUP BY a),
 blocks AS (SELECT a, ref, strand, s AS start_, e AS end_ FROM ops JOIN numbered_aln USING (a) WHERE op = 'M')"""
GENES = """, ex AS (SELECT ref, gene, strand, min(start_) AS es, max(end_) AS ee FROM (SELECT *, sum(fresh) OVER (PARTITION BY ref, gene, strand ORDER BY start_, end_ ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT ref, gene, strand, start_, end_, CASE WHEN start_ <= max(end_) OVER (PARTITION BY ref, gene, strand ORDER BY start_, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM {exons})) GROUP BY ref, gene, strand, island), hits AS (SELECT a, gene, sum(least(end_, ee) - greatest(start_, es)) AS n FROM blocks JOIN ex ON blocks.ref = ex.ref AND start_ < ee AND es < end_ {strand} GROUP BY ALL),
 tops AS (SELECT a, min(gene) AS gene, count(*) AS k FROM (SELECT *, max(n) OVER (PARTITION BY a) AS top FROM hits) WHERE n = top GROUP BY a),
 body AS (SELECT a, min(gene) AS body FROM blocks JOIN (SELECT ref, gene, strand, min(es) AS es, max(ee) AS ee FROM ex GROUP BY ALL) ex ON blocks.ref = ex.ref AND start_ < ee AND es < end_ {strand} GROUP BY a),
 assigned AS (SELECT a, sample, qname, cb, coalesce(gene, body) AS gene, CASE WHEN k = 1 THEN 'unique' WHEN k > 1 THEN 'ambiguous' WHEN body IS NOT NULL THEN 'intronic' ELSE 'none' END AS class FROM numbered_aln LEFT JOIN tops USING (a) LEFT JOIN body USING (a))"""
FITS = """, tx AS (SELECT ref, gene, transcript, list_filter(list({{'s': start_, 'e': end_}} ORDER BY start_), lambda x: true) AS b FROM {exons} GROUP BY ALL),
 txs AS (SELECT ref, gene, transcript, list_transform(range(2, len(b) + 1), lambda i: {{'s': b[i - 1].e, 'e': b[i].s}}) AS t FROM tx),
 fits AS (SELECT a, transcript FROM assigned JOIN numbered_aln n USING (a) JOIN chains USING (a) JOIN txs ON txs.ref = n.ref AND txs.gene = assigned.gene WHERE class = 'unique' AND (len(chain) = 0 OR len(list_filter(range(0, len(t) - len(chain) + 1), lambda j: len(list_filter(range(1, len(chain) + 1), lambda i: abs(t[j + i].s - chain[i].s) <= {delta} AND abs(t[j + i].e - chain[i].e) <= {delta})) = len(chain))) > 0))"""


def said(exons: str = "exon3", aln: str = "spliced", strand: str = "", delta: int = DELTA) -> str:
    return OPS.format(aln=aln, strand=STRAND) + GENES.format(exons=exons, strand=strand) + FITS.format(exons=exons, delta=delta)


def blocks(t: Tables) -> DataFrame:
    return al.aligned_blocks(al.with_aln_id(t.spliced))


consistent = lambda t: quant.assign_genes(blocks(t), t.exon3, delta=DELTA)
CLASSES = ", said_genes AS (SELECT a, sample, qname, cb, gene, CASE WHEN class = 'unique' AND a NOT IN (SELECT a FROM fits) THEN 'inconsistent' ELSE class END AS class FROM assigned)"
query("assign_genes_consistent", lambda t: consistent(t).select("sample", "qname", "gene", "class"), said() + CLASSES + " SELECT sample, qname, gene, class FROM said_genes", "spliced exon3")
for library, sign in (("forward", "="), ("reverse", "<>")):
    query(f"assign_genes_{library}", lambda t, x=library: quant.assign_genes(blocks(t), t.exon3, x).select("sample", "qname", "gene", "class"), said(strand=f"AND blocks.strand {sign} ex.strand") + " SELECT sample, qname, gene, class FROM assigned", "spliced exon3")


def transcripts(t: Tables) -> DataFrame:
    b = blocks(t)
    return quant.assign_transcripts(b, quant.assign_genes(b, t.exon3), t.exon3, DELTA)


KINDS = " SELECT sample, qname, transcript, CASE WHEN count(*) OVER (PARTITION BY a) = 1 THEN 'unique' ELSE 'ambiguous' END AS class FROM fits JOIN numbered_aln USING (a)"
query("assign_spliced_transcripts", lambda t: transcripts(t).drop("aln_id"), said() + KINDS, "spliced exon3")
registry.SQL["assign_transcripts"] = ", ".join([fx.FX, registry.CTE["aln"], registry.CTE["exons"]]) + said("exons", "aln", delta=60) + KINDS

# policies of counting: inconsistent reads with the unique ones, and transcripts that share a read
PLACED = ("sample", "cb", "ref", "gene", "class", "chain")
fitted = lambda t: genes.with_transcripts(genes.place_alignments(t.spliced, t.exon3).select(*PLACED), t.exon3, DELTA)  # noqa: E731  a row an alignment, with its cell
query("count_matrix_inconsistent", lambda t: quant.count_matrix(genes.by_splicing(fitted(t)), classes=("unique", "inconsistent")), said() + CLASSES + " SELECT sample, gene AS feature, cb AS cell, cast(count(*) AS double) AS n FROM said_genes WHERE class IN ('unique', 'inconsistent') GROUP BY ALL", "spliced exon3")
shares = lambda t: fitted(t).where("transcripts is not null").select("sample", "cb", "class", (1 / F.size("transcripts")).alias("weight"), F.explode("transcripts").alias("transcript"))
query(
    "count_matrix_shared",
    lambda t: quant.count_matrix(shares(t), None, "transcript", weight="weight").withColumn("n", F.round("n", 6)),
    said() + ", shares AS (SELECT sample, transcript, cb, 1.0 / count(*) OVER (PARTITION BY a) AS w FROM fits JOIN numbered_aln USING (a)) SELECT sample, transcript AS feature, cb AS cell, round(cast(sum(w) AS double), 6) AS n FROM shares GROUP BY ALL",
    "spliced exon3",
)

# directional deduplication: the best-ranked UMI that reaches each
REACH = """, umis AS (SELECT sample, ref, strand, {place} AS place, cr, ur, count(*) AS k, min(struct_pack(q := -mapq, qname := qname)) AS b FROM (SELECT *, {strand} AS strand FROM {aln} WHERE flag & 4 = 0) GROUP BY ALL),
 ided AS (SELECT *, row_number() OVER (ORDER BY k DESC, ur, sample, ref, strand, place, cr) AS rnk FROM umis),
 edges AS (SELECT a.rnk AS src, b.rnk AS dst FROM ided a JOIN ided b ON a.sample = b.sample AND a.ref = b.ref AND a.strand = b.strand AND a.place = b.place AND a.cr = b.cr AND a.k >= 2 * b.k - 1 AND hamming(a.ur, b.ur) = 1),
 reach AS (SELECT rnk AS head, rnk AS node FROM ided UNION SELECT head, dst FROM reach JOIN edges ON src = node),
 best AS (SELECT node, min(head) AS head FROM reach GROUP BY node)
 SELECT h.sample, h.ref, h.strand, h.place AS {place}, h.cr, h.ur, min(o.b).qname AS qname FROM best JOIN ided o ON o.rnk = node JOIN ided h ON h.rnk = head GROUP BY ALL"""


def recursive(name: str, tail: str, uses: str) -> None:
    registry.SQL[name] = ", ".join([fx.FX, *[registry.CTE[x] for x in uses.split()]]).replace("WITH ", "WITH RECURSIVE ", 1) + tail


recursive("umi_dedup_directional", REACH.format(place="pos", strand=STRAND, aln="aln"), "aln")
recursive("umi_dedup_directional_five_prime", CLIPPED + REACH.format(place="five", strand=STRAND, aln="placed"), "aln")
# UMIs of a place whatever their cells: clusters of many sizes
query("umi_dedup_by_sample", lambda t: dedup.umi_dedup_directional(crowded(t)))
CROWDED = ", crowded AS (SELECT sample, qname, flag, ref, cast(pos - pos % 1000 AS int) AS pos, mapq, 'all' AS cr, concat(substr(cr, 1, 3), substr(ur, 1, 2)) AS ur FROM aln)"
crowded = lambda t: t.aln.select("sample", "qname", "flag", "ref", F.expr("pos - pos % 1000").cast("int").alias("pos"), "mapq", F.lit("all").alias("cr"), F.expr("concat(substr(cr, 1, 3), substr(ur, 1, 2))").alias("ur"))
recursive("umi_dedup_by_sample", CROWDED + REACH.format(place="pos", strand=STRAND, aln="crowded"), "aln")

# estimates: four rounds over classes of reads, one step a common table expression
STEP = ", t{j} AS (SELECT sample, cell, transcript, sum(w * n / whole) AS n FROM (SELECT l.*, n, sum(n) OVER (PARTITION BY class) AS whole FROM l JOIN t{i} USING (sample, cell, transcript)) GROUP BY ALL)"
EM = """, r AS (SELECT sample, cb AS cell, a, list(transcript ORDER BY transcript) AS txs FROM fits JOIN numbered_aln USING (a) GROUP BY ALL), c AS (SELECT sample, cell, txs, count(*) AS w, row_number() OVER (ORDER BY sample, cell, txs) AS class FROM r GROUP BY sample, cell, txs),
 l AS (SELECT sample, cell, class, w, len(txs) AS k, unnest(txs) AS transcript FROM c), t0 AS (SELECT sample, cell, transcript, sum(w / k) AS n FROM l GROUP BY ALL)""" + "".join(STEP.format(i=i, j=i + 1) for i in range(4))
ESTIMATED = ", ".join([fx.FX, registry.CTE["aln"], registry.CTE["exons"]]) + said("exons", "aln", delta=60) + EM
registry.SQL["em_quantify"] = ESTIMATED + " SELECT sample, cell, transcript, round(n, 6) AS n FROM t4"
by_cell = lambda t: fitted(t).select("sample", F.col("cb").alias("cell"), "transcripts")
SPLICED_EM = said() + EM
query("em_spliced", lambda t: quant.em_quantify(by_cell(t), 4).withColumn("n", F.round("n", 6)), SPLICED_EM + " SELECT sample, cell, transcript, round(n, 6) AS n FROM t4", "spliced exon3")
query("em_cells", lambda t: quant.em_run(by_cell(t), 4)[1].withColumn("change", F.round("change", 6)), SPLICED_EM + ", moved AS (SELECT sample, cell, count(*) AS transcripts, round(max(abs(t4.n - t3.n)), 6) AS change FROM t4 JOIN t3 USING (sample, cell, transcript) GROUP BY ALL) SELECT sample, cell, reads, transcripts, 4 AS rounds, change, false AS settled FROM moved JOIN (SELECT sample, cell, cast(sum(w) AS bigint) AS reads FROM c GROUP BY ALL) USING (sample, cell)", "spliced exon3")


# summaries of genes and of transcripts, one below the other
def summaries(t: Tables) -> DataFrame:
    placed = genes.with_transcripts(genes.place_alignments(t.aln, t.exons).select(*PLACED), t.exons, 60)
    tx = quant.count_matrix(placed.withColumn("transcript", F.explode("transcripts")), None, "transcript")
    matrices = {"gene": written(quant.count_matrix(placed), "counts"), "transcript": written(tx, "counts")}
    stats = al.flagstat(t.aln)
    return qc.concat_stats(*[qc.cell_summary(qc.cell_qc(m, t.whitelist), m, stats, kind) for kind, m in matrices.items()])


PER = "SELECT sample, '{kind}' AS feature_type, cells, {mean} AS mean_reads_per_cell, median_features, total_features FROM (SELECT sample, count(*) AS cells, quantile_cont(n_feature, 0.5) AS median_features FROM (SELECT w.sample, w.bc, count(n) AS n_feature FROM whitelist w LEFT JOIN {m} c ON w.sample = c.sample AND w.bc = c.cell GROUP BY ALL) GROUP BY 1) JOIN (SELECT sample, count(DISTINCT feature) AS total_features FROM {m} GROUP BY 1) USING (sample) JOIN (SELECT sample, count(*) AS total FROM aln GROUP BY 1) USING (sample)"
MATRICES = ", by_gene AS (SELECT sample, gene AS feature, cb AS cell, count(*) AS n FROM assigned WHERE class = 'unique' GROUP BY ALL), by_tx AS (SELECT sample, transcript AS feature, cb AS cell, count(*) AS n FROM fits JOIN numbered_aln USING (a) GROUP BY ALL) "
query("cell_summary_by_type", summaries, said("exons", "aln", delta=60) + MATRICES + " UNION ALL ".join(PER.format(kind=kind, m=m, mean=registry.HALF_EVEN) for kind, m in (("gene", "by_gene"), ("transcript", "by_tx"))), "whitelist aln exons")

# statistics of UMIs by place, and after deduplication
UMI = f", before AS (SELECT sample, ref, {STRAND} AS strand, pos, cr, ur, count(*) AS count FROM aln WHERE {MAPPED} GROUP BY ALL)"
query("umi_stats_by_position", lambda t: dedup.umi_stats_by_position(t.aln, al.umi_dedup_exact(t.aln)), UMI + ", a AS (SELECT sample, count, count(*) AS places_before FROM before GROUP BY ALL), b AS (SELECT sample, cast(1 AS bigint) AS count, count(*) AS places_after FROM before GROUP BY sample) SELECT sample, count, coalesce(places_before, 0) AS places_before, coalesce(places_after, 0) AS places_after FROM a FULL JOIN b USING (sample, count)", "aln")
AFTER = ", pairs AS (SELECT a.sample, a.ref, a.strand, a.pos, a.cr, avg(hamming(a.ur, b.ur)) AS mean FROM kept a JOIN kept b ON a.sample = b.sample AND a.ref = b.ref AND a.strand = b.strand AND a.pos = b.pos AND a.cr = b.cr AND a.ur < b.ur GROUP BY ALL) SELECT sample, cast(floor(mean + 1e-9) AS bigint) AS distance, count(*) AS places FROM pairs GROUP BY 1, 2"
query("umi_distances_after", lambda t: dedup.umi_distances_after(dedup.umi_dedup_directional(crowded(t))))
recursive("umi_distances_after", CROWDED + REACH.format(place="pos", strand=STRAND, aln="crowded").replace("\n SELECT h.sample", ",\n kept AS (SELECT h.sample") + ")" + AFTER, "aln")
