"""Registered queries over the derived tables, each with the DuckDB SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.seq import ADAPTER, COMPLEMENT, IUPAC, kit_column, reverse_complement
from ..operators import alignments as al
from ..operators import barcodes as bc
from ..operators import dedup, qc, quant
from ..operators.genes import place_alignments
from ..operators import reads as rd
from ..sources.shared import written
from . import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

CTE = {"reads": fx.READS, "putative": fx.PUTATIVE, "bc_info": fx.BC_INFO, "whitelist": fx.WHITELIST, "bc_counts": fx.COUNTS, "aln": fx.ALN, "exons": f"{fx.GENES}, {fx.EXONS}"}
ORDER = list(CTE)


class Tables:
    """The derived tables of one folder, by name; what they share is derived once for each folder and session, and written."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        fixture = fx.written(self.spark, self.sf_dir)
        return fixture if name == "fx" else self.spark.sql(f"WITH {CTE[name]} SELECT * FROM {name}".replace("FROM fx", "FROM {fx}"), fx=fixture)


def query(name: str, run: Callable[[Tables], DataFrame], sql: str | None = None, uses: str = "") -> None:
    QUERIES[name] = lambda spark, sf_dir: run(Tables(spark, sf_dir))
    if sql:
        SQL[name] = ", ".join([fx.FX, *[CTE[x] for x in uses.split()]]) + ("" if sql.lstrip().startswith(",") else " ") + sql


MEANQ = "-10 * log10((SELECT sum(pow(10, -(ascii(substr(qual, cast(i AS int), 1)) - 33) / 10.0)) FROM range(1, length(qual) + 1) t(i)) / length(qual))"
REV = f"translate(reverse(seq), '{IUPAC}', '{COMPLEMENT}')"
MAPPED = "flag & 4 = 0"
STRAND = "CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END"
LOCATED = f""", pairs AS (SELECT r.*, putative_bc, {REV} AS turned FROM reads r JOIN putative USING (sample, read_id)),
located AS (SELECT sample, read_id, putative_bc, CASE WHEN strpos(seq, putative_bc) = 0 AND strpos(turned, putative_bc) > 0 THEN turned ELSE seq END AS seq,
 CASE WHEN strpos(seq, putative_bc) = 0 AND strpos(turned, putative_bc) > 0 THEN reverse(qual) ELSE qual END AS qual,
 CASE WHEN strpos(seq, putative_bc) > 0 THEN strpos(seq, putative_bc) - 1 WHEN strpos(turned, putative_bc) > 0 THEN strpos(turned, putative_bc) - 1 ELSE -1 END AS idx FROM pairs)"""
located = lambda t: rd.locate_barcode(rd.pair_reads_barcodes(t.reads, t.putative))

# reads
query("filter_reads", lambda t: rd.filter_reads(t.reads, 90, 5.0).select("sample", "read_id"), f"SELECT sample, read_id FROM reads WHERE length(seq) >= 90 AND {MEANQ} >= 5.0", "reads")
query("phred_probability", lambda t: rd.phred_probability(t.reads).withColumn("p", F.round("p", 9)), "SELECT sample, read_id, round(pow(10, -(ascii(substr(qual, 1, 1)) - 33) / 10.0), 9) AS p FROM reads", "reads")
query("base_probabilities", lambda t: rd.base_probabilities(t.reads).withColumn("p", F.round("p", 9)), "SELECT sample, read_id, cast(i - 1 AS int) AS pos, round(pow(10, -(ascii(substr(qual, cast(i AS int), 1)) - 33) / 10.0), 9) AS p FROM reads, range(1, 200) t(i) WHERE i <= length(qual)", "reads")
query("reverse_complement", lambda t: t.reads.select("read_id", reverse_complement(F.col("seq")).alias("rc")), f"SELECT read_id, {REV} AS rc FROM reads", "reads")
query("pair_reads_barcodes", lambda t: rd.pair_reads_barcodes(t.reads, t.putative), "SELECT sample, read_id, seq, qual, putative_bc FROM reads JOIN putative USING (sample, read_id)", "reads putative")
query("locate_barcode", lambda t: located(t).select("sample", "read_id", "idx", "seq", "qual"), LOCATED + " SELECT sample, read_id, cast(idx AS int) AS idx, seq, qual FROM located", "reads putative")
query("drop_unassigned", lambda t: rd.drop_unassigned(located(t)).select("sample", "read_id"), LOCATED + " SELECT sample, read_id FROM located WHERE putative_bc IS NOT NULL AND idx >= 0", "reads putative")
query("extract_read", lambda t: rd.extract_read(located(t)), LOCATED + " SELECT sample, read_id, substr(seq, idx + 1, 16) AS bc, substr(qual, idx + 1, 16) AS bc_qual, substr(seq, idx + 17, 12) AS umi, substr(qual, idx + 17, 12) AS umi_qual, substr(seq, idx + 39) AS insert_seq, substr(qual, idx + 39) AS insert_qual FROM located WHERE putative_bc IS NOT NULL AND idx >= 0", "reads putative")
query("kit_geometry", lambda t: t.fx.select("read_id", F.when(F.col("sample") == "S0", "10X_3v3").otherwise("10X_5v2").alias("kit")).select("read_id", *[kit_column(F.col("kit"), i).alias(c) for i, c in enumerate(("bc_len", "umi_len", "poly_t"))]), "SELECT read_id, 16 AS bc_len, CASE WHEN sample = 'S0' THEN 12 ELSE 10 END AS umi_len, 10 AS poly_t FROM fx")
query("chunk_reads", lambda t: rd.chunk_reads(t.fx.select("sample", "read_id", F.expr("cast(substring_index(read_id, '-', 1) as bigint)").alias("ordinal")), 500), "SELECT sample, read_id, cast(split_part(read_id, '-', 1) AS bigint) AS ordinal, cast(split_part(read_id, '-', 1) AS bigint) // 500 AS chunk FROM fx")
query("putative_barcodes", lambda t: rd.putative_barcodes(t.reads), f"""SELECT sample, read_id, regexp_extract(o, '{ADAPTER}(.{{16}})', 1) AS putative_bc, cast((SELECT min(ascii(substr(q, cast(strpos(o, '{ADAPTER}') + 21 + i AS int), 1)) - 33) FROM range(1, 17) t(i)) AS int) AS min_q FROM (SELECT sample, read_id, CASE WHEN strpos(seq, '{ADAPTER}') > 0 THEN seq ELSE {REV} END AS o, CASE WHEN strpos(seq, '{ADAPTER}') > 0 THEN qual ELSE reverse(qual) END AS q FROM reads)""", "reads")

# barcodes
query("barcode_counts", lambda t: bc.barcode_counts(t.putative), "SELECT sample, coalesce(putative_bc, '') AS bc, count(*) AS n FROM putative GROUP BY 1, 2", "putative")
query("knee_ranks", lambda t: bc.knee_ranks(t.bc_counts), "SELECT sample, bc, n, cast(row_number() OVER (PARTITION BY sample ORDER BY n DESC, bc) AS int) AS rnk, round(sum(n) OVER (PARTITION BY sample ORDER BY n DESC, bc ROWS UNBOUNDED PRECEDING) / sum(n) OVER (PARTITION BY sample), 6) AS share FROM bc_counts", "bc_counts")
query("call_whitelist", lambda t: bc.call_whitelist(t.bc_counts, t.whitelist, 30), ", known AS (SELECT c.* FROM bc_counts c SEMI JOIN whitelist USING (sample, bc)), top AS (SELECT sample, quantile_cont(n, 0.95) / 20.0 AS least FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY n DESC, bc) AS r FROM known) WHERE r <= 30 GROUP BY sample) SELECT sample, bc, n FROM known JOIN top USING (sample) WHERE n >= least", "whitelist bc_counts")
HAM = ", q AS (SELECT DISTINCT sample, bc FROM bc_info), near AS (SELECT q.sample, q.bc, w.bc AS cand, hamming(q.bc, w.bc) AS dist FROM q JOIN whitelist w ON q.sample = w.sample AND hamming(q.bc, w.bc) BETWEEN 1 AND 2)"
query("hamming_neighbours", lambda t: bc.hamming_neighbours(t.bc_info, t.whitelist), HAM + " SELECT sample, bc, cand, cast(dist AS int) AS dist FROM near", "bc_info whitelist")
PRIOR = HAM + ", prior AS (SELECT near.*, coalesce(c.n + 1, 0) AS prior FROM near LEFT JOIN bc_counts c ON c.sample = near.sample AND c.bc = near.cand)"
query("barcode_prior", lambda t: bc.barcode_prior(bc.hamming_neighbours(t.bc_info, t.whitelist), t.bc_counts), PRIOR + " SELECT sample, bc, cand, cast(dist AS int) AS dist, prior FROM prior", "bc_info whitelist bc_counts")
LIKE = PRIOR + ", scored AS (SELECT b.sample, b.read_id, b.bc, cand, prior * pow(10, -(SELECT sum(CASE WHEN substr(b.bc, cast(i AS int), 1) <> substr(cand, cast(i AS int), 1) THEN ascii(substr(bc_qual, cast(i AS int), 1)) - 33 ELSE 0 END) FROM range(1, 17) t(i)) / 10.0) AS p FROM bc_info b JOIN prior USING (sample, bc) WHERE prior > 0)"
query("barcode_likelihood", lambda t: bc.barcode_likelihood(t.bc_info, bc.barcode_prior(bc.hamming_neighbours(t.bc_info, t.whitelist), t.bc_counts)).select("sample", "read_id", "cand", F.round("p", 6).alias("p")), LIKE + " SELECT sample, read_id, cand, round(p, 6) AS p FROM scored", "bc_info whitelist bc_counts")
CORR = LIKE + ", corrected AS (SELECT sample, read_id, bc AS corrected_bc FROM bc_info SEMI JOIN whitelist USING (sample, bc) UNION ALL SELECT sample, read_id, cand FROM (SELECT *, sum(p) OVER (PARTITION BY sample, read_id) AS a FROM scored WHERE (sample, bc) NOT IN (SELECT (sample, bc) FROM whitelist)) WHERE p / a > 0.975)"
corrected = lambda t: bc.correct_barcodes(t.bc_info, t.whitelist, t.bc_counts)
query("correct_barcodes", lambda t: corrected(t).select("sample", "read_id", "corrected_bc"), CORR + " SELECT * FROM corrected", "bc_info whitelist bc_counts")
query("read_funnel", lambda t: qc.read_funnel(t.reads, rd.filter_reads(t.reads, 90, 5.0), rd.drop_unassigned(located(t)), corrected(t)), CORR + LOCATED + f" SELECT * FROM (SELECT sample, count(*) AS base_fastq_counts FROM reads GROUP BY 1) FULL JOIN (SELECT sample, count(*) AS trimmed_read_counts FROM reads WHERE length(seq) >= 90 AND {MEANQ} >= 5.0 GROUP BY 1) USING (sample) FULL JOIN (SELECT sample, count(*) AS extracted_read_counts FROM located WHERE putative_bc IS NOT NULL AND idx >= 0 GROUP BY 1) USING (sample) FULL JOIN (SELECT sample, count(*) AS corrected_read_counts FROM corrected GROUP BY 1) USING (sample)", "reads putative bc_info whitelist bc_counts")

# alignments
query("filter_mapped", lambda t: al.filter_mapped(t.aln).select("sample", "qname", "flag"), f"SELECT sample, qname, flag FROM aln WHERE {MAPPED}", "aln")
query("select_alignments", lambda t: al.select_alignments(t.aln).select("sample", "qname", "flag"), "SELECT sample, qname, flag FROM aln WHERE flag & 256 = 0", "aln")
query("select_contigs", lambda t: al.select_contigs(t.aln, t.exons.where("gene in ('G1', 'G7')").select("ref").distinct()).select("qname", "ref"), f"SELECT qname, ref FROM aln WHERE {MAPPED} AND ref IN (SELECT ref FROM exons WHERE gene IN ('G1', 'G7'))", "aln exons")
query("tag_barcodes", lambda t: al.tag_barcodes(t.aln, corrected(t)), CORR + " SELECT a.sample, concat_ws('_', a.qname, b.bc, b.umi) AS qname, flag, ref, pos, b.bc AS cr, bc_qual AS cy, umi AS ur, umi_qual AS uy, corrected_bc AS cb FROM aln a JOIN corrected c ON a.sample = c.sample AND a.qname = c.read_id JOIN bc_info b ON b.sample = c.sample AND b.read_id = c.read_id", "bc_info whitelist bc_counts aln")
query("sort_coordinate", lambda t: al.sort_coordinate(t.aln).select("qname", "ref", "pos"), "SELECT qname, ref, pos FROM aln ORDER BY ref, pos, qname", "aln")
query("sort_by_cell", lambda t: al.sort_by_cell(t.aln).select("qname", "cb", "ref", "pos"), "SELECT qname, cb, ref, pos FROM aln ORDER BY cb, ref, pos", "aln")
query("merge_alignments", lambda t: al.merge_alignments(t.aln.where("pos < 9000"), t.aln.where("pos >= 9000")).select("qname", "ref", "pos"), "SELECT qname, ref, pos FROM aln", "aln")
query("group_transcripts", lambda t: al.group_transcripts(t.fx.select(F.concat(F.lit("T"), (F.col("gene_no") + F.expr("cast(substr(m, 1, 1) in ('a', 'b') as int)") * 40).cast("string"), F.lit(".1")).alias("transcript")).distinct(), t.exons), ", tx AS (SELECT DISTINCT concat('T', cast(gene_no + CASE WHEN substr(m, 1, 1) IN ('a', 'b') THEN 40 ELSE 0 END AS string), '.1') AS transcript FROM fx) SELECT transcript, coalesce(min(ref), 'chr_Unknown') AS chrom FROM tx LEFT JOIN exons USING (transcript) GROUP BY transcript", "exons")
query("umi_dedup_exact", lambda t: al.umi_dedup_exact(t.aln), f"SELECT sample, ref, strand, pos, cr, ur, qname FROM (SELECT *, {STRAND} AS strand, row_number() OVER (PARTITION BY sample, ref, {STRAND}, pos, cr, ur ORDER BY mapq DESC, qname) AS r FROM aln WHERE {MAPPED}) WHERE r = 1", "aln")
query("umi_dedup_directional", lambda t: dedup.umi_dedup_directional(t.aln))
query("umi_stats", lambda t: al.umi_stats(t.aln), f"SELECT sample, ur, count(*) AS reads_before, count(DISTINCT (ref, pos)) AS positions, count(DISTINCT (ref, {STRAND}, pos, cr)) AS reads_after FROM aln WHERE {MAPPED} GROUP BY 1, 2", "aln")
DUP = f", q AS (SELECT *, {STRAND} AS strand, (SELECT sum(ascii(substr(qual, cast(i AS int), 1)) - 33) FROM range(1, length(qual) + 1) t(i)) AS total FROM aln WHERE {MAPPED}), marked AS (SELECT sample, qname, ref, pos, flag, row_number() OVER (w ORDER BY total DESC, qname) > 1 AS is_dup, count(*) OVER w AS dup_set_size, min(qname) OVER w AS dup_set_id FROM q WINDOW w AS (PARTITION BY sample, ref, pos, strand, cb))"
query("mark_duplicates", lambda t: al.mark_duplicates(t.aln), DUP + " SELECT sample, qname, ref, pos, CASE WHEN is_dup THEN flag | 1024 ELSE flag END AS flag, is_dup, dup_set_size, dup_set_id FROM marked", "aln")
query("filter_duplicates", lambda t: al.filter_duplicates(al.mark_duplicates(t.aln)).select("sample", "qname"), DUP + " SELECT sample, qname FROM marked WHERE NOT is_dup", "aln")
query("duplicate_metrics", lambda t: al.duplicate_metrics(al.mark_duplicates(t.aln)), DUP + " SELECT sample, count(*) AS examined, count(*) FILTER (is_dup) AS duplicates, round(count(*) FILTER (is_dup) / count(*), 6) AS share FROM marked GROUP BY 1", "aln")
query("flagstat", lambda t: al.flagstat(t.aln), "SELECT sample, count(*) AS total, count(*) FILTER (flag & 256 = 0 AND flag & 2048 = 0) AS primary_n, count(*) FILTER (flag & 256 <> 0) AS secondary, count(*) FILTER (flag & 2048 <> 0) AS supplementary, count(*) FILTER (flag & 1024 <> 0) AS duplicates, count(*) FILTER (flag & 4 = 0) AS mapped, count(*) FILTER (flag & 1 <> 0) AS paired, count(*) FILTER (flag & 512 <> 0) AS qc_failed FROM aln GROUP BY 1", "aln")
query("idxstats", lambda t: al.idxstats(t.aln, t.fx.groupBy("sample", "ref").agg(F.max("pos").cast("long").alias("length"))), "SELECT sample, ref, cast(max(pos) AS bigint) AS length, count(*) FILTER (flag & 4 = 0) AS mapped, count(*) FILTER (flag & 4 <> 0) AS unmapped FROM aln GROUP BY 1, 2", "aln")
query("alignment_stats", lambda t: al.alignment_stats(t.aln), f"SELECT sample, count(*) AS reads, cast(sum(length(seq)) AS bigint) AS bases, cast(sum(CASE WHEN {MAPPED} THEN length(seq) ELSE 0 END) AS bigint) AS bases_mapped, cast(sum(CASE WHEN {MAPPED} THEN nm ELSE 0 END) AS bigint) AS mismatches, round(sum(CASE WHEN {MAPPED} THEN nm ELSE 0 END) / sum(CASE WHEN {MAPPED} THEN length(seq) ELSE 0 END), 6) AS error_rate, cast(max(length(seq)) AS int) AS max_length FROM aln GROUP BY 1", "aln")
BLOCKS = f", blocks AS (SELECT sample, qname, ref, {STRAND} AS strand, 0 AS blk, pos AS start_, cast(CASE WHEN cigar LIKE '%N%' THEN pos + 10 ELSE pos + length(seq) END AS int) AS end_ FROM aln WHERE {MAPPED} UNION ALL SELECT sample, qname, ref, {STRAND}, 1, pos + 410, cast(pos + 400 + length(seq) AS int) FROM aln WHERE {MAPPED} AND cigar LIKE '%N%')"
by_name = lambda t: al.aligned_blocks(t.aln).drop("aln_id")  # noqa: E731  one alignment a read name
query("aligned_blocks", by_name, BLOCKS + " SELECT * FROM blocks", "aln")
query("percent_identity", lambda t: al.percent_identity(al.aligned_blocks(t.aln), t.aln).drop("aln_id"), f"SELECT sample, qname, round(100 * (1 - nm / length(seq)), 6) AS identity FROM aln WHERE {MAPPED}", "aln")

# quantification and annotation
GENE = BLOCKS + ", ex AS (SELECT ref, gene, min(start_) AS es, max(end_) AS ee FROM (SELECT *, sum(fresh) OVER (PARTITION BY ref, gene ORDER BY start_, end_ ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT ref, gene, start_, end_, CASE WHEN start_ <= max(end_) OVER (PARTITION BY ref, gene ORDER BY start_, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM exons)) GROUP BY ref, gene, island), hits AS (SELECT sample, qname, gene, sum(least(end_, ee) - greatest(start_, es)) AS n FROM blocks JOIN ex ON blocks.ref = ex.ref AND start_ < ee AND es < end_ GROUP BY 1, 2, 3), tops AS (SELECT sample, qname, min(gene) AS gene, count(*) AS k FROM (SELECT *, max(n) OVER (PARTITION BY sample, qname) AS top FROM hits) WHERE n = top GROUP BY 1, 2), span AS (SELECT ref, gene, min(start_) AS gs, max(end_) AS ge FROM exons GROUP BY 1, 2), inside AS (SELECT sample, qname, min(gene) AS body FROM blocks JOIN span ON blocks.ref = span.ref AND start_ < ge AND gs < end_ GROUP BY 1, 2), assigned AS (SELECT r.sample, r.qname, coalesce(gene, body) AS gene, CASE WHEN k = 1 THEN 'unique' WHEN k > 1 THEN 'ambiguous' WHEN body IS NOT NULL THEN 'intronic' ELSE 'none' END AS class FROM (SELECT DISTINCT sample, qname FROM blocks) r LEFT JOIN tops USING (sample, qname) LEFT JOIN inside USING (sample, qname))"
genes = lambda t: quant.assign_genes(by_name(t), t.exons)
query("assign_genes", genes, GENE + " SELECT * FROM assigned", "aln exons")
query("assign_transcripts", lambda t: quant.assign_transcripts(by_name(t), genes(t), t.exons, 60))
counts = lambda t: quant.count_matrix(place_alignments(t.aln, t.exons))  # noqa: E731  each alignment by its own row
COUNT = GENE + ", counts AS (SELECT sample, gene AS feature, cb AS cell, cast(count(*) AS double) AS n FROM assigned JOIN aln USING (sample, qname) WHERE class = 'unique' GROUP BY 1, 2, 3)"
query("count_matrix", counts, COUNT + " SELECT * FROM counts", "aln exons")
query("transpose_matrix", lambda t: quant.transpose_matrix(counts(t)), COUNT + " SELECT sample, cell AS feature, feature AS cell, n FROM counts", "aln exons")
query("merge_matrices", lambda t: quant.merge_matrices(*[counts(t).where(F.col("sample") == s).select("feature", "cell", "n") for s in ("S0", "S1")]), COUNT + " SELECT feature, cell, sum(n) AS n FROM counts GROUP BY 1, 2", "aln exons")
query("em_quantify", lambda t: quant.em_quantify(quant.assign_transcripts(by_name(t), genes(t), t.exons, 60).join(t.aln.select("sample", "qname", F.col("cb").alias("cell")), ["sample", "qname"]), 4).withColumn("n", F.round("n", 6)))
query("gtf_to_genepred", lambda t: quant.gtf_to_genepred(t.exons).select("transcript", "gene", "ref", "strand", "tx_start", "tx_end", F.array_join(F.transform("exons", lambda x: x["start"].cast("string")), ",").alias("exon_starts")), "SELECT transcript, gene, ref, strand, min(start_) AS tx_start, max(end_) AS tx_end, string_agg(cast(start_ AS string), ',' ORDER BY start_) AS exon_starts FROM exons GROUP BY 1, 2, 3, 4", "exons")
PRED = ", pred AS (SELECT transcript, gene, ref, strand, min(start_) AS tx_start, max(end_) AS tx_end FROM exons GROUP BY 1, 2, 3, 4)"
query("genepred_to_bed", lambda t: quant.genepred_to_bed(quant.gtf_to_genepred(t.exons)), PRED + " SELECT e.ref AS chrom, tx_start, tx_end, transcript AS name, e.strand, count(*) AS block_count, string_agg(cast(end_ - start_ AS string), ',' ORDER BY start_) AS block_sizes, string_agg(cast(start_ - tx_start AS string), ',' ORDER BY start_) AS block_starts FROM exons e JOIN pred USING (transcript) GROUP BY 1, 2, 3, 4, 5", "exons")
query("refflat", lambda t: quant.refflat(quant.gtf_to_genepred(t.exons)), PRED + " SELECT e.gene, transcript, e.ref AS chrom, e.strand, tx_start, tx_end, count(*) AS exon_count, string_agg(cast(start_ AS string), ',' ORDER BY start_) AS exon_starts, string_agg(cast(end_ AS string), ',' ORDER BY start_) AS exon_ends FROM exons e JOIN pred USING (transcript) GROUP BY 1, 2, 3, 4, 5, 6", "exons")

# quality control
query("length_distribution", lambda t: qc.length_distribution(t.reads), "SELECT sample, cast(length(seq) AS int) AS len, count(*) AS n FROM reads GROUP BY 1, 2", "reads")
N50 = ", lens AS (SELECT sample, length(seq) AS len, count(*) AS n FROM reads GROUP BY 1, 2), n50 AS (SELECT sample, cast(max(len) AS int) AS n50 FROM (SELECT *, sum(len * n) OVER (PARTITION BY sample ORDER BY len DESC) AS upto, sum(len * n) OVER (PARTITION BY sample) AS whole FROM lens) WHERE 2 * upto >= whole GROUP BY 1)"
query("n50", lambda t: qc.n50(t.reads), N50 + " SELECT * FROM n50", "reads")
query("read_stats", lambda t: qc.read_stats(t.reads), N50 + f", q AS (SELECT sample, length(seq) AS len, {MEANQ} AS q FROM reads) SELECT sample, count(*) AS reads, cast(sum(len) AS bigint) AS bases, round(avg(len), 6) AS mean_length, round(quantile_cont(len, 0.5), 6) AS median_length, round(stddev_samp(len), 4) AS stdev_length, count(*) FILTER (q > 10) AS reads_over_q10, count(*) FILTER (q > 12) AS reads_over_q12, count(*) FILTER (q > 15) AS reads_over_q15, max(n50) AS n50 FROM q JOIN n50 USING (sample) GROUP BY sample", "reads")
query("compare_samples", lambda t: qc.compare_samples(t.reads), "SELECT sample, bin, n, round(n / sum(n) OVER (PARTITION BY sample), 6) AS share FROM (SELECT sample, cast(length(seq) // 10 AS bigint) AS bin, count(*) AS n FROM reads GROUP BY 1, 2)", "reads")
query("per_read_quality", lambda t: qc.per_read_quality(t.reads), f"SELECT sample, cast(floor({MEANQ} + 1e-9) AS bigint) AS q, count(*) AS n FROM reads GROUP BY 1, 2", "reads")
AT = lambda c: f", places AS (SELECT sample, i - 1 AS pos, substr({c}, cast(i AS int), 1) AS c FROM reads, range(1, 200) t(i) WHERE i <= length({c}))"
query("per_base_quality", lambda t: qc.per_base_quality(t.reads), AT("qual") + " SELECT sample, cast(pos AS int) AS pos, round(avg(ascii(c) - 33), 6) AS mean_q, cast(min(ascii(c) - 33) AS int) AS min_q, cast(max(ascii(c) - 33) AS int) AS max_q FROM places GROUP BY 1, 2", "reads")
query("per_base_content", lambda t: qc.per_base_content(t.reads), AT("seq") + " SELECT sample, cast(pos AS int) AS pos, " + ", ".join(f"round(count(*) FILTER (c = '{b}') / count(*), 6) AS {b.lower()}_share" for b in "ACGTN") + " FROM places GROUP BY 1, 2", "reads")
query("n_content", lambda t: qc.n_content(t.reads), AT("seq") + " SELECT sample, cast(pos AS int) AS pos, round(count(*) FILTER (c = 'N') / count(*), 6) AS n_share FROM places GROUP BY 1, 2", "reads")
query("gc_content", lambda t: qc.gc_content(t.reads), "SELECT sample, cast(100 * length(regexp_replace(seq, '[^GCgc]', '', 'g')) // length(seq) AS bigint) AS gc, count(*) AS n FROM reads GROUP BY 1, 2", "reads")
query("duplication_levels", lambda t: qc.duplication_levels(t.fx.select("sample", F.col("umi").alias("seq"))), "SELECT sample, level, count(*) AS distinct_seqs FROM (SELECT sample, umi, count(*) AS level FROM fx GROUP BY 1, 2) GROUP BY 1, 2")
query("overrepresented", lambda t: qc.overrepresented(t.fx.select("sample", F.col("umi").alias("seq"))), "SELECT sample, seq, n, round(100 * n / a, 6) AS pct FROM (SELECT sample, umi AS seq, count(*) AS n, sum(count(*)) OVER (PARTITION BY sample) AS a FROM fx GROUP BY 1, 2) WHERE n >= 0.001 * a")
query("read_duplication_levels", lambda t: qc.duplication_levels(t.reads), "SELECT sample, level, count(*) AS distinct_seqs FROM (SELECT sample, seq, count(*) AS level FROM reads GROUP BY 1, 2) GROUP BY 1, 2", "reads")
query("read_overrepresented", lambda t: qc.overrepresented(t.reads), "SELECT sample, seq, n, round(100 * n / a, 6) AS pct FROM (SELECT sample, seq, count(*) AS n, sum(count(*)) OVER (PARTITION BY sample) AS a FROM reads GROUP BY 1, 2) WHERE n >= 0.001 * a", "reads")
query("adapter_content", lambda t: qc.adapter_content(t.reads, {"poly_t": "TTTTTTTTTT", "tail": ADAPTER}), f", hits AS (SELECT sample, 'poly_t' AS adapter, strpos(seq, 'TTTTTTTTTT') AS pos FROM reads UNION ALL SELECT sample, 'tail', strpos(seq, '{ADAPTER}') FROM reads), h AS (SELECT sample, adapter, pos, count(*) AS n FROM hits GROUP BY 1, 2, 3) SELECT sample, adapter, cast(pos AS int) AS pos, pct FROM (SELECT *, round(100 * sum(CASE WHEN pos > 0 THEN n ELSE 0 END) OVER (PARTITION BY sample, adapter ORDER BY pos) / sum(n) OVER (PARTITION BY sample, adapter), 6) AS pct FROM h) WHERE pos > 0", "reads")
CELLQC = COUNT + ", cellqc AS (SELECT w.sample, w.bc AS cell, coalesce(sum(n), 0) AS n_count, count(n) AS n_feature FROM whitelist w LEFT JOIN counts c ON w.sample = c.sample AND w.bc = c.cell GROUP BY 1, 2)"
cellqc = lambda t: qc.cell_qc(counts(t), t.whitelist)
query("cell_qc", cellqc, CELLQC + " SELECT * FROM cellqc", "whitelist aln exons")
SUMMARY = CELLQC + ", summary AS (SELECT sample, count(*) AS cells, quantile_cont(n_feature, 0.5) AS median_features FROM cellqc GROUP BY 1)"
#: 100 times the ratio as a whole number, halves to even, so that no rounding of doubles decides
HALF_EVEN = "((100 * total) // cells + CASE WHEN 2 * ((100 * total) % cells) > cells OR (2 * ((100 * total) % cells) = cells AND ((100 * total) // cells) % 2 = 1) THEN 1 ELSE 0 END) / 100.0"
summed = lambda t: qc.cell_summary(qc.cell_qc(m := written(counts(t), "counts"), t.whitelist), m, al.flagstat(t.aln))
query("cell_summary", summed, SUMMARY + f" SELECT sample, cells, {HALF_EVEN} AS mean_reads_per_cell, median_features, total_features FROM summary JOIN (SELECT sample, count(DISTINCT feature) AS total_features FROM counts GROUP BY 1) USING (sample) JOIN (SELECT sample, count(*) AS total FROM aln GROUP BY 1) USING (sample)", "whitelist aln exons")
query("qc_density", lambda t: qc.qc_density(cellqc(t)), CELLQC + " SELECT sample, cast(floor(log10(n_count + 1) * 4 + 1e-9) AS bigint) AS count_bin, cast(floor(log10(n_feature + 1) * 4 + 1e-9) AS bigint) AS feature_bin, count(*) AS cells FROM cellqc GROUP BY 1, 2, 3", "whitelist aln exons")
query("concat_stats", lambda t: qc.concat_stats(al.flagstat(t.aln).select("sample", "total"), al.flagstat(t.aln).select("sample", "mapped")).na.fill(0), f"SELECT sample, count(*) AS total, 0 AS mapped FROM aln GROUP BY 1 UNION ALL SELECT sample, 0, count(*) FILTER ({MAPPED}) FROM aln GROUP BY 1", "aln")
query("qc_report", lambda t: qc.qc_report(al.flagstat(t.aln).select("sample", "total", "mapped"), qc.n50(t.reads), al.duplicate_metrics(al.mark_duplicates(t.aln))), DUP + N50 + f" SELECT sample, total, mapped, n50, examined, duplicates, share FROM (SELECT sample, count(*) AS total, count(*) FILTER ({MAPPED}) AS mapped FROM aln GROUP BY 1) LEFT JOIN n50 USING (sample) LEFT JOIN (SELECT sample, count(*) AS examined, count(*) FILTER (is_dup) AS duplicates, round(count(*) FILTER (is_dup) / count(*), 6) AS share FROM marked GROUP BY 1) USING (sample)", "aln reads")
