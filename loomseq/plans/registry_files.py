"""Queries that write a derived table to the shared folder and read it back; their SQL is that of the derived table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.seq import header_delimiter, transcript_id
from ..operators import alignments as al
from ..operators import contigs, dedup, qc, quant
from ..operators import reads as rd
from ..sources import files
from ..sources.shared import new_path
from . import registry
from .registry import MEANQ, STRAND, Tables, query

MAPPED = "flag & 4 = 0"


def lines(df: DataFrame, value, name: str) -> str:
    """The path of a text file with the lines ``value``."""
    path = new_path(df.sparkSession, name)
    df.select(value.alias("value")).write.text(path)
    return path


def fastq(t: Tables) -> dict[str, str]:
    """One folder of FASTQ for each sample."""
    found = {}
    for sample in ("S0", "S1"):
        found[sample] = new_path(t.spark, f"{sample}.fastq")
        files.write_fastq(t.reads.where(F.col("sample") == sample), found[sample])
    return found


READS = "SELECT {} FROM reads"
query("scan_fastq", lambda t: files.scan_fastq(t.spark, list(fastq(t).values())).select("read_id", "seq", "qual"), READS.format("read_id, seq, qual"), "reads")


def written_fastq(t: Tables) -> DataFrame:
    path = new_path(t.spark, "reads.fastq")
    files.write_fastq(t.reads, path)
    return t.spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


query("write_fastq", written_fastq, "SELECT line, count(*) AS n FROM (SELECT concat('@', read_id) AS line FROM reads UNION ALL SELECT seq FROM reads UNION ALL SELECT '+' FROM reads UNION ALL SELECT qual FROM reads) GROUP BY 1", "reads")


def same_names(spark, folder: str) -> list[str]:
    """The parts of a folder, renamed to ``reads.0.gz`` and so on, as files of different samples are often called alike."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(x.getPath().getName() for x in fs.listStatus(at) if x.getPath().getName().startswith("part-"))
    for i, name in enumerate(parts):
        fs.rename(jvm.org.apache.hadoop.fs.Path(at, name), jvm.org.apache.hadoop.fs.Path(at, f"reads.{i}.gz"))
    return [f"reads.{i}.gz" for i in range(len(parts))]


def merged(t: Tables) -> DataFrame:
    paths = fastq(t)
    listed = [(sample, [f"{sample}.fastq/{name}" for name in same_names(t.spark, path)]) for sample, path in paths.items()]
    samples = t.spark.createDataFrame(listed, "sample string, fastqs array<string>")
    return files.merge_replicates(samples, files.scan_fastq(t.spark, list(paths.values()))).select("sample", "read_id", "seq", "qual")


query("merge_replicates", merged, READS.format("sample, read_id, seq, qual"), "reads")


def sheet(t: Tables) -> DataFrame:
    rows = t.fx.select("sample", F.concat("sample", F.lit("_"), "ref", F.lit(".fastq.gz")).alias("fastq"), (F.length("sample") * 100 + F.substring("sample", 2, 1).cast("int")).alias("cell_count")).distinct()
    path = new_path(t.spark, "sheet.csv")
    rows.write.csv(path, header=True)
    return files.scan_samplesheet(t.spark, path)[0].select("sample", "cell_count", F.array_join(F.array_sort("fastqs"), ",").alias("fastqs"))


query("scan_samplesheet", sheet, "SELECT sample, cast(200 + cast(substr(sample, 2, 1) AS int) AS int) AS cell_count, string_agg(DISTINCT concat(sample, '_', ref, '.fastq.gz'), ',' ORDER BY concat(sample, '_', ref, '.fastq.gz')) AS fastqs FROM fx GROUP BY sample")
query("scan_contigs", lambda t: files.scan_contigs(t.spark, lines(t.fx, F.concat(F.lit(">"), "read_id", F.lit(" a contig\n"), F.substring("ins", 1, 15), F.lit("\n"), F.substring("ins", 16, 1000)), "contigs.fa")), "SELECT read_id AS ref, cast(length(ins) AS bigint) AS length FROM fx")


def gtf(t: Tables) -> str:
    row = F.concat_ws("\t", "ref", F.lit("x"), F.lit("exon"), (F.col("start_") + 1).cast("string"), F.col("end_").cast("string"), F.lit("."), "strand", F.lit("."), F.concat(F.lit('gene_id "'), "gene", F.lit('"; transcript_id "'), "transcript", F.lit('"; level 2; tag "a"; tag "b";')))
    return lines(t.exons, row, "exons.gtf")


query("scan_gtf", lambda t: files.exons_of(files.scan_gtf(t.spark, gtf(t)).where("attrs['level'] = '2' and attrs['tag'] = 'a'")), "SELECT ref, gene, transcript, strand, start_, end_ FROM exons", "exons")
query("scan_whitelist", lambda t: files.scan_whitelist(t.spark, kit="10X_3v3", kits={"10X_3v3": lines(t.whitelist, F.col("bc"), "list.txt")}), "SELECT DISTINCT bc FROM whitelist", "whitelist")


def sam(t: Tables) -> str:
    text = lambda c: F.col(c).cast("string")
    row = F.concat_ws("\t", "qname", text("flag"), "ref", (F.col("pos") + 1).cast("string"), text("mapq"), "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "seq", "qual", F.concat(F.lit("NM:i:"), text("nm")), F.concat(F.lit("CR:Z:"), "cr"), F.concat(F.lit("UR:Z:"), "ur"), F.concat(F.lit("CB:Z:"), "cb"))
    return lines(t.aln.where("sample = 'S0'"), row, "S0.sam")


query("scan_sam", lambda t: files.scan_sam(t.spark, sam(t), "S0").select("sample", "qname", "flag", "ref", "pos", "mapq", "cigar", "seq", "qual", "nm", "cr", "ur", "cb"), "SELECT sample, qname, flag, ref, pos, mapq, cigar, seq, qual, nm, cr, ur, cb FROM aln WHERE sample = 'S0'", "aln")


def table(t: Tables) -> str:
    path = new_path(t.spark, "info.tsv")
    files.write_table(t.bc_info, path)
    return path


INFO = "SELECT sample, read_id, bc, bc_qual, umi, umi_qual FROM bc_info"
query("scan_bc_tables", lambda t: files.scan_bc_table(t.spark, table(t), "info"), INFO, "bc_info")


def with_header(t: Tables) -> DataFrame:
    path = new_path(t.spark, "info.csv")
    files.write_table(t.bc_info, path, header=True)
    return t.spark.read.csv(path, sep="\t", header=True, quote="", escape="")


query("write_tables", with_header, INFO, "bc_info")

MINI = ", mini AS (SELECT concat('G', cast(gene_no AS string)) AS feature, tb AS cell, cast(count(*) AS double) AS n FROM fx GROUP BY 1, 2)"
mini = lambda t: t.fx.groupBy(F.concat(F.lit("G"), F.col("gene_no").cast("string")).alias("feature"), F.col("tb").alias("cell")).agg(F.count("*").cast("double").alias("n"))


def mex(t: Tables) -> str:
    path = new_path(t.spark, "mex")
    files.write_mex(mini(t), path)
    return path


def dense(t: Tables) -> str:
    path = new_path(t.spark, "dense.tsv")
    files.write_dense(mini(t), path)
    return path


query("scan_mex", lambda t: files.scan_mex(t.spark, mex(t)), MINI + " SELECT feature, cell, n FROM mini")
query("write_mex", lambda t: t.spark.read.text(f"{mex(t)}/features.tsv").withColumnRenamed("value", "feature"), MINI + " SELECT DISTINCT feature FROM mini")
ALL = " SELECT f.feature, c.cell, coalesce(n, 0.0) AS n FROM (SELECT DISTINCT feature FROM mini) f CROSS JOIN (SELECT DISTINCT cell FROM mini) c LEFT JOIN mini USING (feature, cell)"
query("scan_dense", lambda t: files.scan_dense(t.spark, dense(t)), MINI + ALL)
query("write_dense", lambda t: files.scan_dense(t.spark, dense(t)).where("n > 0"), MINI + " SELECT feature, cell, n FROM mini")


def split(t: Tables) -> DataFrame:
    return files.split_by_reference(t.aln, new_path(t.spark, "parts")).select("sample", "qname", "ref", "pos")


query("split_by_reference", split, "SELECT sample, qname, ref, pos FROM aln", "aln")

# where molecules begin: every third alignment is clipped at one end or both
CLIPPED = ", clipped AS (SELECT * REPLACE (CASE WHEN length(seq) % 3 = 0 THEN concat('3S', cigar, '2S') WHEN length(seq) % 3 = 1 THEN concat('4S', cigar) ELSE cigar END AS cigar) FROM aln), placed AS (SELECT *, cast(CASE WHEN flag & 16 <> 0 THEN pos + length(seq) + CASE WHEN cigar LIKE '%N%' THEN 400 ELSE 0 END + CASE WHEN length(seq) % 3 = 0 THEN 2 ELSE 0 END ELSE pos - CASE length(seq) % 3 WHEN 0 THEN 3 WHEN 1 THEN 4 ELSE 0 END END AS int) AS five FROM clipped WHERE flag & 4 = 0)"
CIGAR = "case when length(seq) % 3 = 0 then concat('3S', cigar, '2S') when length(seq) % 3 = 1 then concat('4S', cigar) else cigar end"
placed = lambda t: t.aln.withColumn("cigar", F.expr(CIGAR)).withColumn("five", al.five_prime())
query("umi_dedup_five_prime", lambda t: al.umi_dedup_exact(placed(t), place="five"), CLIPPED + f" SELECT sample, ref, strand, five, cr, ur, qname FROM (SELECT *, {STRAND} AS strand, row_number() OVER (PARTITION BY sample, ref, {STRAND}, five, cr, ur ORDER BY mapq DESC, qname) AS r FROM placed) WHERE r = 1", "aln")
query("mark_duplicates_five_prime", lambda t: al.mark_duplicates(placed(t), place="five").select("sample", "qname", "is_dup", "dup_set_size", "dup_set_id"), CLIPPED + f", q AS (SELECT *, {STRAND} AS strand, (SELECT sum(ascii(substr(qual, cast(i AS int), 1)) - 33) FROM range(1, length(qual) + 1) t(i)) AS total FROM placed) SELECT sample, qname, row_number() OVER (w ORDER BY total DESC, qname) > 1 AS is_dup, count(*) OVER w AS dup_set_size, min(qname) OVER w AS dup_set_id FROM q WINDOW w AS (PARTITION BY sample, ref, five, strand, cb)", "aln")
query("umi_dedup_directional_five_prime", lambda t: dedup.umi_dedup_directional(placed(t), place="five"))

# regions: the coding part leaves 15 bases of a transcript before it and 40 behind it
PRED = ", pred AS (SELECT transcript, gene, ref, strand, min(start_) AS tx_start, max(end_) AS tx_end, cast(min(start_) + 15 AS int) AS cds_start, cast(max(end_) - 40 AS int) AS cds_end FROM exons GROUP BY 1, 2, 3, 4)"
coded = lambda t: quant.with_cds(p := quant.gtf_to_genepred(t.exons), p.select("transcript", (F.col("tx_start") + 15).alias("start_"), (F.col("tx_end") - 40).alias("end_")))
query("bed12", lambda t: quant.bed12(coded(t)), PRED + " SELECT e.ref AS chrom, tx_start, tx_end, transcript AS name, 0 AS score, e.strand, cds_start AS thick_start, cds_end AS thick_end, '0' AS rgb, count(*) AS block_count, string_agg(cast(end_ - start_ AS string), ',' ORDER BY start_) AS block_sizes, string_agg(cast(start_ - tx_start AS string), ',' ORDER BY start_) AS block_starts FROM exons e JOIN pred USING (transcript) GROUP BY ALL", "exons")
UP, DOWN = "CASE WHEN strand <> '-' THEN 'tss_up_' ELSE 'tes_down_' END", "CASE WHEN strand <> '-' THEN 'tes_down_' ELSE 'tss_up_' END"
ORDER = ", ".join(f"'{c}'" for c in quant.REGIONS)
REGION = PRED + f""", raw AS (
 SELECT e.ref, greatest(start_, cds_start) AS s, least(end_, cds_end) AS e, 'cds_exons' AS class FROM exons e JOIN pred USING (transcript)
 UNION ALL SELECT e.ref, start_, least(end_, cds_start), CASE WHEN e.strand <> '-' THEN 'utr5_exons' ELSE 'utr3_exons' END FROM exons e JOIN pred USING (transcript)
 UNION ALL SELECT e.ref, greatest(start_, cds_end), end_, CASE WHEN e.strand <> '-' THEN 'utr3_exons' ELSE 'utr5_exons' END FROM exons e JOIN pred USING (transcript)
 UNION ALL SELECT ref, end_, lead(start_) OVER (PARTITION BY transcript ORDER BY start_), 'introns' FROM exons
 UNION ALL SELECT ref, greatest(tx_start - 1000 * k, 0), tx_start, concat({UP}, k, 'kb') FROM pred, (VALUES (1), (5), (10)) d(k)
 UNION ALL SELECT ref, tx_end, tx_end + 1000 * k, concat({DOWN}, k, 'kb') FROM pred, (VALUES (1), (5), (10)) d(k)),
 good AS (SELECT ref, cast(s AS bigint) AS s, cast(e AS bigint) AS e, list_position([{ORDER}], class) AS p FROM raw WHERE s < e),
 points AS (SELECT ref, s AS a FROM good UNION SELECT ref, e FROM good),
 parts AS (SELECT ref, a, lead(a) OVER (PARTITION BY ref ORDER BY a) AS b FROM points),
 said AS (SELECT parts.ref, a, b, min(p) AS p FROM parts JOIN good ON parts.ref = good.ref AND s <= a AND b <= e GROUP BY 1, 2, 3),
 marked AS (SELECT *, CASE WHEN lag(p) OVER w = p AND lag(b) OVER w = a THEN 0 ELSE 1 END AS fresh FROM said WINDOW w AS (PARTITION BY ref ORDER BY a)),
 islands AS (SELECT *, sum(fresh) OVER (PARTITION BY ref ORDER BY a) AS i FROM marked),
 regions AS (SELECT ref, [{ORDER}][cast(p AS int)] AS class, min(a) AS start_, max(b) AS end_ FROM islands GROUP BY ref, p, i)"""
regions = lambda t: quant.feature_regions(coded(t))
query("feature_regions", regions, REGION + " SELECT ref, class, start_, end_ FROM regions", "exons")
BLOCKS = f", blocks AS (SELECT sample, ref, pos AS start_, CASE WHEN cigar LIKE '%N%' THEN pos + 10 ELSE pos + length(seq) END AS end_ FROM aln WHERE {MAPPED} UNION ALL SELECT sample, ref, pos + 410, pos + 400 + length(seq) FROM aln WHERE {MAPPED} AND cigar LIKE '%N%')"
query("read_distribution", lambda t: quant.read_distribution(al.aligned_blocks(t.aln), regions(t)), BLOCKS + REGION + """, inner_of AS (SELECT a.class AS grp, b.class FROM (SELECT DISTINCT class FROM regions) a JOIN (SELECT DISTINCT class FROM regions) b ON a.class = b.class OR (regexp_replace(a.class, '_[0-9]+kb$', '') = regexp_replace(b.class, '_[0-9]+kb$', '') AND cast(regexp_extract(b.class, '_([0-9]+)kb$', 1) AS int) <= cast(regexp_extract(a.class, '_([0-9]+)kb$', 1) AS int))),
 tags AS (SELECT sample, class, count(*) AS n FROM blocks JOIN regions ON blocks.ref = regions.ref AND (blocks.start_ + blocks.end_) // 2 >= regions.start_ AND (blocks.start_ + blocks.end_) // 2 < regions.end_ GROUP BY 1, 2),
 bases AS (SELECT class, cast(sum(end_ - start_) AS bigint) AS n FROM regions GROUP BY 1),
 sums AS (SELECT grp, cast(sum(n) AS bigint) AS total_bases FROM inner_of JOIN bases USING (class) GROUP BY 1)
 SELECT sample, grp AS "group", total_bases, cast(sum(n) AS bigint) AS tag_count, round(1000 * sum(n) / total_bases, 6) AS tags_per_kb FROM inner_of JOIN tags USING (class) JOIN sums USING (grp) GROUP BY 1, 2, 3""", "aln exons")

# the run: reads get a time and a channel from their keys
TIMED = ", timed AS (SELECT sample, length(seq) AS len, cast(split_part(read_id, '-', 1) AS bigint) % 5000 * 7 AS t, cast(split_part(read_id, '-', 3) AS bigint) % 512 AS ch FROM fx)"
timed = lambda t: t.fx.select("sample", "seq", F.expr("concat('runid=x start_time=', date_format(timestamp_seconds(1700000000 + cast(split_part(read_id, '-', 1) as bigint) % 5000 * 7), \"yyyy-MM-dd'T'HH:mm:ss\"), 'Z ch=', cast(split_part(read_id, '-', 3) as bigint) % 512)").alias("description"))
query("yield_over_time", lambda t: qc.yield_over_time(timed(t), 30), TIMED + " SELECT sample, bin, reads, bases, channels, cast(sum(bases) OVER (PARTITION BY sample ORDER BY bin) AS bigint) AS cum_bases FROM (SELECT sample, (t - f) // 1800 AS bin, count(*) AS reads, cast(sum(len) AS bigint) AS bases, count(DISTINCT ch) AS channels FROM timed JOIN (SELECT sample, min(t) AS f FROM timed GROUP BY 1) USING (sample) GROUP BY 1, 2)")
QUANTILES = ", ".join(f"min(CASE WHEN upto >= {s} * whole THEN q END) AS q{round(100 * s)}" for s in (0.1, 0.25, 0.5, 0.75, 0.9))
query("quality_quantiles", lambda t: qc.quality_quantiles(t.reads), f", bins AS (SELECT sample, cast(i - 1 AS int) AS pos, cast(ascii(substr(qual, cast(i AS int), 1)) - 33 AS int) AS q, count(*) AS n FROM reads, range(1, 200) t(i) WHERE i <= length(qual) GROUP BY 1, 2, 3), run AS (SELECT *, sum(n) OVER (PARTITION BY sample, pos ORDER BY q) AS upto, sum(n) OVER (PARTITION BY sample, pos) AS whole FROM bins) SELECT sample, pos, {QUANTILES} FROM run GROUP BY 1, 2", "reads")

# contigs: the inserts of every fiftieth read, which all reads are held against
query("assign_contigs", lambda t: contigs.assign_contigs(t.reads, t.fx.where("cell_no % 50 = 0").select(F.col("read_id").alias("ref"), F.col("ins").alias("seq")), 14, 5))


# contigs of genes: the inserts of all its reads, one behind the other in lines of 60 bases, read as tiles
def genome(t: Tables) -> str:
    whole = t.fx.groupBy("gene_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("read_id", "ins"))), lambda x: x["ins"]), "").alias("seq"))
    return lines(whole, F.concat(F.lit(">gene"), F.col("gene_no").cast("string"), F.lit(" made of reads\n"), F.regexp_replace("seq", "(.{60})", "$1\n")), "genome.fa")


query("scan_tiles", lambda t: files.scan_tiles(t.spark, genome(t), 500, 20, 30).select("ref", "length", "tile", "first", "last", "start_", "seq"), ", genome AS (SELECT concat('gene', cast(gene_no AS string)) AS ref, string_agg(ins, '' ORDER BY read_id) AS s FROM fx GROUP BY gene_no), cut AS (SELECT ref, s, length(s) AS length, unnest(range(0, (length(s) + 499) // 500)) AS tile FROM genome) SELECT ref, length, tile, tile * 500 AS first, least(tile * 500 + 500, length) AS last, greatest(tile * 500 - 20, 0) AS start_, s[greatest(tile * 500 - 20, 0) + 1 : tile * 500 + 530] AS seq FROM cut")
query("assign_tiled_contigs", lambda t: contigs.assign_contigs(t.reads, contigs.contig_tiles(t.spark, genome(t), 14, 5, 4096), 14, 5))

# tags of alignments that have some already, and the last row of a read; names have "_", and every second one a tag's suffix
UNDER = "translate({}, '-', '_')"
TAGGED = f"SELECT a.sample, concat_ws('_', {UNDER.format('a.qname')}, i.bc, i.umi) AS qname, a.flag, a.ref, a.pos, coalesce(a.cr, i.bc) AS cr, i.bc_qual AS cy, i.umi AS ur, i.umi_qual AS uy, i.bc AS cb FROM (SELECT sample, qname, flag, ref, pos, CASE WHEN mapq % 2 = 0 THEN cr END AS cr FROM aln) a JOIN bc_info i ON a.sample = i.sample AND a.qname = i.read_id"
partly = lambda t: t.aln.select("sample", F.expr(f"concat({UNDER.format('qname')}, case when pos % 2 = 0 then concat('_', cr, '_', ur) else '' end)").alias("qname"), "flag", "ref", "pos", F.expr("case when mapq % 2 = 0 then cr end").alias("cr"))
under = lambda t: t.bc_info.withColumn("read_id", F.expr(UNDER.format("read_id")))
twice = lambda t: under(t).withColumns({"corrected_bc": F.col("bc"), "ordinal": F.lit(2)}).unionByName(under(t).withColumns({"bc": F.lit("Z"), "corrected_bc": F.lit("Z"), "ordinal": F.lit(1)}))
query("tag_alignments", lambda t: al.tag_alignments(partly(t), twice(t)), TAGGED, "bc_info aln")

# fuller statistics of alignments and reads
PAIRED = ", paired AS (SELECT * REPLACE (cast(flag | CASE WHEN mapq % 2 = 0 THEN 1 | (CASE WHEN mapq % 3 = 0 THEN 2 | 64 ELSE 128 END) | (CASE WHEN mapq % 5 = 0 THEN 8 ELSE 0 END) ELSE 0 END | CASE WHEN mapq % 7 = 0 THEN 512 ELSE 0 END AS int) AS flag) FROM aln)"
paired = lambda t: t.aln.withColumn("flag", F.expr("cast(flag | case when mapq % 2 = 0 then 1 | (case when mapq % 3 = 0 then 2 | 64 else 128 end) | (case when mapq % 5 = 0 then 8 else 0 end) else 0 end | case when mapq % 7 = 0 then 512 else 0 end as int)"))
FIRST = "flag & 2304 = 0"
COUNTS = {"primary_n": FIRST, "mapped": "flag & 4 = 0", "primary_mapped": f"flag & 4 = 0 AND {FIRST}", "duplicates": "flag & 1024 <> 0", "paired": f"flag & 1 <> 0 AND {FIRST}", "read1": f"flag & 1 <> 0 AND {FIRST} AND flag & 64 <> 0", "read2": f"flag & 1 <> 0 AND {FIRST} AND flag & 128 <> 0", "proper": f"flag & 1 <> 0 AND {FIRST} AND flag & 2 <> 0 AND flag & 4 = 0", "both_mapped": f"flag & 1 <> 0 AND {FIRST} AND flag & 12 = 0", "singletons": f"flag & 1 <> 0 AND {FIRST} AND flag & 4 = 0 AND flag & 8 <> 0"}
query("flagstat_by_quality", lambda t: al.flagstat_by_quality(paired(t)), PAIRED + " SELECT sample, CASE WHEN flag & 512 <> 0 THEN 'failed' ELSE 'passed' END AS qc, count(*) AS total, " + ", ".join(f"count(*) FILTER ({v}) AS {k}" for k, v in COUNTS.items()) + " FROM paired GROUP BY 1, 2", "aln")
lengths = lambda t: t.fx.groupBy("sample", "ref").agg(F.max("pos").cast("long").alias("length"))
query("idxstats_shares", lambda t: al.idxstats_shares(al.idxstats(t.aln, lengths(t))), ", stats AS (SELECT sample, ref, cast(max(pos) AS bigint) AS length, count(*) FILTER (flag & 4 = 0) AS mapped, count(*) FILTER (flag & 4 <> 0) AS unmapped FROM aln GROUP BY 1, 2) SELECT *, round(mapped / sum(mapped) OVER w, 6) AS share, round((mapped / sum(mapped) OVER w) / (length / sum(length) OVER w), 6) AS observed_expected FROM stats WINDOW w AS (PARTITION BY sample)", "aln")
query("alignment_histograms", lambda t: al.alignment_histograms(t.aln), f", vs AS (SELECT sample, 'mapq' AS kind, cast(mapq AS bigint) AS value FROM aln WHERE {MAPPED} UNION ALL SELECT sample, 'length', length(seq) FROM aln UNION ALL SELECT sample, 'quality', cast(floor({MEANQ} + 1e-9) AS bigint) FROM aln) SELECT sample, kind, value, count(*) AS n FROM vs GROUP BY ALL", "aln")
TOP = "string_agg(concat(cast(len AS string), ':', cast(round(q, 1) AS string)), ',' ORDER BY r)"
query("read_quality_stats", lambda t: qc.read_quality_stats(t.reads), f", q AS (SELECT sample, read_id, length(seq) AS len, round({MEANQ}, 6) AS q FROM reads), l AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY len DESC, q DESC, read_id) AS r FROM q), b AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY q DESC, len DESC, read_id) AS r FROM q) SELECT * FROM (SELECT sample, round(avg(q), 4) AS mean_q, round(quantile_cont(q, 0.5), 4) AS median_q, " + ", ".join(f"round(sum(CASE WHEN q > {c} THEN len ELSE 0 END) / 1e6, 6) AS mb_over_q{c}" for c in (10, 12, 15)) + f" FROM q GROUP BY 1) JOIN (SELECT sample, {TOP} AS longest FROM l WHERE r <= 5 GROUP BY 1) USING (sample) JOIN (SELECT sample, {TOP} AS best FROM b WHERE r <= 5 GROUP BY 1) USING (sample)", "reads")

# each alignment by itself, and estimates that have settled
BY = f"SELECT sample, qname, aln, ref, start_, end_ FROM (SELECT sample, qname, 0 AS aln, ref, pos AS start_, CASE WHEN cigar LIKE '%N%' THEN pos + 10 ELSE pos + length(seq) END AS end_ FROM aln WHERE {MAPPED} UNION ALL SELECT sample, qname, 0, ref, pos + 410, pos + 400 + length(seq) FROM aln WHERE {MAPPED} AND cigar LIKE '%N%')"
TWO = f", one AS ({BY}), blocks AS (SELECT * FROM one UNION ALL SELECT sample, qname, 1, ref, start_ + 1000, end_ + 1000 FROM one), ex AS (SELECT ref, gene, min(start_) AS es, max(end_) AS ee FROM (SELECT *, sum(fresh) OVER (PARTITION BY ref, gene ORDER BY start_, end_ ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT ref, gene, start_, end_, CASE WHEN start_ <= max(end_) OVER (PARTITION BY ref, gene ORDER BY start_, end_ ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM exons)) GROUP BY ref, gene, island), hits AS (SELECT sample, qname, aln, gene, sum(least(end_, ee) - greatest(start_, es)) AS n FROM blocks JOIN ex ON blocks.ref = ex.ref AND start_ < ee AND es < end_ GROUP BY ALL), tops AS (SELECT sample, qname, aln, min(gene) AS gene, count(*) AS k FROM (SELECT *, max(n) OVER (PARTITION BY sample, qname, aln) AS top FROM hits) WHERE n = top GROUP BY ALL), body AS (SELECT sample, qname, aln, min(gene) AS body FROM blocks JOIN (SELECT ref, gene, min(start_) AS es, max(end_) AS ee FROM exons GROUP BY 1, 2) e ON blocks.ref = e.ref AND start_ < ee AND es < end_ GROUP BY ALL)"
both = lambda t: al.with_aln_id(t.aln.where(MAPPED).unionByName(t.aln.where(MAPPED).withColumn("pos", F.col("pos") + 1000)))
query("assign_genes_by_alignment", lambda t: quant.assign_genes(al.aligned_blocks(both(t)), t.exons).select("sample", "qname", "gene", "class"), TWO + " SELECT sample, qname, coalesce(gene, body) AS gene, CASE WHEN k = 1 THEN 'unique' WHEN k > 1 THEN 'ambiguous' WHEN body IS NOT NULL THEN 'intronic' ELSE 'none' END AS class FROM (SELECT DISTINCT sample, qname, aln FROM blocks) LEFT JOIN tops USING (sample, qname, aln) LEFT JOIN body USING (sample, qname, aln)", "aln exons")
LENGTHS = f", lens AS (SELECT sample, qname, ref, pos, length(seq) AS n, cigar LIKE '%N%' AS cut FROM aln WHERE {MAPPED})"
query("alignment_lengths", lambda t: al.alignment_lengths(t.aln.withColumn("cigar", F.expr(CIGAR))).drop("aln_id"), LENGTHS + " SELECT sample, qname, cast(n AS int) AS aligned, 0 AS inserted, 0 AS deleted, CASE WHEN cut THEN 400 ELSE 0 END AS skipped, CASE n % 3 WHEN 0 THEN 5 WHEN 1 THEN 4 ELSE 0 END AS soft_clipped, 0 AS hard_clipped FROM lens", "aln")
worse = lambda t: al.with_aln_id(t.aln.where(MAPPED).unionByName(t.aln.where(MAPPED).withColumns({"pos": F.col("pos") + 1000, "nm": F.col("nm") + 3})))
identity = lambda t: al.percent_identity(al.aligned_blocks(worse(t)), worse(t))
SAME = f", same AS (SELECT sample, qname, round(100 * (1 - (nm + more) / length(seq)), 6) AS identity FROM aln, (VALUES (0), (3)) v(more) WHERE {MAPPED})"
query("identity_by_alignment", lambda t: identity(t).drop("aln_id"), SAME + " SELECT * FROM same", "aln")
query("identity_distribution", lambda t: al.identity_distribution(identity(t)), SAME + " SELECT sample, cast(floor(identity) AS int) AS percent, count(*) AS n FROM same GROUP BY 1, 2", "aln")
query("em_converged", lambda t: quant.em_quantify(quant.assign_transcripts(registry.by_name(t), registry.genes(t), t.exons, 60).join(t.aln.select("sample", "qname", F.col("cb").alias("cell")), ["sample", "qname"]), 60, 1e-4))

# policies of counting, headers of transcripts, distances of UMIs
GENED = registry.GENE + " SELECT sample, gene AS feature, cb AS cell, cast(count(*) AS double) AS n FROM assigned JOIN aln USING (sample, qname) WHERE class IN ('unique', 'intronic') GROUP BY 1, 2, 3"
query("count_matrix_introns", lambda t: quant.count_matrix(registry.genes(t), t.aln.select("sample", "qname", "cb"), classes=("unique", "intronic")), GENED, "aln exons")
query("transcript_id", lambda t: t.fx.select("read_id", transcript_id(F.concat(F.lit(">T"), "read_id", F.lit("|G"), F.col("gene_no").cast("string"), F.lit(" a gene")), "|").alias("transcript")), "SELECT read_id, concat('T', read_id) AS transcript FROM fx")
query("umi_distances", lambda t: dedup.umi_distances(t.aln), f", u AS (SELECT DISTINCT sample, ref, {STRAND} AS strand, pos, cr, ur FROM aln WHERE {MAPPED}), pairs AS (SELECT a.sample, a.ref, a.strand, a.pos, a.cr, avg(hamming(a.ur, b.ur)) AS mean FROM u a JOIN u b ON a.sample = b.sample AND a.ref = b.ref AND a.strand = b.strand AND a.pos = b.pos AND a.cr = b.cr AND a.ur < b.ur GROUP BY ALL) SELECT sample, cast(floor(mean + 1e-9) AS bigint) AS distance, count(*) AS places FROM pairs GROUP BY 1, 2", "aln")

# a matrix in blocks of cells, a caller's table as it is, and the delimiter of the first header that has one
BLOCKED = 16


def dense_blocks(t: Tables) -> DataFrame:
    path = new_path(t.spark, "dense_blocks")
    files.write_dense(mini(t), path, BLOCKED)
    return files.scan_dense(t.spark, path)


query("write_dense_blocks", dense_blocks, MINI + ALL)


def calls(t: Tables) -> DataFrame:
    body = t.fx.select(F.concat_ws(",", "read_id", F.expr("case when substr(m, 12, 1) = '0' then '' else bc end"), F.expr("cast(mapq as string)"), F.lit("x"), F.lit(""), F.lit(""), F.lit("1")).alias("value"))
    head = t.spark.createDataFrame([("read_id,putative_bc,putative_bc_min_q,a,b,c,d",)], "value string")
    return files.scan_bc_table(t.spark, lines(body.unionByName(head), F.col("value"), "calls.csv"), "calls", "run")


query("scan_bc_calls", calls, "SELECT 'run' AS sample, read_id, CASE WHEN substr(m, 12, 1) <> '0' THEN bc END AS putative_bc, mapq AS min_q FROM fx")


def delimited(t: Tables) -> DataFrame:
    headers = t.fx.select("read_id", F.expr("cast(substring_index(read_id, '-', 1) as bigint) * 100 + cast(substring_index(substring_index(read_id, '-', 2), '-', -1) as bigint)").alias("ordinal"), F.expr("case when gene_no % 2 = 0 then concat('>T', read_id, ' plain') else concat('>T', read_id, '|G', gene_no, ';x|y a gene') end").alias("header"))
    return headers.select("read_id", transcript_id(F.col("header"), header_delimiter(headers)).alias("transcript"))


query("transcript_delimiter", delimited, "SELECT read_id, concat('T', read_id) AS transcript FROM fx")

# coding parts of refFlat, mates, averages and lengths by their logarithm
query("refflat_cds", lambda t: quant.refflat_cds(coded(t)), PRED + " SELECT e.gene, transcript, e.ref AS chrom, e.strand, tx_start, tx_end, cds_start, cds_end, count(*) AS exon_count, string_agg(cast(start_ AS string), ',' ORDER BY start_) AS exon_starts, string_agg(cast(end_ AS string), ',' ORDER BY start_) AS exon_ends FROM exons e JOIN pred USING (transcript) GROUP BY ALL", "exons")
MATE = "case when mapq % 4 = 0 then '=' when mapq % 4 = 1 then ref else 'chr9' end"
query("flagstat_mates", lambda t: al.flagstat_mates(paired(t).withColumn("mate_ref", F.expr(MATE))), PAIRED + f" SELECT sample, count(*) FILTER (away) AS mate_elsewhere, count(*) FILTER (away AND mapq >= 5) AS mate_elsewhere_q5 FROM (SELECT *, flag & 1 <> 0 AND {FIRST} AND flag & 12 = 0 AND mapq % 4 > 1 AS away FROM paired) GROUP BY 1", "aln")
query("alignment_averages", lambda t: al.alignment_averages(t.aln), "SELECT sample, round(sum(length(seq)) / count(*), 6) AS average_length, round(sum((SELECT sum(ascii(substr(qual, cast(i AS int), 1)) - 33) FROM range(1, length(qual) + 1) t(i))) / sum(length(qual)), 6) AS average_quality FROM aln GROUP BY 1", "aln")
query("compare_log_lengths", lambda t: qc.compare_log_lengths(t.reads, 50), "SELECT sample, bin, n, bases, round(n / sum(n) OVER (PARTITION BY sample), 6) AS share, round(bases / sum(bases) OVER (PARTITION BY sample), 6) AS base_share FROM (SELECT sample, cast(floor(log10(length(seq)) * 50 + 1e-9) AS bigint) AS bin, count(*) AS n, cast(sum(length(seq)) AS bigint) AS bases FROM reads WHERE seq <> '' GROUP BY 1, 2)", "reads")


# the report: one wide row a sample from all six tables
def report(t: Tables) -> DataFrame:
    reads_ = qc.read_stats(t.reads).select("sample", "reads", "bases", "n50")
    distribution = quant.read_distribution(al.aligned_blocks(t.aln), regions(t))
    funnel = qc.read_funnel(t.reads, rd.filter_reads(t.reads, 90, 5.0), rd.drop_unassigned(registry.located(t)), registry.corrected(t))
    summary = registry.summed(t)
    return qc.qc_report(al.flagstat(t.aln).select("sample", "total", "mapped"), qc.idxstats_summary(al.idxstats(t.aln, lengths(t))), reads_, qc.distribution_summary(distribution), summary, funnel)


GROUPS = ("cds_exons", "utr5_exons", "utr3_exons", "introns")
query("qc_report_full", report, registry.CORR + registry.LOCATED + registry.N50 + registry.SUMMARY + REGION + f""", tags AS (SELECT sample, {', '.join(f"count(*) FILTER (class = '{g}') AS {g}_tags" for g in GROUPS)} FROM blocks JOIN regions ON blocks.ref = regions.ref AND (blocks.start_ + blocks.end_) // 2 >= regions.start_ AND (blocks.start_ + blocks.end_) // 2 < regions.end_ GROUP BY 1),
 totals AS (SELECT sample, count(*) AS total, count(*) FILTER ({MAPPED}) AS mapped FROM aln GROUP BY 1), idx AS (SELECT sample, ref, count(*) FILTER ({MAPPED}) AS mapped FROM aln GROUP BY 1, 2), refs AS (SELECT sample, count(*) AS refs, count(*) FILTER (mapped > 0) AS refs_with_reads, round(max(mapped) / sum(mapped), 6) AS fullest_ref_share FROM idx GROUP BY 1),
 raw_reads AS (SELECT sample, count(*) AS reads, cast(sum(length(seq)) AS bigint) AS bases, count(*) AS base_fastq_counts, count(*) FILTER (length(seq) >= 90 AND {MEANQ} >= 5.0) AS trimmed_read_counts FROM reads GROUP BY 1),
 cut AS (SELECT sample, count(*) AS extracted_read_counts FROM located WHERE putative_bc IS NOT NULL AND idx >= 0 GROUP BY 1), fixed AS (SELECT sample, count(*) AS corrected_read_counts FROM corrected GROUP BY 1), detected AS (SELECT sample, count(DISTINCT feature) AS total_features FROM counts GROUP BY 1)
 SELECT sample, total, mapped, refs, refs_with_reads, fullest_ref_share, reads, bases, n50, {', '.join(f'{g}_tags' for g in GROUPS)}, cells, {registry.HALF_EVEN} AS mean_reads_per_cell, median_features, total_features, base_fastq_counts, trimmed_read_counts, extracted_read_counts, corrected_read_counts
 FROM totals JOIN refs USING (sample) JOIN raw_reads USING (sample) JOIN n50 USING (sample) JOIN tags USING (sample) JOIN summary USING (sample) JOIN detected USING (sample) JOIN cut USING (sample) JOIN fixed USING (sample)""", "reads putative bc_info whitelist bc_counts aln exons")

# whole jobs beside queries of one sample, one kind or one file

def all_sams(t: Tables) -> DataFrame:
    out = None
    for sample in ("S0", "S1"):
        text = lambda c: F.col(c).cast("string")
        row = F.concat_ws("\t", "qname", text("flag"), "ref", (F.col("pos") + 1).cast("string"), text("mapq"), "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "seq", "qual", F.concat(F.lit("NM:i:"), text("nm")), F.concat(F.lit("CB:Z:"), "cb"))
        rows = files.scan_sam(t.spark, lines(t.aln.where(F.col("sample") == sample), row, f"{sample}.sam"), sample)
        out = rows if out is None else out.unionByName(rows)
    return out.select("sample", "qname", "flag", "ref", "pos", "mapq", "cigar", "seq", "qual", "nm", "cb")


query("scan_sams", all_sams, "SELECT sample, qname, flag, ref, pos, mapq, cigar, seq, qual, nm, cb FROM aln", "aln")


def all_tables(t: Tables) -> DataFrame:
    """Every kind of table, written and read again, as rows of one shape."""
    given = {"putative": t.putative, "info": t.bc_info, "corrected": t.bc_info.withColumn("corrected_bc", F.col("bc")), "counts": t.bc_counts}
    out = None
    for kind, df in given.items():
        path = new_path(t.spark, kind)
        files.write_table(df, path, files.BC_TABLES[kind][1])
        rows = files.scan_bc_table(t.spark, path, kind)
        rows = rows.select(F.lit(kind).alias("kind"), F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in rows.columns]).alias("said"))
        out = rows if out is None else out.unionByName(rows)
    return out


SAID = {"putative": ("putative", "sample, read_id, putative_bc"), "info": ("bc_info", "sample, read_id, bc, bc_qual, umi, umi_qual"), "corrected": ("bc_info", "sample, read_id, bc, bc_qual, umi, umi_qual, bc"), "counts": ("bc_counts", "sample, bc, n")}
query("scan_all_bc_tables", all_tables, " UNION ALL ".join(f"SELECT '{kind}' AS kind, concat_ws('|', {', '.join(f"coalesce(cast({c} AS string), 'none')" for c in columns.split(', '))}) AS said FROM {name}" for kind, (name, columns) in SAID.items()), "putative bc_info bc_counts")


def mex_lines(t: Tables) -> DataFrame:
    """All three files of a sparse matrix, line by line."""
    path = mex(t)
    parts = [t.spark.read.text(f"{path}/{name}").select(F.lit(name).alias("file"), F.col("value").alias("line")) for name in ("matrix.mtx", "features.tsv", "barcodes.tsv")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


MEX = MINI + """, f AS (SELECT feature, row_number() OVER (ORDER BY feature) AS i FROM (SELECT DISTINCT feature FROM mini)), c AS (SELECT cell, row_number() OVER (ORDER BY cell) AS j FROM (SELECT DISTINCT cell FROM mini))
 SELECT 'features.tsv' AS file, feature AS line FROM f UNION ALL SELECT 'barcodes.tsv', cell FROM c UNION ALL SELECT 'matrix.mtx', concat(cast(i AS string), ' ', cast(j AS string), ' ', cast(n AS string)) FROM mini JOIN f USING (feature) JOIN c USING (cell)
 UNION ALL SELECT 'matrix.mtx', '%%MatrixMarket matrix coordinate real general' UNION ALL SELECT 'matrix.mtx', concat((SELECT cast(count(*) AS string) FROM f), ' ', (SELECT cast(count(*) AS string) FROM c), ' ', (SELECT cast(count(*) AS string) FROM mini))"""
query("write_mex_files", mex_lines, MEX)
