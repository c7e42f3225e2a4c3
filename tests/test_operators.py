"""Small hand-written cases, and every registered SQL against its query on the smallest tables."""

from __future__ import annotations

import gzip
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from loomseq.operators import adapters, alignments, barcodes, contigs, dedup, genes, joins, places, qc, quant, reads
from loomseq.plans import fixtures, registry, registry_files, registry_reads, registry_splice  # noqa: F401
from loomseq.functions import seq
from loomseq.functions.seq import ADAPTER
from loomseq.sources import files, shared
from loomseq.streaming.reads import putative_stream

SF = "/root/testdata/sf0.001"
B = "ACGTACGTACGTACGT"


def test_correction_threshold_and_priors(spark):
    near, far = "CCGTACGTACGTACGT", "ACGTACGTACGTACGA"
    info = spark.createDataFrame([("S", "r1", B, "I" * 16, "", ""), ("S", "r2", near, "I" * 16, "", "")], "sample string, read_id string, bc string, bc_qual string, umi string, umi_qual string")
    listed = spark.createDataFrame([("S", near), ("S", far)], "sample string, bc string")
    alone = barcodes.correct_barcodes(info, listed, spark.createDataFrame([("S", near, 3)], "sample string, bc string, n long")).select("read_id", "corrected_bc").collect()
    assert sorted(map(tuple, alone)) == [("r1", near), ("r2", near)]  # a candidate that was never seen has no weight
    even = spark.createDataFrame([("S", near, 3), ("S", far, 3)], "sample string, bc string, n long")
    assert [r.read_id for r in barcodes.correct_barcodes(info, listed, even).collect()] == ["r2"]


def test_barcode_in_neither_orientation_and_short_read(spark):
    pairs = spark.createDataFrame([("S", "a", "TTTT", "IIII", B), ("S", "b", B + "ACG", "I" * 19, B), ("S", "c", "ACGT", "IIII", None)], "sample string, read_id string, seq string, qual string, putative_bc string")
    located = reads.locate_barcode(pairs)
    assert {r.read_id: r.idx for r in located.collect()} == {"a": -1, "b": 0, "c": -1}
    (row,) = reads.extract_read(located).collect()
    assert (row.read_id, row.umi, row.insert_seq) == ("b", "ACG", "")


def test_every_base_has_a_probability(spark):
    rows = spark.createDataFrame([("S", "a", "!+5"), ("S", "b", ""), ("S", "c", None)], "sample string, read_id string, qual string")
    got = {(r.read_id, r.pos): round(r.p, 9) for r in reads.base_probabilities(rows).collect()}
    assert got == {("a", 0): 1.0, ("a", 1): 0.1, ("a", 2): 0.01}


def test_duplicates_of_whole_reads_are_registered():
    assert {"base_probabilities", "read_duplication_levels", "read_overrepresented"} <= registry.SQL.keys()


def test_merge_and_transpose(spark):
    m = spark.createDataFrame([("S", "G1", "c", 1.0), ("S", "G10", "c", 2.0), ("S", "G1", "c", 3.0)], "sample string, feature string, cell string, n double")
    assert sorted(map(tuple, quant.merge_matrices(m.drop("sample")).collect())) == [("G1", "c", 4.0), ("G10", "c", 2.0)]
    assert sorted(quant.transpose_matrix(quant.transpose_matrix(m)).collect()) == sorted(m.collect())


def test_files(spark, tmp_path):
    with gzip.open(tmp_path / "a.fastq.gz", "wt") as f:
        f.write("@r1 x\nACGT\n+\n@III\n@r2\nAC\n+\nII\n")
    got = files.scan_fastq(spark, str(tmp_path / "a.fastq.gz")).orderBy("ordinal").collect()
    assert [(r.read_id, r.description, r.seq, r.qual) for r in got] == [("r1", "x", "ACGT", "@III"), ("r2", "", "AC", "II")]
    (tmp_path / "a.gtf").write_text('chr1\tx\texon\t1\t10\t.\t+\t.\tgene_id "G"; transcript_id "T";\n')
    row = files.scan_gtf(spark, str(tmp_path / "a.gtf")).first()
    assert (row.start, row.end, row.attrs["transcript_id"]) == (0, 10, "T")
    (tmp_path / "a.sam").write_text("@HD\tx\nr\t0\tchr1\t5\t60\t4M\t*\t0\t0\tACGT\tIIII\tCB:Z:AA\n")
    row = files.scan_sam(spark, str(tmp_path / "a.sam")).first()
    assert (row.pos, row.tags) == (4, {"CB": "AA"})
    (tmp_path / "a.fa").write_text(">c1 d\nACGT\nAC\n>c2\nA\n")
    assert sorted(map(tuple, files.scan_contigs(spark, str(tmp_path / "a.fa")).collect())) == [("c1", 6), ("c2", 1)]
    m = spark.createDataFrame([("G1", "c1", 2.0), ("G2", "c2", 1.0)], "feature string, cell string, n double")
    files.write_mex(m, str(tmp_path / "mex"))
    assert sorted(files.scan_mex(spark, str(tmp_path / "mex")).collect()) == sorted(m.collect())
    (tmp_path / "s.csv").write_text("sample,fastq,cell_count\nS,a.fastq.gz,5\nS,b.fq.gz,7\nx y,c.fq.gz,1\n")
    samples, bad = files.scan_samplesheet(spark, str(tmp_path / "s.csv"))
    assert [tuple(r) for r in samples.collect()] == [("S", 5, ["a.fastq.gz", "b.fq.gz"])] and bad.count() == 1


def test_split_by_reference(spark, tmp_path):
    rows = [("01", "a", "chr1", 5), ("01", "b", None, None), ("S", "c", "7", 1), ("S", "c", "7", 1)]
    aln = spark.createDataFrame(rows, "sample string, qname string, ref string, pos int")
    got = files.split_by_reference(aln, str(tmp_path / "parts"))
    assert got.dtypes == aln.dtypes and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, rows))
    assert (tmp_path / "parts" / "sample=S" / "ref=7").is_dir()
    empty = files.split_by_reference(aln.limit(0), str(tmp_path / "none"))
    assert empty.dtypes == aln.dtypes and empty.count() == 0


@pytest.mark.parametrize("name", ["correct_barcodes", "extract_read", "mark_duplicates", "assign_genes", "flagstat", "n50", "cell_qc"])
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from read_parquet('{SF}/lineitem.parquet')")
    got = registry.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    said = con.execute(f"select {', '.join(chr(34) + c + chr(34) for c in columns)} from ({registry.SQL[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, said))


def test_fastq_that_spark_splits(spark, tmp_path):
    """Records come out whole and numbered however the file is split, also where qualities begin with @; a file that ends within a record is refused."""
    for name, end, size in (("a.fastq", "\n", "3333"), ("b.fastq", "\r\n", "501"), ("c.fastq", "\n", "97")):
        want = [(i, f"r{i}", f"d {i}" if i % 2 else "", "ACGT" * (i % 7) + "A" * (i % 5), "@I+"[i % 3] * (4 * (i % 7) + i % 5)) for i in range(2000 if size != "97" else 300)]
        text = "".join(f"@{n}{' ' + d if d else ''}{end}{s}{end}+{end}{q}{end}" for _, n, d, s, q in want)
        (tmp_path / name).write_bytes((text if name != "c.fastq" else text.removesuffix(end)).encode())
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = sorted((r.ordinal, r.read_id, r.description, r.seq, r.qual) for r in files.scan_fastq(spark, str(tmp_path / name)).collect())
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        assert got == want
    for bad in ("@r\nA\n+\nI\n@r2\nA\n", "@r\nA\n+\nI\nx\n", "@r\nA\n+\nI\n@r2\nA\n+"):
        (tmp_path / "z.fastq").write_text(bad)
        with pytest.raises(ValueError, match="no whole records"):
            files.scan_fastq(spark, str(tmp_path / "z.fastq")).count()


def test_fastq_on_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        with gzip.open(tmp_path / "in" / f"{k}.fastq.gz", "wt") as f:
            f.write("".join(f"@r{k}.{i} ch={i}\nACGT\n+\n{'@' if i % 3 else 'I'}III\n" for i in range(50)))
    stream = files.fastq_stream(spark, str(tmp_path / "in"), maxFilesPerTrigger="1")
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 150 and sorted(map(str, got.collect())) == sorted(map(str, files.scan_fastq(spark, str(tmp_path / "in")).collect()))


def test_mex_of_another_program(spark, tmp_path):
    """Names count by their lines, not by their order, and the line of sizes is no entry."""
    (tmp_path / "features.tsv").write_text("GB\tname\nGA\tname\n")
    (tmp_path / "barcodes.tsv").write_text("c2\nc1\n")
    (tmp_path / "matrix.mtx").write_text("%%MatrixMarket matrix coordinate real general\n%\n2 2 2\n1 1 5\n2 2 1\n")
    assert sorted(map(tuple, files.scan_mex(spark, str(tmp_path)).collect())) == [("GA", "c1", 1.0), ("GB", "c2", 5.0)]
    m = spark.createDataFrame([("G2", "c1", 2.0), ("G1", "c3", 1.0)], "feature string, cell string, n double")
    files.write_mex(m, str(tmp_path / "out"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "out" / "matrix.mtx")).collect()]
    assert lines[:3] == ["%%MatrixMarket matrix coordinate real general", "2 2 2", "1 2 1.0"]
    files.write_dense(m, str(tmp_path / "dense"))
    assert sorted(map(tuple, files.scan_dense(spark, str(tmp_path / "dense")).collect())) == [("G1", "c1", 0.0), ("G1", "c3", 1.0), ("G2", "c1", 2.0), ("G2", "c3", 0.0)]
    (tmp_path / "e.tsv").write_text("feature\tcount\nG\t1\n")
    assert files.scan_dense(spark, str(tmp_path / "e.tsv")).count() == 0


def test_gtf_attributes_and_sam_tags(spark, tmp_path):
    (tmp_path / "a.gtf").write_text('c\tx\texon\t1\t9\t.\t-\t.\tgene_id "G;1"; exon_number 2; tag "a"; tag "b"; transcript_id "T";\nc\tx\tgene\t1\t9\t.\t-\t.\t.\n')
    gtf = files.scan_gtf(spark, str(tmp_path / "a.gtf"))
    assert gtf.where("feature = 'exon'").first().attrs == {"gene_id": "G;1", "exon_number": "2", "tag": "a", "transcript_id": "T"}
    assert list(map(tuple, files.exons_of(gtf).collect())) == [("c", "G;1", "T", "-", 0, 9)]
    (tmp_path / "S1.sam").write_text("r\t16\t*\t0\t0\t*\t*\t0\t0\t*\t*\nq\t0\tc\t5\t60\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:2\tCB:Z:AA\n")
    got = {r.qname: (r.sample, r.ref, r.pos, r.nm, r.cb, r.cr) for r in files.scan_sam(spark, str(tmp_path / "S1.sam")).collect()}
    assert got == {"r": ("S1", None, -1, None, None, None), "q": ("S1", "c", 4, 2, "AA", None)}


def test_molecules_begin_at_five_prime(spark):
    rows = [("a", 0, 100, "10M"), ("b", 0, 103, "3S7M"), ("c", 16, 90, "20M"), ("d", 16, 95, "5H10M2N1I1D2M"), ("e", 16, 95, "13M2S3H"), ("f", 0, 100, None)]
    aln = spark.createDataFrame([("S", q, f, "c", p, 9, c, "ACGT", "IIII", "C", "U", "B") for q, f, p, c in rows], "sample string, qname string, flag int, ref string, pos int, mapq int, cigar string, seq string, qual string, cr string, ur string, cb string")
    placed = aln.withColumn("five", alignments.five_prime())
    assert {r.qname: r.five for r in placed.collect()} == {"a": 100, "b": 100, "c": 110, "d": 110, "e": 110, "f": 100}
    assert {r.qname for r in alignments.umi_dedup_exact(placed, place="five").collect()} == {"a", "c"}
    assert {r.qname for r in alignments.mark_duplicates(placed, place="five").where("is_dup").collect()} == {"b", "d", "e", "f"}


def test_alignments_of_one_name_stay_apart(spark):
    aln = spark.createDataFrame([("S", "r", 0, "c1", 10, "20M"), ("S", "r", 256, "c2", 500, "20M")], "sample string, qname string, flag int, ref string, pos int, cigar string")
    exons = spark.createDataFrame([("c1", "G1", "T1", 0, 100), ("c2", "G2", "T2", 400, 600)], "ref string, gene string, transcript string, start_ int, end_ int")
    got = quant.assign_genes(alignments.aligned_blocks(alignments.with_aln_id(aln)), exons)
    assert sorted((r.gene, r["class"]) for r in got.collect()) == [("G1", "unique"), ("G2", "unique")]


def test_contigs_by_minimizers(spark):
    draw = np.random.default_rng(2)
    made = {f"c{i}": "".join(draw.choice(list("ACGT"), 2000)) for i in range(3)}
    turn = lambda x: x[::-1].translate(str.maketrans("ACGT", "TGCA"))
    reads = [("S", "a", made["c0"][500:900]), ("S", "b", turn(made["c1"][100:700])), ("S", "c", "ACGT"), ("S", "d", None), ("S", "e", "N" * 50 + made["c2"][:300])]
    got = contigs.assign_contigs(spark.createDataFrame(reads, "sample string, read_id string, seq string"), spark.createDataFrame(list(made.items()), "ref string, seq string"))
    assert {r.read_id: (r.ref, r.strand) for r in got.collect()} == {"a": ("c0", "+"), "b": ("c1", "-"), "e": ("c2", "+")}


def plain_distances(raw: np.ndarray, pattern: str) -> np.ndarray:
    """Edit distances of a pattern to what ends at each place of equally long rows, by dynamic programming."""
    before = np.zeros((raw.shape[0], raw.shape[1] + 1), int)
    for i, c in enumerate(pattern.encode(), 1):
        row = np.empty_like(before)
        row[:, 0] = i
        for j in range(1, before.shape[1]):
            row[:, j] = np.minimum(np.minimum(before[:, j], row[:, j - 1]) + 1, before[:, j - 1] + (raw[:, j - 1] != c))
        before = row
    return before[:, 1:]


def test_approximate_matching_against_dynamic_programming():
    draw = np.random.default_rng(8)
    alphabet = np.frombuffer(b"ACGTN", np.uint8)
    for length in (1, 20, 300, 700):
        raw = alphabet[draw.choice(5, (10_000 if length == 300 else 300, length), p=[0.24] * 4 + [0.04])]
        for row in raw:  # the adapter with errors somewhere, also across the cuts of windows
            said = [c for c in ADAPTER if draw.random() > 0.04]
            said = "".join(c if draw.random() > 0.08 else draw.choice(list("ACGT")) for c in said).encode()[:length]
            at = int(draw.integers(0, length - len(said) + 1))
            row[at : at + len(said)] = np.frombuffer(said, np.uint8)
        read, end, distance = adapters.match_ends(raw.ravel(), np.arange(len(raw) + 1) * length, ADAPTER, 4)
        want = plain_distances(raw, ADAPTER)
        rows, places = np.nonzero(want <= 4)
        assert sorted(zip(read.tolist(), end.tolist(), distance.tolist(), strict=True)) == sorted(zip(rows.tolist(), (places + 1).tolist(), want[rows, places].tolist(), strict=True))


def test_barcodes_behind_adapters_with_errors(spark):
    turn = lambda x: x[::-1].translate(str.maketrans("ACGT", "TGCA"))
    one, gap, more = ADAPTER[:5] + "T" + ADAPTER[6:], ADAPTER[:8] + ADAPTER[9:], ADAPTER[:12] + "A" + ADAPTER[12:]
    assert one != ADAPTER
    body = lambda bc, tail: bc + "ACGTACGTACGT" + tail + "GATTACA" * 6
    bcs = ["AACCGGTTAACCGGTA", "CATGCATGCATGGGAC", "GGGTCATTACGCAGTA"]
    rows = [("a", "GG" + ADAPTER + body(bcs[0], "T" * 10)), ("b", turn("GG" + one + body(bcs[1], "T" * 10))), ("c", "A" * 5000 + gap + body(bcs[2], "T" * 10)), ("d", more + body(bcs[0], "T" * 10)), ("e", ADAPTER + "ACGT"), ("f", ""), ("g", None)]
    # two adapters as good as each other: what follows the UMI decides
    rows.append(("h", one + body(bcs[0], "ACACACACAC") + one + body(bcs[1], "T" * 10)))
    reads_ = spark.createDataFrame([("S", i, s, s and "".join(chr(40 + k % 30) for k in range(len(s)))) for i, s in rows], "sample string, read_id string, seq string, qual string")
    got = {r.read_id: (r.putative_bc, r.errors) for r in adapters.approximate_barcodes(reads_).collect()}
    assert got == {"a": (bcs[0], 0), "b": (bcs[1], 1), "c": (bcs[2], 1), "d": (bcs[0], 1), "e": (None, None), "f": (None, None), "g": (None, None), "h": (bcs[1], 1)}
    exact = {r.read_id: (r.putative_bc, r.min_q) for r in reads.putative_barcodes(reads_).collect() if r.putative_bc}
    assert exact == {r.read_id: (r.putative_bc, r.min_q) for r in adapters.approximate_barcodes(reads_, most=0).collect() if r.putative_bc}
    five = [("i", one + bcs[0] + "ACGTACGTAC" + "T" * 13 + "GATTACA" + one + bcs[1] + "ACGTACGTAC" + adapters.SWITCH_OLIGO + "GATTACA")]
    reads_ = spark.createDataFrame([("S", i, s, "I" * len(s)) for i, s in five], "sample string, read_id string, seq string, qual string")
    assert adapters.approximate_barcodes(reads_, "10X_5v2").first().putative_bc == bcs[1]


def test_symbols_by_place(spark):
    """Counts in tasks are those of single bases: many samples, null and empty reads, places beyond the kept ones."""
    draw = np.random.default_rng(9)
    rows = [(f"S{i % 11}" if i % 13 else None, "".join(draw.choice(list("ACGTN"), int(draw.integers(0, 50))))) for i in range(400)] + [("S1", None), ("S1", "ACGT" * 5000), ("S2", "\u00e9A")]
    frame = spark.createDataFrame(rows, "sample string, seq string").repartition(3)
    want: dict[tuple, int] = {}
    for s, x in rows:
        for i, b in enumerate((x or "").encode()):
            want[s, i, b] = want.get((s, i, b), 0) + 1
    assert {(r.sample, r.pos, r.code): r.n for r in places.place_counts(frame, "seq").collect()} == want


def test_frequent_reads(spark):
    """All sequences of the share are found, whatever task has them; the summary is never too low by more than it says."""
    draw = np.random.default_rng(10)
    keys = draw.zipf(1.3, 5000).tolist()
    summary = places.Frequent(20)
    for at in range(0, 5000, 300):
        summary.add(keys[at : at + 300])
    true = {k: keys.count(k) for k in set(keys)}
    assert len(summary.counts) <= 20 and summary.lost <= 5000 / 21 and all(n - summary.lost <= summary.counts.get(k, 0) <= n for k, n in true.items())
    rows = [("S", f"ACGT{k}") for k in keys] + [("T", "AA")] * 3 + [("T", None)]
    frame = spark.createDataFrame(rows, "sample string, seq string").repartition(7)
    got = {(r.sample, r.seq): r.n for r in qc.overrepresented(frame, 0.02).collect()}
    assert got == {("S", f"ACGT{k}"): n for k, n in true.items() if n >= 100} | {("T", "AA"): 3}


def test_mean_qualities(spark, monkeypatch):
    draw = np.random.default_rng(14)
    texts = [None, "", "!", "~" * 7] + ["".join(chr(c) for c in draw.integers(33, 127, int(n))) for n in draw.integers(0, 90, 60)] + ["", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, qual string").coalesce(1)
    plain = lambda t: -10 * np.log10(np.mean([10 ** (-(ord(c) - 33) / 10) for c in t])) if t else None
    got = {r.i: r.q for r in frame.select("i", seq.mean_quality(F.col("qual")).alias("q")).collect()}
    assert all((got[i] is None) == (not t) and (not t or abs(got[i] - plain(t)) < 1e-9) for i, t in enumerate(texts))
    monkeypatch.setattr(seq, "LOOKED_UP", 50)  # a batch in many parts gives the same
    import pyarrow as pa

    held = pa.array(["x", None, *texts], pa.string())
    said = seq._mean_error.func(held.slice(2)).to_pylist()
    assert all((a is None) == (not t) and (not t or abs(-10 * np.log10(a) - plain(t)) < 1e-9) for a, t in zip(said, texts, strict=True))


def test_median_by_bins(spark):
    draw = np.random.default_rng(12)
    for n in (1, 2, 7, 1000):
        values = draw.normal(10, 0.02 if n == 7 else 5, n).round(6).tolist()
        frame = spark.createDataFrame([("S", v) for v in values] + [("T", 1.0), ("T", 1.0), ("T", None), ("U", None)], "sample string, q double")
        got = {r.sample: r.median for r in qc.exact_median(frame, "q").collect()}
        assert got.keys() == {"S", "T"} and abs(got["S"] - np.median(values)) < 1e-12 and got["T"] == 1.0


def test_tiles_of_split_fasta(spark, tmp_path):
    """Tiles and lengths of records that Spark splits, whatever their lines; minimizers of tiles are those of whole records."""
    draw = np.random.default_rng(4)
    made = {f"c{i}": "".join(draw.choice(list("ACGTN"), n, p=[0.24] * 4 + [0.04])) for i, n in enumerate([0, 1, 13, 14, 22, 23, 24, 99, 100, 101, 1000, 5003])}
    made["c9"] = "A" * 700 + made["c9"]
    text = "stray\n" + "".join(f">{c} a contig\n" + "\n".join(s[i : i + width] for i in range(0, len(s), width)) + "\n\n" for width, (c, s) in zip([7, 60, 10000] * 4, made.items(), strict=True)) + "> no name\nACGT\n"
    (tmp_path / "a.fa").write_text(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        assert sorted(map(tuple, files.scan_contigs(spark, str(tmp_path / "a.fa")).collect())) == sorted((c, len(s)) for c, s in made.items())
        tiles = files.scan_tiles(spark, str(tmp_path / "a.fa"), 100, 7, 9, piece=33).collect()
        want = {(c, at, min(at + 100, len(s)), max(at - 7, 0), s[max(at - 7, 0) : at + 109]) for c, s in made.items() for at in range(0, len(s), 100)}
        assert {(r.ref, r["first"], r["last"], r.start_, r.seq) for r in tiles} == want and len(tiles) == len(want)
        for k, w in ((14, 10), (5, 3), (4, 1)):
            got = contigs.tile_minimizers(contigs.contig_tiles(spark, str(tmp_path / "a.fa"), k, w, 100), k, w)
            whole = contigs.minimizers(spark.createDataFrame(list(made.items()), "ref string, seq string"), ["ref"], k, w)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_places_against_all_seeds(spark, tmp_path):
    """Fifty contigs and frequent seeds: places by tiles and salts are those of plain counting."""
    draw = np.random.default_rng(6)
    repeat = "".join(draw.choice(list("ACGT"), 60))
    made = {f"c{i:02}": "".join(draw.choice(list("ACGT"), 300)) + repeat + "".join(draw.choice(list("ACGT"), 200)) for i in range(50)}
    (tmp_path / "a.fa").write_text("".join(f">{c}\n{s}\n" for c, s in made.items()))
    turn = lambda x: x[::-1].translate(str.maketrans("ACGT", "TGCA"))
    asked = {f"r{i}": s for i, (a, s) in enumerate((a, x) for c, s in made.items() for a, x in ((0, s[40:240]), (1, turn(s[250:420])), (2, repeat)))}
    rows = spark.createDataFrame([("S", r, s) for r, s in asked.items()], "sample string, read_id string, seq string")
    places: dict[int, list] = {}
    for c, s in made.items():
        for h, at, turned in zip(*contigs.minimizers_of(s, 11, 5), strict=True):
            places.setdefault(int(h), []).append((c, int(at), bool(turned)))
    want = set()
    for r, s in asked.items():
        votes: dict[tuple, int] = {}
        for h, at, turned in zip(*contigs.minimizers_of(s, 11, 5), strict=True):
            for c, there, other in places.get(int(h), []):
                key = c, "-" if turned != other else "+", (there + int(at) if turned != other else there - int(at)) // 500
                votes[key] = votes.get(key, 0) + 1
        best: dict[tuple, int] = {}
        for (c, strand, _), v in votes.items():
            best[c, strand] = max(best.get((c, strand), 0), v)
        want |= {("S", r, c, strand, v) for (c, strand), v in sorted(best.items(), key=lambda x: (-x[1], x[0]))[:3]}
    tiles = contigs.contig_tiles(spark, str(tmp_path / "a.fa"), 11, 5, 128)
    for most in (20_000, 7):
        assert {tuple(r) for r in contigs.assign_contigs(rows, tiles, 11, 5, 3, most=most).collect()} == want


@pytest.mark.parametrize("name", ["knee_ranks", "read_quality_stats", "per_base_content", "overrepresented", "approximate_barcodes", "scan_tiles", "scan_contigs", "merge_replicates", "tag_alignments", "assign_genes_consistent", "assign_spliced_transcripts", "umi_dedup_by_sample", "scan_mex", "feature_regions", "read_distribution", "yield_over_time", "mark_duplicates_five_prime"])
def test_further_sql(spark, name):
    test_sql(spark, name)


def test_reads_on_a_stream(spark, tmp_path):
    """The stateless operators give on a stream, file by file, what they give on the whole table."""
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").select(F.lit("S").alias("sample"), F.col("l_orderkey").cast("string").alias("read_id"), F.concat(F.translate(F.md5(F.col("l_partkey").cast("string")), "0123456789abcdef", "ACGT" * 4), F.lit(ADAPTER), F.translate(F.md5(F.col("l_suppkey").cast("string")), "0123456789abcdef", "ACGT" * 4)).alias("seq"))
    rows = rows.withColumn("qual", F.rpad(F.lit(""), F.length("seq"), "I")).limit(500)
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = putative_stream(stream).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination()
    whole = reads.putative_barcodes(reads.filter_reads(spark.read.parquet(str(tmp_path / "in")), 1, 10))
    got = sorted(map(str, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert got and got == sorted(map(str, whole.collect()))


def test_transcripts_and_estimates(spark):
    """Chains of introns choose transcripts, and the estimates are those of plain expectation maximisation."""
    exons = spark.createDataFrame([("c", "G", "T1", "+", 0, 100), ("c", "G", "T1", "+", 200, 300), ("c", "G", "T1", "+", 400, 500), ("c", "G", "T2", "+", 0, 100), ("c", "G", "T2", "+", 400, 500)], "ref string, gene string, transcript string, strand string, start_ int, end_ int")
    cigars = {"a": (50, "50M100N100M"), "b": (50, "50M300N50M"), "c": (10, "20M"), "d": (52, "50M98N100M"), "e": (60, "30M110N20M")}
    aln = spark.createDataFrame([("S", q, 0, "c", p, c) for q, (p, c) in cigars.items()], "sample string, qname string, flag int, ref string, pos int, cigar string")
    blocks = alignments.aligned_blocks(aln)
    got = sorted((r.qname, r.transcript, r["class"]) for r in quant.assign_transcripts(blocks, quant.assign_genes(blocks, exons), exons).collect())
    assert got == [("a", "T1", "unique"), ("b", "T2", "unique"), ("c", "T1", "ambiguous"), ("c", "T2", "ambiguous"), ("d", "T1", "unique")]
    sets = [{"T1"}, {"T1"}, {"T2"}, {"T1", "T2"}, {"T1", "T2"}, {"T2", "T3"}]
    rows = spark.createDataFrame([("S", "C", str(i), t) for i, x in enumerate(sets) for t in x], "sample string, cell string, qname string, transcript string")
    theta = {t: sum(1 / len(x) for x in sets if t in x) for t in ("T1", "T2", "T3")}
    for _ in range(300):
        theta = {t: sum(theta[t] / sum(theta[u] for u in x) for x in sets if t in x) for t in theta}
    found = {r.transcript: r.n for r in quant.em_quantify(rows, 120, 1e-3).collect()}
    assert abs(sum(found.values()) - len(sets)) < 1e-6 and all(abs(found[t] - theta[t]) < 0.1 for t in theta)


def test_cells_leave_the_loop_as_they_settle(spark):
    """Cells that settle at different rounds have the estimates, rounds and last changes of plain expectation maximisation."""
    draw = np.random.default_rng(13)
    rows = []
    for c in range(12):
        for read in range(int(draw.integers(1, 40))):
            rows += [("S", f"C{c}", f"r{read}", f"T{t}") for t in draw.choice(4, int(draw.integers(1, 2 if c < 3 else 4)), replace=False)]
    tol, rounds = 1e-3, 25
    want, runs = {}, {}
    for c in sorted({r[1] for r in rows}):
        sets: dict[str, set] = {}
        for _, cell, read, t in rows:
            if cell == c:
                sets.setdefault(read, set()).add(t)
        theta = {t: sum(1 / len(x) for x in sets.values() if t in x) for t in set().union(*sets.values())}
        for i in range(1, rounds + 1):
            was, theta = theta, {t: sum(theta[t] / sum(theta[u] for u in x) for x in sets.values() if t in x) for t in theta}
            change = max(abs(theta[t] - was[t]) for t in theta)
            if change <= tol:
                break
        want |= {(c, t): n for t, n in theta.items()}
        runs[c] = (len(sets), len(theta), i, change <= tol)
    estimates, cells = quant.em_run(spark.createDataFrame(rows, "sample string, cell string, qname string, transcript string"), rounds, tol)
    found = {(r.cell, r.transcript): r.n for r in estimates.collect()}
    assert found.keys() == want.keys() and max(abs(found[k] - want[k]) for k in want) < 1e-6
    assert {r.cell: (r.reads, r["transcripts"], r.rounds, r.settled) for r in cells.collect()} == runs and len({i for _, _, i, _ in runs.values()}) > 2


def test_dense_blocks(spark, tmp_path):
    rows = [(f"G{i % 7}", f"c{i % 53:02}", float(i)) for i in range(200)]
    m = spark.createDataFrame(rows, "feature string, cell string, n double")
    files.write_dense(m, str(tmp_path / "blocks"), 10)
    assert sorted(p.name for p in (tmp_path / "blocks").glob("block=*")) == [f"block={i}" for i in range(6)]
    assert max(len(line.split("\t")) for p in (tmp_path / "blocks").rglob("part-*") for line in p.read_text().splitlines()) == 11
    files.write_dense(m, str(tmp_path / "one"), 100)
    wide, one = (sorted(map(tuple, files.scan_dense(spark, str(tmp_path / x)).collect())) for x in ("blocks", "one"))
    sums: dict[tuple, float] = {}
    for g, c, n in rows:
        sums[g, c] = sums.get((g, c), 0.0) + n
    assert wide == one == sorted((g, c, sums.get((g, c), 0.0)) for g in {r[0] for r in rows} for c in {r[1] for r in rows})
    files.write_dense(m.limit(0), str(tmp_path / "none"))
    assert files.scan_dense(spark, str(tmp_path / "none")).count() == 0


def test_files_as_callers_write_them(spark, tmp_path):
    (tmp_path / "S7.csv").write_text("read_id,putative_bc,putative_bc_min_q,a,b,c,d\nr1,ACGT,12,,x,,\nr2,,,,,,\n")
    assert sorted(map(tuple, files.scan_bc_table(spark, str(tmp_path / "S7.csv"), "calls").collect())) == [("S7", "r1", "ACGT", 12), ("S7", "r2", None, None)]
    headers = lambda *x: spark.createDataFrame(list(enumerate(x)), "ordinal int, header string")
    assert [seq.header_delimiter(headers(*x)) for x in ((">T1 a", ">T2;x;y|z", ">T3|x"), (">T|a;b",), (">T a",))] == [";", "|", ""]
    (tmp_path / "S1.sam").write_text("r\t1\tc\t5\t60\t4M\td\t9\t0\tACGT\tIIII\nr\t1\tc\t5\t3\t4M\t=\t9\t0\tACGT\tIIII\nq\t257\tc\t5\t60\t4M\td\t9\t0\tACGT\tIIII\n")
    (row,) = alignments.flagstat_mates(files.scan_sam(spark, str(tmp_path / "S1.sam"))).collect()
    assert (row.mate_elsewhere, row.mate_elsewhere_q5) == (1, 1)


def test_reads_a_cell_to_two_places(spark):
    cells = spark.createDataFrame([("S", f"c{i}", 1.0, i) for i in range(8)], "sample string, cell string, n_count double, n_feature long")
    features = spark.createDataFrame([("S", "G"), ("S", "H")], "sample string, feature string")
    for total, mean in ((1, 0.12), (3, 0.38), (8, 1.0), (17, 2.12)):
        stats = spark.createDataFrame([("S", total)], "sample string, total long")
        (row,) = qc.cell_summary(cells, features, stats, "gene").collect()
        assert tuple(row) == ("S", "gene", 8, mean, 3.5, 2)


def greedy(counts: dict[str, int]) -> dict[str, str]:
    """UMI -> the UMI of its cluster: from the most frequent on, a cluster takes in neighbours one base away that are rare enough."""
    found: dict[str, str] = {}
    for head in sorted(counts, key=lambda u: (-counts[u], u)):
        if head in found:
            continue
        found[head], todo = head, [head]
        while todo:
            a = todo.pop()
            near = (a[:i] + base + a[i + 1 :] for i in range(len(a)) for base in "ACGTN")
            for b in near:
                if b in counts and b not in found and counts[a] >= 2 * counts[b] - 1:
                    found[b] = head
                    todo.append(b)
    return found


def test_directional_against_greedy_clusters(spark):
    """Random places with few letters, so that clusters touch; other letters and lengths, null and empty UMIs too."""
    draw = np.random.default_rng(11)
    rows = []
    for place in range(30):
        for i in range(int(draw.integers(1, 120))):
            umi = "".join(draw.choice(list("ACN" if place % 3 else "AC"), int(draw.integers(3, 6)), p=[0.6, 0.3, 0.1] if place % 3 else [0.7, 0.3]))
            rows.append(("S", f"r{place}.{i}", 0, "c", place, int(draw.integers(5)), "B" if place % 4 else None, umi))
    rows += [("S", "x1", 0, "c", 99, 1, "B", None), ("S", "x2", 0, "c", 99, 1, "B", ""), ("S", "x3", 0, "c", 99, 1, "B", "RA"), ("S", "x4", 0, "c", 99, 1, "B", "AA")]
    aln = spark.createDataFrame(rows, "sample string, qname string, flag int, ref string, pos int, mapq int, cr string, ur string")
    want = set()
    for place in {r[4] for r in rows}:
        own = [r for r in rows if r[4] == place]
        counts = {}
        for r in own:
            counts[r[7]] = counts.get(r[7], 0) + 1
        head = greedy({u: n for u, n in counts.items() if u}) | {u: u for u in counts if not u}
        for u in set(head.values()):
            want.add((place, u, min((-r[5], r[1]) for r in own if head[r[7]] == u)[1]))
    assert {(r.pos, r.ur, r.qname) for r in dedup.umi_dedup_directional(aln).collect()} == want
    assert dedup.umi_dedup_directional(aln.limit(0)).count() == 0


def test_chains_of_two_references(spark):
    """A read that is unique on two references has transcripts on both, with and without ids of alignments; none is lost."""
    exons = spark.createDataFrame([("c1", "G1", "T1", "+", 0, 100), ("c1", "G1", "T1", "+", 200, 300), ("c2", "G2", "T2", "-", 400, 500), ("c2", "G2", "T2", "-", 600, 700)], "ref string, gene string, transcript string, strand string, start_ int, end_ int")
    aln = spark.createDataFrame([("S", "r", 0, "c1", 80, "20M100N30M"), ("S", "r", 256, "c2", 480, "20M100N30M"), ("S", "s", 16, "c2", 480, "20M60N30M"), ("S", "t", 0, "c2", 5, "9M")], "sample string, qname string, flag int, ref string, pos int, cigar string")
    blocks = alignments.aligned_blocks(alignments.with_aln_id(aln))
    genes = quant.assign_genes(blocks, exons)
    got = quant.assign_transcripts(blocks, genes, exons)
    assert sorted((r.qname, r.transcript, r["class"]) for r in got.collect()) == [("r", "T1", "unique"), ("r", "T2", "unique")]
    one = blocks.where("ref = 'c1' or qname <> 'r'").drop("aln_id")
    got = quant.assign_transcripts(blocks.drop("aln_id"), quant.assign_genes(one, exons), exons)
    assert sorted((r.qname, r.transcript) for r in got.collect()) == [("r", "T1")]
    kinds = {(r.qname, r.gene): r["class"] for r in quant.assign_genes(blocks, exons, delta=6).collect()}
    assert kinds == {("r", "G1"): "unique", ("r", "G2"): "unique", ("s", "G2"): "inconsistent", ("t", None): "none"}
    sided = lambda x: {(r.qname, r.gene) for r in quant.assign_genes(blocks, exons, x).collect() if r.gene}
    assert sided("forward") == {("r", "G1"), ("s", "G2")} and sided("reverse") == {("r", "G2")}


def test_files_of_one_name(spark):
    rows = [("file:///w/a/reads.fastq.gz", "r1"), ("file:///w/b/reads.fastq.gz", "r2"), ("file:///w/c/reads.fastq.gz", "r3"), ("file:///w/x.fq.gz", "r4")]
    reads_ = spark.createDataFrame([(f, 0, n, "", "A", "I") for f, n in rows], "file string, ordinal long, read_id string, description string, seq string, qual string")
    sheet = lambda *x: spark.createDataFrame(list(x), "sample string, fastqs array<string>")
    got = lambda *x: sorted((r.sample, r.read_id) for r in files.merge_replicates(sheet(*x), reads_).collect())
    assert got(("A", ["a/reads.fastq.gz"]), ("B", ["s3://store/b/reads.fastq.gz", "x.fq.gz"])) == [("A", "r1"), ("B", "r2"), ("B", "r4")]
    with pytest.raises(ValueError, match="list more of its path"):
        files.merge_replicates(sheet(("A", ["reads.fastq.gz"]), ("B", ["reads.fastq.gz"])), reads_)


def test_names_with_underscores_keep_their_tags(spark):
    info = spark.createDataFrame([("S", "m_1_read", B, "q", "ACGT", "q", B), ("S", "m", B, "q", "TTTT", "q", B)], "sample string, read_id string, bc string, bc_qual string, umi string, umi_qual string, corrected_bc string")
    aln = spark.createDataFrame([("S", "m_1_read", 0), ("S", f"m_1_read_{B}_ACGT", 16), ("S", "m", 4), ("S", "m_2", 0)], "sample string, qname string, flag int")
    got = {(r.flag, r.qname, r.ur) for r in alignments.tag_alignments(aln, info).collect()}
    assert got == {(0, f"m_1_read_{B}_ACGT", "ACGT"), (16, f"m_1_read_{B}_ACGT", "ACGT"), (4, f"m_{B}_TTTT", "TTTT")}


def test_identity_of_two_alignments(spark):
    aln = spark.createDataFrame([("S", "r", 0, "c", 10, "20M", 2), ("S", "r", 256, "c", 90, "3S20M2H", 0)], "sample string, qname string, flag int, ref string, pos int, cigar string, nm int")
    got = alignments.percent_identity(alignments.aligned_blocks(aln), aln)
    assert sorted(r.identity for r in got.collect()) == [90.0, 100.0]
    assert sorted((r.aligned, r.soft_clipped, r.hard_clipped) for r in alignments.alignment_lengths(aln).collect()) == [(20, 0, 0), (20, 3, 2)]
    assert {(r.percent, r.n) for r in alignments.identity_distribution(got).collect()} == {(90, 1), (100, 1)}


def test_bases_of_a_gene_count_once(spark):
    """A gene whose transcripts share an exon has no more bases there than one with a single transcript."""
    exons = spark.createDataFrame([("c", "G1", "T1", 0, 60), ("c", "G1", "T2", 10, 60), ("c", "G1", "T3", 60, 70), ("c", "G2", "T4", 0, 80), ("c", "G3", "T5", 500, 600)], "ref string, gene string, transcript string, start_ int, end_ int")
    assert sorted(map(tuple, quant.merged_exons(exons, ["ref", "gene"]).collect())) == [("c", "G1", 0, 70), ("c", "G2", 0, 80), ("c", "G3", 500, 600)]
    aln = spark.createDataFrame([("S", "a", 0, "c", 5, "75M"), ("S", "b", 0, "c", 5, "50M"), ("S", "d", 0, "c", 550, "10M"), ("S", "e", 0, "c", 900, "10M")], "sample string, qname string, flag int, ref string, pos int, cigar string")
    got = {r.qname: (r.gene, r["class"]) for r in quant.assign_genes(alignments.aligned_blocks(aln), exons).collect()}
    assert got == {"a": ("G2", "unique"), "b": ("G1", "ambiguous"), "d": ("G3", "unique"), "e": (None, "none")}


def test_hot_keys_of_a_shuffled_join(spark):
    """A table too large to send is joined by salts: the same rows, also of keys that most rows have, and of none."""
    rows = spark.range(1000).select("id", F.when(F.col("id") % 10 > 0, 1).otherwise(F.col("id")).alias("k"))
    table = spark.createDataFrame([(1, "a"), (1, "b"), (20, "c"), (5000, "d")], "k long, v string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert sorted(map(str, joins.spread_join(rows, table, ["k"], how, most=1).collect())) == sorted(map(str, rows.join(table, "k", how).collect()))


def test_large_tables_of_a_spread_join_stay_off_the_driver(spark):
    """Lookups of 100,000 barcodes are shuffled, once each; without Spark's splitting of skewed partitions, by salts."""
    rows, table = spark.range(1000).withColumnRenamed("id", "k"), spark.range(0, 200_000, 2).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 20).alias("v"))
    want = sorted(map(str, rows.where("k % 2 = 0").withColumn("v", F.repeat(F.lit("x"), 20)).collect()))
    got, hint = joins.spread_join(rows, table, ["k"]), spark.conf.get("spark.sql.adaptive.enabled")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, got.collect())) == want and "broadcast" not in plan and "explode" not in plan
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = joins.spread_join(rows, table, ["k"])
        assert "explode" in got._jdf.queryExecution().optimizedPlan().toString() and sorted(map(str, got.collect())) == want
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", hint)


def test_directional_on_a_table(spark):
    rows = [("a", 0, "AAAA", 5), ("b", 0, "AAAA", 9), ("c", 0, "AAAA", 1), ("d", 0, "AAAT", 60), ("e", 0, "TTTT", 3), ("f", 16, "AAAA", 2), ("g", 4, "AAAA", 60)]
    aln = spark.createDataFrame([("S", q, f, "c", 100, m, "B", u) for q, f, u, m in rows], "sample string, qname string, flag int, ref string, pos int, mapq int, cr string, ur string")
    got = sorted((r.strand, r.ur, r.qname) for r in dedup.umi_dedup_directional(aln).collect())
    assert got == [("+", "AAAA", "d"), ("+", "TTTT", "e"), ("-", "AAAA", "f")]
    assert sorted(map(tuple, dedup.umi_distances(aln).collect())) == [("S", 2, 1)]


def test_neighbours_beyond_four_letters(spark):
    """Barcodes of any letters, and of another length, against all pairs."""
    listed = ["ACGTACGTACGTACGT", "ACGTACGTACGTACGA", "NCGTACGTACGTACGT", "RCGTACGTACGTACGT", "ACGTACGTACGTAC", "TTTTACGTACGTACGT"]
    asked = ["ACGTACGTACGTACGT", "RRGTACGTACGTACGT", "ACGTACGTACGTACG"]
    near = lambda a, b: len(a) == len(b) == 16 and 1 <= sum(x != y for x, y in zip(a, b, strict=True)) <= 2
    q, w = (spark.createDataFrame([("S", x) for x in xs], "sample string, bc string") for xs in (asked, listed))
    got = sorted((r.bc, r.cand) for r in barcodes.hamming_neighbours(q, w).collect())
    assert got == sorted((a, b) for a in asked for b in listed if near(a, b))


def test_what_operators_wrote_is_cleared(spark):
    table = shared.written(spark.range(5), "five")
    folder = table.inputFiles()[0].rsplit("/", 2)[0].removeprefix("file://")
    assert Path(folder).is_dir() and shared.clear(spark) >= 1 and not Path(folder).exists() and shared.clear(spark) == 0
    fixtures._written.clear()  # the derived tables went as well


def test_written_tables_are_small_and_leave_no_shuffles(spark):
    files_ = lambda: {b.toString() for b in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks()) if b.toString().startswith("shuffle_")}
    before, was = files_(), spark.conf.get(shared.CLEANUP, None)
    table = shared.written(spark.range(20_000).groupBy((F.col("id") % 5000).alias("k")).agg(F.count("*").alias("n")), "kept")
    assert not files_() - before and spark.conf.get(shared.CLEANUP, None) == was
    assert table.count() == 5000 and table.where("n <> 4").isEmpty()
    part = next(Path(table.inputFiles()[0].removeprefix("file://")).parent.glob("part-*.parquet"))
    assert part.name.endswith(".zstd.parquet")


def test_genes_by_row_against_blocks(spark, monkeypatch):
    """Genes, classes and transcripts of alignments by their own rows, without shuffling them, are those of joined blocks."""
    rng = np.random.default_rng(5)
    exons = []
    for g in range(60):
        at = int(rng.integers(0, 60_000))
        for k in range(int(rng.integers(1, 4))):
            exons += [(f"c{g % 3}", f"G{g}", f"T{g}.{k}", "+-"[g % 2], at + 400 * i + int(rng.integers(0, 3)) * 20, at + 400 * i + 100 + int(rng.integers(0, 200))) for i in range(4)]
    exons += [("c0", "Whole", "W", "+", 0, 10), ("c0", "Whole", "W", "+", 69_990, 70_000)]
    exons = spark.createDataFrame(exons, "ref string, gene string, transcript string, strand string, start_ int, end_ int")
    cigars = ["50M", "3S40M300N30M2I10D20M", "20M380N60M320N40M", "5H", "900M17000N30M", None]
    rows = [("S", f"r{i}", int(rng.choice([0, 16, 256, 4])), f"c{rng.integers(0, 4)}", int(rng.integers(0, 60_000)), cigars[int(rng.integers(0, 6))], f"B{i % 7}") for i in range(3000)]
    aln = alignments.with_aln_id(spark.createDataFrame(rows, "sample string, qname string, flag int, ref string, pos int, cigar string, cb string")).repartition(3)
    blocks, own = alignments.aligned_blocks(aln), ["qname", "aln_id", "gene", "class"]
    monkeypatch.setattr(genes, "PAIRS", 64)
    for stranded in ("none", "forward", "reverse"):
        want = sorted(map(str, quant.assign_genes(blocks, exons, stranded).select(*own).collect()))
        placed = genes.place_alignments(aln, exons, stranded)
        assert "Exchange hash" not in placed._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, placed.select(*own).collect())) == want and len({x.split("class=")[1] for x in want}) == 4
        assert sorted(map(str, genes.place_alignments(aln, exons, stranded, most=1).select(*own).collect())) == want
    placed = genes.with_transcripts(genes.place_alignments(aln, exons), exons, 20)
    want = quant.assign_transcripts(blocks, quant.assign_genes(blocks, exons), exons, 20)
    assert sorted(map(str, placed.select("qname", F.explode("transcripts").alias("transcript")).collect())) == sorted(map(str, want.select("qname", "transcript").collect()))
    want = quant.assign_genes(blocks, exons, delta=20).select(*own)
    assert sorted(map(str, genes.by_splicing(placed).select(*own).collect())) == sorted(map(str, want.collect()))
    want = quant.count_matrix(quant.assign_genes(blocks, exons), aln.select("sample", "qname", "aln_id", "cb"))
    assert sorted(map(str, quant.count_matrix(placed).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("name", ["count_matrix_shared", "count_matrix_inconsistent", "em_spliced", "em_cells", "cell_summary", "cell_summary_by_type", "count_matrix"])
def test_sql_of_alignments_by_row(spark, name):
    test_sql(spark, name)


def test_distances_of_several_umis_only(spark):
    """UMIs alone at their place are never taken apart; places without a cell, repeated and empty UMIs count as they are."""
    rows = [(f"C{i}", "ACGTACGTACGT") for i in range(2000)] + [("D", "AAAA"), ("D", "AATT"), ("D", "AATT"), (None, "AAAA"), (None, "TTTT"), ("E", ""), ("E", "ACGT"), ("F", None), ("F", "ACGT")]
    aln = spark.createDataFrame([("S", f"r{i}", 0, "c", 5, c, u) for i, (c, u) in enumerate(rows)], "sample string, qname string, flag int, ref string, pos int, cr string, ur string")
    found = dedup.umi_distances(aln)
    below = found._jdf.queryExecution().optimizedPlan().toString().split("Generate posexplode")
    assert sorted(map(tuple, found.collect())) == [("S", 2, 1), ("S", 4, 1)] and "Join" in below[1]


def test_minimizers_of_many_sequences(spark):
    """All sequences of a batch at once, against each by itself; and reads without those that no contig has."""
    rng = np.random.default_rng(3)
    seqs = ["".join(rng.choice(list("ACGTacgtN"), int(n), p=[0.12] * 8 + [0.04])) for n in rng.integers(0, 120, 400)] + ["", "A" * 60, "ACGT" * 30, "é" * 40 + "ACGTTGCATTGACCAGTA"]
    for k, w in ((14, 5), (6, 10), (3, 1)):
        found = contigs.minimizers_of_all(seqs, k, w)
        got = sorted(zip(*[x.tolist() for x in found], strict=True))
        want = []
        for i, x in enumerate(seqs):
            h, at, turned = contigs.minimizers_of(x, k, w)
            n = len(x) - k + 1
            every = {int(p) for p in at}
            want += list(zip([i] * len(h), h.tolist(), at.tolist(), turned.tolist(), strict=True))
            assert n >= 1 or not every
        assert got == sorted(want)
    reads_ = spark.createDataFrame([("S", f"r{i}", x) for i, x in enumerate(seqs)], "sample string, read_id string, seq string")
    some = spark.createDataFrame([(f"c{i}", x) for i, x in enumerate(seqs[:5])], "ref string, seq string")
    places_ = shared.written(contigs.minimizers(some, ["ref"], 14, 5), "p")
    seeds = contigs.minimizers(reads_, ["sample", "read_id"], 14, 5)
    fewer = contigs.minimizers(reads_, ["sample", "read_id"], 14, 5, contigs.places_held(places_))
    assert fewer.count() < seeds.count() / 10
    assert sorted(map(str, fewer.join(places_.select("h").distinct(), "h").collect())) == sorted(map(str, seeds.join(places_.select("h").distinct(), "h").collect()))


def test_dense_lines_are_split_once(spark, tmp_path):
    """Nothing above the explosion of a line's counts splits the line again for each of them."""
    counts = spark.createDataFrame([("G1", "A", 1.0), ("G2", "B", 2.0)], "feature string, cell string, n double")
    files.write_dense(counts, str(tmp_path / "dense"))
    found = files.scan_dense(spark, str(tmp_path / "dense"))
    above = found._jdf.queryExecution().optimizedPlan().toString().split("Generate posexplode")[0]
    assert "split(" not in above
    assert sorted(map(tuple, found.collect())) == [("G1", "A", 1.0), ("G1", "B", 0.0), ("G2", "A", 0.0), ("G2", "B", 2.0)]
