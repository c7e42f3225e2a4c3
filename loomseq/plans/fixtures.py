"""Sequencing tables derived from ``lineitem`` by hashing, in SQL that Spark and DuckDB evaluate alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.seq import COMPLEMENT, IUPAC
from ..sources.shared import new_path, save

_HEX, _B4, _Q = "0123456789abcdef", "ACGTACGTACGTACGT", "$&(*,.02468:<>@B"
_dna = lambda x: f"translate({x}, '{_HEX}', '{_B4}')"
_qual = lambda x: f"translate({x}, '{_HEX}', '{_Q}')"
_revcomp = lambda x: f"translate(reverse({x}), '{IUPAC}', '{COMPLEMENT}')"

#: Common table expressions up to ``fx``: one row for each read with all that the tables below need.
FX = f"""WITH base AS (SELECT DISTINCT l_orderkey AS o, l_linenumber AS n, l_partkey AS p, l_suppkey AS s FROM lineitem),
hashed AS (SELECT *, concat_ws('-', cast(o AS string), cast(n AS string), cast(p AS string), cast(s AS string)) AS read_id FROM base),
digest AS (SELECT *, md5(read_id) AS m, {_dna("substr(md5(concat('c', cast(s - s % 2 AS string))), 1, 16)")} AS t0 FROM hashed),
cells AS (SELECT *, CASE WHEN s % 2 = 1 THEN concat(translate(substr(t0, 1, 1), 'ACGT', 'CGTA'), substr(t0, 2)) ELSE t0 END AS tb, 1 + ascii(substr(m, 1, 1)) % 16 AS p1, 1 + ascii(substr(m, 2, 1)) % 16 AS p2 FROM digest),
err1 AS (SELECT *, CASE WHEN substr(m, 3, 1) < '4' THEN concat(substr(tb, 1, p1 - 1), translate(substr(tb, p1, 1), 'ACGT', 'CGTA'), substr(tb, p1 + 1)) ELSE tb END AS b1 FROM cells),
err2 AS (SELECT *, CASE WHEN substr(m, 4, 1) < '2' THEN concat(substr(b1, 1, p2 - 1), translate(substr(b1, p2, 1), 'ACGT', 'GTAC'), substr(b1, p2 + 1)) ELSE b1 END AS bc,
 {_dna("substr(md5(concat('u', cast(p % 50 AS string), '-', cast(o % 7 AS string))), 1, 12)")} AS u0, substr({_dna("concat(md5(concat('x', m)), md5(concat('y', m)))")}, 1, cast(20 + p % 45 AS int)) AS ins FROM err1),
oriented AS (SELECT *, CASE WHEN substr(m, 9, 1) < '1' THEN concat(translate(substr(u0, 1, 1), 'ACGT', 'CGTA'), substr(u0, 2)) ELSE u0 END AS umi FROM err2),
whole AS (SELECT *, concat('CTACACGACGCTCTTCCGATCT', bc, umi, 'TTTTTTTTTT', ins) AS fwd FROM oriented),
fx AS (SELECT read_id, m, concat('S', cast(o % 2 AS string)) AS sample, tb, s AS cell_no, bc, umi, ins,
 {_qual("substr(md5(concat('q', m)), 1, 16)")} AS bc_qual, {_qual("substr(md5(concat('r', m)), 1, 12)")} AS umi_qual,
 CASE WHEN substr(m, 5, 1) < '8' THEN fwd ELSE {_revcomp("fwd")} END AS seq,
 substr({_qual("concat(md5(concat('s', m)), md5(concat('t', m)), md5(concat('v', m)), md5(concat('w', m)))")}, 1, cast(length(fwd) AS int)) AS qual,
 concat('chr', cast(p % 50 % 5 AS string)) AS ref, cast((p % 50) * 1000 + p % 3 AS int) AS pos, p % 50 AS gene_no,
 cast(CASE WHEN substr(m, 6, 1) < '1' THEN 4 ELSE (CASE WHEN substr(m, 7, 1) < '8' THEN 0 ELSE 16 END) + (CASE WHEN substr(m, 8, 1) < '1' THEN 256 ELSE 0 END) END AS int) AS flag,
 cast(ascii(substr(m, 11, 1)) % 60 AS int) AS mapq,
 CASE WHEN substr(m, 10, 1) < '4' THEN concat('10M400N', cast(length(ins) - 10 AS string), 'M') ELSE concat(cast(length(ins) AS string), 'M') END AS cigar,
 cast(length(ins) % 5 AS int) AS nm FROM whole)"""

READS = "reads AS (SELECT sample, read_id, seq, qual FROM fx)"
PUTATIVE = "putative AS (SELECT sample, read_id, CASE WHEN substr(m, 12, 1) = '0' THEN NULL ELSE bc END AS putative_bc FROM fx)"
BC_INFO = "bc_info AS (SELECT sample, read_id, bc, bc_qual, umi, umi_qual FROM fx)"
WHITELIST = "whitelist AS (SELECT DISTINCT sample, tb AS bc FROM fx WHERE cell_no % 7 <> 0)"
COUNTS = "bc_counts AS (SELECT sample, bc, count(*) AS n FROM fx GROUP BY sample, bc)"
ALN = "aln AS (SELECT sample, read_id AS qname, flag, ref, pos, mapq, cigar, ins AS seq, substr(qual, 1, cast(length(ins) AS int)) AS qual, nm, bc AS cr, umi AS ur, tb AS cb FROM fx)"
GENES = "genes AS (SELECT DISTINCT ref, cast(gene_no AS int) AS g FROM fx)"
EXONS = "exons AS (SELECT ref, concat('G', cast(g AS string)) AS gene, concat('T', cast(g AS string), '.', k) AS transcript, CASE WHEN g % 2 = 0 THEN '+' ELSE '-' END AS strand, cast(g * 1000 + a AS int) AS start_, cast(g * 1000 + b AS int) AS end_ FROM genes CROSS JOIN (SELECT '1' AS k, -20 AS a, 60 AS b UNION ALL SELECT '1', 405, 520 UNION ALL SELECT '2', -20, 45 UNION ALL SELECT '2', 450, 700) e)"


def sql(spark: SparkSession, sf_dir: str, tail: str) -> DataFrame:
    """Common table expressions and a query over ``lineitem`` of a folder, in Spark."""
    return spark.sql(tail.replace("FROM lineitem", "FROM {lineitem}"), lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


_written: dict[tuple[str, str], str] = {}


def written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx`` of a folder, written to the shared folder when it is first asked for."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        path = new_path(spark, "fx")
        save(sql(spark, sf_dir, f"{FX} SELECT * FROM fx"), path)
        _written[key] = path
    return spark.read.parquet(_written[key])
