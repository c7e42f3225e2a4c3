"""Queries of reads with errors, per-place tables and repeated reads, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.seq import ADAPTER
from ..operators import adapters
from . import registry
from .registry import REV, Tables, query

# reads whose adapter has a wrong, a missing or a further base, or two of these
HURT = "CASE WHEN substr(m, 15, 1) < '3' THEN concat(substr(o, 1, 4), 'G', substr(o, 6)) WHEN substr(m, 15, 1) < '5' THEN concat(substr(o, 1, 9), substr(o, 11)) WHEN substr(m, 15, 1) < '7' THEN concat(substr(o, 1, 12), 'A', substr(o, 13)) WHEN substr(m, 15, 1) < '9' THEN concat(substr(o, 1, 3), 'T', substr(o, 5, 10), substr(o, 16)) ELSE o END"
DAMAGED = f"""oriented_reads AS (SELECT sample, read_id, m, qual, substr(m, 5, 1) < '8' AS ahead, CASE WHEN substr(m, 5, 1) < '8' THEN seq ELSE {REV} END AS o FROM fx),
hurt AS (SELECT *, {HURT} AS seq FROM oriented_reads),
damaged AS (SELECT sample, read_id, CASE WHEN ahead THEN seq ELSE {REV} END AS seq, substr(concat(qual, qual), 1, cast(length(seq) AS int)) AS qual FROM hurt)"""
registry.CTE["damaged"] = DAMAGED


def damaged(t: Tables) -> DataFrame:
    return adapters.approximate_barcodes(t.damaged, "10X_3v3", 2)


FOUND = f""", both_ways AS (SELECT sample, read_id, 0 AS turned, seq AS o, qual AS q FROM damaged UNION ALL SELECT sample, read_id, 1, {REV}, reverse(qual) FROM damaged),
 ends AS (SELECT *, unnest(range(20, length(o) - 15)) AS e FROM both_ways),
 near AS (SELECT *, list_min(list_transform(range(greatest(e - 24, 0), e - 19), lambda s: levenshtein(o[s + 1 : e], '{ADAPTER}'))) AS errors FROM ends),
 tails AS (SELECT *, len(list_filter(range(1, 11), lambda j: substr(o, cast(e + 28 + j AS int), 1) <> 'T')) AS wrong FROM near WHERE errors <= 2),
 best AS (SELECT * FROM tails QUALIFY row_number() OVER (PARTITION BY sample, read_id ORDER BY errors, wrong, turned, e) = 1)
 SELECT d.sample, d.read_id, o[e + 1 : e + 16] AS putative_bc, cast(list_min(list_transform(range(1, 17), lambda i: ascii(substr(q, cast(e + i AS int), 1)) - 33)) AS int) AS min_q, cast(errors AS int) AS errors FROM damaged d LEFT JOIN best ON best.sample = d.sample AND best.read_id = d.read_id"""
query("approximate_barcodes", damaged, FOUND, "damaged")
