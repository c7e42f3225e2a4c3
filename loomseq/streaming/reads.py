"""The stateless read operators on streams: they are column expressions, so a stream of reads runs through them as it is."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.reads import filter_reads, putative_barcodes


def putative_stream(reads: DataFrame, min_length: int = 1, min_q: float = 10) -> DataFrame:
    return putative_barcodes(filter_reads(reads, min_length, min_q))
