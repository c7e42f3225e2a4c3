"""Column expressions over sequences and qualities."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

IUPAC, COMPLEMENT = "ACGTRYKMBVDHNSWacgtrykmbvdhnsw", "TGCAYRMKVBHDNSWtgcayrmkvbhdnsw"
#: Kits: barcode, UMI and poly-T lengths. Fixed values of the chemistry.
KITS = {"10X_3v3": (16, 12, 10), "10X_3v4": (16, 12, 10), "10X_5v2": (16, 10, 10), "10X_5v3": (16, 12, 10)}
ADAPTER = "CTACACGACGCTCTTCCGATCT"


def reverse_complement(seq: Column) -> Column:
    return F.translate(F.reverse(seq), IUPAC, COMPLEMENT)


def error_probability(char: Column) -> Column:
    """Of one Phred+33 character."""
    return F.pow(F.lit(10.0), -(F.ascii(char) - 33) / 10.0)


def chars(x: Column) -> Column:
    return F.filter(F.split(x, ""), lambda c: c != "")


#: Bytes that are looked up at once (a string is never cut).
LOOKED_UP = 1 << 20
#: Error probability of each byte of a Phred+33 string.
_ERROR = 10.0 ** (-(np.arange(256) - 33) / 10.0)


@F.arrow_udf(DoubleType())
def _mean_error(qual: pa.Array) -> pa.Array:
    """Mean error probability of each string: one look-up a byte on the batch's own buffer; null for null and empty strings."""
    if not len(qual):
        return pa.array([], pa.float64())
    qual = qual.cast(pa.large_binary())
    ends = np.frombuffer(qual.buffers()[1], np.int64)[qual.offset : qual.offset + len(qual) + 1]
    raw = np.frombuffer(qual.buffers()[2] or b"", np.uint8)
    sizes = np.diff(ends)
    means = np.full(len(qual), np.nan)
    some = np.flatnonzero(sizes)
    # strings whose bytes are looked up together
    for rows in np.split(some, np.flatnonzero(np.diff(ends[some] // LOOKED_UP)) + 1) if len(some) else []:
        first = ends[rows[0]]
        means[rows] = np.add.reduceat(_ERROR[raw[first : ends[rows[-1] + 1]]], ends[rows] - first) / sizes[rows]
    return pa.array(means, pa.float64(), from_pandas=True)


def mean_quality(qual: Column) -> Column:
    """Phred value of the mean error probability; null where there are no bases."""
    return -10 * F.log10(_mean_error(qual))


def kit_column(kit: Column, part: int) -> Column:
    out = None
    for name, lengths in KITS.items():
        out = (F.when if out is None else out.when)(kit == name, lengths[part])
    return out


def transcript_id(header: Column, delimiter: str = "") -> Column:
    """The transcript of a FASTA header: its first word without ``>``, cut at the delimiter where one is given."""
    first = F.regexp_extract(header, r"^>?(\S*)", 1)
    return F.substring_index(first, delimiter, 1) if delimiter else first


def header_delimiter(headers: DataFrame, header: str = "header", order: str = "ordinal") -> str:
    """What cuts transcripts from the rest of FASTA headers: of ``|`` and ``;`` the one that the first header with either has
    more often, ``|`` where both are as many; the empty string, for white space alone, where none has any."""
    first = headers.where(F.col(header).rlike("[|;]")).agg(F.min(F.struct(order, header)).alias("x")).first().x
    if first is None:
        return ""
    return "|" if first[header].count("|") >= first[header].count(";") else ";"
