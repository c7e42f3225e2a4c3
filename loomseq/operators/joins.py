"""Joins whose keys may be hot: the smaller side is counted, then broadcast, or shuffled with skewed partitions split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows (up to some hundred bytes each, so some megabytes) of a written table that are sent to every executor. They pass through the driver.
MOST_ROWS = 20_000
SALTS = 16


def spread_join(rows: DataFrame, table: DataFrame, on: list[str], how: str = "inner", most: int = MOST_ROWS, salts: int = SALTS) -> DataFrame:
    """``rows`` joined with a written ``table`` of few rows a key; ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``.

    A table of more than ``most`` rows is shuffled, and Spark splits partitions that a key with many of ``rows`` has made
    large. In sessions that don't do so each of the table's rows goes to all salts of its key, each of ``rows`` to one, by a
    hash of itself, so that a key with a third of all rows is many partitions.
    """
    if table.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(table), on, how)
    conf = rows.sparkSession.conf
    if conf.get("spark.sql.adaptive.enabled") == "true" and conf.get("spark.sql.adaptive.skewJoin.enabled") == "true":
        return rows.join(table.hint("merge"), on, how)
    salted = rows.withColumn("salt_", F.pmod(F.xxhash64(*[c for c, t in rows.dtypes if not t.startswith("map")]), F.lit(salts)))
    copies = table.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return salted.join(copies, [*on, "salt_"], how).drop("salt_")
