"""Frequency tables: the one shuffle that serves most categorical statistics.

``freq_table`` unpivots the categorical columns to (column, value) and counts per pair.
Partial aggregation runs before the shuffle, so the shuffle carries one row per distinct
(column, value) per task, not one per input row, and a value holding a third of all rows
costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.functions.columns import q


def freq_table(df: DataFrame, cols: list[str], *, by: list[str] | None = None, dropna: bool = True) -> DataFrame:
    """(by..., column, value, n) with values cast to string; NULL values kept when
    ``dropna`` is False."""
    by = list(by or [])
    base = df.select(*[F.col(q(b)) for b in by], *[F.col(q(c)).cast("string").alias(c) for c in cols])
    long_df = base.unpivot([q(b) for b in by], [q(c) for c in cols], "column", "value")
    if dropna:
        long_df = long_df.where(F.col("value").isNotNull())
    return long_df.groupBy(*[q(b) for b in by], "column", "value").agg(F.count(F.lit(1)).alias("n"))


def value_counts(df: DataFrame, col: str, *, normalize: bool = False, dropna: bool = True) -> DataFrame:
    """Frequency per value of one column: (value, n[, share]), count-descending, ties by
    value ascending. ``share`` is relative to the rows counted (NULLs included only when
    ``dropna`` is False). Values keep the column's type."""
    c = F.col(q(col))
    src = df.where(c.isNotNull()) if dropna else df
    vc = src.groupBy(c.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    if normalize:
        total = vc.agg(F.sum("n")).scalar()
        vc = vc.withColumn("share", F.col("n") / total)
    return vc.orderBy(F.col("n").desc(), F.col("value").asc_nulls_last())
