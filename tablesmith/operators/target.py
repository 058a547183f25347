"""Target processing (#37-#42)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesmith.functions.columns import lookup, q, trim_ws
from tablesmith.operators.frequency import value_counts


def inspect_target(df: DataFrame, col: str) -> DataFrame:
    """Absolute and relative frequencies of the raw target, the NULL group included,
    with the column's type: (value, n, share, dtype)."""
    vc = value_counts(df, col, normalize=True, dropna=False)
    return vc.withColumn("dtype", F.lit(df.schema[col].dataType.simpleString()))


def normalize_target(df: DataFrame, col: str, valid: list[str]) -> DataFrame:
    """Strip white space, delete every '.' and blank, and NULL anything outside ``valid``."""
    c = F.translate(trim_ws(F.col(q(col)).cast("string")), ". ", "")
    return df.withColumn(col, F.when(c.isin(list(valid)), c))


def encode_target(df: DataFrame, col: str, mapping: dict) -> DataFrame:
    """Map labels to a nullable 64-bit integer; unmapped and NULL give NULL."""
    return df.withColumn(col, lookup(F.col(q(col)), mapping, "bigint"))


def invalid_target_count(df: DataFrame, col: str) -> DataFrame:
    """Rows whose target is NULL (after normalisation/encoding): (n_invalid)."""
    return df.agg(F.count_if(F.col(q(col)).isNull()).cast("bigint").alias("n_invalid"))


def target_distribution(df: DataFrame, col: str) -> DataFrame:
    """Class balance, absolute and relative, NULL excluded: (value, n, share)."""
    return value_counts(df, col, normalize=True, dropna=True)


def target_status(df: DataFrame, col: str) -> DataFrame:
    """Encoded value counts including NULL, with the row total and the affected
    (NULL-target) rows: (value, n, n_rows, n_affected)."""
    every = Window.partitionBy(F.lit(0))      # over one row per class
    null = F.when(F.col("value").isNull(), F.col("n")).otherwise(0)
    return value_counts(df, col, normalize=False, dropna=False).select(
        "value", "n", F.sum("n").over(every).cast("bigint").alias("n_rows"), F.sum(null).over(every).cast("bigint").alias("n_affected"))
