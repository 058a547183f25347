"""Cleaning: projections, filters, scalar functions (#19-#25)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions.columns import numeric_or_null, q, trim_ws
from tablesmith.operators.profile import _long_from_row, duplicate_count


def drop_duplicates(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole-row de-duplication keeping one copy, plus a one-row frame (n_removed).

    ``dropDuplicates`` aggregates map-side first, so heavy repetition shrinks before the
    shuffle."""
    removed = duplicate_count(df).select(F.col("n_duplicates").alias("n_removed"))
    return df.dropDuplicates(), removed


def trim_strings(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Strip leading/trailing white space on every (or the given) string column."""
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    targets = strings if cols is None else strings & set(cols)
    return df.select(*[trim_ws(F.col(q(c))).alias(c) if c in targets else F.col(q(c)) for c in df.columns])


def stringify_nulls(df: DataFrame, cols: list[str] | None = None, text: str = "nan") -> DataFrame:
    """Option of :func:`trim_strings`: NULL in a string column becomes the literal ``text``
    (what a text conversion of a missing value produces). Off by default in cleaning."""
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    targets = strings if cols is None else strings & set(cols)
    return df.select(*[F.coalesce(F.col(q(c)), F.lit(text)).alias(c) if c in targets else F.col(q(c))
                       for c in df.columns])


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Text to double for the listed columns that exist; unparsable values become NULL.
    Columns that are already numeric are cast to double unchanged."""
    present = set(df.columns)
    out = []
    for f in df.schema.fields:
        c = F.col(q(f.name))
        if f.name in cols and f.name in present:
            if isinstance(f.dataType, T.NumericType):
                out.append(c.cast("double").alias(f.name))
            else:
                out.append(numeric_or_null(c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def gross_outliers(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, min, max, n_negative) per numeric column; data untouched. One aggregate."""
    aggs = []
    for c in cols:
        x = F.col(q(c)).cast("double")
        aggs += [F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
                 F.count_if(x < 0).alias(f"{c}__n_negative")]
    return _long_from_row(df.agg(*aggs), cols, ["min", "max", "n_negative"], {"n_negative": "bigint"})


def clean_status(df: DataFrame, target: str) -> DataFrame:
    """One record of de-duplicating ``df``: (n_rows left, n_cols, n_removed, total_nulls and
    nulls_in_target in what is left), from one pass: the group-by that de-duplicates counts
    the copies."""
    rows = df.groupBy(*[q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__c"))
    nulls = lambda cols: F.coalesce(F.sum(sum((F.col(q(c)).isNull().cast("long") for c in cols), F.lit(0))), F.lit(0))
    return rows.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_cols"),
        F.coalesce(F.sum(F.col("__c") - 1), F.lit(0)).cast("bigint").alias("n_removed"),
        nulls(df.columns).cast("bigint").alias("total_nulls"), nulls([target]).cast("bigint").alias("nulls_in_target"))
