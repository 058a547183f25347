"""Small helpers that write the oracle SQL for per-column statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def r6(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (the oracle convention on both sides)."""
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


# A mean of decimal data can lie exactly between two roundings, where the last bit of the sum
# decides. Both sides take nine digits first, as a decimal, and round that half up.
MEAN_SQL = "CAST(ROUND(CAST(ROUND({x}, 9) AS DECIMAL(38, 9)), 6) AS DOUBLE)"


def settled_mean(df: DataFrame, name: str = "mean") -> DataFrame:
    return df.withColumn(name, F.round(F.round(F.col(name), 9).cast("decimal(38,9)"), 6).cast("double"))


def union_cols(template: str, cols: list[str]) -> str:
    """``template`` formatted once per column (``{c}``), joined by UNION ALL."""
    return "\nUNION ALL\n".join(template.format(c=c) for c in cols)


def lit_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


# Spark simpleString of the DuckDB types that occur in the test tables.
DUCK_TYPE = ("CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' "
             "WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'FLOAT' THEN 'float' "
             "WHEN 'TIMESTAMP' THEN 'timestamp' ELSE lower(column_type) END")

QUANT = "ROUND(quantile_cont({c}, {p}), 6)"
