"""Lookup of column values in a dictionary table, safe for values that many rows share.

A dictionary is a table (column, value, n, ...payload): for each column its values, how often
each was counted, and what it maps to. The HOT most frequent entries of a column (all of them,
mostly) are broadcast, so the rows that hold them are not shuffled; entries beyond that are
joined by a shuffle of the rows that are still unmapped, among which no value is frequent, and
mapped rows are dealt at random beside them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.functions.columns import q

# Parameter: entries per column that are broadcast (the bound of what a lookup broadcasts).
HOT = 10_000
SALTS = 4096


def entries(table: DataFrame) -> dict[str, int]:
    """Number of entries per column: what decides whether a lookup has a part beyond HOT."""
    return {r["column"]: r["count"] for r in table.groupBy("column").count().collect()}


def looked_up(df: DataFrame, columns: list[str], table: DataFrame, sizes: dict[str, int], payload: str, out: dict[str, str],
              hot: int = HOT) -> DataFrame:
    """``df`` with ``out[c]``, the ``payload`` of the entry of each of ``columns`` (NULL without an
    entry). NULL is a value: an entry whose value is NULL maps it."""
    for c in columns:
        mine = table.where(F.col("column") == c).select(F.col("value").alias("__value"), F.col("n").alias("__n"), F.col(payload).alias("__hit"))
        value = F.col(q(c)).cast("string")
        if sizes.get(c, 0) <= hot:
            first, rest = mine.select("__value", "__hit"), None
        else:
            # the rank of the frequent entries: a top-k, never a sort of all entries in a task
            first = mine.orderBy(F.desc("__n"), "__value").limit(hot).select("__value", "__hit")
            rest = mine.join(F.broadcast(first.select(F.col("__value").alias("__first"))), F.col("__value").eqNullSafe(F.col("__first")), "left_anti")
        df = df.join(F.broadcast(first), value.eqNullSafe(F.col("__value")), "left").drop("__value").withColumnRenamed("__hit", out[c] + "__1" if rest is not None else out[c])
        if rest is not None:
            found = F.col(q(out[c] + "__1")).isNotNull()
            df = df.withColumn("__open", F.when(~found, value)).withColumn(
                "__salt", F.when(F.col("__open").isNotNull(), F.lit(0)).otherwise((F.rand(7) * SALTS).cast("int") + 1))
            cold = rest.where("__value IS NOT NULL").select(F.col("__value").alias("__cold"), F.lit(0).alias("__zero"), F.col("__hit"))
            df = df.join(cold, (F.col("__open") == F.col("__cold")) & (F.col("__salt") == F.col("__zero")), "left")
            df = df.withColumn(out[c], F.coalesce(q(out[c] + "__1"), "__hit")).drop(out[c] + "__1", "__open", "__salt", "__cold", "__zero", "__hit")
    return df
