"""Queries: CSV files written from the given tables and read back (#1, #3)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablesmith.plans.registry import query
from tablesmith.session import checkpoint_dir
from tablesmith.sources.tables import csv_report, read_csv, read_table, write_table

# The columns written, their types, and the marker of a missing priority.
COLUMNS = ["o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus"]
SCHEMA = "o_orderkey bigint, o_totalprice double, o_orderpriority string, o_orderstatus string"
MARKER = "5-LOW"


def _path(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"


@query("csv_round_trip", f"""
    SELECT o_orderkey, ROUND(o_totalprice, 6) AS o_totalprice, CASE WHEN o_orderpriority <> '{MARKER}' THEN o_orderpriority END AS o_orderpriority, o_orderstatus
    FROM orders""")
def q_csv_round_trip(spark, d):
    """Orders written as CSV and read back in strict mode, with a marker turned into NULL."""
    path = _path(spark)
    write_table(read_table(spark, d, "orders").select(*COLUMNS), path, fmt="csv")
    back = read_csv(spark, path, schema=SCHEMA, tokens=[MARKER])
    return back.withColumn("o_totalprice", F.round("o_totalprice", 6))


def _broken(spark, d) -> str:
    """Orders as CSV lines, some of which hold a value more or less, or a word for a number."""
    path = _path(spark)
    o = read_table(spark, d, "orders")
    key, price = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string")
    kind = F.col("o_orderkey") % 50
    line = (F.when(kind == 1, F.concat_ws(",", key, price, "o_orderpriority", "o_orderstatus", F.lit("extra")))
            .when(kind == 2, F.concat_ws(",", key, price)).when(kind == 3, F.concat_ws(",", key, F.lit("many"), "o_orderpriority", "o_orderstatus"))
            .when(kind == 4, F.concat_ws(",", F.concat(F.lit("k"), key), price, "o_orderpriority", "o_orderstatus"))
            .otherwise(F.concat_ws(",", key, price, "o_orderpriority", "o_orderstatus")))
    # one text column under a header of four names, without quotes: lines as they are
    out = o.select(line.alias(",".join(COLUMNS)))
    out.write.option("header", True).option("sep", "\x01").option("quote", "").option("escape", "").csv(path)
    return path


@query("csv_report", """
    SELECT kind, "column", count(*)::BIGINT AS n FROM (
      SELECT CASE WHEN o_orderkey % 50 IN (1, 2) THEN 'width' ELSE 'cast' END AS kind,
             CASE o_orderkey % 50 WHEN 3 THEN 'o_totalprice' WHEN 4 THEN 'o_orderkey' END AS "column"
      FROM orders WHERE o_orderkey % 50 IN (1, 2, 3, 4)) GROUP BY kind, "column" """)
def q_csv_report(spark, d):
    """What is wrong with a broken file, counted by kind and column."""
    return csv_report(spark, _broken(spark, d), schema=SCHEMA).select("kind", "column", "n")


@query("csv_good_rows", """
    SELECT o_orderkey, ROUND(o_totalprice, 6) AS o_totalprice, o_orderpriority, o_orderstatus FROM orders WHERE o_orderkey % 50 NOT IN (1, 2, 3, 4)""")
def q_csv_good_rows(spark, d):
    """The lines of a broken file that are sound."""
    return read_csv(spark, _broken(spark, d), schema=SCHEMA, tokens=[], mode="drop").withColumn("o_totalprice", F.round("o_totalprice", 6))
