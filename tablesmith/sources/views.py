"""Test frames over the given tables (the views of FIXTURES.md).

Each view exists twice: as a DataFrame plan for Spark, and as SQL text that the oracle
queries (DuckDB) inline as a CTE. The test tables carry no NULLs, so the views inject
NULLs, blanks and invalid targets deterministically from key arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.sources.tables import read_table

# Roles of the census-like order frame.
ORD_TARGET = "status"
ORD_VALID = ["F", "O"]
ORD_MAPPING = {"F": 0, "O": 1}
ORD_MISSING_TOKENS = ["?", "4-NOT SPECIFIED"]
ORD_NUMERIC = ["o_totalprice", "c_acctbal"]
ORD_CATEGORICAL = ["o_orderpriority", "c_mktsegment", "n_name"]
LI_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "qty_n", "qty2", "const_one"]
LI_CATEGORICAL = ["l_returnflag", "l_linestatus"]
DOC_NUMERIC = ["n_chars", "lower_share"]
DOC_CATEGORICAL = ["lang", "source"]


def v_ord(spark: SparkSession, d: str) -> DataFrame:
    """orders joined to customer and nation: a census-like frame with a text target."""
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
                                              "o_orderstatus")
    c = read_table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = read_table(spark, d, "nation").select("n_nationkey", "n_name")
    cn = c.join(n, c.c_nationkey == n.n_nationkey)
    j = o.join(cn, o.o_custkey == cn.c_custkey)
    status = (F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit(" "), F.col("o_orderstatus"), F.lit(". ")))
              .otherwise(F.col("o_orderstatus")))
    return j.select("o_orderkey", "o_totalprice", "c_acctbal", "o_orderpriority", "c_mktsegment", "n_name",
                    status.alias("status"))


def v_li(spark: SparkSession, d: str) -> DataFrame:
    """lineitem numerics with a NULL-bearing, a doubled and a constant column."""
    li = read_table(spark, d, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("qty_n"),
        (F.col("l_quantity") * 2).alias("qty2"),
        F.lit(1.0).cast("double").alias("const_one"),
        "l_returnflag", "l_linestatus")


def v_evt(spark: SparkSession, d: str) -> DataFrame:
    """events with padded text and a text-typed number for coercion."""
    e = read_table(spark, d, "events")
    return e.select(
        "event_id", "user_id", "event_type", "value",
        F.concat(F.lit("  "), F.col("event_type"), F.lit("\t")).alias("event_pad"),
        "props",
        F.when(F.col("event_id") % 5 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value_txt"))


def v_doc(spark: SparkSession, d: str) -> DataFrame:
    """documents with their (partial) quality labels: the model frame."""
    docs = read_table(spark, d, "documents")
    labels = read_table(spark, d, "labels").select("doc_id", "quality")
    # lower-case letters: what is left after deleting every run of other characters
    # (runs, not single characters: measured fastest among translate/regexp_count/this)
    n_lower = F.length(F.regexp_replace("text", "[^a-z]+", ""))
    lower = n_lower.cast("double") / F.length("text")
    # the share is taken before the join, which then has no texts to shuffle
    docs = docs.select("doc_id", "n_chars", lower.alias("lower_share"), "lang", "source")
    return docs.join(labels, "doc_id", "left").select("doc_id", "n_chars", "lower_share", "lang", "source", "quality")


def v_score(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents with a deterministic score: metric input without a model."""
    doc = v_doc(spark, d).where(F.col("quality").isNotNull())
    score = ((F.col("n_chars") % 1000) / F.lit(1000.0)).cast("double")
    return doc.select(F.lit("len").alias("run"), F.col("doc_id"), F.col("quality").cast("long").alias("label"),
                      score.alias("score")).withColumn(
        "prediction", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("long"))


def v_scores(spark: SparkSession, d: str) -> DataFrame:
    """Two deterministic runs for run comparison, from one scan: length score ('len')
    and lower-case share ('lower')."""
    doc = v_doc(spark, d).where(F.col("quality").isNotNull())
    len_score = ((F.col("n_chars") % 1000) / F.lit(1000.0)).cast("double")
    runs = F.array(F.struct(F.lit("len").alias("run"), len_score.alias("score")),
                   F.struct(F.lit("lower").alias("run"), F.col("lower_share").alias("score")))
    out = doc.select(F.col("doc_id"), F.col("quality").cast("long").alias("label"), F.inline(runs))
    return out.select("run", "doc_id", "label", "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("long").alias("prediction"))


# The same frames as SQL (DuckDB dialect; also valid Spark SQL except regexp flags).
VIEW_SQL = {
    "v_ord": """
        SELECT o.o_orderkey, o.o_totalprice, c.c_acctbal, o.o_orderpriority, c.c_mktsegment, n.n_name,
               CASE WHEN o.o_orderkey % 7 = 0 THEN ' ' || o.o_orderstatus || '. ' ELSE o.o_orderstatus END
                 AS status
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
             JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "v_li": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS qty_n,
               l_quantity * 2 AS qty2, CAST(1.0 AS DOUBLE) AS const_one, l_returnflag, l_linestatus
        FROM lineitem""",
    "v_evt": """
        SELECT event_id, user_id, event_type, value, '  ' || event_type || chr(9) AS event_pad, props,
               CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE CAST(value AS STRING) END AS value_txt
        FROM events""",
    "v_doc": """
        SELECT d.doc_id, d.n_chars,
               CAST(length(regexp_replace(d.text, '[^a-z]', '', 'g')) AS DOUBLE) / length(d.text) AS lower_share,
               d.lang, d.source, l.quality
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "v_score": """
        SELECT 'len' AS run, doc_id, CAST(quality AS BIGINT) AS label,
               CAST((n_chars % 1000) / 1000.0 AS DOUBLE) AS score,
               CAST(CASE WHEN CAST((n_chars % 1000) / 1000.0 AS DOUBLE) >= 0.5 THEN 1 ELSE 0 END AS BIGINT)
                 AS prediction
        FROM v_doc WHERE quality IS NOT NULL""",
    "v_scores": """
        SELECT * FROM v_score
        UNION ALL
        SELECT 'lower' AS run, doc_id, CAST(quality AS BIGINT) AS label, lower_share AS score,
               CAST(CASE WHEN lower_share >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS prediction
        FROM v_doc WHERE quality IS NOT NULL""",
}

VIEW_DEPENDS = {"v_score": ["v_doc"], "v_scores": ["v_doc", "v_score"]}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs of the named views (and what they depend on)."""
    order = []
    for n in names:
        for dep in VIEW_DEPENDS.get(n, []) + [n]:
            if dep not in order:
                order.append(dep)
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in order)
    return f"WITH {ctes}\n{sql}"
