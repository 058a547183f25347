"""Queries: splits and folds (#49-#51, #53). Membership is hash-based and not portable,
so the oracles check the exact sizes per (side or fold, class)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablesmith.operators import features as FE
from tablesmith.operators import split as SP
from tablesmith.plans.frames import ord_clean, sql_with
from tablesmith.plans.registry import query
from tablesmith.plans.sqlgen import r6
from tablesmith.session import checkpoint_dir
from tablesmith.sources import views as V

_ALLOC = """
    , cc AS (SELECT {label} AS label, count(*) AS n_c FROM {src} WHERE {label} IS NOT NULL GROUP BY {label}),
    tot AS (SELECT sum(n_c) AS n, CAST(ceil(0.2 * sum(n_c)) AS BIGINT) AS n_test FROM cc),
    base AS (SELECT label, n_c, ((n - n_test) * n_c) // n AS fl, ((n - n_test) * n_c) % n AS rem FROM cc, tot),
    rk AS (SELECT *, row_number() OVER (ORDER BY rem DESC, label) AS r FROM base),
    alloc AS (SELECT label, n_c, fl + CASE WHEN r <= (SELECT n - n_test FROM tot) - (SELECT sum(fl) FROM base)
                                       THEN 1 ELSE 0 END AS n_train FROM rk),
    sizes AS (SELECT 'train' AS side, label, CAST(n_train AS BIGINT) AS n FROM alloc
              UNION ALL SELECT 'test', label, CAST(n_c - n_train AS BIGINT) FROM alloc)"""


def _split_sql(body, label, src, views=(), ctes=()):
    return sql_with(_ALLOC.format(label=label, src=src) + "\n" + body, views=views, ctes=ctes)


def _doc_split(spark, d):
    df = V.v_doc(spark, d)
    return SP.stratified_split(df, "quality", "doc_id", test_size=0.2, seed=42)[0]


@query("prepare_xy", sql_with("SELECT o_orderkey, o_totalprice, c_acctbal, o_orderpriority, c_mktsegment, n_name, "
                              "status FROM ord_clean", ctes=["ord_clean"]))
def q_prepare_xy(spark, d):
    df = ord_clean(spark, d)
    roles = FE.role_lists(FE.feature_roles(df, ["o_orderkey"], V.ORD_TARGET))
    return FE.select_for_model(df, roles["final_features"], V.ORD_TARGET, key="o_orderkey")


@query("stratified_split", _split_sql("SELECT side, label, n FROM sizes WHERE n > 0", "quality", "v_doc",
                                      views=["v_doc"]))
def q_stratified_split(spark, d):
    return (_doc_split(spark, d).groupBy("side", F.col("quality").cast("int").alias("label"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


@query("stratified_split_ord", _split_sql("SELECT side, label, n FROM sizes WHERE n > 0", "status", "ord_clean",
                                          ctes=["ord_clean"]))
def q_stratified_split_ord(spark, d):
    df, _ = SP.stratified_split(ord_clean(spark, d), "status", "o_orderkey", test_size=0.2, seed=42)
    return df.groupBy("side", F.col("status").alias("label")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("saved_splits", _split_sql("SELECT side, label, n FROM sizes WHERE n > 0", "quality", "v_doc", views=["v_doc"]))
def q_saved_splits(spark, d):
    """The split written by side and read back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/splits-{uuid.uuid4().hex}"
    SP.save_splits(_doc_split(spark, d), path)
    return spark.read.parquet(path).groupBy("side", F.col("quality").cast("int").alias("label")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("split_quality", _split_sql("""
    SELECT side, label, n, ROUND(n / sum(n) OVER (PARTITION BY side), 6) AS share,
           CAST(sum(n) OVER (PARTITION BY side) AS BIGINT) AS n_side, CAST(0 AS BIGINT) AS n_null_label
    FROM sizes WHERE n > 0""", "quality", "v_doc", views=["v_doc"]))
def q_split_quality(spark, d):
    sq = SP.split_quality(_doc_split(spark, d), "quality")
    return r6(sq.withColumn("label", F.col("label").cast("int")))


@query("stratified_folds", sql_with("""
    , cc AS (SELECT quality AS label, count(*) AS n_c FROM v_doc WHERE quality IS NOT NULL GROUP BY quality),
    pos AS (SELECT label, n_c, sum(n_c) OVER (ORDER BY label) - n_c AS start FROM cc),
    f AS (SELECT label, n_c, start, t.range AS fold, start + (((t.range - start) % 5) + 5) % 5 AS first
          FROM pos, range(0, 5) t)
    SELECT CAST(fold AS INTEGER) AS fold, label,
           CAST(CASE WHEN first >= start + n_c THEN 0 ELSE (start + n_c - 1 - first) // 5 + 1 END AS BIGINT) AS n
    FROM f WHERE first < start + n_c""", views=["v_doc"]))
def q_stratified_folds(spark, d):
    folds = SP.stratified_folds(V.v_doc(spark, d), "quality", "doc_id", k=5, seed=42)
    return folds.groupBy("fold", F.col("quality").cast("int").alias("label")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))
