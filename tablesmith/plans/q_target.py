"""Queries: sources, null markers and target processing (#2, #37-#42)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.operators import target as TG
from tablesmith.plans.frames import ord_clean, ord_tokens, sql_with
from tablesmith.plans.registry import query
from tablesmith.sources import views as V


@query("null_tokens", sql_with("SELECT * FROM ord_tokens", ctes=["ord_tokens"]))
def q_null_tokens(spark, d):
    return ord_tokens(spark, d)


@query("inspect_target", sql_with("""
    SELECT status AS value, CAST(count(*) AS BIGINT) AS n,
           round(count(*) / (SELECT count(*) FROM v_ord), 6) AS share, 'string' AS dtype
    FROM v_ord GROUP BY status""", views=["v_ord"]))
def q_inspect_target(spark, d):
    out = TG.inspect_target(V.v_ord(spark, d), V.ORD_TARGET)
    return out.withColumn("share", F.round("share", 6))


@query("normalize_target", sql_with("SELECT * FROM ord_norm", ctes=["ord_norm"]))
def q_normalize_target(spark, d):
    return TG.normalize_target(ord_tokens(spark, d), V.ORD_TARGET, V.ORD_VALID)


@query("invalid_target_count", sql_with(
    "SELECT CAST(count(*) FILTER (WHERE status IS NULL) AS BIGINT) AS n_invalid FROM ord_norm",
    ctes=["ord_norm"]))
def q_invalid_target_count(spark, d):
    return TG.invalid_target_count(TG.normalize_target(ord_tokens(spark, d), V.ORD_TARGET, V.ORD_VALID),
                                   V.ORD_TARGET)


@query("encode_target", sql_with("SELECT * FROM ord_clean", ctes=["ord_clean"]))
def q_encode_target(spark, d):
    return ord_clean(spark, d)


@query("target_distribution", sql_with("""
    SELECT status AS value, CAST(count(*) AS BIGINT) AS n,
           round(count(*) / (SELECT count(*) FROM ord_clean WHERE status IS NOT NULL), 6) AS share
    FROM ord_clean WHERE status IS NOT NULL GROUP BY status""", ctes=["ord_clean"]))
def q_target_distribution(spark, d):
    return TG.target_distribution(ord_clean(spark, d), V.ORD_TARGET).withColumn("share", F.round("share", 6))


@query("target_status", sql_with("""
    SELECT status AS value, CAST(count(*) AS BIGINT) AS n,
           CAST((SELECT count(*) FROM ord_clean) AS BIGINT) AS n_rows,
           CAST((SELECT count(*) FROM ord_clean WHERE status IS NULL) AS BIGINT) AS n_affected
    FROM ord_clean GROUP BY status""", ctes=["ord_clean"]))
def q_target_status(spark, d):
    return TG.target_status(ord_clean(spark, d), V.ORD_TARGET)
