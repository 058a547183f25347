"""Prepared frames shared by several queries, each with its SQL twin for the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablesmith.operators.target import encode_target, normalize_target
from tablesmith.sources import views as V
from tablesmith.sources.tables import null_tokens


def ord_tokens(spark: SparkSession, d: str) -> DataFrame:
    """V_ORD with the missing markers turned into NULL."""
    return null_tokens(V.v_ord(spark, d), V.ORD_MISSING_TOKENS)


def ord_clean(spark: SparkSession, d: str) -> DataFrame:
    """V_ORD after null tokens, target normalisation and encoding (the census frame)."""
    df = normalize_target(ord_tokens(spark, d), V.ORD_TARGET, V.ORD_VALID)
    return encode_target(df, V.ORD_TARGET, V.ORD_MAPPING)


_TOK = "('?', '4-NOT SPECIFIED')"

ORD_TOKENS_SQL = f"""
    SELECT o_orderkey, o_totalprice, c_acctbal,
           CASE WHEN o_orderpriority IN {_TOK} THEN NULL ELSE o_orderpriority END AS o_orderpriority,
           CASE WHEN c_mktsegment IN {_TOK} THEN NULL ELSE c_mktsegment END AS c_mktsegment,
           CASE WHEN n_name IN {_TOK} THEN NULL ELSE n_name END AS n_name,
           CASE WHEN status IN {_TOK} THEN NULL ELSE status END AS status
    FROM v_ord"""

NORM_STATUS = "translate(trim(status, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)), '. ', '')"

ORD_NORM_SQL = f"""
    SELECT o_orderkey, o_totalprice, c_acctbal, o_orderpriority, c_mktsegment, n_name,
           CASE WHEN {NORM_STATUS} IN ('F', 'O') THEN {NORM_STATUS} END AS status
    FROM ord_tokens"""

ORD_CLEAN_SQL = """
    SELECT o_orderkey, o_totalprice, c_acctbal, o_orderpriority, c_mktsegment, n_name,
           CAST(CASE status WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS BIGINT) AS status
    FROM ord_norm"""


def sql_with(body: str, views=(), ctes=()) -> str:
    """Oracle SQL: the base views, then named CTEs (in order), then ``body``.

    ``ctes`` may contain the names 'ord_tokens', 'ord_norm', 'ord_clean' (resolved here,
    dependencies added) or (name, sql) pairs. A ``body`` starting with ``, name AS (...)``
    adds further CTEs before its final SELECT."""
    known = {"ord_tokens": ORD_TOKENS_SQL, "ord_norm": ORD_NORM_SQL, "ord_clean": ORD_CLEAN_SQL}
    chain = {"ord_tokens": ["ord_tokens"], "ord_norm": ["ord_tokens", "ord_norm"],
             "ord_clean": ["ord_tokens", "ord_norm", "ord_clean"]}
    views = list(views)
    named = []
    for c in ctes:
        if isinstance(c, str):
            if "v_ord" not in views:
                views.append("v_ord")
            for n in chain[c]:
                if n not in [x[0] for x in named]:
                    named.append((n, known[n]))
        else:
            named.append(c)
    base = V.with_views("SELECT 1", *views)[:-len("SELECT 1")].rstrip() if views else ""
    parts = [f"{n} AS ({s})" for n, s in named]
    if base:
        head = base + (",\n" + ",\n".join(parts) if parts else "")
    else:
        head = ("WITH " + ",\n".join(parts)) if parts else ""
    # a body that starts with ", name AS (...)" continues the WITH list
    stripped = body.lstrip()
    if stripped.startswith(","):
        if not head:
            raise ValueError("a continued WITH list needs views or CTEs before it")
        return f"{head},\n{stripped[1:].lstrip()}"
    return f"{head}\n{body}"
