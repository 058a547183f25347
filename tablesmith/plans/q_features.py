"""Queries: feature selection and checks (#43-#46, #48)."""

from __future__ import annotations

import uuid

from tablesmith.operators import features as FE
from tablesmith.operators import profile as PR
from tablesmith.plans.frames import ord_clean, sql_with
from tablesmith.plans.q_explore import freq_sql
from tablesmith.plans.q_profile import CLEAN_ALL, CLEAN_CAT
from tablesmith.plans.registry import query
from tablesmith.session import checkpoint_dir
from tablesmith.sources import persist as P
from tablesmith.sources import views as V

# Query parameters (analyst decisions, thresholds, candidate grids).
DROP = ["o_orderkey"]
REDUNDANT = ["o_totalprice"]
IRRELEVANT = ["o_orderkey"]
GROUP_MIN_FREQ = {"lang": 130, "source": 50}
SURVIVE_GRID = {"n_name": [0, 550, 600, 650], "c_mktsegment": [0, 2900, 3000, 3100], "o_orderpriority": [0, 2990, 3000]}

_NUMERIC_TYPES = "('BIGINT', 'DOUBLE', 'INTEGER', 'FLOAT', 'SMALLINT', 'TINYINT', 'HUGEINT')"
_ROLES_SQL = f"""
    , roles AS (SELECT column_name AS "column", CAST(row_number() OVER () - 1 AS INTEGER) AS position,
                CASE WHEN column_name = 'status' THEN 'target' WHEN column_name IN ('o_orderkey') THEN 'dropped'
                     ELSE 'feature' END AS role,
                CASE WHEN column_type IN {_NUMERIC_TYPES} THEN 'numeric' ELSE 'categorical' END AS kind
                FROM (DESCRIBE ord_clean))"""


def _roles(spark, d):
    return FE.feature_roles(ord_clean(spark, d), DROP, V.ORD_TARGET)


_COUNTS_SQL = ", pres AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS c, CAST(count({c}) AS BIGINT) AS n_present FROM ord_clean" for c in CLEAN_ALL) + ")"


def _counted(spark, d, table):
    """A table of columns with the rows in which each has a value."""
    return table.join(PR.present_counts(ord_clean(spark, d)), "column")


@query("feature_roles", sql_with(_ROLES_SQL + _COUNTS_SQL + """
    SELECT roles.*, n_present FROM roles JOIN pres ON roles."column" = pres.c""", ctes=["ord_clean"]))
def q_feature_roles(spark, d):
    return _counted(spark, d, _roles(spark, d))


@query("saved_roles", sql_with(_ROLES_SQL + _COUNTS_SQL + """
    SELECT roles.*, n_present FROM roles JOIN pres ON roles."column" = pres.c""", ctes=["ord_clean"]))
def q_saved_roles(spark, d):
    """The role table written and read back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/roles-{uuid.uuid4().hex}"
    P.save_roles(_roles(spark, d), path)
    return _counted(spark, d, P.load_roles(spark, path))


@query("feature_flags", sql_with(_ROLES_SQL + _COUNTS_SQL + """
    SELECT "column", role, kind, CASE WHEN "column" = 'o_totalprice' THEN 'redundant'
                                      WHEN "column" = 'o_orderkey' THEN 'irrelevant' END AS flag, n_present
    FROM roles JOIN pres ON roles."column" = pres.c""",
    ctes=["ord_clean"]))
def q_feature_flags(spark, d):
    return _counted(spark, d, FE.feature_flags(_roles(spark, d), REDUNDANT, IRRELEVANT))


@query("propose_groupings", sql_with(f"""
    SELECT "column", value, CAST(n AS BIGINT) AS n, CAST(CASE "column" WHEN 'lang' THEN 130 ELSE 50 END AS INTEGER)
             AS min_freq, 'Other' AS other_label
    FROM ({freq_sql('v_doc', V.DOC_CATEGORICAL)})
    WHERE n < CASE "column" WHEN 'lang' THEN 130 ELSE 50 END""", views=["v_doc"]))
def q_propose_groupings(spark, d):
    return FE.propose_groupings(V.v_doc(spark, d), V.DOC_CATEGORICAL, GROUP_MIN_FREQ)


@query("feature_issues", sql_with(_ROLES_SQL + f"""
    , nn AS ({' UNION ALL '.join(f"SELECT '{c}' AS c, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null "
                                 f"FROM ord_clean" for c in ['o_totalprice', 'c_acctbal'] + CLEAN_CAT)}),
    nu AS ({' UNION ALL '.join(f"SELECT '{c}' AS c, CAST(count(DISTINCT {c}) AS BIGINT) AS n_unique FROM ord_clean"
                               for c in CLEAN_CAT)})
    SELECT r."column", r.kind, nn.n_null, nu.n_unique,
           (r.kind = 'categorical' AND coalesce(nu.n_unique, 0) > 20) AS high_cardinality
    FROM roles r JOIN nn ON r."column" = nn.c LEFT JOIN nu ON r."column" = nu.c
    WHERE r.role = 'feature' AND (nn.n_null > 0 OR (r.kind = 'categorical' AND coalesce(nu.n_unique, 0) > 20))""",
    ctes=["ord_clean"]))
def q_feature_issues(spark, d):
    df = ord_clean(spark, d)
    return FE.feature_issues(df, FE.feature_roles(df, DROP, V.ORD_TARGET), max_card=20)


def _survive_sql():
    th = " UNION ALL ".join(f"SELECT '{c}' AS c, {t} AS t" for c, ts in SURVIVE_GRID.items() for t in ts)
    return f"""
    SELECT th.c AS "column", CAST(th.t AS INTEGER) AS min_freq,
           CAST(count(*) FILTER (WHERE fr.n >= th.t) + 1 AS BIGINT) AS n_categories
    FROM ({freq_sql('ord_clean', list(SURVIVE_GRID))}) fr JOIN ({th}) th ON fr."column" = th.c
    GROUP BY th.c, th.t"""


@query("surviving_categories", sql_with(_survive_sql(), ctes=["ord_clean"]))
def q_surviving_categories(spark, d):
    return FE.surviving_categories(ord_clean(spark, d), SURVIVE_GRID)
