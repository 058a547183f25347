"""Queries: schema, profile and cleaning (#8-#24)."""

from __future__ import annotations

from tablesmith.operators import clean as CL
from tablesmith.operators import profile as PR
from tablesmith.plans.frames import ord_clean, ord_tokens, sql_with
from tablesmith.plans.registry import query
from tablesmith.plans.sqlgen import DUCK_TYPE, MEAN_SQL, lit_list, r6, settled_mean, union_cols
from tablesmith.sources import views as V

# The expected column list used by the schema check (one name absent
# from the frame, one frame column not expected).
ORD_EXPECTED = ["o_totalprice", "c_acctbal", "o_orderpriority", "c_mktsegment", "n_name", "status", "o_clerk"]
CLEAN_NUM = ["o_orderkey", "o_totalprice", "c_acctbal", "status"]
CLEAN_CAT = ["o_orderpriority", "c_mktsegment", "n_name"]
CLEAN_ALL = ["o_orderkey", "o_totalprice", "c_acctbal", "o_orderpriority", "c_mktsegment", "n_name", "status"]
EVT_DUP_COLS = ["user_id", "event_type", "value"]
EVT_STRINGS = ["event_type", "event_pad", "props", "value_txt"]


@query("schema_diff", sql_with(f"""
    , cols AS (SELECT column_name AS c FROM (DESCRIBE v_ord)),
    exp AS (SELECT unnest({lit_list(ORD_EXPECTED)}) AS c),
    pres AS ({union_cols("SELECT '{c}' AS p, CAST(count({c}) AS BIGINT) AS n_present FROM v_ord", CLEAN_ALL)}),
    st AS (SELECT c AS "column", 'ok' AS status FROM cols WHERE c IN (SELECT c FROM exp)
    UNION ALL SELECT c, 'missing' FROM exp WHERE c NOT IN (SELECT c FROM cols)
    UNION ALL SELECT c, 'extra' FROM cols WHERE c NOT IN (SELECT c FROM exp))
    SELECT st.*, n_present FROM st LEFT JOIN pres ON st."column" = pres.p""", views=["v_ord"]))
def q_schema_diff(spark, d):
    return PR.schema_diff(V.v_ord(spark, d), ORD_EXPECTED)


@query("data_dictionary", sql_with(f"""
    SELECT column_name AS name, {DUCK_TYPE} AS type,
           CASE WHEN column_name = 'status' THEN 'target' ELSE 'feature' END AS role, '' AS notes, n_present
    FROM (DESCRIBE ord_clean) JOIN ({union_cols("SELECT '{c}' AS p, CAST(count({c}) AS BIGINT) AS n_present FROM ord_clean", CLEAN_ALL)})
      ON column_name = p""", ctes=["ord_clean"]))
def q_data_dictionary(spark, d):
    return PR.data_dictionary(ord_clean(spark, d), V.ORD_TARGET)


@query("table_shape", sql_with("""
    SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST((SELECT count(*) FROM (DESCRIBE ord_clean)) AS BIGINT) AS n_cols
    FROM ord_clean""", ctes=["ord_clean"]))
def q_table_shape(spark, d):
    return PR.table_shape(ord_clean(spark, d))


@query("null_counts", sql_with(union_cols(
    "SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null FROM ord_clean",
    CLEAN_ALL), ctes=["ord_clean"]))
def q_null_counts(spark, d):
    return PR.null_counts(ord_clean(spark, d))


@query("unique_counts", sql_with(union_cols(
    "SELECT '{c}' AS \"column\", CAST(count(DISTINCT {c}) AS BIGINT) AS n_unique FROM ord_clean", CLEAN_ALL),
    ctes=["ord_clean"]))
def q_unique_counts(spark, d):
    return PR.unique_counts(ord_clean(spark, d))


@query("numeric_min_max", sql_with(union_cols(
    "SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM v_li",
    V.LI_NUMERIC), views=["v_li"]))
def q_numeric_min_max(spark, d):
    return PR.min_max(V.v_li(spark, d), V.LI_NUMERIC)


_DESC_NUM = """SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS count,
    CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq,
    """ + MEAN_SQL.replace("{x}", "favg({c})") + """ AS mean, ROUND(stddev_samp({c}), 6) AS std, ROUND(CAST(min({c}) AS DOUBLE), 6) AS min,
    ROUND(quantile_cont({c}, 0.25), 6) AS p25, ROUND(quantile_cont({c}, 0.5), 6) AS p50,
    ROUND(quantile_cont({c}, 0.75), 6) AS p75, ROUND(CAST(max({c}) AS DOUBLE), 6) AS max FROM ord_clean"""
_DESC_CAT = """SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS count,
    CAST(count(DISTINCT {c}) AS BIGINT) AS "unique",
    (SELECT {c} FROM ord_clean WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
    (SELECT CAST(count(*) AS BIGINT) FROM ord_clean WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1)
      AS freq,
    CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS p25,
    CAST(NULL AS DOUBLE) AS p50, CAST(NULL AS DOUBLE) AS p75, CAST(NULL AS DOUBLE) AS max FROM ord_clean"""


@query("describe_all", sql_with(union_cols(_DESC_NUM, CLEAN_NUM) + "\nUNION ALL\n" + union_cols(_DESC_CAT, CLEAN_CAT),
                                ctes=["ord_clean"]))
def q_describe_all(spark, d):
    return r6(settled_mean(PR.describe_all(ord_clean(spark, d))))


@query("quick_profile", sql_with(
    union_cols("""SELECT '{c}' AS "column", (SELECT {dt} FROM (DESCRIBE ord_clean) WHERE column_name = '{c}') AS dtype,
        CAST(count(*) AS BIGINT) AS n_rows, CAST((SELECT count(*) FROM (DESCRIBE ord_clean)) AS BIGINT) AS n_cols,
        CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null, CAST(count(DISTINCT {c}) AS BIGINT) AS n_unique,
        ROUND(CAST(min({c}) AS DOUBLE), 6) AS min, ROUND(CAST(max({c}) AS DOUBLE), 6) AS max FROM ord_clean""".replace(
        "{dt}", DUCK_TYPE), CLEAN_NUM) + "\nUNION ALL\n" +
    union_cols("""SELECT '{c}' AS "column", 'string' AS dtype, CAST(count(*) AS BIGINT) AS n_rows,
        CAST((SELECT count(*) FROM (DESCRIBE ord_clean)) AS BIGINT) AS n_cols,
        CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null, CAST(count(DISTINCT {c}) AS BIGINT) AS n_unique,
        CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max FROM ord_clean""", CLEAN_CAT),
    ctes=["ord_clean"]))
def q_quick_profile(spark, d):
    return r6(PR.quick_profile(ord_clean(spark, d)))


@query("duplicate_count", sql_with("""
    SELECT CAST(count(*) AS BIGINT) AS n_rows,
           CAST((SELECT count(*) FROM (SELECT DISTINCT user_id, event_type, value FROM v_evt)) AS BIGINT) AS n_distinct,
           CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type, value FROM v_evt)) AS BIGINT)
             AS n_duplicates
    FROM v_evt""", views=["v_evt"]))
def q_duplicate_count(spark, d):
    return PR.duplicate_count(V.v_evt(spark, d).select(*EVT_DUP_COLS))


@query("missing_summary", sql_with(f"""
    , nc AS ({union_cols("SELECT '{c}' AS c, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n FROM ord_clean",
                         CLEAN_ALL)})
    SELECT c AS "column", n AS n_null, CAST((SELECT sum(n) FROM nc) AS BIGINT) AS total_nulls,
           CAST((SELECT n FROM nc WHERE c = 'status') AS BIGINT) AS nulls_in_target FROM nc""",
    ctes=["ord_clean"]))
def q_missing_summary(spark, d):
    return PR.missing_summary(ord_clean(spark, d), V.ORD_TARGET)


@query("drop_duplicates", sql_with("SELECT DISTINCT user_id, event_type, value FROM v_evt", views=["v_evt"]))
def q_drop_duplicates(spark, d):
    out, _ = CL.drop_duplicates(V.v_evt(spark, d).select(*EVT_DUP_COLS))
    return out


_TRIM = "trim({c}, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))"


@query("trim_strings", sql_with(
    "SELECT event_id, user_id, value, " + ", ".join(f"{_TRIM.format(c=c)} AS {c}" for c in EVT_STRINGS) +
    " FROM v_evt", views=["v_evt"]))
def q_trim_strings(spark, d):
    return CL.trim_strings(V.v_evt(spark, d))


@query("stringify_nulls", sql_with(
    "SELECT o_orderkey, o_totalprice, c_acctbal, " +
    ", ".join(f"coalesce({c}, 'nan') AS {c}" for c in ["o_orderpriority", "c_mktsegment", "n_name", "status"]) +
    " FROM ord_tokens", ctes=["ord_tokens"]))
def q_stringify_nulls(spark, d):
    return CL.stringify_nulls(ord_tokens(spark, d))


_NUM_RE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


@query("coerce_numeric", sql_with(f"""
    SELECT event_id, user_id, event_type, value, event_pad, props,
           CASE WHEN regexp_full_match({_TRIM.format(c='value_txt')}, '{_NUM_RE}')
                THEN TRY_CAST({_TRIM.format(c='value_txt')} AS DOUBLE) END AS value_txt
    FROM v_evt""", views=["v_evt"]))
def q_coerce_numeric(spark, d):
    return CL.coerce_numeric(V.v_evt(spark, d), ["value_txt"])


@query("gross_outliers", sql_with(union_cols(
    "SELECT '{c}' AS \"column\", min({c}) AS min, max({c}) AS max, "
    "CAST(count(*) FILTER (WHERE {c} < 0) AS BIGINT) AS n_negative FROM v_ord", V.ORD_NUMERIC), views=["v_ord"]))
def q_gross_outliers(spark, d):
    return CL.gross_outliers(V.v_ord(spark, d), V.ORD_NUMERIC)


@query("clean_status", sql_with(f"""
    , nc AS ({union_cols("SELECT '{c}' AS c, count(*) FILTER (WHERE {c} IS NULL) AS n FROM ord_clean", CLEAN_ALL)})
    SELECT CAST((SELECT count(*) FROM ord_clean) AS BIGINT) AS n_rows,
           CAST((SELECT count(*) FROM (DESCRIBE ord_clean)) AS BIGINT) AS n_cols,
           CAST((SELECT count(*) FROM ord_clean) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ord_clean)) AS BIGINT)
             AS n_removed,
           CAST((SELECT sum(n) FROM nc) AS BIGINT) AS total_nulls,
           CAST((SELECT n FROM nc WHERE c = 'status') AS BIGINT) AS nulls_in_target""",
    ctes=["ord_clean"]))
def q_clean_status(spark, d):
    return CL.clean_status(ord_clean(spark, d), V.ORD_TARGET)


