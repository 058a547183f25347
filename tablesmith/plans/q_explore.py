"""Queries: exploratory aggregates (#26-#36)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.functions.ranking import to_long_numeric
from tablesmith.operators import explore as EX
from tablesmith.operators import profile as PR
from tablesmith.operators.frequency import value_counts
from tablesmith.plans.frames import ord_clean, sql_with
from tablesmith.plans.q_profile import CLEAN_CAT
from tablesmith.plans.registry import query
from tablesmith.plans.sqlgen import MEAN_SQL, r6, settled_mean, union_cols
from tablesmith.sources import views as V

HIST_COLS = ["l_quantity", "l_extendedprice", "l_discount", "const_one"]
KDE_COLS = ["l_quantity", "l_discount", "l_tax", "heavy"]
AUTO_COLS = ["l_quantity", "l_extendedprice", "heavy", "const_one"]
CAT_MIN_FREQ = 50


def long_sql(view: str, cols: list[str], by: list[str] | None = None) -> str:
    by = list(by or [])
    pre = "".join(f"{b}, " for b in by)
    notnull = "".join(f" AND {b} IS NOT NULL" for b in by)
    return union_cols(f"SELECT {pre}'{{c}}' AS \"column\", CAST({{c}} AS DOUBLE) AS x FROM {view} "
                      f"WHERE {{c}} IS NOT NULL{notnull}", cols)


def freq_sql(view: str, cols: list[str], by: list[str] | None = None) -> str:
    by = list(by or [])
    pre = "".join(f"{b}, " for b in by)
    notnull = "".join(f" AND {b} IS NOT NULL" for b in by)
    grp = ", ".join(by + ['"column"', "value"])
    return ("SELECT " + pre + '"column", value, count(*) AS n FROM (' + union_cols(
        f"SELECT {pre}'{{c}}' AS \"column\", CAST({{c}} AS VARCHAR) AS value FROM {view} "
        f"WHERE {{c}} IS NOT NULL{notnull}", cols) + f") GROUP BY {grp}")


@query("describe_numerical", sql_with(union_cols(
    """SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS n, """ + MEAN_SQL.replace("{x}", "favg({c})") + """ AS mean,
       ROUND(stddev_samp({c}), 6) AS std, ROUND(CAST(min({c}) AS DOUBLE), 6) AS min,
       ROUND(quantile_cont({c}, 0.25), 6) AS p25, ROUND(quantile_cont({c}, 0.5), 6) AS p50,
       ROUND(quantile_cont({c}, 0.75), 6) AS p75, ROUND(CAST(max({c}) AS DOUBLE), 6) AS max FROM v_li""",
    V.LI_NUMERIC), views=["v_li"]))
def q_describe_numerical(spark, d):
    return r6(settled_mean(PR.describe_numerical(V.v_li(spark, d), V.LI_NUMERIC)))


@query("describe_categorical", sql_with(f"""
    , fr AS ({freq_sql('ord_clean', CLEAN_CAT)}),
    rk AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS r FROM fr)
    SELECT "column", CAST(sum(n) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS n_unique,
           max(value) FILTER (WHERE r = 1) AS most_freq, CAST(max(n) AS BIGINT) AS freq_most_freq,
           string_agg(value || ':' || CAST(n AS VARCHAR), '|' ORDER BY r) FILTER (WHERE r <= 10) AS top_values
    FROM rk GROUP BY "column" """, ctes=["ord_clean"]))
def q_describe_categorical(spark, d):
    return PR.describe_categorical(ord_clean(spark, d), CLEAN_CAT, k=10)


@query("value_counts", sql_with("""
    SELECT c_mktsegment AS value, CAST(count(*) AS BIGINT) AS n FROM ord_clean
    WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment""", ctes=["ord_clean"]))
def q_value_counts(spark, d):
    return value_counts(ord_clean(spark, d), "c_mktsegment")


@query("value_counts_rel", sql_with("""
    SELECT o_orderpriority AS value, CAST(count(*) AS BIGINT) AS n,
           ROUND(count(*) / (SELECT count(*) FROM ord_clean), 6) AS share
    FROM ord_clean GROUP BY o_orderpriority""", ctes=["ord_clean"]))
def q_value_counts_rel(spark, d):
    return r6(value_counts(ord_clean(spark, d), "o_orderpriority", normalize=True, dropna=False))


@query("top_categories", sql_with(f"""
    SELECT "column", CAST(r AS BIGINT) AS rank, value, CAST(n AS BIGINT) AS n FROM (
      SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS r
      FROM ({freq_sql('v_doc', V.DOC_CATEGORICAL)})) WHERE r <= 10""", views=["v_doc"]))
def q_top_categories(spark, d):
    return EX.top_categories(V.v_doc(spark, d), V.DOC_CATEGORICAL, k=10)


@query("histogram", sql_with(f"""
    , lng AS ({long_sql('v_li', HIST_COLS)}),
    rng AS (SELECT "column", min(x) AS lo, max(x) AS hi FROM lng GROUP BY "column"),
    b AS (SELECT l."column", CAST(CASE WHEN hi > lo THEN LEAST(FLOOR((x - lo) / (hi - lo) * 10), 9) ELSE 0 END AS BIGINT)
            AS bin FROM lng l JOIN rng r ON l."column" = r."column"),
    cnt AS (SELECT "column", bin, count(*) AS n FROM b GROUP BY "column", bin),
    grid AS (SELECT "column", lo, hi, t.range AS bin FROM rng, range(0, 10) t)
    SELECT g."column", CAST(g.bin AS BIGINT) AS bin, ROUND(lo + g.bin * ((hi - lo) / 10), 6) AS bin_lo,
           ROUND(lo + (g.bin + 1) * ((hi - lo) / 10), 6) AS bin_hi, CAST(coalesce(c.n, 0) AS BIGINT) AS n
    FROM grid g LEFT JOIN cnt c ON g."column" = c."column" AND g.bin = c.bin""", views=["v_li"]))
def q_histogram(spark, d):
    return r6(EX.histogram(V.v_li(spark, d), HIST_COLS, bins=10))


_HEAVY_SQL = """
    , hv AS (SELECT *, CASE WHEN l_orderkey % 500 = 0 THEN l_extendedprice * 1000 ELSE l_extendedprice END AS heavy FROM v_li)"""


def _heavy(spark, d):
    """v_li with a heavy-tailed column: a few values lie a thousand times further out."""
    far = F.when(F.col("l_orderkey") % 500 == 0, F.col("l_extendedprice") * 1000).otherwise(F.col("l_extendedprice"))
    return V.v_li(spark, d).withColumn("heavy", far)


# The density from the rows themselves (equal values counted once).
@query("kde", sql_with(_HEAVY_SQL + f"""
    , lng AS ({long_sql('hv', KDE_COLS)}),
    st AS (SELECT "column", min(x) AS lo, max(x) AS hi, count(*) AS n_obs, stddev_samp(x) AS sd FROM lng
           GROUP BY "column"),
    st2 AS (SELECT *, sd * pow(CAST(n_obs AS DOUBLE), -0.2) AS bw FROM st WHERE sd * pow(CAST(n_obs AS DOUBLE), -0.2) > 0),
    vals AS (SELECT "column", x AS v, count(*) AS c FROM lng GROUP BY 1, 2),
    pts AS (SELECT "column", n_obs, bw, t.range AS point, lo + t.range * ((hi - lo) / 199) AS x FROM st2, range(0, 200) t)
    SELECT p."column", CAST(p.point AS BIGINT) AS point, ROUND(p.x, 3) AS x,
           ROUND(bw * sum(c * exp(-0.5 * ((p.x - v) / bw) * ((p.x - v) / bw))) / (n_obs * bw * sqrt(2 * pi())), 6) AS density
    FROM pts p JOIN vals c ON p."column" = c."column" GROUP BY p."column", p.point, p.x, n_obs, bw""",
    views=["v_li"]))
def q_kde(spark, d):
    """Densities in units of 1 / bandwidth, so that every column shows six digits."""
    out = EX.kde(_heavy(spark, d), KDE_COLS, grid=200)
    long_df = to_long_numeric(_heavy(spark, d), KDE_COLS)
    bw = long_df.groupBy("column").agg((F.stddev_samp("x") * F.pow(F.count("x").cast("double"), F.lit(-0.2))).alias("bw"))
    return r6(out.join(bw, "column").select("column", F.col("point").cast("bigint").alias("point"), F.round("x", 3).alias("x"),
                                            (F.col("bw") * F.col("density")).alias("density")))


@query("histogram_auto", sql_with(_HEAVY_SQL + f"""
    , lng AS ({long_sql('hv', AUTO_COLS)}),
    st AS (SELECT "column", min(x) AS lo, max(x) AS hi, count(*) AS n, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr
           FROM lng GROUP BY "column"),
    w AS (SELECT *, (hi - lo) / (log2(n) + 1.0) AS sturges, 2.0 * iqr * pow(n, -1.0 / 3.0) AS fd FROM st),
    nb AS (SELECT *, CASE WHEN hi > lo THEN greatest(1, ceil((hi - lo) / CASE WHEN fd > 0 THEN least(fd, sturges) ELSE sturges END)) ELSE 1 END
             AS nbins FROM w)
    SELECT "column", CAST(bin AS BIGINT) AS bin, ROUND(lo + bin * ((hi - lo) / nbins), 6) AS bin_lo,
           ROUND(lo + (bin + 1) * ((hi - lo) / nbins), 6) AS bin_hi, CAST(count(*) AS BIGINT) AS n
    FROM (SELECT nb.*, CASE WHEN hi > lo THEN least(floor((x - lo) / (hi - lo) * nbins), nbins - 1) ELSE 0 END AS bin
          FROM lng JOIN nb ON lng."column" = nb."column") GROUP BY "column", bin, lo, hi, nbins""", views=["v_li"]))
def q_histogram_auto(spark, d):
    return r6(EX.histogram(_heavy(spark, d), AUTO_COLS, bins="auto"))


_BOX_SQL = """
    , lng AS ({long}),
    qs AS (SELECT {pre}"column", quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
                  quantile_cont(x, 0.75) AS q3 FROM lng GROUP BY {pre}"column"),
    f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM qs)
    SELECT {fpre}f."column", ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3, ROUND(iqr, 6) AS iqr,
           ROUND(min(x) FILTER (WHERE x >= lo_f), 6) AS whisker_lo, ROUND(max(x) FILTER (WHERE x <= hi_f), 6) AS whisker_hi,
           CAST(count(*) FILTER (WHERE x < lo_f OR x > hi_f) AS BIGINT) AS n_outliers
    FROM lng l JOIN f ON l."column" = f."column" {join_by}
    GROUP BY {fpre}f."column", q1, median, q3, iqr"""


@query("box_stats", sql_with(_BOX_SQL.format(long=long_sql("v_li", V.LI_NUMERIC), pre="", fpre="", join_by=""),
                             views=["v_li"]))
def q_box_stats(spark, d):
    return r6(EX.box_stats(V.v_li(spark, d), V.LI_NUMERIC))


@query("box_stats_by", sql_with(_BOX_SQL.format(long=long_sql("v_doc", V.DOC_NUMERIC, ["quality"]), pre="quality, ",
                                                fpre="f.quality, ", join_by="AND l.quality = f.quality"),
                                views=["v_doc"]))
def q_box_stats_by(spark, d):
    return r6(EX.box_stats(V.v_doc(spark, d), V.DOC_NUMERIC, by=["quality"]))


@query("category_distribution", sql_with(f"""
    SELECT "column", CASE WHEN n < {CAT_MIN_FREQ} THEN 'Other' ELSE value END AS value, CAST(sum(n) AS BIGINT) AS n
    FROM ({freq_sql('v_doc', V.DOC_CATEGORICAL)}) GROUP BY 1, 2""", views=["v_doc"]))
def q_category_distribution(spark, d):
    return EX.category_distribution(V.v_doc(spark, d), V.DOC_CATEGORICAL, min_freq=CAT_MIN_FREQ)


@query("crosstab_normalized", sql_with(f"""
    SELECT "column", value, quality AS label, CAST(n AS BIGINT) AS n,
           ROUND(n / sum(n) OVER (PARTITION BY "column", value), 6) AS share
    FROM ({freq_sql('v_doc', V.DOC_CATEGORICAL, ['quality'])})""", views=["v_doc"]))
def q_crosstab_normalized(spark, d):
    return r6(EX.crosstab_normalized(V.v_doc(spark, d), V.DOC_CATEGORICAL, "quality"))


def _corr_sql(cols, where=""):
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if where == "upper" and not i < j:
                continue
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS r FROM v_li")
    return "\nUNION ALL\n".join(parts)


@query("correlation_matrix", sql_with(f"""
    SELECT col_a, col_b, CASE WHEN isnan(r) THEN NULL ELSE ROUND(r, 6) END AS r FROM ({_corr_sql(V.LI_NUMERIC)})""",
    views=["v_li"]))
def q_correlation_matrix(spark, d):
    return r6(EX.correlation_matrix(V.v_li(spark, d), V.LI_NUMERIC))


@query("redundant_pairs", sql_with(f"""
    SELECT col_a, col_b, ROUND(r, 6) AS r FROM ({_corr_sql(V.LI_NUMERIC, 'upper')})
    WHERE NOT isnan(r) AND abs(r) > 0.95""", views=["v_li"]))
def q_redundant_pairs(spark, d):
    return r6(EX.redundant_pairs(V.v_li(spark, d), V.LI_NUMERIC, 0.95))
