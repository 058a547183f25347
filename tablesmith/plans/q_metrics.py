"""Queries: classification metrics over deterministic scored runs (#70, #76-#85)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesmith.operators import metrics as M
from tablesmith.plans.frames import sql_with
from tablesmith.plans.registry import query
from tablesmith.plans.sqlgen import r6
from tablesmith.sources import views as V
from tablesmith.sources.tables import read_table

_S = """
    , s AS (SELECT run, score, CAST(sum(label) AS BIGINT) AS pos, CAST(count(*) - sum(label) AS BIGINT) AS neg
            FROM v_scores GROUP BY run, score),
    c AS (SELECT run, score, pos, neg, sum(pos) OVER (PARTITION BY run ORDER BY score DESC) AS cp,
                 sum(neg) OVER (PARTITION BY run ORDER BY score DESC) AS cn FROM s),
    t AS (SELECT run, sum(pos) AS P, sum(neg) AS N FROM s GROUP BY run),
    dr AS (SELECT run, CAST(count(*) FILTER (WHERE score IS NULL OR label IS NULL) AS BIGINT) AS n_dropped FROM v_scores GROUP BY run)"""


def _sql(body):
    return sql_with(_S + "\n" + body, views=["v_scores"])


_COUNTS = """
    SELECT run, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
           count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp,
           count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn,
           count(*) FILTER (WHERE label <> 1 AND prediction <> 1) AS tn FROM v_scores GROUP BY run"""
_PRF = """
    SELECT run, CASE WHEN tp + fp + fn + tn = 0 THEN 0 ELSE (tp + tn) / (tp + fp + fn + tn) END AS accuracy,
           CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
           CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall FROM ({counts})"""
_BM = f"""
    SELECT run, ROUND(accuracy, 6) AS accuracy, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall,
           ROUND(CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END, 6) AS f1
    FROM ({_PRF.format(counts=_COUNTS)})"""


@query("accuracy", sql_with("SELECT run, ROUND(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy "
                            "FROM v_scores GROUP BY run", views=["v_scores"]))
def q_accuracy(spark, d):
    return r6(M.accuracy(V.v_scores(spark, d)))


@query("binary_metrics", sql_with(_BM, views=["v_scores"]))
def q_binary_metrics(spark, d):
    return r6(M.binary_metrics(V.v_scores(spark, d)))


@query("confusion_matrix", sql_with("""
    SELECT g.run, g.actual, g.predicted, CAST(coalesce(n, 0) AS BIGINT) AS n
    FROM (SELECT DISTINCT run FROM v_scores) r,
         LATERAL (SELECT r.run, CAST(a AS BIGINT) AS actual, CAST(p AS BIGINT) AS predicted
                  FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(a, p)) g
    LEFT JOIN (SELECT run, label, prediction, count(*) AS n FROM v_scores GROUP BY 1, 2, 3) c
      ON g.run = c.run AND g.actual = c.label AND g.predicted = c.prediction""", views=["v_scores"]))
def q_confusion_matrix(spark, d):
    return M.confusion_matrix(V.v_scores(spark, d))


_REPORT = """
    , k AS (SELECT run, count(*) AS n, count(*) FILTER (WHERE label = prediction) AS correct,
                   count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tp0, count(*) FILTER (WHERE prediction = 0) AS pp0,
                   count(*) FILTER (WHERE label = 0) AS s0,
                   count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp1, count(*) FILTER (WHERE prediction = 1) AS pp1,
                   count(*) FILTER (WHERE label = 1) AS s1 FROM v_scores GROUP BY run),
    pc AS (SELECT run, n, correct, s0, s1,
                  CASE WHEN pp0 = 0 THEN 0 ELSE tp0 / pp0 END AS p0, CASE WHEN s0 = 0 THEN 0 ELSE tp0 / s0 END AS r0,
                  CASE WHEN pp1 = 0 THEN 0 ELSE tp1 / pp1 END AS p1, CASE WHEN s1 = 0 THEN 0 ELSE tp1 / s1 END AS r1 FROM k),
    pf AS (SELECT *, CASE WHEN p0 + r0 = 0 THEN 0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f0,
                     CASE WHEN p1 + r1 = 0 THEN 0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1 FROM pc)
    SELECT run, '0' AS class, ROUND(p0, 6) AS precision, ROUND(r0, 6) AS recall, ROUND(f0, 6) AS f1,
           CAST(s0 AS BIGINT) AS support FROM pf
    UNION ALL SELECT run, '1', ROUND(p1, 6), ROUND(r1, 6), ROUND(f1, 6), CAST(s1 AS BIGINT) FROM pf
    UNION ALL SELECT run, 'accuracy', NULL, NULL, ROUND(correct / n, 6), CAST(n AS BIGINT) FROM pf
    UNION ALL SELECT run, 'macro avg', ROUND((p0 + p1) / 2, 6), ROUND((r0 + r1) / 2, 6), ROUND((f0 + f1) / 2, 6),
                     CAST(n AS BIGINT) FROM pf
    UNION ALL SELECT run, 'weighted avg', ROUND((p0 * s0 + p1 * s1) / n, 6), ROUND((r0 * s0 + r1 * s1) / n, 6),
                     ROUND((f0 * s0 + f1 * s1) / n, 6), CAST(n AS BIGINT) FROM pf"""


@query("classification_report", sql_with(_REPORT, views=["v_scores"]))
def q_classification_report(spark, d):
    return r6(M.classification_report(V.v_scores(spark, d)))


_THREE = """
    , x AS (SELECT lang AS run, CAST(n_chars % 3 AS BIGINT) AS label,
                   CASE WHEN doc_id % 11 = 0 THEN NULL ELSE CAST(length(text) % 4 AS BIGINT) END AS prediction FROM documents),
    m AS (SELECT run, label AS actual, prediction AS predicted, CAST(count(*) AS BIGINT) AS n FROM x GROUP BY 1, 2, 3),
    cl AS (SELECT DISTINCT run, c FROM (SELECT run, actual AS c FROM m UNION ALL SELECT run, predicted FROM m) WHERE c IS NOT NULL)"""


def _three(spark, d):
    """Documents with a label of three classes and a prediction of four, some missing."""
    doc = read_table(spark, d, "documents")
    return doc.select(F.col("lang").alias("run"), (F.col("n_chars") % 3).cast("long").alias("label"),
                      F.when(F.col("doc_id") % 11 != 0, (F.length("text") % 4).cast("long")).alias("prediction"))


@query("confusion_matrix_classes", "WITH one AS (SELECT 1)" + _THREE + """
    SELECT a.run, a.c AS actual, b.c AS predicted, coalesce(n, 0) AS n FROM cl a JOIN cl b ON a.run = b.run
      LEFT JOIN m ON m.run = a.run AND m.actual = a.c AND m.predicted = b.c
    UNION ALL SELECT run, actual, predicted, n FROM m WHERE actual IS NULL OR predicted IS NULL""")
def q_confusion_matrix_classes(spark, d):
    return M.confusion_matrix(_three(spark, d))


@query("classification_report_classes", "WITH one AS (SELECT 1)" + _THREE + """
    , w AS (SELECT * FROM m WHERE actual IS NOT NULL AND predicted IS NOT NULL),
    wc AS (SELECT DISTINCT run, c FROM (SELECT run, actual AS c FROM w UNION ALL SELECT run, predicted FROM w)),
    k AS (SELECT wc.run, c, coalesce(sum(n) FILTER (actual = c), 0) AS s, coalesce(sum(n) FILTER (predicted = c), 0) AS pp,
                 coalesce(sum(n) FILTER (actual = c AND predicted = c), 0) AS tp FROM wc JOIN w ON wc.run = w.run GROUP BY 1, 2),
    pr AS (SELECT *, CASE WHEN pp = 0 THEN 0 ELSE tp / pp END AS p, CASE WHEN s = 0 THEN 0 ELSE tp / s END AS r FROM k),
    f AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f FROM pr)
    SELECT run, CAST(c AS VARCHAR) AS class, ROUND(p, 6) AS precision, ROUND(r, 6) AS recall, ROUND(f, 6) AS f1, CAST(s AS BIGINT) AS support FROM f
    UNION ALL SELECT run, 'accuracy', NULL, NULL, ROUND(sum(tp) / sum(s), 6), CAST(sum(s) AS BIGINT) FROM f GROUP BY run
    UNION ALL SELECT run, 'macro avg', ROUND(avg(p), 6), ROUND(avg(r), 6), ROUND(avg(f), 6), CAST(sum(s) AS BIGINT) FROM f GROUP BY run
    UNION ALL SELECT run, 'weighted avg', ROUND(sum(p * s) / sum(s), 6), ROUND(sum(r * s) / sum(s), 6), ROUND(sum(f * s) / sum(s), 6),
                     CAST(sum(s) AS BIGINT) FROM f GROUP BY run
    UNION ALL SELECT run, 'missing', NULL, NULL, NULL, CAST(sum(n) AS BIGINT) FROM m WHERE actual IS NULL OR predicted IS NULL GROUP BY run""")
def q_classification_report_classes(spark, d):
    return r6(M.classification_report(_three(spark, d)))


@query("roc_curve", _sql("""
    SELECT c.run, c.score AS threshold, ROUND(cn / N, 6) AS fpr, ROUND(cp / P, 6) AS tpr FROM c JOIN t ON c.run = t.run
    UNION ALL SELECT run, CAST('inf' AS DOUBLE), 0.0, 0.0 FROM t"""))
def q_roc_curve(spark, d):
    return r6(M.roc_curve(V.v_scores(spark, d)))


@query("roc_auc", _sql("""
    SELECT c.run, ROUND(sum(neg * (2 * cp - pos)) / (2 * max(P) * max(N)), 6) AS roc_auc, max(n_dropped) AS n_dropped
    FROM c JOIN t ON c.run = t.run JOIN dr ON c.run = dr.run GROUP BY c.run"""))
def q_roc_auc(spark, d):
    return r6(M.roc_auc(V.v_scores(spark, d)))


@query("pr_curve", _sql("""
    SELECT c.run, c.score AS threshold, ROUND(cp / (cp + cn), 6) AS precision, ROUND(cp / P, 6) AS recall
    FROM c JOIN t ON c.run = t.run
    UNION ALL SELECT run, CAST(NULL AS DOUBLE), 1.0, 0.0 FROM t"""))
def q_pr_curve(spark, d):
    return r6(M.pr_curve(V.v_scores(spark, d)))


@query("average_precision", _sql("""
    SELECT c.run, ROUND(sum(pos * (cp / (cp + cn))) / max(P), 6) AS average_precision, max(n_dropped) AS n_dropped
    FROM c JOIN t ON c.run = t.run JOIN dr ON c.run = dr.run GROUP BY c.run"""))
def q_average_precision(spark, d):
    return r6(M.average_precision(V.v_scores(spark, d)))


_TH = "(VALUES " + ", ".join(f"({t})" for t in M.SWEEP_THRESHOLDS) + ") th(threshold)"
_SWEEP = f"""
    , sw AS (SELECT run, CAST(threshold AS DOUBLE) AS threshold,
                    count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp,
                    count(*) FILTER (WHERE label = 0 AND score >= threshold) AS fp,
                    count(*) FILTER (WHERE label = 1 AND score < threshold) AS fn
             FROM v_scores, {_TH} GROUP BY run, threshold),
    pr AS (SELECT run, threshold, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
                  CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall FROM sw),
    f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1
          FROM pr)"""


@query("threshold_sweep", sql_with(_SWEEP + """
    SELECT run, threshold, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1,
           (SELECT CAST(count(*) FILTER (WHERE score IS NULL OR label IS NULL) AS BIGINT) FROM v_scores v WHERE v.run = f.run) AS n_dropped
    FROM f""",
    views=["v_scores"]))
def q_threshold_sweep(spark, d):
    return r6(M.threshold_sweep(V.v_scores(spark, d)))


@query("best_threshold", sql_with(_SWEEP + """
    SELECT run, arg_max(threshold, (ROUND(f1, 12), -threshold)) AS threshold, ROUND(max(f1), 6) AS f1
    FROM f GROUP BY run""", views=["v_scores"]))
def q_best_threshold(spark, d):
    return r6(M.best_threshold(M.threshold_sweep(V.v_scores(spark, d))))


@query("compare_runs", _sql(f"""
    , auc AS (SELECT c.run, sum(neg * (2 * cp - pos)) / (2 * max(P) * max(N)) AS roc_auc,
                     sum(pos * (cp / (cp + cn))) / max(P) AS average_precision FROM c JOIN t ON c.run = t.run
              GROUP BY c.run),
    bm AS ({_BM})
    SELECT bm.*, ROUND(auc.roc_auc, 6) AS roc_auc, ROUND(auc.average_precision, 6) AS average_precision, n_dropped
    FROM bm JOIN auc ON bm.run = auc.run JOIN dr ON bm.run = dr.run"""))
def q_compare_runs(spark, d):
    return r6(M.compare_runs(V.v_scores(spark, d)))
