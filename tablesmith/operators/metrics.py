"""Classification metrics as distributed aggregations (#70, #76-#85).

Input is a scored frame with ``label`` (1 = positive), ``score`` (probability of class 1)
and optionally ``prediction``, plus grouping columns (``run``). Every metric is one pass over
the rows grouped by run; curves and areas aggregate to distinct scores first and then use
running totals over ranges of the scores, so no window spans all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.functions.columns import div_or_zero, is_numeric, q, safe_div
from tablesmith.functions.ranking import running_totals

# The decision-threshold grid of the threshold sweep, 0.10 to 0.90 by 0.05,
# built from integers so that no binary drift accumulates.
SWEEP_THRESHOLDS = [round(i * 0.05, 2) for i in range(2, 19)]


def _by(by):
    return [q(b) for b in (by or [])]


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction", by=("run",)) -> DataFrame:
    """(by..., accuracy): share of rows with prediction equal to label (#70)."""
    return df.groupBy(*_by(by)).agg(F.avg((F.col(q(prediction)) == F.col(q(label))).cast("double")).alias("accuracy"))


def _counts(df, label, prediction, by):
    y, p = F.col(q(label)), F.col(q(prediction))
    return df.groupBy(*_by(by)).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y != 1) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p != 1)).alias("fn"), F.count_if((y != 1) & (p != 1)).alias("tn"))


def _prf(tp, fp, fn):
    precision = div_or_zero(tp, tp + fp)
    recall = div_or_zero(tp, tp + fn)
    f1 = div_or_zero(2 * precision * recall, precision + recall)
    return precision, recall, f1


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", by=("run",)) -> DataFrame:
    """(by..., accuracy, precision, recall, f1) of class 1; 0 for an empty denominator.
    Four conditional counts in one aggregate."""
    c = _counts(df, label, prediction, by)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    p, r, f1 = _prf(tp, fp, fn)
    return c.select(*_by(by), div_or_zero(tp + tn, tp + fp + fn + tn).alias("accuracy"), p.alias("precision"),
                    r.alias("recall"), f1.alias("f1"))


def predict_at(df: DataFrame, threshold: float = 0.5, score: str = "score", out: str = "prediction") -> DataFrame:
    """prediction = 1 when score >= threshold."""
    return df.withColumn(out, (F.col(q(score)) >= threshold).cast("long"))


def _class_of(df: DataFrame, name: str):
    """A label or prediction as a class: whole numbers for numeric columns, else text."""
    return F.col(q(name)).cast("long" if is_numeric(df.schema[name].dataType) else "string")


def _cells(df: DataFrame, label: str, prediction: str, by) -> DataFrame:
    """(by..., actual, predicted, n): the non-empty cells, at most classes squared per group."""
    return df.groupBy(*_by(by), _class_of(df, label).alias("actual"), _class_of(df, prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction", by=("run",)) -> DataFrame:
    """(by..., actual, predicted, n): every cell of the grid of the classes that occur on
    either side in the group. Rows with a NULL label or prediction stand in cells of their
    own, so the cells of a group add up to its rows."""
    cells = _cells(df, label, prediction, by)
    classes = F.array_distinct(F.array_compact(F.flatten(F.array(F.collect_set("actual"), F.collect_set("predicted")))))
    cell = lambda a, p, n: F.struct(a.alias("actual"), p.alias("predicted"), n.alias("n"))
    per = cells.groupBy(*_by(by)).agg(classes.alias("c"), F.collect_list(F.struct("actual", "predicted", "n")).alias("cells"))
    grid = F.flatten(F.transform("c", lambda a: F.transform("c", lambda p: cell(a, p, F.lit(0).cast("long")))))
    return (per.select(*_by(by), F.inline(F.concat(grid, "cells"))).groupBy(*_by(by), "actual", "predicted")
            .agg(F.sum("n").alias("n")))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction", by=("run",)) -> DataFrame:
    """(by..., class, precision, recall, f1, support): one row per class that occurs on
    either side, then 'accuracy' (in the f1 column), 'macro avg' and 'weighted avg'. Rows
    with a NULL label or prediction are left out of these and counted in a row 'missing',
    which is there only if there are such rows."""
    by = list(by or [])
    cells = _cells(df, label, prediction, by)
    whole = F.col("actual").isNotNull() & F.col("predicted").isNotNull()
    sides = cells.select(*_by(by), F.inline(F.array(
        F.struct(F.when(whole, F.col("actual")).alias("class"), F.col("n").alias("support"), F.lit(0).alias("pp"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.when(whole, F.col("predicted")).alias("class"), F.lit(0).alias("support"), F.col("n").alias("pp"),
                 F.lit(0).alias("tp")))))
    per = sides.groupBy(*_by(by), "class").agg(*[F.sum(c).alias(c) for c in ("support", "pp", "tp")])
    precision, recall = div_or_zero(F.col("tp"), F.col("pp")), div_or_zero(F.col("tp"), F.col("support"))
    per = per.withColumn("precision", precision).withColumn("recall", recall).withColumn(
        "f1", div_or_zero(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    known = F.col("class").isNotNull()
    n = F.sum(F.when(known, F.col("support")))
    measures = ("precision", "recall", "f1")
    row = lambda name, p, r, f, support: F.struct(name.alias("class"), p.alias("precision"), r.alias("recall"),
                                                  f.alias("f1"), support.cast("bigint").alias("support"))
    name = F.coalesce(F.col("class").cast("string"), F.lit("missing"))
    total = per.groupBy(*_by(by)).agg(
        F.collect_list(row(name, *[F.when(known, F.col(m)) for m in measures], F.col("support"))).alias("rows"),
        F.coalesce(n, F.lit(0)).alias("n"), div_or_zero(F.sum(F.when(known, F.col("tp"))), n).alias("acc"),
        *[F.avg(F.when(known, F.col(m))).alias("macro_" + m) for m in measures],
        *[div_or_zero(F.sum(F.when(known, F.col(m) * F.col("support"))), n).alias("weighted_" + m) for m in measures])
    empty = F.lit(None).cast("double")
    summary = F.array(row(F.lit("accuracy"), empty, empty, F.col("acc"), F.col("n")),
                      *[row(F.lit(f"{kind} avg"), *[F.col(f"{kind}_{m}") for m in measures], F.col("n")) for kind in ("macro", "weighted")])
    return total.select(*_by(by), F.inline(F.concat("rows", summary)))


def score_table(df: DataFrame, label: str = "label", score: str = "score", by=("run",),
                prediction: str | None = None) -> DataFrame:
    """Per (by, distinct score): positives and negatives, their running totals in descending
    score order, and the totals of the group. Rows with a NULL score or label form one row
    per group with a NULL score; their number is ``tot_n_dropped`` on every row. With
    ``prediction`` the counts of the confusion matrix are totalled too. One pass over the
    rows, one table in the checkpoint folder."""
    by = list(by or [])
    y = F.col(q(label)).cast("long")
    ok = F.col(q(score)).isNotNull() & F.col(q(label)).isNotNull()
    sums = {"pos": F.when(ok, y).otherwise(0), "neg": F.when(ok, 1 - y).otherwise(0), "n_dropped": F.when(ok, 0).otherwise(1)}
    if prediction:
        p, one = F.col(q(prediction)) == 1, F.col(q(label)) == 1
        sums |= {"tp": (one & p).cast("long"), "fp": (~one & p).cast("long"), "fn": (one & ~p).cast("long"),
                 "tn": (~one & ~p).cast("long")}
    s = df.groupBy(*_by(by), F.when(ok, F.col(q(score)).cast("double")).alias("score")).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(k) for k, c in sums.items()])
    return running_totals(s, by, "score", list(sums), descending=True)


def _points(t: DataFrame) -> DataFrame:
    return t.where(F.col("score").isNotNull())


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", by=("run",)) -> DataFrame:
    """(by..., threshold, fpr, tpr): one point per distinct score (descending), plus the
    start point (0, 0) at threshold +inf. All points are kept."""
    t = score_table(df, label, score, by)
    pts = _points(t).select(*_by(by), F.col("score").alias("threshold"), safe_div(F.col("cum_neg"), F.col("tot_neg")).alias("fpr"),
                            safe_div(F.col("cum_pos"), F.col("tot_pos")).alias("tpr"))
    start = t.select(*_by(by)).distinct() if by else t.limit(1)
    return pts.unionByName(start.select(*_by(by), F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                                        F.lit(0.0).alias("tpr")))


def _areas(t: DataFrame, by) -> DataFrame:
    """(by..., roc_auc, average_precision, n_dropped and the other totals) of a score table.
    A score adds neg * (previous tpr + tpr) / 2 to the area, the previous point being its own
    running total less its own counts, and its recall step times its precision to the average
    precision, so no ordered window is needed."""
    area = F.col("neg") * (2 * F.col("cum_pos") - F.col("pos"))
    precision = div_or_zero(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))
    totals = [F.first(c).alias(c[4:]) for c in t.columns if c.startswith("tot_")]
    g = t.groupBy(*_by(by)).agg(F.sum(area).alias("area"), F.sum(F.col("pos") * precision).alias("steps"), *totals)
    return g.select(*_by(by), safe_div(F.col("area"), 2 * F.col("pos") * F.col("neg")).alias("roc_auc"),
                    safe_div(F.col("steps"), F.col("pos")).alias("average_precision"),
                    *[F.col(c[4:]).cast("bigint").alias(c[4:]) for c in t.columns if c.startswith("tot_")])


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", by=("run",)) -> DataFrame:
    """(by..., roc_auc, n_dropped): trapezoid area under the ROC curve; n_dropped rows had a
    NULL score or label."""
    return _areas(score_table(df, label, score, by), by).select(*_by(by), "roc_auc", "n_dropped")


def pr_curve(df: DataFrame, label: str = "label", score: str = "score", by=("run",)) -> DataFrame:
    """(by..., threshold, precision, recall): a point per distinct score plus the end
    point (recall 0, precision 1) without threshold."""
    t = score_table(df, label, score, by)
    pts = _points(t).select(*_by(by), F.col("score").alias("threshold"),
                            div_or_zero(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
                            F.coalesce(safe_div(F.col("cum_pos"), F.col("tot_pos")), F.lit(1.0)).alias("recall"))
    end = t.select(*_by(by)).distinct() if by else t.limit(1)
    return pts.unionByName(end.select(*_by(by), F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                                      F.lit(0.0).alias("recall")))


def average_precision(df: DataFrame, label: str = "label", score: str = "score", by=("run",)) -> DataFrame:
    """(by..., average_precision, n_dropped) = sum over thresholds of (R_n - R_(n-1)) * P_n;
    the recall step at a score is its positives over all positives."""
    return _areas(score_table(df, label, score, by), by).select(*_by(by), "average_precision", "n_dropped")


def threshold_counts(df: DataFrame, thresholds, label: str, score: str, by) -> DataFrame:
    """(by..., j, threshold, tp, fp, pos, neg, n_dropped) at each threshold (prediction =
    score >= threshold) from one aggregate: rows are counted by how many thresholds they
    reach, and the at most len(thresholds) + 2 counts of a group are added up per threshold."""
    ts = sorted(float(t) for t in thresholds)
    y, x = F.col(q(label)).cast("long"), F.col(q(score))
    reached = sum(((x >= t).cast("int") for t in ts), F.lit(0))
    ok = x.isNotNull() & y.isNotNull()
    g = df.groupBy(*_by(by), F.when(ok, reached).alias("b")).agg(
        F.coalesce(F.sum(F.when(ok, y)), F.lit(0)).alias("pos"), F.coalesce(F.sum(F.when(ok, 1 - y)), F.lit(0)).alias("neg"),
        F.count_if(~ok).alias("n_dropped"))
    cells = g.groupBy(*_by(by)).agg(F.collect_list(F.struct("b", "pos", "neg")).alias("cells"), F.sum("pos").alias("pos"),
                                    F.sum("neg").alias("neg"), F.sum("n_dropped").alias("n_dropped"))
    above = lambda name: F.aggregate(
        F.filter("cells", lambda c: c["b"] > F.col("j")), F.lit(0).cast("long"), lambda s, c: s + c[name])
    grid = cells.select("*", F.posexplode(F.array(*[F.lit(t) for t in ts])).alias("j", "threshold"))
    return grid.select(*_by(by), "j", "threshold", above("pos").alias("tp"), above("neg").alias("fp"), "pos", "neg", "n_dropped")


def threshold_sweep(df: DataFrame, thresholds=None, label: str = "label", score: str = "score",
                    by=("run",)) -> DataFrame:
    """(by..., threshold, precision, recall, f1, n_dropped) at each threshold; n_dropped rows
    had a NULL score or label."""
    c = threshold_counts(df, thresholds or SWEEP_THRESHOLDS, label, score, by)
    p, r, f1 = _prf(F.col("tp"), F.col("fp"), F.col("pos") - F.col("tp"))
    return c.select(*_by(by), "threshold", p.alias("precision"), r.alias("recall"), f1.alias("f1"),
                    F.col("n_dropped").cast("bigint").alias("n_dropped"))


def best_threshold(sweep: DataFrame, metric: str = "f1", by=("run",)) -> DataFrame:
    """(by..., threshold, <metric>): the arg-max of the sweep, ties to the lower threshold."""
    return sweep.groupBy(*_by(by)).agg(
        F.max_by("threshold", F.struct(F.col(metric), -F.col("threshold"))).alias("threshold"),
        F.max(metric).alias(metric))


def compare_runs(df: DataFrame, label: str = "label", score: str = "score", prediction: str = "prediction",
                 by=("run",), digits: int | None = None) -> DataFrame:
    """One row per run: accuracy, precision, recall, F1 (class 1), ROC AUC, average precision
    and n_dropped (rows without score or label), all from one score table; optionally
    rounded."""
    a = _areas(score_table(df, label, score, by, prediction), by)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    p, r, f1 = _prf(tp, fp, fn)
    out = a.select(*_by(by), div_or_zero(tp + tn, tp + fp + fn + tn).alias("accuracy"), p.alias("precision"), r.alias("recall"),
                   f1.alias("f1"), "roc_auc", "average_precision", "n_dropped")
    if digits is not None:
        out = out.select(*[F.round(c, digits).alias(c) if c not in [*(by or []), "n_dropped"] else F.col(q(c)) for c in out.columns])
    return out

