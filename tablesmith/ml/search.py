"""Grid search with k-fold cross-validation, CV tables and leaderboards (#71-#74, #47).

Candidates form a tree over the ordered stage parameters (:class:`StageTree`): each distinct
prefix is a node that is fitted once for all folds, from statistics that subtract
(:mod:`tablesmith.ml.statistics`), so the scans of the training frame for preprocessing depend
neither on the folds nor on the candidates. The transformed frame of a leaf is written once per
fold, both sides together, and every model candidate of the leaf is fitted and scored on that
table: the plans of these jobs, which stay on the driver, are a scan. Each fit is an MLlib job over
the whole fold; the driver loop starts several leaves at a time and collects one score per
(candidate, fold, split).
"""

from __future__ import annotations

import dataclasses
import itertools
import json
import time
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.errors import IllegalArgumentException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tablesmith.functions.columns import q
from tablesmith.ml.assembly import (MODEL_NAMES, PrepConfig, assembler, build_classifier, category_prep, numeric_prep, one_hot,
                                    preprocessing_stages)
from tablesmith.ml.chains import CategoryPrepModel, NumericPrepModel
from tablesmith.ml.stages import ClassWeightsModel, class_weights
from tablesmith.ml.statistics import CategoryStatistics, FittedNumeric, NumericStatistics
from tablesmith.operators import metrics as M
from tablesmith.session import discarded, garbage_collected, stored

PREP_FIELDS = {f.name for f in dataclasses.fields(PrepConfig)} - {"num_cols", "cat_cols", "label"}
MODEL_PARAMS = {"model", "C", "penalty", "max_iter", "max_depth", "n_estimators", "min_samples_leaf",
                "min_samples_split", "max_bins", "random_state"}
SCORERS = ["accuracy", "precision", "recall", "f1", "roc_auc"]
# Parameter: rows of a fold's table that a task of a fit reads. Fits make a job for every iteration,
# and what a job costs the driver grows with its stages and tasks.
FIT_ROWS = 1 << 18


def expand_grid(grid) -> list[dict]:
    """Cartesian product of a dict of lists; a list of dicts is the union of products."""
    grids = grid if isinstance(grid, list) else [grid]
    out = []
    for g in grids:
        keys = sorted(g)
        for combo in itertools.product(*[g[k] for k in keys]):
            out.append(dict(zip(keys, combo)))
    return out


def _check_names(cands):
    for c in cands:
        for k in c:
            if k not in PREP_FIELDS and k not in MODEL_PARAMS and not k.startswith("grouping."):
                raise ValueError(f"unknown grid parameter {k}")


def _prep_of(cfg: PrepConfig, cand: dict) -> PrepConfig:
    upd = {k: v for k, v in cand.items() if k in PREP_FIELDS}
    grouping = dict(cfg.grouping)
    for k, v in cand.items():
        if k.startswith("grouping."):
            grouping[k.split(".", 1)[1]] = v
    return dataclasses.replace(cfg, grouping=grouping, **upd)


class StageTree:
    """The candidates' preprocessing as a prefix tree over the ordered stage parameters: clip ->
    fill -> scale, then fill -> group of the categories, then class weights.

    A node is a prefix of parameters; what is fitted hangs at the node that decides it, so
    candidates that differ in the scaler share clip and fill, and all of these share the
    categories' dictionary. ``model(i, fold)`` is the fitted preprocessing of candidate i for the
    training side of a fold (None: for the whole frame). Candidates whose parameters are invalid
    have an entry in ``errors``."""

    def __init__(self, train: DataFrame, cfg: PrepConfig, cands: list[dict], fold_col: str | None = None):
        self.train, self.fold_col = train, fold_col
        self.configs, self.errors, self.paths = {}, {}, {}
        numeric, category = {}, {}
        for i, c in enumerate(cands):
            try:
                own = _prep_of(cfg, {k: v for k, v in c.items() if k not in MODEL_PARAMS})
                x = numeric_prep(own).chain() if own.num_cols else None
                y = category_prep(own).chain() if own.cat_cols else None
                if own.class_weight not in (None, "none", "balanced") and not isinstance(own.class_weight, dict):
                    raise ValueError(f"unknown class weight {own.class_weight}")
            except PARAMETER_ERRORS as e:
                self.errors[i] = str(e)
                continue
            self.configs[i] = own
            numeric[i], category[i] = x, y
            weight = json.dumps(own.class_weight, sort_keys=True, default=str)
            # the path from the root, a node per stage
            self.paths[i] = [*([("clip", *x.clip), ("fill", x.impute), ("scale", x.scaling)] if x else []),
                             *([("category", y.impute, y.fill), ("group", y.grouping, y.other)] if y else []), ("weight", weight)]
        self.numeric_of, self.category_of = numeric, category
        self.numeric = NumericStatistics(train, list(cfg.num_cols), [x for x in numeric.values() if x], fold_col)
        # rows per fold: a row each reaches the driver
        self.sizes = {r[0]: r[1] for r in train.groupBy(q(fold_col)).count().collect()} if fold_col else {}
        views = [None] + sorted(f for f in self.sizes if f is not None)
        self.category = CategoryStatistics(train, list(cfg.cat_cols), [y for y in category.values() if y], fold_col, views)
        # rows per fold and class: a row each reaches the driver
        self.classes = {}
        if any(c.class_weight not in (None, "none") for c in self.configs.values()):
            by = [F.col(q(fold_col)) if fold_col else F.lit(None).alias("fold"), F.col(q(cfg.label))]
            for fold, label, n in train.where(F.col(q(cfg.label)).isNotNull()).groupBy(*by).count().collect():
                self.classes.setdefault(fold, {})[label] = n

    def nodes(self) -> set[tuple]:
        """Every distinct prefix: what is fitted once, for all folds."""
        return {tuple(path[:n + 1]) for path in self.paths.values() for n in range(len(path))}

    def leaves(self) -> dict[tuple, list[int]]:
        """Candidates by their whole path."""
        out = {}
        for i, path in self.paths.items():
            out.setdefault(tuple(path), []).append(i)
        return out

    def side(self, fold) -> DataFrame:
        """The training side of a fold."""
        return self.train if fold is None else self.train.where(F.col(q(self.fold_col)) != F.lit(fold))

    def model(self, i: int, fold=None) -> PipelineModel:
        cfg, stages = self.configs[i], []
        if cfg.num_cols:
            stages.append(NumericPrepModel.of(list(cfg.num_cols), self.numeric.fitted.get((self.numeric_of[i], fold), FittedNumeric())))
        if cfg.cat_cols:
            outs = [f"{c}__idx" for c in cfg.cat_cols]
            found = self.category.dictionary(self.category_of[i], fold)
            index = CategoryPrepModel.of(list(cfg.cat_cols), outs, found)
            # the number of indexes is in the columns' metadata: this fit reads no rows
            stages += [index, one_hot(cfg).fit(index.transform(self.train))]
        counts = {}
        for f, per in self.classes.items():
            for label, n in per.items() if fold is None or f != fold else ():
                counts[label] = counts.get(label, 0) + n
        weights = class_weights(cfg.class_weight, counts, self.train.schema[cfg.label].dataType)
        return PipelineModel([*stages, assembler(cfg), ClassWeightsModel(labelCol=cfg.label, outputCol="weight", values=weights)])


def _score(scored: DataFrame, scoring: str) -> dict:
    """The score of each split."""
    made = M.roc_auc(scored, by=["split"]) if scoring == "roc_auc" else M.binary_metrics(scored, by=["split"])
    return {r["split"]: r[scoring] for r in made.collect()}


def _scored(model, df, label):
    from pyspark.ml.functions import vector_to_array
    out = model.transform(df)
    return out.select("split", F.col(label).cast("long").alias("label"), vector_to_array("probability")[1].alias("score"),
                      F.col("prediction").cast("long").alias("prediction"))


# What an invalid combination raises; anything else (a lost executor, memory) ends the search.
PARAMETER_ERRORS = (ValueError, TypeError, NotImplementedError, IllegalArgumentException)
CV_SCHEMA = ("experiment string, candidate int, params map<string,string>, fold int, split string, score double, "
             "fit_time double, error string")


def _params(cand: dict) -> dict:
    return {k: json.dumps(v, default=str) for k, v in cand.items()}


def grid_search(train: DataFrame, cfg: PrepConfig, grid, *, fold_col: str = "fold", model: str = "LogisticRegression",
                scoring: str = "accuracy", experiment: str = "experiment", refit: bool = True,
                model_params: dict | None = None, parallelism: int = 4):
    """Cross-validate every candidate on the folds of ``fold_col``.

    Returns ``(cv_long, best_params, best_model)`` where ``cv_long`` is
    (experiment, candidate, params, fold, split, score, fit_time, error) with split 'train' or
    'test'; an invalid combination gets a NULL score and its error. Up to ``parallelism``
    (fold, preprocessing) groups are fitted at the same time, so the cluster isn't idle in the
    single-task ends of their jobs; each is a set of Spark jobs over the whole fold."""
    if scoring not in SCORERS:
        raise ValueError(f"unknown scoring {scoring}")
    cands = [{**(model_params or {}), **c} for c in expand_grid(grid)]
    _check_names(cands)
    # the statistics and every fold and leaf re-read the training frame: keep it for the search
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tree = StageTree(train, cfg, cands, fold_col)
        folds = sorted(tree.sizes)
        fit_tasks = -(-sum(tree.sizes.values()) // FIT_ROWS)
        label = cfg.label

        def evaluate(task):
            f, idxs = task
            out = []
            try:
                prep = tree.model(idxs[0], f)
            except PARAMETER_ERRORS as e:
                return [(i, f, s, None, None, str(e)) for i in idxs for s in ("train", "test")]
            split = F.when(F.col(q(fold_col)) == F.lit(f), "test").otherwise("train").alias("split")
            rows = prep.transform(train.where(F.col(q(fold_col)).isNotNull())).select(q(label), "features", "weight", split)
            table = stored(rows, "fold-rows")
            rows = table.coalesce(fit_tasks)
            try:
                for i in idxs:
                    try:
                        t0 = time.time()
                        m = build_classifier(cands[i].get("model", model), cands[i], label=label).fit(rows.where("split = 'train'").drop("split"))
                        ft = time.time() - t0
                        scores = _score(_scored(m, rows, label), scoring)
                        out += [(i, f, s, scores.get(s), ft, None) for s in ("train", "test")]
                    except PARAMETER_ERRORS as e:
                        out += [(i, f, s, None, None, str(e)) for s in ("train", "test")]
                    # a fit broadcasts in every iteration, each time through a buffer of 4 MB
                    garbage_collected(train.sparkSession)
            finally:
                discarded(table)
            return out

        tasks = [(f, idxs) for f in folds for idxs in tree.leaves().values()]
        rows = [(i, f, s, None, None, e) for i, e in tree.errors.items() for f in folds for s in ("train", "test")]
        garbage_collected(train.sparkSession)
        if tasks:
            with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
                rows += [r for part in pool.map(inheritable_thread_target(train.sparkSession)(evaluate), tasks) for r in part]
        cv = train.sparkSession.createDataFrame([(experiment, i, _params(cands[i]), int(f), s, None if x is None else float(x), ft, err)
                                    for i, f, s, x, ft, err in rows], CV_SCHEMA)
        best_params, best_model = None, None
        means = {}
        for i, _, s, x, _, _ in rows:
            if s == "test":
                means.setdefault(i, []).append(x)
        valid = {i: sum(v) / len(v) for i, v in means.items() if all(x is not None for x in v)}
        if valid:
            best = min(valid, key=lambda i: (-valid[i], i))
            best_params = cands[best]
            if refit:
                prep = tree.model(best)
                best_model = PipelineModel([*prep.stages, build_classifier(best_params.get("model", model), best_params, label=label).fit(prep.transform(train))])
    finally:
        train.unpersist()
    return cv, best_params, best_model


def build_pipeline_for(cfg: PrepConfig, cand: dict, model: str) -> Pipeline:
    pcfg = _prep_of(cfg, cand)
    return Pipeline(stages=preprocessing_stages(pcfg) + [build_classifier(cand.get("model", model), cand,
                                                                          label=cfg.label)])


def cv_results(cv_long: DataFrame) -> DataFrame:
    """Per candidate: params, mean/std (population) of test and train scores, the test scores
    by fold (``fold_scores``), mean fit time and ``rank_test_score`` (ties share the lowest
    rank; NULL scores last)."""
    test = F.col("split") == "test"
    agg = cv_long.groupBy("experiment", "candidate").agg(
        F.any_value("params").alias("params"),
        F.avg(F.when(test, F.col("score"))).alias("mean_test_score"),
        F.stddev_pop(F.when(test, F.col("score"))).alias("std_test_score"),
        F.avg(F.when(~test, F.col("score"))).alias("mean_train_score"),
        F.stddev_pop(F.when(~test, F.col("score"))).alias("std_train_score"),
        F.avg(F.when(test, F.col("fit_time"))).alias("mean_fit_time"),
        F.transform(F.array_sort(F.collect_list(F.when(test, F.struct("fold", "score")))), lambda x: x["score"]).alias("fold_scores"),
        F.count_if(test & F.col("score").isNull()).alias("__bad"))
    agg = agg.withColumn("mean_test_score", F.when(F.col("__bad") == 0, F.col("mean_test_score"))).drop("__bad")
    w = Window.partitionBy("experiment").orderBy(F.col("mean_test_score").desc_nulls_last())
    return agg.withColumn("rank_test_score", F.rank().over(w))


def leaderboard(results: DataFrame) -> DataFrame:
    """Best candidate of each experiment (lowest rank, first candidate on ties) with its
    params, sorted by mean test score descending."""
    w = Window.partitionBy("experiment").orderBy("rank_test_score", "candidate")
    best = results.withColumn("__r", F.row_number().over(w)).where(F.col("__r") == 1).drop("__r")
    return best.orderBy(F.col("mean_test_score").desc_nulls_last(), "experiment")


def nan_audit(train: DataFrame, cfg: PrepConfig, grid) -> DataFrame:
    """For the default configuration and every grid combination: fit the preprocessing on
    ``train`` and count missing cells of the columns that make the feature matrix. Invalid
    combinations are recorded, not raised: (combination, params, n_missing, error).

    The combinations' distinct prefixes are fitted once (:class:`StageTree`), and one aggregate
    counts the cells of every numeric chain and every dictionary: a combination's missing cells
    are those of its two."""
    spark = train.sparkSession
    cands = [{}] + expand_grid(grid)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tree = StageTree(train, cfg, cands)
        # one representative of each numeric chain and each dictionary
        parts = {}
        for i, own in tree.configs.items():
            if own.num_cols:
                parts.setdefault(("x", tree.numeric_of[i]), i)
            if own.cat_cols:
                parts.setdefault(("y", tree.category_of[i]), i)
        rows = train.select(*[F.col(q(c)) for c in [*cfg.num_cols, *cfg.cat_cols]])
        counts = []
        for n, ((kind, chain), i) in enumerate(parts.items()):
            if kind == "x":
                cols = list(cfg.num_cols)
                made = NumericPrepModel.of([f"__x{n}_{c}" for c in cols], _renamed(tree.numeric.fitted.get((chain, None), FittedNumeric()), f"__x{n}_"))
                rows = made.transform(rows.withColumns({f"__x{n}_{c}": F.col(q(c)) for c in cols}))
                outs = [f"__x{n}_{c}" for c in cols]
            else:
                outs = [f"__y{n}_{c}" for c in cfg.cat_cols]
                rows = CategoryPrepModel.of(list(cfg.cat_cols), outs, tree.category.dictionary(chain)).transform(rows)
            bad = sum((F.count_if(F.col(q(c)).isNull() | F.isnan(F.col(q(c)).cast("double"))) for c in outs), F.lit(0))
            counts.append(bad.cast("bigint").alias(f"n{n}"))
        found = rows.agg(*counts).first() if counts else []
        missing = {key: found[n] for n, key in enumerate(parts)}
        out = []
        for i, c in enumerate(cands):
            keys = [("x", tree.numeric_of.get(i)), ("y", tree.category_of.get(i))]
            out.append((i, _params(c), None if i in tree.errors else sum(missing.get(k, 0) for k in keys), tree.errors.get(i)))
    finally:
        train.unpersist()
    return spark.createDataFrame(out, "combination int, params map<string,string>, n_missing bigint, error string")


def _renamed(fitted: FittedNumeric, prefix: str) -> FittedNumeric:
    return FittedNumeric(*[{prefix + c: v for c, v in d.items()} for d in (fitted.limits, fitted.fills, fitted.scales)])


__all__ = ["expand_grid", "grid_search", "cv_results", "leaderboard", "nan_audit", "MODEL_NAMES"]


def threshold_cv(scored: DataFrame, thresholds: list[float], fold_col: str = "fold", by=("run",),
                 label: str = "label", score: str = "score") -> DataFrame:
    """Cross-validated search over the decision threshold of fixed scores: for each
    group (experiment), threshold (candidate) and fold, accuracy inside the fold ('test')
    and outside it ('train'). One aggregation; the window runs over the folds of one
    candidate. Output has the ``grid_search`` CV-table columns."""
    keys = list(by or [])
    rows = scored.select(*keys, F.col(fold_col).alias("fold"), F.col(label).alias("__y"), F.col(score).alias("__s"))
    # counts per threshold from one aggregate: right = positives reached + negatives not reached
    c = M.threshold_counts(rows, thresholds, "__y", "__s", [*keys, "fold"])
    order = F.array(*[F.lit(float(t)) for t in thresholds])
    g = c.select(*keys, "fold", "threshold", (F.array_position(order, F.col("threshold")) - 1).cast("int").alias("candidate"),
                 (F.col("pos") + F.col("neg")).alias("n"), (F.col("tp") + F.col("neg") - F.col("fp")).alias("ok"))
    w = Window.partitionBy(*keys, "candidate")
    g = g.withColumn("tot_n", F.sum("n").over(w)).withColumn("tot_ok", F.sum("ok").over(w))
    exp = F.concat_ws("/", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("experiment")
    share = lambda a, b: F.try_divide(a.cast("double"), b.cast("double")).alias("score")
    def side(name, x):
        return g.select(exp.alias("experiment"), "candidate", F.create_map(F.lit("threshold"), F.col("threshold").cast("string")).alias("params"),
                        F.col("fold").cast("int").alias("fold"), F.lit(name).alias("split"), x, F.lit(None).cast("double").alias("fit_time"),
                        F.lit(None).cast("string").alias("error"))
    return side("test", share(F.col("ok"), F.col("n"))).unionByName(
        side("train", share(F.col("tot_ok") - F.col("ok"), F.col("tot_n") - F.col("n"))))
