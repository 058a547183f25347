"""Queries: preprocessing stages, class weights, models, search and run tables (#47, #54-#74)."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tablesmith import workflow as W
from tablesmith.config import RunConfig
from tablesmith.ml import search as S
from tablesmith.ml.assembly import PrepConfig, build_pipeline, feature_array, score_frame
from tablesmith.ml.chains import CategoryPrep
from tablesmith.ml.stages import (CategoricalImputer, CategoryGrouper, ClassWeights, NumericImputer, NumericScaler,
                                  Winsorizer)
from tablesmith.operators import metrics as M
from tablesmith.plans.frames import ord_clean, sql_with
from tablesmith.plans.q_explore import freq_sql
from tablesmith.plans.registry import query
from tablesmith.plans.sqlgen import r6
from tablesmith.session import checkpoint_dir, stored
from tablesmith.sources import persist as P
from tablesmith.sources import views as V

# Query parameters.
WIN_COLS = ["l_extendedprice", "qty_n"]
SCALE_COLS = ["l_quantity", "qty_n", "const_one"]
GROUPS = {"lang": 130, "source": 50}
CV_THRESHOLDS = [0.3, 0.5, 0.7]


def _li(spark, d):
    return V.v_li(spark, d).select("l_orderkey", "l_linenumber", *sorted(set(WIN_COLS + SCALE_COLS)))


@query("winsorize", sql_with("""
    , lim AS (SELECT quantile_cont(l_extendedprice, 0.01) AS lo1, quantile_cont(l_extendedprice, 0.99) AS hi1,
                     quantile_cont(qty_n, 0.01) AS lo2, quantile_cont(qty_n, 0.99) AS hi2 FROM v_li)
    SELECT l_orderkey, l_linenumber, const_one, l_quantity,
           ROUND(CASE WHEN l_extendedprice IS NULL THEN NULL ELSE LEAST(GREATEST(l_extendedprice, lo1), hi1) END, 6)
             AS l_extendedprice,
           ROUND(CASE WHEN qty_n IS NULL THEN NULL ELSE LEAST(GREATEST(qty_n, lo2), hi2) END, 6) AS qty_n
    FROM v_li, lim""", views=["v_li"]))
def q_winsorize(spark, d):
    df = _li(spark, d)
    return r6(Winsorizer(inputCols=WIN_COLS, pmin=0.01, pmax=0.99).fit(df).transform(df))


@query("impute_numeric", sql_with("""
    SELECT l_orderkey, l_linenumber, const_one, l_extendedprice, l_quantity,
           coalesce(qty_n, (SELECT quantile_cont(qty_n, 0.5) FROM v_li)) AS qty_n FROM v_li""", views=["v_li"]))
def q_impute_numeric(spark, d):
    df = _li(spark, d)
    return r6(NumericImputer(inputCols=["qty_n"], strategy="median").fit(df).transform(df))


@query("impute_mean", sql_with("""
    SELECT l_orderkey, l_linenumber, const_one, l_extendedprice, l_quantity,
           ROUND(coalesce(qty_n, (SELECT favg(qty_n) FROM v_li)), 6) AS qty_n FROM v_li""", views=["v_li"]))
def q_impute_mean(spark, d):
    df = _li(spark, d)
    return r6(NumericImputer(inputCols=["qty_n"], strategy="mean").fit(df).transform(df))


@query("impute_mode", sql_with("""
    SELECT o_orderkey, coalesce(o_orderpriority, (SELECT o_orderpriority FROM ord_clean WHERE o_orderpriority IS NOT NULL
             GROUP BY o_orderpriority ORDER BY count(*) DESC, o_orderpriority LIMIT 1)) AS o_orderpriority
    FROM ord_clean""", ctes=["ord_clean"]))
def q_impute_mode(spark, d):
    df = ord_clean(spark, d).select("o_orderkey", "o_orderpriority")
    return CategoricalImputer(inputCols=["o_orderpriority"]).fit(df).transform(df)


@query("impute_constant", sql_with("SELECT o_orderkey, coalesce(o_orderpriority, 'Missing') AS o_orderpriority "
                                   "FROM ord_clean", ctes=["ord_clean"]))
def q_impute_constant(spark, d):
    df = ord_clean(spark, d).select("o_orderkey", "o_orderpriority")
    return CategoricalImputer(inputCols=["o_orderpriority"], strategy="constant").fit(df).transform(df)


@query("group_rare", sql_with(f"""
    , fr AS ({freq_sql('v_doc', V.DOC_CATEGORICAL)})
    SELECT doc_id,
      CASE WHEN lang IN (SELECT value FROM fr WHERE "column" = 'lang' AND n >= 130) THEN lang ELSE 'Other' END AS lang,
      CASE WHEN source IN (SELECT value FROM fr WHERE "column" = 'source' AND n >= 50) THEN source ELSE 'Other' END
        AS source
    FROM v_doc""", views=["v_doc"]))
def q_group_rare(spark, d):
    df = V.v_doc(spark, d).select("doc_id", "lang", "source")
    return CategoryGrouper(inputCols=["lang", "source"], minFreqs=GROUPS).fit(df).transform(df)


def _scale_sql(expr_center, expr_scale):
    parts = []
    for c in SCALE_COLS:
        parts.append(f"ROUND((CAST({c} AS DOUBLE) - (SELECT {expr_center.format(c=c)} FROM v_li)) / "
                     f"(SELECT CASE WHEN {expr_scale.format(c=c)} IS NULL OR {expr_scale.format(c=c)} = 0 THEN 1.0 "
                     f"ELSE {expr_scale.format(c=c)} END FROM v_li), 6) AS {c}")
    return sql_with("SELECT l_orderkey, l_linenumber, ROUND(l_extendedprice, 6) AS l_extendedprice, " + ", ".join(parts) +
                    " FROM v_li", views=["v_li"])


def _scaled(spark, d, method):
    df = _li(spark, d)
    return r6(NumericScaler(inputCols=SCALE_COLS, method=method).fit(df).transform(df))


@query("scale_standard", _scale_sql("favg({c})", "stddev_pop({c})"))
def q_scale_standard(spark, d):
    return _scaled(spark, d, "standard")


@query("scale_minmax", _scale_sql("min({c})", "(max({c}) - min({c}))"))
def q_scale_minmax(spark, d):
    return _scaled(spark, d, "minmax")


@query("scale_robust", _scale_sql("quantile_cont({c}, 0.5)", "(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"))
def q_scale_robust(spark, d):
    return _scaled(spark, d, "robust")


@query("one_hot", sql_with("""
    , cats AS (SELECT DISTINCT lang FROM v_doc WHERE lang IS NOT NULL)
    SELECT doc_id, lang, CAST(CASE WHEN lang = (SELECT min(lang) FROM cats) THEN 1.0 ELSE 0.0 END AS DOUBLE) AS oh_0,
           CAST(CASE WHEN lang = (SELECT lang FROM cats ORDER BY lang LIMIT 1 OFFSET 1) THEN 1.0 ELSE 0.0 END AS DOUBLE)
             AS oh_1,
           CAST(CASE WHEN lang = (SELECT lang FROM cats ORDER BY lang LIMIT 1 OFFSET 2) THEN 1.0 ELSE 0.0 END AS DOUBLE)
             AS oh_2,
           CAST(CASE WHEN lang = (SELECT lang FROM cats ORDER BY lang LIMIT 1 OFFSET 3) THEN 1.0 ELSE 0.0 END AS DOUBLE)
             AS oh_3
    FROM v_doc""", views=["v_doc"]))
def q_one_hot(spark, d):
    df = V.v_doc(spark, d).select("doc_id", "lang")
    m = Pipeline(stages=[CategoryPrep(inputCols=["lang"], outputCols=["lang_idx"], impute="none"),
                         OneHotEncoder(inputCol="lang_idx", outputCol="lang_oh", dropLast=True, handleInvalid="error")]).fit(df)
    n = m.stages[0].getOrDefault("sizes")["outputs"]["lang"]
    out = m.transform(df).withColumn("__a", vector_to_array("lang_oh"))
    return out.select("doc_id", "lang", *[F.col("__a")[i].alias(f"oh_{i}") for i in range(n)])


EXPLICIT_WEIGHTS = {0: 1, 1: 3}


@query("class_weights", sql_with("""
    SELECT CAST(quality AS DOUBLE) AS label, CAST(count(*) AS BIGINT) AS n,
           ROUND((SELECT count(*) FROM v_doc WHERE quality IS NOT NULL) /
                 ((SELECT count(DISTINCT quality) FROM v_doc) * count(*)), 6) AS weight,
           CASE WHEN quality = 1 THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END AS explicit
    FROM v_doc WHERE quality IS NOT NULL GROUP BY quality""", views=["v_doc"]))
def q_class_weights(spark, d):
    """Balanced weights and an explicit map, on a label of type double as models have it."""
    df = V.v_doc(spark, d).where(F.col("quality").isNotNull()).withColumn("label", F.col("quality").cast("double"))
    w = ClassWeights(labelCol="label", mode="balanced").fit(df).transform(df)
    w = ClassWeights(labelCol="label", outputCol="explicit", mode=EXPLICIT_WEIGHTS).fit(w).transform(w)
    return r6(w.groupBy("label").agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.first("weight").alias("weight"),
                                     F.first("explicit").alias("explicit")))


# ---------------------------------------------------------------- models
# A fitted model's numbers can't be said in SQL; what can is which rows it scores, that scores
# are probabilities and predictions follow them, and conditions that a right fit meets.
DOC_CFG = dict(num_cols=V.DOC_NUMERIC, cat_cols=V.DOC_CATEGORICAL, grouping={"source": 40}, label="label")


def _doc_labelled(spark, d):
    """Labelled documents as a model frame. Fitting reads it many times (each stage's
    statistics, every optimiser iteration), so it is written once to the shared
    checkpoint folder, as training data is cached before an MLlib fit."""
    df = (V.v_doc(spark, d).where(F.col("quality").isNotNull())
          .withColumn("label", F.col("quality").cast("double")).drop("quality"))
    checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def _sides(spark, d):
    """(train, test) of the labelled documents: every fifth id is on the test side."""
    df = _doc_labelled(spark, d)
    return df.where(F.col("doc_id") % 5 != 0), df.where(F.col("doc_id") % 5 == 0)


def _checked(scored, own, **flags):
    """``own``: (doc_id, prediction) as the model itself predicts, to hold against the scores."""
    scored = scored.join(own.select("doc_id", F.col("prediction").alias("__own")), "doc_id")
    return scored.select("run", "doc_id", "label", F.col("score").between(0, 1).alias("in_range"),
                         ((F.col("prediction") == F.col("__own")) | (F.abs(F.col("score") - 0.5) < 1e-9)).alias("consistent"),
                         *[F.lit(bool(v)).alias(k) for k, v in flags.items()])


def _checked_sql(run, where="doc_id % 5 = 0", *flags):
    return sql_with(f"""SELECT '{run}' AS run, doc_id, CAST(quality AS BIGINT) AS label, TRUE AS in_range, TRUE AS consistent
        {''.join(f', TRUE AS {x}' for x in flags)} FROM v_doc WHERE quality IS NOT NULL AND {where}""", views=["v_doc"])


def _fit(spark, d, model, params, run, scaling="standard"):
    train, test = _sides(spark, d)
    pm = build_pipeline(PrepConfig(scaling=scaling, **DOC_CFG), model, params).fit(train)
    return pm, train, score_frame(pm, test, run, key="doc_id"), pm.transform(test)


def _auc(scored) -> float:
    return M.roc_auc(scored, by=()).first()[0]


def _learns(pm, train, fit) -> bool:
    """Whether a model ranks its training rows better than chance and than a model that was fitted
    to drawn labels: a constant, or one that never saw the labels, does not."""
    own = _auc(score_frame(pm, train, "own", key="doc_id"))
    # labels of the same share, drawn by a hash of the id
    share = train.agg(F.avg("label")).first()[0]
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(share * 1_000_000)
    other = _auc(score_frame(fit(train.withColumn("label", drawn.cast("double"))), train, "drawn", key="doc_id"))
    return own > 0.6 and own > other + 0.05


def _is_optimal(pm, train, params, tolerance=1e-3) -> bool:
    """Whether a logistic fit meets the first-order condition of its penalised loss: the mean
    gradient of each coefficient is balanced by the penalty (intercept: zero)."""
    lr = pm.stages[-1]
    n = train.count()
    strength = 1.0 / (params["C"] * n)
    rows = pm.transform(train).select((vector_to_array("probability")[1] - F.col("label")).alias("r"),
                                      F.posexplode(F.concat(vector_to_array("features"), F.array(F.lit(1.0)))).alias("j", "x"))
    grad = {r[0]: r[1] for r in rows.groupBy("j").agg(F.sum(F.col("r") * F.col("x")) / n).collect()}
    w = [*lr.coefficients.toArray(), 0.0]

    def gap(j):
        if j == len(w) - 1:
            return abs(grad[j])
        if params["penalty"] == "l2":
            return abs(grad[j] + strength * w[j])
        return max(0.0, abs(grad[j]) - strength) if w[j] == 0 else abs(grad[j] + (strength if w[j] > 0 else -strength))

    return max(map(gap, grad)) < tolerance


LOGISTIC, LOGISTIC_L1 = {"C": 0.1, "penalty": "l2"}, {"C": 0.05, "penalty": "l1"}


@query("fit_logistic", _checked_sql("log_regression", "doc_id % 5 = 0", "optimal"))
def q_fit_logistic(spark, d):
    pm, train, scored, own = _fit(spark, d, "LogisticRegression", LOGISTIC, "log_regression", "minmax")
    return _checked(scored, own, optimal=_is_optimal(pm, train, LOGISTIC))


@query("fit_logistic_l1", _checked_sql("log_regression_l1", "doc_id % 5 = 0", "optimal"))
def q_fit_logistic_l1(spark, d):
    pm, train, scored, own = _fit(spark, d, "LogisticRegression", LOGISTIC_L1, "log_regression_l1", "minmax")
    return _checked(scored, own, optimal=_is_optimal(pm, train, LOGISTIC_L1))


@query("fit_tree", _checked_sql("tree", "doc_id % 5 = 0", "learns"))
def q_fit_tree(spark, d):
    params = {"max_depth": 5, "min_samples_split": 4}
    pm, train, scored, own = _fit(spark, d, "DecisionTreeClassifier", params, "tree")
    return _checked(scored, own, learns=_learns(pm, train, build_pipeline(PrepConfig(**DOC_CFG), "DecisionTreeClassifier", params).fit))


# The best first split of a tree, by its impurity, over columns of few values: all thresholds.
SPLIT_COLS = ["l_quantity", "l_discount", "l_tax"]
_GINI = "(1 - ({s}p / {s}n) * ({s}p / {s}n) - (1 - {s}p / {s}n) * (1 - {s}p / {s}n))"


@query("tree_split", sql_with(f"""
    , b AS (SELECT l_quantity, l_discount, l_tax, CASE WHEN l_quantity + 100 * l_discount > 28.5 THEN 1 ELSE 0 END AS y FROM v_li),
    cells AS ({" UNION ALL ".join(f"SELECT '{c}' AS c, {c} AS x, y, count(*) AS n FROM b GROUP BY {c}, y" for c in SPLIT_COLS)}),
    sides AS (SELECT t.c, t.v, sum(n) FILTER (x <= v)::DOUBLE AS ln, coalesce(sum(n) FILTER (x <= v AND y = 1), 0)::DOUBLE AS lp,
                sum(n) FILTER (x > v)::DOUBLE AS rn, coalesce(sum(n) FILTER (x > v AND y = 1), 0)::DOUBLE AS rp
              FROM cells JOIN (SELECT DISTINCT c, x AS v FROM cells) t ON cells.c = t.c GROUP BY t.c, t.v),
    g AS (SELECT *, (SELECT 2 * avg(y) * (1 - avg(y)) FROM b) - (ln * {_GINI.format(s='l')} + rn * {_GINI.format(s='r')}) / (ln + rn) AS gain
          FROM sides WHERE rn > 0)
    SELECT c AS "column", CAST(ln AS BIGINT) AS n_left, CAST(rn AS BIGINT) AS n_right, ROUND(lp / ln, 6) AS left_share, ROUND(rp / rn, 6) AS right_share,
           ROUND(gain, 6) AS gain FROM g ORDER BY gain DESC LIMIT 1""", views=["v_li"]))
def q_tree_split(spark, d):
    """The first split of a fitted tree: its column, what lies on its sides, and its gain."""
    df = V.v_li(spark, d).select(*SPLIT_COLS, (F.col("l_quantity") + 100 * F.col("l_discount") > 28.5).cast("double").alias("label"))
    cfg = PrepConfig(num_cols=SPLIT_COLS, cat_cols=[], outlier="none", scaling="none")
    pm = build_pipeline(cfg, "DecisionTreeClassifier", {"max_depth": 1}).fit(df)
    root = pm.stages[-1]._java_obj.rootNode()
    column, at = SPLIT_COLS[root.split().featureIndex()], float(root.split().threshold())
    left = F.col(column) <= at
    return r6(df.agg(F.lit(column).alias("column"), F.count_if(left).alias("n_left"), F.count_if(~left).alias("n_right"),
                     F.avg(F.when(left, F.col("label"))).alias("left_share"), F.avg(F.when(~left, F.col("label"))).alias("right_share"),
                     F.lit(float(root.gain())).alias("gain")))


FOREST, BALANCED = {"n_estimators": 50, "max_depth": 10, "min_samples_leaf": 2}, {"n_estimators": 30, "max_depth": 8}


@query("fit_forest", _checked_sql("forest", "doc_id % 5 = 0", "learns"))
def q_fit_forest(spark, d):
    pm, train, scored, own = _fit(spark, d, "RandomForestClassifier", FOREST, "forest")
    return _checked(scored, own, learns=_learns(pm, train, build_pipeline(PrepConfig(**DOC_CFG), "RandomForestClassifier", FOREST).fit))


@query("score", _checked_sql("forest_balanced", "TRUE", "learns"))
def q_score(spark, d):
    """Score every labelled row with a fitted forest pipeline (class weights balanced)."""
    df = _doc_labelled(spark, d)
    pipeline = build_pipeline(PrepConfig(class_weight="balanced", **DOC_CFG), "RandomForestClassifier", BALANCED)
    pm = pipeline.fit(df)
    return _checked(score_frame(pm, df, "forest_balanced", key="doc_id"), pm.transform(df), learns=_learns(pm, df, pipeline.fit))


_MATRIX_SQL = sql_with("""
    , b AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS x0, lower_share AS x1, lang, source FROM v_doc WHERE quality IS NOT NULL),
    lim AS (SELECT quantile_cont(x0, 0.01) AS a0, quantile_cont(x0, 0.99) AS z0, quantile_cont(x1, 0.01) AS a1, quantile_cont(x1, 0.99) AS z1 FROM b),
    cl AS (SELECT doc_id, lang, source, CASE WHEN x0 IS NOT NULL THEN least(greatest(x0, a0), z0) END AS x0,
                  CASE WHEN x1 IS NOT NULL THEN least(greatest(x1, a1), z1) END AS x1 FROM b, lim),
    im AS (SELECT doc_id, coalesce(x0, (SELECT quantile_cont(x0, 0.5) FROM cl)) AS x0, coalesce(x1, (SELECT quantile_cont(x1, 0.5) FROM cl)) AS x1,
                  coalesce(lang, (SELECT lang FROM b WHERE lang IS NOT NULL GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1)) AS lang,
                  coalesce(source, (SELECT source FROM b WHERE source IS NOT NULL GROUP BY source ORDER BY count(*) DESC, source LIMIT 1)) AS source FROM cl),
    gr AS (SELECT doc_id, x0, x1, lang, CASE WHEN source IN (SELECT source FROM im GROUP BY source HAVING count(*) >= 40) THEN source ELSE 'Other' END
             AS source FROM im),
    ml AS (SELECT favg(x0) AS m0, stddev_pop(x0) AS s0, favg(x1) AS m1, stddev_pop(x1) AS s1 FROM gr),
    lg AS (SELECT lang AS v, row_number() OVER (ORDER BY lang) - 1 AS i FROM (SELECT DISTINCT lang FROM gr)),
    so AS (SELECT source AS v, row_number() OVER (ORDER BY source) - 1 AS i FROM (SELECT DISTINCT source FROM gr))
    SELECT doc_id, CAST(0 AS BIGINT) AS slot, ROUND((x0 - m0) / CASE WHEN s0 = 0 THEN 1 ELSE s0 END, 6) AS value FROM gr, ml
    UNION ALL SELECT doc_id, 1, ROUND((x1 - m1) / CASE WHEN s1 = 0 THEN 1 ELSE s1 END, 6) FROM gr, ml
    UNION ALL SELECT doc_id, CAST(2 + i AS BIGINT), CASE WHEN lang = v THEN 1.0 ELSE 0.0 END FROM gr, lg
    UNION ALL SELECT doc_id, CAST(2 + (SELECT count(*) FROM lg) + i AS BIGINT), CASE WHEN source = v THEN 1.0 ELSE 0.0 END FROM gr, so""",
    views=["v_doc"])


@query("feature_matrix", _MATRIX_SQL)
def q_feature_matrix(spark, d):
    """The assembled matrix of every labelled document, one row per cell."""
    df = _doc_labelled(spark, d)
    pm = Pipeline(stages=build_pipeline(PrepConfig(**DOC_CFG)).getStages()).fit(df)
    cells = feature_array(pm, df, keep=["doc_id"]).select("doc_id", F.posexplode("features").alias("slot", "value"))
    return r6(cells.withColumn("slot", F.col("slot").cast("bigint")))


@query("feature_pipeline", _MATRIX_SQL)
def q_feature_pipeline(spark, d):
    """The same cells from a whole fitted pipeline, classifier included, saved and loaded again."""
    df = _doc_labelled(spark, d)
    path = f"{checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    P.save_model(build_pipeline(PrepConfig(**DOC_CFG), "LogisticRegression", {"C": 1.0, "max_iter": 5}).fit(df), path)
    loaded = P.load_model(path)
    cells = loaded.transform(df).where(F.col("probability").isNotNull()).select("doc_id", F.posexplode(vector_to_array("features")).alias("slot", "value"))
    return r6(cells.withColumn("slot", F.col("slot").cast("bigint")))


@query("run_log", sql_with("""
    SELECT run AS experiment, CAST(count(*) AS VARCHAR) AS n, ROUND(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy
    FROM v_scores GROUP BY run""", views=["v_scores"]))
def q_run_log(spark, d):
    """Run records of the scored documents, written one by one and read back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/runs-{uuid.uuid4().hex}"
    sc = V.v_scores(spark, d)
    for r in sc.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("acc")).collect():
        P.log_run(spark, path, r["run"], tags={"source": "documents"}, params={"n": r["n"]}, metrics={"accuracy": r["acc"]})
    return r6(P.load_runs(spark, path).select("experiment", F.col("params")["n"].alias("n"), F.col("metrics")["accuracy"].alias("accuracy")))


@query("expand_grid", sql_with("""
    , p AS (SELECT DISTINCT o_orderpriority AS v FROM v_ord), s AS (SELECT DISTINCT c_mktsegment AS v FROM v_ord)
    SELECT CAST(row_number() OVER (ORDER BY p.v, s.v) - 1 AS INTEGER) AS candidate, p.v AS priority, s.v AS segment FROM p CROSS JOIN s""", views=["v_ord"]))
def q_expand_grid(spark, d):
    """The grid over the values of two columns, candidate by candidate."""
    df = V.v_ord(spark, d)
    values = lambda c: sorted(r[0] for r in df.select(c).distinct().collect())
    grid = S.expand_grid({"priority": values("o_orderpriority"), "segment": values("c_mktsegment")})
    return spark.createDataFrame([(i, g["priority"], g["segment"]) for i, g in enumerate(grid)], "candidate int, priority string, segment string")


AUDIT_GRID = {"outlier": ["clip", "none"], "scaling": ["standard", "robust"], "grouping.source": [0, 60]}


@query("nan_audit", "SELECT CAST(range AS INTEGER) AS combination, CAST(0 AS BIGINT) AS n_missing, CAST(NULL AS VARCHAR) AS error "
                    f"FROM range({1 + len(S.expand_grid(AUDIT_GRID))})")
def q_nan_audit(spark, d):
    """No combination may leave a missing cell."""
    return S.nan_audit(_sides(spark, d)[0], PrepConfig(**DOC_CFG), AUDIT_GRID).select("combination", "n_missing", "error")


@query("grid_search", """
    SELECT CAST(i AS INTEGER) AS candidate, c AS "C", scaling, CAST(f.range AS INTEGER) AS fold, split, TRUE AS beats_constant, CAST(NULL AS VARCHAR) AS error
    FROM (VALUES (0, '10.0', '"standard"'), (1, '10.0', '"minmax"'), (2, '100.0', '"standard"'), (3, '100.0', '"minmax"')) t(i, c, scaling),
         range(3) f, (VALUES ('train'), ('test')) s(split)""")
def q_grid_search(spark, d):
    """Candidates on a label that the features tell; a constant model would not beat the larger class."""
    docs = V.v_doc(spark, d).withColumn("label", F.coalesce(F.col("lang") == "en", F.lit(False)).cast("double")).withColumn("fold", (F.col("doc_id") % 3).cast("int"))
    docs = stored(docs, "labelled")
    share = docs.agg(F.avg("label")).first()[0]
    grid = {"C": [10.0, 100.0], "scaling": ["standard", "minmax"]}
    cv, _, _ = S.grid_search(docs, PrepConfig(**DOC_CFG), grid, model="LogisticRegression", refit=False, experiment="log_regression")
    return cv.select("candidate", F.col("params")["C"].alias("C"), F.col("params")["scaling"].alias("scaling"), "fold", "split",
                     (F.col("score").between(0, 1) & (F.col("score") > max(share, 1 - share) + 0.05)).alias("beats_constant"), "error")


def _threshold_cv(spark, d):
    sc = V.v_scores(spark, d).withColumn("fold", (F.col("doc_id") % 5).cast("int"))
    return S.threshold_cv(sc, CV_THRESHOLDS)


_CV_SQL = """
    , sc AS (SELECT run, label, score, CAST(doc_id % 5 AS INTEGER) AS fold FROM v_scores),
    th AS (SELECT * FROM (VALUES (0, 0.3), (1, 0.5), (2, 0.7)) t(candidate, threshold)),
    g AS (SELECT run, candidate, threshold, fold, count(*) AS n,
                 sum(CASE WHEN CAST(score >= threshold AS BIGINT) = label THEN 1 ELSE 0 END) AS ok
          FROM sc, th GROUP BY run, candidate, threshold, fold),
    g2 AS (SELECT *, sum(n) OVER (PARTITION BY run, candidate) AS tot_n, sum(ok) OVER (PARTITION BY run, candidate) AS tot_ok
           FROM g),
    cvl AS (SELECT run AS experiment, candidate, fold, 'test' AS split, ok / n AS score FROM g2
            UNION ALL SELECT run, candidate, fold, 'train', (tot_ok - ok) / (tot_n - n) FROM g2),
    res AS (SELECT experiment, candidate, avg(score) FILTER (WHERE split = 'test') AS mean_test_score,
                   stddev_pop(score) FILTER (WHERE split = 'test') AS std_test_score,
                   avg(score) FILTER (WHERE split = 'train') AS mean_train_score,
                   stddev_pop(score) FILTER (WHERE split = 'train') AS std_train_score
            FROM cvl GROUP BY experiment, candidate),
    ranked AS (SELECT *, CAST(rank() OVER (PARTITION BY experiment ORDER BY mean_test_score DESC) AS INTEGER)
                 AS rank_test_score, [0.3, 0.5, 0.7][candidate + 1]::DOUBLE AS threshold FROM res)"""
_FOLDS = "".join(f""", ROUND((SELECT max(score) FROM cvl v WHERE v.experiment = ranked.experiment AND v.candidate = ranked.candidate
    AND split = 'test' AND fold = {i}), 6) AS split{i}_test_score""" for i in range(5))
_CV_COLS = """experiment, candidate, threshold, ROUND(mean_test_score, 6) AS mean_test_score,
    ROUND(std_test_score, 6) AS std_test_score, ROUND(mean_train_score, 6) AS mean_train_score,
    ROUND(std_train_score, 6) AS std_train_score, rank_test_score"""


def _cv_cols(df):
    return r6(df.select("experiment", "candidate", F.col("params")["threshold"].cast("double").alias("threshold"), "mean_test_score",
                        "std_test_score", "mean_train_score", "std_train_score", "rank_test_score",
                        *[F.get("fold_scores", F.lit(i)).alias(f"split{i}_test_score") for i in range(5)]))


@query("cv_results", sql_with(_CV_SQL + f"\nSELECT {_CV_COLS}{_FOLDS} FROM ranked", views=["v_scores"]))
def q_cv_results(spark, d):
    return _cv_cols(S.cv_results(_threshold_cv(spark, d)))


@query("leaderboard", sql_with(_CV_SQL + f"""
    SELECT {_CV_COLS}{_FOLDS} FROM (SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY rank_test_score, candidate) AS r
                            FROM ranked) ranked WHERE r = 1""", views=["v_scores"]))
def q_leaderboard(spark, d):
    """The leaderboard of a CV table that was written and read again."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/cv-{uuid.uuid4().hex}"
    P.save_cv(_threshold_cv(spark, d), path)
    return _cv_cols(S.leaderboard(S.cv_results(P.load_cv_results(spark, path))))


# ---------------------------------------------------------------- end-to-end run
ORD_RUN = RunConfig(path="", target="status", target_mapping={"F": 0, "O": 1},
                    expected_columns=["o_orderkey", "o_totalprice", "c_acctbal", "o_orderpriority", "c_mktsegment",
                                      "n_name", "status"],
                    drop_features=[], numeric_columns=("o_totalprice", "c_acctbal"), grouping={"n_name": 600},
                    model="LogisticRegression", model_params={"C": 1.0}, folds=3, key="o_orderkey",
                    null_tokens=("?", "4-NOT SPECIFIED"), experiment="orders")
RUN_METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc", "average_precision")


@query("workflow_orders", sql_with(f"""
    SELECT 'orders' AS run, CAST(ceil(0.2 * count(*)) AS BIGINT) AS n_test, {', '.join(f'TRUE AS {m}' for m in RUN_METRICS)},
           CAST(0 AS BIGINT) AS n_dropped
    FROM (SELECT DISTINCT * FROM ord_clean) WHERE status IS NOT NULL""", ctes=["ord_clean"]))
def q_workflow_orders(spark, d):
    """The whole batch run on the order frame: the test rows of the refit model and whether
    each of its metrics is a share."""
    out = W.run(V.v_ord(spark, d), ORD_RUN)
    return out["test_metrics"].select("run", F.lit(out["scored"].count()).cast("bigint").alias("n_test"),
                                      *[F.col(m).between(0, 1).alias(m) for m in RUN_METRICS], "n_dropped")
