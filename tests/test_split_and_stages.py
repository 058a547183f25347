"""Splits, folds, preprocessing stages, persistence and sources."""

import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tablesmith.ml.assembly import PrepConfig, build_pipeline, missing_cells, score_frame
from tablesmith.ml.search import cv_results, expand_grid, grid_search, leaderboard
from tablesmith.ml.stages import CategoryGrouper, ClassWeights, NumericScaler, Winsorizer
from tablesmith.operators import metrics as M
from tablesmith.operators.split import approximate_mode, fold_allocation, save_splits, stratified_folds, stratified_split
from tablesmith.sources import persist as P
from tablesmith.sources.tables import read_csv, write_table

from sf_paths import MEDIUM


def _labelled(spark, n=2000):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 7 == 0).cast("int").alias("y"),
                                 (F.col("id") % 13).cast("double").alias("x"))


def test_split_sizes_exact_and_stable(spark):
    df = _labelled(spark)
    out, rep = stratified_split(df, "y", "k", test_size=0.2, seed=42)
    got = {(r.side, r.y): r["count"] for r in out.groupBy("side", "y").count().collect()}
    ns = [df.where(f"y = {c}").count() for c in (0, 1)]
    train = approximate_mode(ns, 2000 - 400)
    assert got == {("train", 0): train[0], ("test", 0): ns[0] - train[0], ("train", 1): train[1],
                   ("test", 1): ns[1] - train[1]}
    again, _ = stratified_split(df.repartition(5), "y", "k", test_size=0.2, seed=42)
    a = {r.k for r in out.where("side = 'test'").select("k").collect()}
    b = {r.k for r in again.where("side = 'test'").select("k").collect()}
    assert a == b


def test_folds_partition_rows(spark):
    df = _labelled(spark, 1003)
    f = stratified_folds(df, "y", "k", k=5, seed=7)
    assert f.count() == 1003
    assert f.select("k").distinct().count() == 1003
    counts = {(r.fold, r.y): r["count"] for r in f.groupBy("fold", "y").count().collect()}
    ns = [df.where(f"y = {c}").count() for c in (0, 1)]
    alloc = fold_allocation(ns, 5)
    for ci, c in enumerate((0, 1)):
        for j in range(5):
            assert counts.get((j, c), 0) == alloc[ci][j]


def test_winsorizer_keeps_nulls_and_clips(spark):
    df = spark.createDataFrame([(float(i) if i % 10 else None,) for i in range(1, 101)], "x double")
    m = Winsorizer(inputCols=["x"], pmin=0.05, pmax=0.95).fit(df)
    out = m.transform(df)
    assert out.where("x IS NULL").count() == 10
    lo, hi = m.getValues()["x"]
    r = out.agg(F.min("x"), F.max("x")).first()
    assert r[0] == lo and r[1] == hi


def test_grouper_unseen_and_idempotent(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [("c",)], "v string")
    m = CategoryGrouper(inputCols=["v"], minFreq=2).fit(df)
    once = m.transform(df)
    assert sorted(r.v for r in once.distinct().collect()) == ["Other", "a", "b"]
    new = spark.createDataFrame([("zzz",), ("a",)], "v string")
    assert sorted(r.v for r in m.transform(new).collect()) == ["Other", "a"]
    twice = CategoryGrouper(inputCols=["v"], minFreq=2).fit(once).transform(once)
    assert sorted(r.v for r in twice.collect()) == sorted(r.v for r in once.collect())


def test_scaler_zero_scale(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 5.0), (1.0, 10.0)], "c double, x double")
    for method in ("standard", "minmax", "robust"):
        out = NumericScaler(inputCols=["c", "x"], method=method).fit(df).transform(df)
        assert {r.c for r in out.collect()} == {0.0}


def test_pipeline_persistence_and_unseen_category(spark, tmpdir_path):
    df = _labelled(spark).withColumn("cat", F.when(F.col("k") % 3 == 0, "u").otherwise("v")) \
        .withColumn("label", F.col("y").cast("double"))
    cfg = PrepConfig(num_cols=["x"], cat_cols=["cat"], grouping={"cat": 1}, label="label")
    model = build_pipeline(cfg, "LogisticRegression", {"C": 1.0}).fit(df)
    path = os.path.join(tmpdir_path, "model")
    P.save_model(model, path)
    loaded = PipelineModel.load(path)
    a = score_frame(model, df, "r", key="k").orderBy("k").collect()
    b = score_frame(loaded, df, "r", key="k").orderBy("k").collect()
    assert [r.score for r in a] == [r.score for r in b]
    unseen = df.limit(3).withColumn("cat", F.lit("never"))
    assert missing_cells(model, unseen).first()[0] == 0
    # numeric slot first, then the one-hot slots of 'cat': all zeros for an unseen value
    from pyspark.ml.functions import vector_to_array
    vecs = [r.a for r in model.transform(unseen).select(vector_to_array("features").alias("a")).collect()]
    assert all(sum(v[1:]) == 0.0 for v in vecs) and all(len(v) == 3 for v in vecs)


def test_auc_matches_mllib_and_symmetry(spark):
    sc = spark.read.parquet(f"{MEDIUM}/documents.parquet").select(
        "doc_id", ((F.col("n_chars") % 997) / 997.0).alias("score"), (F.col("doc_id") % 3 == 0).cast("long").alias("label"))
    ours = M.roc_auc(sc, by=()).first()[0]
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", metricName="areaUnderROC",
                                       numBins=0)
    assert abs(ours - ev.evaluate(sc.withColumn("label", F.col("label").cast("double")))) < 1e-12
    neg = M.roc_auc(sc.withColumn("score", -F.col("score")), by=()).first()[0]
    assert abs(ours + neg - 1.0) < 1e-12


def test_grid_search_and_leaderboard(spark):
    df = _labelled(spark, 600).withColumn("label", F.col("y").cast("double"))
    folds = stratified_folds(df, "label", "k", k=3)
    cfg = PrepConfig(num_cols=["x"], cat_cols=[], label="label")
    cv, best, model = grid_search(folds, cfg, {"C": [0.1, 1.0]}, experiment="e", refit=True)
    assert cv.count() == 2 * 3 * 2
    res = cv_results(cv)
    assert res.count() == 2 and leaderboard(res).count() == 1
    assert best is not None and model is not None
    assert len(expand_grid([{"a": [1, 2]}, {"b": [3]}])) == 3
    with pytest.raises(ValueError):
        grid_search(folds, cfg, {"not_a_param": [1]})


def test_csv_reader_tokens_and_dotted_names(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "x.csv")
    with open(path, "w") as f:
        f.write("age,capital.gain,work.class,income\n39,0,State-gov,<=50K\n50,?,?,>50K.\n")
    df = read_csv(spark, path)
    assert df.columns == ["age", "capital_gain", "work_class", "income"]
    assert df.schema["capital_gain"].metadata == {"source_name": "capital.gain"}
    rows = df.collect()
    assert rows[1]["work_class"] is None and rows[1]["capital_gain"] is None


def test_run_table_and_roles(spark, tmpdir_path):
    runs = os.path.join(tmpdir_path, "runs")
    P.log_run(spark, runs, "exp1", tags={"model": "rf"}, params={"max_depth": 10}, metrics={"test_score": 0.85})
    P.log_run(spark, runs, "exp2", metrics={"test_score": 0.8})
    got = P.load_runs(spark, runs, ["exp1"]).collect()
    assert len(got) == 1 and got[0].metrics["test_score"] == 0.85 and got[0].params["max_depth"] == "10"
    from tablesmith.operators.features import feature_roles
    roles = feature_roles(_labelled(spark), ["k"], "y")
    P.save_roles(roles, os.path.join(tmpdir_path, "roles"))
    back = P.load_roles(spark, os.path.join(tmpdir_path, "roles"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, roles.collect()))


def test_grouper_of_any_size_is_saved_with_its_model(spark, tmpdir_path):
    """A kept set beyond any list loads from the model's own folder, nothing else."""
    df = spark.range(120_000).select(F.concat(F.lit("v"), (F.col("id") % 60_000)).alias("v")).union(
        spark.createDataFrame([("rare",), (None,)], "v string"))
    m = CategoryGrouper(inputCols=["v"], minFreq=2).fit(df)
    path = os.path.join(tmpdir_path, "grouper")
    PipelineModel([m]).write().save(path)
    m.kept = None                                        # the table in the checkpoint folder is out of reach
    got = PipelineModel.load(path).transform(df).groupBy("v").count()
    assert got.count() == 60_001
    assert {r.v: r["count"] for r in got.where("v in ('Other', 'v0')").collect()} == {"Other": 2, "v0": 2}


def test_class_weights_compare_as_numbers(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.0,), (None,)], "label double")
    for mode in ({0: 1, 1: 3}, {"0": 1, "1": 3}, {0.0: 1, 1.0: 3}):
        out = ClassWeights(mode=mode).fit(df).transform(df)
        assert sorted(((r.label, r.weight) for r in out.collect()), key=str) == sorted(
            [(0.0, 1.0), (1.0, 3.0), (1.0, 3.0), (None, 1.0)], key=str)
    texts = spark.createDataFrame([("a",), ("b",)], "label string")
    assert {r.label: r.weight for r in ClassWeights(mode={"a": 2, "b": 5}).fit(texts).transform(texts).collect()} == {"a": 2.0, "b": 5.0}
    with pytest.raises(ValueError):
        ClassWeights(mode={0: 1}).fit(df)


def test_tree_depth_beyond_the_library_raises():
    with pytest.raises(ValueError):
        build_pipeline(PrepConfig(num_cols=["x"], cat_cols=[]), "DecisionTreeClassifier", {"max_depth": 31})


def test_csv_marker_does_not_decide_a_type(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t.csv")
    with open(path, "w") as f:
        f.write("capital.gain,rate,code,empty\n0,1.5,a1,?\n?, 2 ,?,?\n7,?,12,?\n")
    df = read_csv(spark, path)
    assert dict(df.dtypes) == {"capital_gain": "bigint", "rate": "double", "code": "string", "empty": "string"}
    assert [tuple(r) for r in df.collect()] == [(0, 1.5, "a1", None), (None, 2.0, None, None), (7, None, "12", None)]


@pytest.mark.parametrize("distinct", [1, 3, 50])
def test_split_and_folds_of_repeated_keys_are_exact(spark, distinct):
    df = spark.range(200).select((F.col("id") % distinct).alias("k"), (F.col("id") % 2).cast("int").alias("y"), "id")
    out, rep = stratified_split(df, "y", "k", test_size=0.25, seed=1)
    got = {(r.side, r.y): r["count"] for r in out.groupBy("side", "y").count().collect()}
    assert got == {("test", 0): 25, ("test", 1): 25, ("train", 0): 75, ("train", 1): 75}
    f = stratified_folds(df, "y", "k", k=5, seed=1)
    assert {r["count"] for r in f.groupBy("fold", "y").count().collect()} == {20} and f.select("id").distinct().count() == 200
    assert set(out.columns) == {"k", "y", "id", "side"}


def test_confusion_and_report_take_the_classes_from_the_data(spark):
    rows = [(0, 0), (1, 2), (2, 2), (2, 0), (1, 1), (None, 1), (2, None)]
    df = spark.createDataFrame(rows, "label long, prediction long")
    cm = M.confusion_matrix(df, by=()).collect()
    assert sum(r.n for r in cm) == len(rows) and {r.actual for r in cm} == {0, 1, 2, None}
    rep = {r["class"]: r for r in M.classification_report(df, by=()).collect()}
    assert sum(rep[c].support for c in "012") == rep["accuracy"].support == 5 and rep["missing"].support == 2
    words = spark.createDataFrame([("a", "a"), ("b", "a")], "label string, prediction string")
    assert {r["class"] for r in M.classification_report(words, by=()).collect()} >= {"a", "b"}


def test_metrics_without_groups_count_what_they_drop(spark):
    rows = [(1, 0.9, 1), (0, 0.1, 0), (1, 0.4, 0), (0, None, 1), (None, 0.3, 0)]
    df = spark.createDataFrame(rows, "label long, score double, prediction long")
    r = M.compare_runs(df, by=()).first()
    assert r.n_dropped == 2 and r.roc_auc == 1.0 and abs(r.accuracy - 0.5) < 1e-12
    sweep = M.threshold_sweep(df, [0.3, 0.5], by=()).collect()
    assert [(x.threshold, x.recall, x.n_dropped) for x in sorted(sweep)] == [(0.3, 1.0, 2), (0.5, 0.5, 2)] or len(sweep) == 2
    assert M.best_threshold(M.threshold_sweep(df, by=()), by=()).count() == 1


def test_round_trips(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, None)], "k long, s string, x double")
    path = os.path.join(tmpdir_path, "csv")
    write_table(df, path, fmt="csv")
    assert sorted(map(tuple, spark.read.option("header", True).schema(df.schema).csv(path).collect())) == sorted(map(tuple, df.collect()))
    split, _ = stratified_split(_labelled(spark, 100), "y", "k")
    save_splits(split, os.path.join(tmpdir_path, "splits"))
    back = spark.read.parquet(os.path.join(tmpdir_path, "splits"))
    assert sorted((r.k, r.side) for r in back.collect()) == sorted((r.k, r.side) for r in split.collect())
    folds = stratified_folds(_labelled(spark, 120).withColumn("label", F.col("y").cast("double")), "label", "k", k=2)
    cv, best, model = grid_search(folds, PrepConfig(num_cols=["x"], cat_cols=[], label="label"), {"C": [1.0], "max_iter": [5]}, experiment="e")
    P.save_cv(cv, os.path.join(tmpdir_path, "cv"))
    again = cv_results(P.load_cv_results(spark, os.path.join(tmpdir_path, "cv"), ["e"])).first()
    assert again.params == {"C": "1.0", "max_iter": "5"} and len(again.fold_scores) == 2
    P.save_model(model, os.path.join(tmpdir_path, "model"))
    assert len(P.load_model(os.path.join(tmpdir_path, "model")).stages) == len(model.stages)


def test_search_records_bad_parameters_and_raises_the_rest(spark, monkeypatch):
    from tablesmith.ml import search
    folds = stratified_folds(_labelled(spark, 120).withColumn("label", F.col("y").cast("double")), "label", "k", k=2)
    cfg = PrepConfig(num_cols=["x"], cat_cols=[], label="label")
    cv, best, _ = grid_search(folds, cfg, {"penalty": ["l2", "nonsense"]}, refit=False)
    errors = {r.params["penalty"]: r.error for r in cv.where("error is not null").collect()}
    assert "nonsense" in errors['"nonsense"'] and best["penalty"] == "l2"
    monkeypatch.setattr(search, "_score", lambda *a: (_ for _ in ()).throw(RuntimeError("executor lost")))
    with pytest.raises(RuntimeError):
        grid_search(folds, cfg, {"C": [1.0]}, refit=False)


def test_workflow_coerces_and_keeps_roles_and_splits(spark, tmpdir_path):
    from tablesmith import workflow
    from tablesmith.config import RunConfig
    rows = [(f"{i % 17}" if i % 9 else "?", "u" if i % 3 else " v ", ">50K." if i % 4 == 0 else "<=50K", i) for i in range(300)]
    df = spark.createDataFrame(rows, "age string, work string, income string, id long")
    cfg = RunConfig(path="", target="income", target_mapping={"<=50K": 0, ">50K": 1}, expected_columns=["age", "work", "income", "id"],
                    drop_features=[], numeric_columns=("age",), model="LogisticRegression", folds=2, key="id")
    out = workflow.run(df, cfg, roles_path=tmpdir_path + "/roles", splits_path=tmpdir_path + "/splits", cv_table=tmpdir_path + "/cv",
                       run_table=tmpdir_path + "/runs")
    kinds = {r.column: r.kind for r in P.load_roles(spark, tmpdir_path + "/roles").collect()}
    assert kinds["age"] == "numeric" and kinds["work"] == "categorical"
    assert spark.read.parquet(tmpdir_path + "/splits").count() == 300
    assert P.load_runs(spark, tmpdir_path + "/runs").count() == 1 and leaderboard(cv_results(P.load_cv_results(spark, tmpdir_path + "/cv"))).count() == 1
    assert out["scored"].count() == 60
