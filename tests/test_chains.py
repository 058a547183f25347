"""Chains, fold statistics, the stage tree, lookups, the Gram product and the CSV channel."""

import math
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tablesmith.functions.lookup import entries, looked_up
from tablesmith.ml import search as S
from tablesmith.ml import statistics as ST
from tablesmith.ml.assembly import PrepConfig, feature_array, preprocessing_stages
from tablesmith.ml.chains import CategoryPrep, NumericPrep
from tablesmith.ml.stages import CategoricalImputer, CategoryGrouper, NumericImputer, NumericScaler, Winsorizer
from tablesmith.operators.explore import correlation_matrix
from tablesmith.operators.split import stratified_folds_report, stratified_split
from tablesmith.session import stored
from tablesmith.sources.tables import MalformedCsv, csv_report, read_csv


def frame(spark, n=400, folds=3):
    rng = np.random.default_rng(4)
    rows = [(i, i % folds, None if i % 7 == 0 else float(rng.normal(5, 20)), None if i % 11 < 5 else float(i % 5),
             None if i % 13 == 0 else f"c{int(rng.integers(0, 12)) ** 2 % 17}", "only", float(i % 3 == 0)) for i in range(n)]
    return stored(spark.createDataFrame(rows, "k long, fold int, x double, y double, cat string, one string, label double"), "frame")


def by_stages(df, chain, cols):
    """The fitted values of the separate stages, one after the other."""
    limits = Winsorizer(inputCols=cols, strategy=chain.outlier, pmin=chain.pmin, pmax=chain.pmax).fit(df)
    df = limits.transform(df)
    fills = NumericImputer(inputCols=cols, strategy=chain.impute).fit(df)
    scales = NumericScaler(inputCols=cols, method=chain.scaling).fit(fills.transform(df))
    return limits.getValues(), fills.getValues(), scales.getValues()


CHAINS = [ST.NumericChain("clip", 0.05, 0.9, "median", "robust"), ST.NumericChain("none", 0.01, 0.99, "mean", "robust"),
          ST.NumericChain("clip", 0.05, 0.9, "mean", "standard"), ST.NumericChain("none", 0.01, 0.99, "median", "minmax")]


def close(a, b):
    if isinstance(a, dict):
        return a.keys() == b.keys() and all(close(a[k], b[k]) for k in a)
    if isinstance(a, (list, tuple)):
        return len(a) == len(b) and all(map(close, a, b))
    return a == b or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


def test_chain_statistics_equal_the_stages_for_every_fold(spark):
    df = frame(spark)
    made = ST.NumericStatistics(df, ["x", "y"], CHAINS, "fold").fitted
    for chain, view in zip(CHAINS, (None, 2, 1, None)):
        want = by_stages(df if view is None else df.where(F.col("fold") != view), chain, ["x", "y"])
        got = made[chain, view]
        assert close(got.limits, want[0] or {}) and close(got.fills, want[1]) and close(got.scales, want[2]), (chain, view)


def test_chain_of_an_empty_column_and_one_value(spark):
    df = spark.createDataFrame([(None, 3.0), (None, 3.0), (None, None)], "x double, y double")
    for chain in CHAINS:
        out = NumericPrep(inputCols=["x", "y"], outlier=chain.outlier, pmin=chain.pmin, pmax=chain.pmax, impute=chain.impute, scaling=chain.scaling).fit(df).transform(df)
        assert [r.x for r in out.collect()] == [None] * 3 and {r.y for r in out.collect()} == {0.0}
    with pytest.raises(ValueError):
        NumericPrep(inputCols=["x"], scaling="nonsense").fit(df)


def passes(spark, monkeypatch, make):
    """Passes over a training frame that a search's preprocessing statistics start."""
    seen = []
    for module, name in ((ST, "key_stats"), (ST, "select_ranks"), (ST.NumericStatistics, "_outside"), (ST, "stored")):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, real=real, name=name, **k: (seen.append(name), real(*a, **k))[1])
    make()
    monkeypatch.undo()
    return sorted(seen)


def test_passes_do_not_grow_with_folds_or_candidates(spark, monkeypatch):
    cfg = PrepConfig(num_cols=["x", "y"], cat_cols=["cat"], grouping={"cat": 30})
    few = passes(spark, monkeypatch, lambda: S.StageTree(frame(spark), cfg, [{}], "fold"))
    grid = S.expand_grid({"scaling": ["standard", "robust"], "pmin": [0.01, 0.05], "num_impute": ["median"], "grouping.cat": [0, 30], "C": [1.0, 2.0]})
    many = passes(spark, monkeypatch, lambda: S.StageTree(frame(spark, folds=6), cfg, grid, "fold"))
    assert len(grid) == 16 and few == many


def test_stage_tree_fits_each_prefix_once(spark):
    cfg = PrepConfig(num_cols=["x", "y"], cat_cols=["cat"], grouping={"cat": 30})
    grid = S.expand_grid({"outlier": ["clip", "none"], "scaling": ["standard", "robust"], "grouping.cat": [0, 30]}) + [{"scaling": "nonsense"}]
    tree = S.StageTree(frame(spark), cfg, grid, "fold")
    assert list(tree.errors) == [8] and "nonsense" in tree.errors[8] and len(tree.leaves()) == 8
    at = {}
    for path in tree.nodes():
        at[len(path)] = at.get(len(path), 0) + 1
    # clip, fill, scale, category, group, weight
    assert at == {1: 2, 2: 2, 3: 4, 4: 4, 5: 8, 6: 8}
    assert len(tree.numeric.chains) == 4 and len(tree.category.chains) == 2


def test_tree_models_equal_a_fit_on_the_training_side(spark):
    df = frame(spark)
    cfg = PrepConfig(num_cols=["x", "y"], cat_cols=["cat", "one"], grouping={"cat": 30}, class_weight="balanced")
    tree = S.StageTree(df, cfg, [{}, {"cat_impute": "constant", "scaling": "robust"}], "fold")
    for i, view in ((0, 1), (1, 1), (1, None)):
        own = tree.model(i, view)
        other = Pipeline(stages=preprocessing_stages(tree.configs[i])).fit(tree.side(view))
        cells = [{r.k: (r.features, r.weight) for r in m.transform(df).selectExpr("k", "features", "weight").collect()} for m in (own, other)]
        assert cells[0].keys() == cells[1].keys() and all(np.allclose(cells[0][k][0].toArray(), cells[1][k][0].toArray()) and cells[0][k][1] == cells[1][k][1] for k in cells[0])


def test_category_chain_equals_imputer_and_grouper(spark):
    df = frame(spark).unionByName(spark.createDataFrame([(900, 0, None, None, "never", None, 1.0)], frame(spark).schema))
    train = df.where("k < 900")
    model = CategoryPrep(inputCols=["cat"], outputCols=["i"], grouping={"cat": 30}).fit(train)
    filled = CategoricalImputer(inputCols=["cat"]).fit(train)
    grouped = CategoryGrouper(inputCols=["cat"], minFreqs={"cat": 30}).fit(filled.transform(train))
    text = {r.k: r.cat for r in grouped.transform(filled.transform(df)).collect()}
    labels = sorted({r.cat for r in grouped.transform(filled.transform(train)).select("cat").distinct().collect()})
    assert {r.k: r.i for r in model.transform(df).collect()} == {k: float(labels.index(v)) for k, v in text.items()}


def test_dictionary_of_a_million_values_is_a_table(spark, tmpdir_path, monkeypatch):
    """Labels never reach the driver, and a saved model carries its table."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic
    df = spark.range(1_000_000).select(F.format_string("v%07d", "id").alias("v"))
    sizes, real = [], Classic.collect
    monkeypatch.setattr(Classic, "collect", lambda self: (lambda rows: sizes.append(len(rows)) or rows)(real(self)))
    model = CategoryPrep(inputCols=["v"], outputCols=["i"], impute="none").fit(df)
    assert max(sizes) <= 10
    monkeypatch.undo()
    PipelineModel([model]).write().save(tmpdir_path + "/m")
    out = PipelineModel.load(tmpdir_path + "/m").transform(df.where("v >= 'v0999990'").unionByName(spark.createDataFrame([("zz",), (None,)], "v string")))
    got = {r.v: r.i for r in out.collect()}
    assert got == {**{f"v{i:07d}": float(i) for i in range(999_990, 1_000_000)}, "zz": 1e6, None: 1e6}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_grouper_does_not_shuffle_the_rows(spark):
    df = spark.range(50_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 40)).alias("a"),
                                    F.concat(F.lit("w"), F.col("id") % 9).alias("b"))
    out = CategoryGrouper(inputCols=["a", "b"], minFreq=1000).fit(df).transform(df)
    plan = plan_of(out)
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 2
    assert {r.a for r in out.select("a").distinct().collect()} == {"hot", "Other"} or out.where("a = 'hot'").count() == 16667


def test_lookup_beyond_the_broadcast_part_is_exact(spark):
    table = stored(spark.range(300).select(F.lit("v").alias("column"), F.concat(F.lit("k"), "id").alias("value"), (300 - F.col("id")).alias("n"),
                                           F.col("id").cast("double").alias("at")), "dictionary")
    rows = [(f"k{i % 300}",) for i in range(900)] + [("k0",)] * 500 + [(None,), ("absent",)]
    df = spark.createDataFrame(rows, "v string")
    out = looked_up(df, ["v"], table, entries(table), "at", {"v": "hit"}, hot=20).collect()
    assert len(out) == len(rows) and all(r.hit == (float(r.v[1:]) if r.v and r.v != "absent" else None) for r in out)


def test_correlations_of_wide_tables_take_two_passes(spark, tmpdir_path):
    k, n = 200, 400
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, k)) + rng.normal(size=(n, 1)) + 1e4
    x[rng.random((n, k)) < 0.1] = np.nan
    x[:, 7] = 0.1
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(k)])
    path = os.path.join(tmpdir_path, "wide")
    spark.createDataFrame(pdf).write.parquet(path)
    out = correlation_matrix(spark.read.parquet(path), list(pdf.columns))
    assert plan_of(out).count("FileScan parquet") <= 2
    got = out.toPandas().pivot(index="col_a", columns="col_b", values="r").loc[pdf.columns, pdf.columns].to_numpy(dtype=float)
    want = pdf.corr().to_numpy()
    want[7, :] = want[:, 7] = np.nan
    assert np.allclose(got, want, atol=1e-8, equal_nan=True)


LINES = "a,b\n1,2\n4,5,6\nx,3\n7\n?,8\n"


def test_csv_bad_records(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "x.csv")
    with open(path, "w") as f:
        f.write(LINES)
    with pytest.raises(MalformedCsv) as e:
        read_csv(spark, path, schema="a int, b int")
    assert "2 lines of a wrong width" in str(e.value) and "1 values of a, such as 'x'" in str(e.value)
    rep = {(r.kind, r.column): (r.n, r.example) for r in csv_report(spark, path, schema="a int, b int").collect()}
    assert rep == {("width", None): (2, "4,5,6"), ("cast", "a"): (1, "x")}
    assert sorted(map(tuple, read_csv(spark, path, schema="a int, b int", mode="drop").collect()), key=str) == [(1, 2), (None, 8)]
    loose = read_csv(spark, path, schema="a int, b int", mode="permissive")
    assert sorted(map(tuple, loose.collect()), key=str) == [(1, 2), (4, 5), (7, None), (None, 3), (None, 8)]
    with pytest.raises(Exception, match="malformed line"):
        read_csv(spark, path, schema="a int, b int", mode="failfast").collect()
    with pytest.raises(MalformedCsv):
        read_csv(spark, path)                                 # without a schema the width still counts
    with pytest.raises(ValueError):
        read_csv(spark, path, mode="whatever")
    with open(path, "w") as f:
        f.write("a,b\n1,2\n?,8\n")
    assert csv_report(spark, path, schema="a int, b int").count() == 0
    assert sorted(map(tuple, read_csv(spark, path, schema="a int, b int").collect()), key=str) == [(1, 2), (None, 8)]


def test_splits_and_folds_of_many_classes(spark, monkeypatch):
    """Allocations and boundaries of 20,000 classes stay tables, and sizes are exact."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic
    df = stored(spark.range(80_000).select("id", (F.col("id") % 20_000).alias("c")), "classes").unionByName(
        spark.createDataFrame([(80_000, None), (80_001, None)], "id long, c long"))
    sizes, real = [], Classic.collect
    monkeypatch.setattr(Classic, "collect", lambda self: (lambda rows: sizes.append(len(rows)) or rows)(real(self)))
    out, report = stratified_split(df, "c", "id", test_size=0.25)
    folds, rep = stratified_folds_report(df, "c", "id", k=3)
    assert (report["n"], report["n_null_label"], rep["n_null_label"]) == (80_000, 2, 2) and max(sizes, default=0) <= 20
    monkeypatch.undo()
    assert {(r.side, r.n): r.c for r in out.groupBy("side", "c").agg(F.count("*").alias("n")).groupBy("side", "n").agg(F.count("*").alias("c")).collect()} == {
        ("test", 1): 20_000, ("train", 3): 20_000}
    assert [r["count"] for r in folds.groupBy("fold").count().orderBy("fold").collect()] == [26_667, 26_667, 26_666]
    assert report["per_class"][5] == {"n": 4, "train": 3, "test": 1}


def test_a_constant_model_turns_the_model_queries_red(spark, monkeypatch):
    """The flags that the oracles ask for are false for a model that knows nothing."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from sf_paths import SMALL
    from tablesmith.ml import assembly
    from tablesmith.plans import q_models as Q

    def constant(name, params=None, label="label", weight="weight"):
        return DecisionTreeClassifier(labelCol=label, featuresCol="features", weightCol=weight, maxDepth=0)

    monkeypatch.setattr(assembly, "build_classifier", constant)
    monkeypatch.setattr(S, "build_classifier", constant)
    for query, flag in ((Q.q_fit_tree, "learns"), (Q.q_fit_forest, "learns"), (Q.q_score, "learns"), (Q.q_grid_search, "beats_constant")):
        assert not all(r[flag] for r in query(spark, SMALL).collect()), flag
    with pytest.raises(Exception, match="split"):
        Q.q_tree_split(spark, SMALL)
