"""Edge frames: empty, all-NULL column, constant column, single class, ties."""

from pyspark.sql import functions as F

from tablesmith.operators import explore as EX
from tablesmith.operators import metrics as M
from tablesmith.operators import profile as PR
from tablesmith.operators.split import stratified_folds, stratified_split

SCHEMA = "k long, x double, z double, c double, s string"


def _frame(spark, n=50):
    rows = [(i, float(i % 9), None, 3.0, "ab"[i % 2] if i % 5 else None) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def test_empty_frame_profiles(spark):
    df = spark.createDataFrame([], SCHEMA)
    qp = {r["column"]: r for r in PR.quick_profile(df).collect()}
    assert qp["x"]["n_rows"] == 0 and qp["x"]["n_unique"] == 0
    dn = {r["column"]: r for r in PR.describe_numerical(df, ["x", "z"]).collect()}
    assert dn["x"]["n"] == 0 and dn["x"]["p50"] is None
    assert PR.duplicate_count(df).first()["n_duplicates"] is None or PR.duplicate_count(df).count() == 1


def test_all_null_and_constant_columns(spark):
    df = _frame(spark)
    dn = {r["column"]: r for r in PR.describe_numerical(df, ["x", "z", "c"]).collect()}
    assert dn["z"]["n"] == 0 and dn["z"]["p50"] is None
    assert dn["c"]["std"] == 0.0 and dn["c"]["p25"] == 3.0 and dn["c"]["p75"] == 3.0
    cm = {(r.col_a, r.col_b): r.r for r in EX.correlation_matrix(df, ["x", "z", "c"]).collect()}
    assert cm[("x", "c")] is None and cm[("x", "z")] is None and abs(cm[("x", "x")] - 1.0) < 1e-12
    h = EX.histogram(df, ["c"], bins=4).collect()
    assert sum(r.n for r in h) == 50 and [r.n for r in h if r.bin == 0] == [50]
    uc = {r["column"]: r["n_unique"] for r in PR.unique_counts(df).collect()}
    assert uc["z"] == 0 and uc["s"] == 2


def test_single_class_split_and_folds(spark):
    df = _frame(spark, 23).withColumn("y", F.lit(1))
    out, rep = stratified_split(df, "y", "k", test_size=0.2)
    assert out.where("side = 'test'").count() == 5 and out.count() == 23
    f = stratified_folds(df, "y", "k", k=5)
    assert sorted(r["count"] for r in f.groupBy("fold").count().collect()) == [4, 4, 5, 5, 5]


def test_tiny_class_gets_empty_folds(spark):
    df = _frame(spark, 12).withColumn("y", F.when(F.col("k") < 2, 1).otherwise(0))
    f = stratified_folds(df, "y", "k", k=5)
    assert f.count() == 12
    assert f.where("y = 1").select("fold").distinct().count() == 2


def test_metrics_single_class_labels(spark):
    df = spark.createDataFrame([("r", 1, 0.2, 0), ("r", 1, 0.7, 1)], "run string, label long, score double, "
                                                                      "prediction long")
    bm = M.binary_metrics(df).first()
    assert bm.recall == 0.5 and bm.precision == 1.0
    assert M.roc_auc(df).first().roc_auc is None
    assert M.average_precision(df).first().average_precision == 1.0


def test_duplicate_rows_with_nulls_compare_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert PR.duplicate_count(df).first()["n_duplicates"] == 1


def test_correlation_of_several_blocks(spark):
    """However the rows are dealt to tasks, the blocks' sums are those of the whole."""
    from tablesmith.operators import explore
    df = spark.range(200).select(*[(F.col("id") * (i + 1) % (17 + i)).cast("double").alias(f"c{i}") for i in range(6)])
    df = df.withColumn("c6", F.when(F.col("c0") > 3, F.col("c1")))
    want = df.toPandas().corr()
    for dealt in (df.coalesce(1), df.repartition(7)):
        got = {(r.col_a, r.col_b): r.r for r in explore.correlation_matrix(dealt, df.columns).collect()}
        assert len(got) == 49 and all(abs(got[a, b] - want.loc[a, b]) < 1e-9 for a, b in got)
