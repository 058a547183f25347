"""Property tests on generated frames."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tablesmith.functions.ranking import key_stats, rank_select
from tablesmith.operators import explore as EX
from tablesmith.operators.clean import drop_duplicates
from tablesmith.operators.frequency import value_counts

values = st.lists(st.one_of(st.integers(-3, 3).map(float), st.floats(-1e6, 1e6, allow_nan=False)),
                  min_size=1, max_size=60)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(xs=values, data=st.data())
def test_rank_select_is_sorting(spark, xs, data):
    df = spark.createDataFrame([(1, x) for x in xs], "g int, x double")
    ks = sorted(set(data.draw(st.lists(st.integers(0, len(xs) - 1), min_size=1, max_size=4))))
    got = rank_select(df, ["g"], "x", key_stats(df, ["g"], "x"), [((1,), k) for k in ks], max_window=4)
    srt = np.sort(np.array(xs))
    for k in ks:
        v, n_less = got[((1,), k)]
        assert v == srt[k] and n_less == int((srt < v).sum())


def test_dedup_idempotent(spark):
    df = spark.createDataFrame([(i % 4, "ab"[i % 2]) for i in range(40)], "a int, b string")
    once, removed = drop_duplicates(df)
    twice, removed2 = drop_duplicates(once)
    assert once.count() == twice.count() == 4
    assert removed.first()[0] == 36 and removed2.first()[0] == 0


def test_one_hot_rows_sum(spark):
    train = spark.createDataFrame([(c,) for c in "aabbbc"], "v string")
    m = Pipeline(stages=[StringIndexer(inputCol="v", outputCol="i", stringOrderType="alphabetAsc", handleInvalid="keep"),
                         OneHotEncoder(inputCol="i", outputCol="o", dropLast=True)]).fit(train)
    test = spark.createDataFrame([("a",), ("c",), ("zz",)], "v string")
    sums = {r.v: r.s for r in m.transform(test).select("v", F.aggregate(vector_to_array("o"), F.lit(0.0),
                                                                          lambda a, x: a + x).alias("s")).collect()}
    assert sums == {"a": 1.0, "c": 1.0, "zz": 0.0}


def test_shares_sum_to_one(spark):
    df = spark.createDataFrame([(c, i % 2) for i, c in enumerate("aabbbcddddx")], "v string, y int")
    vc = value_counts(df, "v", normalize=True)
    assert abs(sum(r.share for r in vc.collect()) - 1.0) < 1e-12
    ct = EX.crosstab_normalized(df, ["v"], "y").groupBy("value").agg(F.sum("share").alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-12 for r in ct)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sizes=st.lists(st.integers(1, 40), min_size=1, max_size=4), test_size=st.sampled_from([0.1, 0.2, 0.33]))
def test_split_sizes_property(spark, sizes, test_size):
    import math

    from tablesmith.operators.split import approximate_mode, stratified_split
    rows = [(i, c) for c, n in enumerate(sizes) for i in range(sum(sizes[:c]), sum(sizes[:c]) + n)]
    df = spark.createDataFrame(rows, "k long, y int")
    out, rep = stratified_split(df, "y", "k", test_size=test_size, seed=3)
    got = {(r.side, r.y): r["count"] for r in out.groupBy("side", "y").count().collect()}
    n = sum(sizes)
    train = approximate_mode(sizes, n - int(math.ceil(test_size * n)))
    for c, nc in enumerate(sizes):
        assert got.get(("train", c), 0) == train[c] and got.get(("test", c), 0) == nc - train[c]
    assert out.count() == n and out.select("k").distinct().count() == n
