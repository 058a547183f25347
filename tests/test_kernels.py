"""The distributed kernels against brute force on small frames, with parameters that
force the multi-round paths (tiny windows, tiny buckets, small salts)."""

import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tablesmith.functions.ranking import (key_stats, quantiles_long, rank_select, running_totals, to_long_numeric,
                                          top_k)


def _frame(spark, n=3000, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "a" if i % 3 else "b"
        hot = 7.0 if rnd.random() < 0.34 else rnd.gauss(0, 100)  # a third of the rows share one value
        rows.append((i, g, hot, float(rnd.randint(-5, 5)) if i % 11 else None))
    return spark.createDataFrame(rows, "id long, g string, x double, y double")


def test_rank_select_matches_sorting(spark):
    df = _frame(spark)
    pdf = df.toPandas()
    stats = key_stats(df, ["g"], "x")
    targets = [(("a",), 0), (("a",), 1000), (("a",), 1999), (("b",), 5), (("b",), 500), (("b",), 999)]
    for window in (1_000_000, 50, 7):
        got = rank_select(df, ["g"], "x", stats, targets, max_window=window)
        for (key, k), (v, n_less) in got.items():
            xs = np.sort(pdf[pdf.g == key[0]].x.to_numpy())
            assert v == xs[k], (window, key, k)
            assert n_less == int((xs < v).sum())


def test_rank_select_long_hash_values(spark):
    df = spark.range(5000).select(F.lit(1).alias("g"), F.xxhash64("id").alias("h"))
    xs = np.sort(np.array([r.h for r in df.collect()], dtype=np.int64))
    stats = key_stats(df, ["g"], "h")
    got = rank_select(df, ["g"], "h", stats, [((1,), 0), ((1,), 1234), ((1,), 4999)], max_window=20)
    assert [got[((1,), k)][0] for k in (0, 1234, 4999)] == [int(xs[0]), int(xs[1234]), int(xs[4999])]


def test_quantiles_match_linear_interpolation(spark):
    df = _frame(spark)
    pdf = df.toPandas()
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    for window in (1_000_000, 13):
        out = quantiles_long(df, ["x", "y"], probs, by=["g"], max_window=window).collect()
        for r in out:
            s = pdf[pdf.g == r["g"]][r["column"]].dropna()
            assert math.isclose(r["q"], float(s.quantile(r["p"])), rel_tol=1e-12, abs_tol=1e-12)


def test_to_long_drops_nulls(spark):
    df = _frame(spark, 100)
    n = to_long_numeric(df, ["x", "y"]).count()
    assert n == 100 + df.where("y IS NOT NULL").count()


def test_running_totals_multi_bucket(spark):
    rnd = random.Random(3)
    rows = [(r, float(s), rnd.randint(0, 3)) for r in ("p", "q") for s in rnd.sample(range(10_000), 700)]
    df = spark.createDataFrame(rows, "run string, score double, v long")
    for desc in (False, True):
        out = running_totals(df, ["run"], "score", ["v"], descending=desc, ranges=19).toPandas()
        pdf = pd.DataFrame(rows, columns=["run", "score", "v"]).sort_values(["run", "score"], ascending=[True, not desc])
        pdf["cum_v"] = pdf.groupby("run").v.cumsum()
        m = out.merge(pdf, on=["run", "score"], suffixes=("", "_e"))
        assert len(m) == len(rows)
        assert (m.cum_v == m.cum_v_e).all()


def test_top_k_exact_with_salt(spark):
    rows = [("c", f"v{i:03d}", (i * 7919) % 50) for i in range(400)] + [("d", "x", 5), ("d", "y", 5)]
    df = spark.createDataFrame(rows, "column string, value string, n long")
    out = top_k(df, ["column"], [F.col("n").desc(), F.col("value").asc()], 10, salt=8, tiebreak="value").toPandas()
    pdf = pd.DataFrame(rows, columns=["column", "value", "n"]).sort_values(["column", "n", "value"],
                                                                         ascending=[True, False, True])
    exp = pdf.groupby("column").head(10)
    assert sorted(map(tuple, out[["column", "value"]].values)) == sorted(map(tuple, exp[["column", "value"]].values))


def test_approximate_quantiles_close(spark):
    df = _frame(spark)
    exact = {(r["column"], r["p"]): r["q"] for r in quantiles_long(df, ["x"], [0.1, 0.5, 0.9]).collect()}
    approx = quantiles_long(df, ["x"], [0.1, 0.5, 0.9], accuracy=10_000).collect()
    pdf = df.toPandas()
    for r in approx:
        xs = np.sort(pdf["x"].dropna().to_numpy())
        lo = np.searchsorted(xs, exact[(r["column"], r["p"])], side="left")
        hi = np.searchsorted(xs, r["q"], side="left")
        assert abs(int(hi) - int(lo)) <= len(xs) / 10_000 + 2


def test_running_totals_balance_crowded_values(spark):
    # most distinct values crowd into a tiny part of the range: ranges follow the data
    rows = [("p", float(i) * 1e-6, 1) for i in range(3000)] + [("p", 1000.0 + i, 2) for i in range(5)]
    df = spark.createDataFrame(rows, "run string, score double, v long")
    for desc in (False, True):
        out = running_totals(df, ["run"], "score", ["v"], descending=desc, ranges=60)
        pdf = pd.DataFrame(rows, columns=["run", "score", "v"]).sort_values("score", ascending=not desc)
        pdf["cum_v"] = pdf.v.cumsum()
        m = out.toPandas().merge(pdf, on=["run", "score"], suffixes=("", "_e"))
        assert len(m) == len(rows) and (m.cum_v == m.cum_v_e).all() and (m.tot_v == 3010).all()
    dealt = df.repartitionByRange(60, "run", "score").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert dealt <= 4 * len(rows) / 60


def test_running_totals_without_a_part_and_with_null(spark):
    df = spark.createDataFrame([(None, 5), (1.0, 1), (2.0, 2), (3.0, 4)], "x double, v long")
    got = {r.x: (r.cum_v, r.tot_v) for r in running_totals(df, [], "x", ["v"], descending=True, ranges=3).collect()}
    assert got == {3.0: (4, 12), 2.0: (6, 12), 1.0: (7, 12), None: (12, 12)}


def test_quantiles_of_a_heavy_tail_take_two_passes(spark, monkeypatch):
    from tablesmith.functions import ranking
    rows = spark.range(30_000).select((F.when(F.col("id") % 1000 == 0, F.col("id") * 1e9).otherwise(F.col("id") / 7)).alias("x"))
    passes = []
    for name in ("key_stats", "_count_values"):
        real = getattr(ranking, name)
        monkeypatch.setattr(ranking, name, lambda *a, real=real, **k: passes.append(1) or real(*a, **k))
    got = {r["p"]: r["q"] for r in quantiles_long(rows, ["x"], [0.25, 0.5, 0.75]).collect()}
    xs = pd.Series([r.x for r in rows.collect()])
    assert all(math.isclose(got[p], xs.quantile(p), rel_tol=1e-12) for p in got) and len(passes) == 2


def test_rank_select_recovers_when_a_sketch_misses(spark):
    df = spark.range(1000).select(F.lit("a").alias("g"), F.col("id").cast("double").alias("x"))
    wrong = [{"g": "a", "__n": 1000, "__min": 0.0, "__max": 999.0, "__edges": [float(i) / 10 for i in range(257)]}]
    for window in (20_000, 10):
        got = rank_select(df, ["g"], "x", wrong, [(("a",), 700), (("a",), 3)], max_window=window)
        assert got == {(("a",), 700): (700.0, 700), (("a",), 3): (3.0, 3)}


def test_a_value_of_most_rows_is_one_count(spark, monkeypatch):
    """60 % zeros: rows enter a pass once, and no window holds more than ``max_window`` values."""
    from tablesmith.functions import ranking
    df = spark.range(40_000).select(F.lit("a").alias("g"), F.when(F.col("id") % 5 < 3, F.lit(0.0)).otherwise(F.hash("id") / 1e3).alias("x"))
    xs = np.sort(df.toPandas().x.to_numpy())
    entered, windows = [], []
    for name in ("_count_values", "_count_sketches"):
        def spy(data, groups, keys, x, longest, extra, real=getattr(ranking, name)):
            entered.append(ranking._classified(data, groups, keys, x, longest, extra).count())
            out = real(data, groups, keys, x, longest, extra)
            if "v" in out.columns:
                windows.extend(r["count"] for r in out.where("v IS NOT NULL").groupBy("code").count().collect())
            return out
        monkeypatch.setattr(ranking, name, spy)
    first, last = int(np.searchsorted(xs, 0.0)), int(np.searchsorted(xs, 0.0, side="right")) - 1
    ks = [0, first - 1, first, last, last + 1, 39_999]
    got = rank_select(df, ["g"], "x", key_stats(df, ["g"], "x"), [(("a",), k) for k in ks], max_window=1000)
    assert [got[("a",), k][0] for k in ks] == [xs[k] for k in ks]
    assert set(entered) == {40_000} and max(windows) <= 1000


def test_quantiles_of_many_groups_without_a_row_each_on_the_driver(spark, monkeypatch):
    """Targets, brackets and results of 200,000 groups stay tables."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic
    df = spark.range(600_000).select((F.col("id") % 200_000).alias("g"), F.col("id").cast("double").alias("x"))
    sizes, real = [], Classic.collect
    monkeypatch.setattr(Classic, "collect", lambda self: (lambda rows: sizes.append(len(rows)) or rows)(real(self)))
    out = quantiles_long(df, ["x"], [0.5], by=["g"])
    assert out.count() == 200_000 and out.where(F.col("q") != F.col("g") + 200_000).count() == 0
    assert max(sizes, default=0) <= 10


def test_ranks_outside_of_a_part(spark):
    """The order statistics of all rows but one fold's, for all folds in the same passes."""
    from tablesmith.functions.ranking import WITHOUT, select_ranks
    pdf = pd.DataFrame({"g": "a", "f": [i % 3 for i in range(900)], "x": [float((i * 7919) % 1000 // 7) for i in range(900)]})
    df = spark.createDataFrame(pdf)
    for window in (20_000, 30):
        rows = [("a", w, k, 900 if w is None else 600) for w in (None, 0, 1, 2) for k in (0, 17, 300, 599)]
        targets = spark.createDataFrame(rows, f"g string, {WITHOUT} long, k long, n long")
        got = {(r[WITHOUT], r.k): r["value"] for r in select_ranks(df, ["g"], "x", key_stats(df, ["g"], "x"), targets, part="f", max_window=window).collect()}
        assert got == {(w, k): np.sort(pdf[pdf.f != w].x.to_numpy() if w is not None else pdf.x.to_numpy())[k] for _, w, k, _ in rows}


def test_three_million_rows_need_no_second_sketch(spark, monkeypatch):
    from tablesmith.functions import ranking

    def unwanted(*args):
        raise AssertionError("a second sketch")

    monkeypatch.setattr(ranking, "_count_sketches", unwanted)
    df = spark.range(3_000_001).select(F.lit("x").alias("column"), ((F.col("id") * 1_000_003) % 3_000_001).cast("double").alias("x"))
    got = {r["p"]: r["q"] for r in ranking.quantile_table(df, ["column"], "x", [0.0, 0.25, 0.5, 1.0]).collect()}
    assert got == {0.0: 0.0, 0.25: 750_000.0, 0.5: 1_500_000.0, 1.0: 3_000_000.0}


def test_a_sketching_pass_reads_the_rows_once(spark):
    from tablesmith.functions.ranking import SKETCH, _count_sketches
    df = spark.range(1000).select(F.lit("x").alias("column"), F.col("id").cast("double").alias("x"))
    groups = spark.createDataFrame([("x", [100.0, 900.0], [0, SKETCH, 0])], "column string, bounds array<double>, modes array<int>")
    out = _count_sketches(df, groups, ["column"], "x", 2, [])
    assert out._jdf.queryExecution().sparkPlan().toString().count("Range (0, 1000") == 1
    rows = {r["code"]: (r["c"], r["edges"]) for r in out.collect()}
    assert {k: v[0] for k, v in rows.items()} == {0: 100, 1: 1, 2: 799, 3: 1, 4: 99}
    assert (rows[2][1][0], rows[2][1][-1]) == (101.0, 899.0) and rows[0][1] is None


def test_fences_are_joined_without_shuffling_the_values(spark):
    from tablesmith.operators.explore import box_stats
    df = spark.range(5000).select((F.col("id") % 100).cast("double").alias("a"), F.when(F.col("id") == 7, 1e6).otherwise(F.col("id") % 10).alias("b"))
    out = box_stats(df, ["a", "b"])
    assert "SortMergeJoin" not in out._jdf.queryExecution().sparkPlan().toString()
    assert {r["column"]: (r["median"], r["whisker_hi"], r["n_outliers"]) for r in out.collect()} == {"a": (49.5, 99.0, 0), "b": (4.5, 9.0, 1)}


def test_auto_histogram_takes_its_range_from_the_quantiles(spark, monkeypatch):
    from tablesmith.operators import explore

    def unwanted(*args):
        raise AssertionError("the range is known")

    monkeypatch.setattr(explore, "_ranges", unwanted)
    df = spark.range(64).select(F.col("id").cast("double").alias("a"), F.lit(2.0).alias("b"), F.lit(None).cast("double").alias("c"))
    rows = explore.histogram(df, ["a", "b", "c"], bins="auto").collect()
    assert {(r["column"], r["n"]) for r in rows if r["column"] != "a"} == {("b", 64)}
    mine = sorted((r["bin_lo"], r["n"]) for r in rows if r["column"] == "a")
    counts, edges = np.histogram(np.arange(64.0), bins="auto")
    assert [n for _, n in mine] == counts.tolist() and np.allclose([lo for lo, _ in mine], edges[:-1])
