"""What the search's jobs leave on the driver and shuffle: plans of a scan, few tasks, no texts."""

from __future__ import annotations

import threading

import pytest

from tablesmith.ml import search as S
from tablesmith.ml.assembly import PrepConfig
from tablesmith.session import shuffles_removed
from tablesmith.sources import views as V


def _frame(spark):
    rows = [(float(i % 7), "abc"[i % 3], float(i % 7 > 3), i % 3) for i in range(90)]
    return spark.createDataFrame(rows, "x double, c string, label double, fold int").repartition(6)


@pytest.mark.parametrize("rows,tasks", [(1 << 18, 1), (40, 3)])
def test_fits_read_a_table_in_as_many_tasks_as_its_rows_ask_for(spark, monkeypatch, rows, tasks):
    seen, build = [], S.build_classifier

    class Watched:
        def __init__(self, own):
            self.own = own

        def fit(self, df):
            seen.append((df._jdf.queryExecution().optimizedPlan().toString(), df.rdd.getNumPartitions(), df.count()))
            return self.own.fit(df)

    monkeypatch.setattr(S, "FIT_ROWS", rows, raising=False)
    monkeypatch.setattr(S, "build_classifier", lambda *a, **k: Watched(build(*a, **k)))
    cv, _, _ = S.grid_search(_frame(spark), PrepConfig(num_cols=["x"], cat_cols=["c"], label="label"), {"C": [1.0, 10.0]}, refit=False)
    scores = {(r["candidate"], r["fold"], r["split"]): r["score"] for r in cv.collect()}
    assert len(scores) == 12 and all(x > 0.9 for x in scores.values())
    assert len(seen) == 6
    for plan, n, count in seen:
        assert "Join" not in plan and "InMemoryRelation" not in plan and plan.count("Relation") == 1
        assert n == tasks and count == 60


def test_split_scores_are_those_of_their_rows(spark):
    rows = [(1, 1, 0.9, "train"), (0, 1, 0.8, "train"), (1, 0, 0.4, "train"), (1, 1, 0.7, "test"), (0, 0, 0.2, "test")]
    df = spark.createDataFrame([(float(y), p, s, w) for y, p, s, w in rows], "label double, prediction int, score double, split string")
    assert S._score(df, "accuracy") == {"train": pytest.approx(1 / 3), "test": 1.0}
    assert S._score(df, "roc_auc") == {"train": 0.5, "test": 1.0}


def test_texts_stay_out_of_the_join_of_documents_and_labels(spark, tmpdir_path):
    docs = spark.createDataFrame([(1, "ab C", "en", "s", 4), (2, None, None, "t", 0), (2, "xyz", "de", "t", 3), (3, "XY", "de", "t", 2)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame([(1, 5, 0), (1, 6, 0), (2, 7, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmpdir_path}/labels.parquet")
    df = V.v_doc(spark, tmpdir_path)
    plan = df._jdf.queryExecution().optimizedPlan()
    while "Join" not in plan.nodeName():
        plan = plan.children().head()
    sides = [plan.children().apply(i) for i in range(plan.children().size())]
    assert not any("text#" in side.output().toString() for side in sides)
    assert {tuple(r) for r in df.collect()} == {(1, 4, 0.5, "en", "s", 5), (1, 4, 0.5, "en", "s", 6), (2, 0, None, None, "t", 7), (2, 3, 1.0, "de", "t", 7),
                                                (3, 2, 0.0, "de", "t", None)}


def test_threads_share_the_setting_that_removes_shuffles(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    entered, left = threading.Event(), threading.Event()

    def first():
        with shuffles_removed(spark):
            entered.set()
            left.wait(20)

    thread = threading.Thread(target=first)
    thread.start()
    entered.wait(20)
    with shuffles_removed(spark):
        left.set()
        thread.join(20)
        assert spark.conf.get(key) == "true"        # the other thread has not taken it back
    assert spark.conf.get(key, None) == before
