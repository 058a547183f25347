"""The tree's table of different rows: the same tree as from the rows themselves."""

from __future__ import annotations

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler

from tablesmith.ml.assembly import build_classifier


def _rows(spark):
    # equal rows, labels that disagree on equal features, weights that differ on equal rows
    rows = [(float(i % 7), float(i % 3), float(i % 7 + i % 3 > 4 or i % 50 == 0), 1.0 + i % 2) for i in range(600)]
    df = spark.createDataFrame(rows, "a double, b double, label double, weight double").repartition(5)
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


@pytest.mark.parametrize("params", [{"max_depth": 1}, {"max_depth": 6}, {"max_depth": 6, "min_samples_leaf": 40}])
def test_tree_of_counted_rows_is_the_tree_of_the_rows(spark, monkeypatch, params):
    df = _rows(spark)
    plain = DecisionTreeClassifier(featuresCol="features", labelCol="label", weightCol="weight", impurity="gini", seed=42, maxBins=64,
                                   maxDepth=params["max_depth"], minInstancesPerNode=params.get("min_samples_leaf", 1)).fit(df)
    fitted, fit = [], DecisionTreeClassifier._fit
    monkeypatch.setattr(DecisionTreeClassifier, "_fit", lambda self, rows: fitted.append(rows.count()) or fit(self, rows))
    own = build_classifier("DecisionTreeClassifier", params).fit(df)
    assert own.toDebugString.split("\n")[1:] == plain.toDebugString.split("\n")[1:]
    probability = [[tuple(r[0]) for r in m.transform(df.select("features").distinct()).orderBy("features").select("probability").collect()] for m in (own, plain)]
    assert probability[0] == probability[1]
    # MLlib gets every different row once, unless a least count of rows is asked for
    assert fitted == [600 if "min_samples_leaf" in params else df.select("features", "label", "weight").distinct().count()]
