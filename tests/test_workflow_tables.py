"""The batch run's frame and its sides are tables: later stages read columns of them."""

from __future__ import annotations

from tablesmith import workflow as W
from tablesmith.config import RunConfig


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sides_are_read_from_a_table(spark):
    rows = [(i, float(i * 37 % 101), "abc"[i % 3], "yes" if i * 37 % 101 > 50 else "no") for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, x double, c string, y string")
    cfg = RunConfig(path="", target="y", target_mapping={"no": 0, "yes": 1}, expected_columns=df.columns, drop_features=[], numeric_columns=("x",),
                    model="LogisticRegression", model_params={"C": 1.0}, folds=2, key="id")
    out = W.run(df, cfg)
    # neither the split's boundaries nor a checkpoint's whole rows are read again
    plan = _plan(out["split_quality"])
    assert "LogicalRDD" not in plan and "Join" not in plan and "Relation" in plan
    assert {r["side"]: r["n_side"] for r in out["split_quality"].collect()} == {"train": 240, "test": 60}
    assert out["scored"].count() == 60
