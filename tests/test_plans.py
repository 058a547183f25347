"""Physical-plan checks: column pruning at the scan, no Python in the row path, one scan
for the one-pass profile, and no single-partition exchange under the curve windows."""

import re

import pytest
from pyspark.sql import functions as F

from tablesmith.functions.ranking import running_totals
from tablesmith.operators import clean as CL
from tablesmith.operators import metrics as M
from tablesmith.operators import profile as PR
from tablesmith.operators import target as TG
from tablesmith.sources import views as V

from sf_paths import SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_numeric_profile_single_pruned_scan(spark):
    li = V.v_li(spark, SMALL)
    plan = _plan(PR.numeric_profile(li, ["l_quantity", "l_discount"]))
    assert plan.count("FileScan parquet") == 1
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "l_comment" not in scan and "l_shipdate" not in scan and "l_quantity" in scan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_quick_profile_no_python(spark):
    plan = _plan(PR.quick_profile(V.v_ord(spark, SMALL)))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_running_totals_partitioned_window(spark):
    df = spark.range(5000).select(F.lit("r").alias("run"), (F.col("id") / 5000.0).alias("score"),
                                  F.lit(1).alias("v"))
    out = running_totals(df, ["run"], "score", ["v"], ranges=50)
    # the row-level window is dealt by range; a single task may only see one row per range
    assert re.search(r"Exchange hashpartitioning\([^)]*__b", _plan(out))
    assert "SinglePartition" not in _plan(out)
    assert out.agg(F.max("cum_v")).first()[0] == 5000


def _scans(df):
    """Scans of base tables in the plan before adaptive execution reuses anything."""
    return _plan(df).count("FileScan parquet")


@pytest.mark.parametrize("make", [
    PR.quick_profile, PR.null_counts, PR.unique_counts, PR.min_max, lambda df: PR.missing_summary(df, "status"),
    lambda df: CL.clean_status(df, "status"), lambda df: TG.target_status(df, "status")])
def test_profiles_scan_each_table_once(spark, make):
    assert _scans(make(V.v_ord(spark, SMALL))) == 3        # orders, customer, nation


def test_metrics_scan_once(spark):
    for make in (M.confusion_matrix, M.classification_report, M.threshold_sweep):
        assert _scans(make(V.v_scores(spark, SMALL))) == 2     # documents, labels


def test_compare_runs_checkpoints_one_table(spark):
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    spark.sparkContext._jvm.System.gc()
    before = len(fs.listStatus(files))
    kept = M.compare_runs(V.v_scores(spark, SMALL))
    assert len(fs.listStatus(files)) <= before + 1 and kept.count() == 2
