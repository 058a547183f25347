"""Persistence (#4-#7): feature roles, fitted pipelines, the run table and CV tables.

All of them are directories of part files under a shared path, written and read by Spark.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROLE_SCHEMA = "column string, position int, role string, kind string"
RUN_SCHEMA = ("run_id string, experiment string, ts timestamp, tags map<string,string>, "
              "params map<string,string>, metrics map<string,double>")


def save_roles(roles: DataFrame, path: str) -> None:
    """Role table as JSON lines."""
    roles.write.mode("overwrite").json(path)


def load_roles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROLE_SCHEMA).json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def log_run(spark: SparkSession, path: str, experiment: str, *, tags: dict | None = None,
            params: dict | None = None, metrics: dict | None = None, run_id: str | None = None) -> str:
    """Append one run record to the run table; returns its id."""
    rid = run_id or uuid.uuid4().hex
    row = (rid, experiment, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
           {str(k): str(v) for k, v in (tags or {}).items()},
           {str(k): json.dumps(v, default=str) for k, v in (params or {}).items()},
           {str(k): float(v) for k, v in (metrics or {}).items() if v is not None})
    spark.createDataFrame([row], RUN_SCHEMA).write.mode("append").parquet(path)
    return rid


def load_runs(spark: SparkSession, path: str, experiments: list[str] | None = None) -> DataFrame:
    runs = spark.read.schema(RUN_SCHEMA).parquet(path)
    return runs.where(F.col("experiment").isin(experiments)) if experiments else runs


def save_cv(cv_long: DataFrame, path: str) -> None:
    """CV table appended per experiment (partitioned by experiment)."""
    cv_long.write.mode("append").partitionBy("experiment").parquet(path)


def load_cv_results(spark: SparkSession, path: str, experiments: list[str] | None = None) -> DataFrame:
    """Read the CV tables of the given experiments (partition pruning on experiment)."""
    cv = spark.read.parquet(path)
    return cv.where(F.col("experiment").isin(experiments)) if experiments else cv
