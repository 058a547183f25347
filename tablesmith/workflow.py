"""The end-to-end batch run: load and check, target, clean, features, split, search,
score and record (the stages of the reference's batch script), chained from the
operators of this package.

Every stage's report is a DataFrame in the returned dict; the fitted model and the
chosen parameters come back too. Actions happen only where a stage must fit something
(quantiles, split boundaries, models).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesmith.config import RunConfig
from tablesmith.functions.columns import numeric_columns
from tablesmith.ml.assembly import PrepConfig, score_frame
from tablesmith.ml.search import cv_results, grid_search
from tablesmith.operators import clean as CL
from tablesmith.operators import features as FE
from tablesmith.operators import metrics as M
from tablesmith.operators import profile as PR
from tablesmith.operators import split as SP
from tablesmith.operators import target as TG
from tablesmith.sources import persist as P
from tablesmith.session import stored
from tablesmith.sources.tables import null_tokens, read_csv


def load(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """Read the configured CSV (names made Spark-safe, marker tokens and NaN to NULL)."""
    return read_csv(spark, cfg.path, tokens=list(cfg.null_tokens))


def run(df: DataFrame, cfg: RunConfig, grid=None, *, run_table: str | None = None, cv_table: str | None = None,
        roles_path: str | None = None, splits_path: str | None = None) -> dict:
    """Run every stage on ``df`` and return the reports, the model and the test metrics. The
    paths name where the roles, the splits, the run record and the CV table are kept."""
    out = {}
    df = null_tokens(df, list(cfg.null_tokens))
    # load and check
    out["schema"] = PR.schema_diff(df, cfg.expected_columns)
    out["profile"] = PR.quick_profile(df)
    out["duplicates"] = PR.duplicate_count(df)
    # target
    df = TG.normalize_target(df, cfg.target, list(cfg.target_mapping))
    out["invalid_target"] = TG.invalid_target_count(df, cfg.target)
    df = TG.encode_target(df, cfg.target, cfg.target_mapping)
    out["target_status"] = TG.target_status(df, cfg.target)
    out["target_distribution"] = TG.target_distribution(df, cfg.target)
    # clean: de-duplicate first, then trim and coerce (the reference's order)
    df, out["removed"] = CL.drop_duplicates(df)
    out["missing"] = PR.missing_summary(df, cfg.target)
    df = CL.coerce_numeric(CL.trim_strings(df), list(cfg.numeric_columns))
    nums = numeric_columns(df, exclude=[cfg.target])
    out["gross_outliers"] = CL.gross_outliers(df, nums)
    # features
    roles = FE.feature_roles(df, cfg.drop_features + ([cfg.key] if cfg.key else []), cfg.target)
    out["roles"] = roles
    out["issues"] = FE.feature_issues(df, roles)
    lists = FE.role_lists(roles)
    # split: the whole row is the key (trimming can make rows equal again; the split allows it)
    key = [cfg.key] if cfg.key else list(df.columns)
    frame = df.select(*dict.fromkeys(key + lists["final_features"] + [cfg.target]))
    # every later stage (split boundaries, folds, each fit and score) re-reads this frame, most of
    # them a few columns: write it once as a table, which also cuts the lineage, and its sides too
    frame = stored(frame, "frame")
    split, report = SP.stratified_split(frame, cfg.target, key, cfg.test_size, cfg.seed)
    split = stored(split, "split")
    out["split_quality"] = SP.split_quality(split, cfg.target)
    out["split_report"] = report
    if roles_path:
        P.save_roles(roles, roles_path)
    if splits_path:
        SP.save_splits(split, splits_path)
    train = split.where(F.col("side") == "train")
    test = split.where(F.col("side") == "test")
    folds = SP.stratified_folds(train, cfg.target, key, k=cfg.folds, seed=cfg.seed)
    prep = PrepConfig(num_cols=lists["final_num_features"], cat_cols=lists["final_cat_features"],
                      outlier=cfg.outlier, pmin=cfg.pmin, pmax=cfg.pmax, num_impute=cfg.num_impute,
                      cat_impute=cfg.cat_impute, grouping={c: v for c, v in cfg.grouping.items()
                                                           if c in lists["final_cat_features"]},
                      other_label=cfg.other_label, scaling=cfg.scaling, label=cfg.target)
    cv, best, model = grid_search(folds.drop("side"), prep, grid or {}, model=cfg.model, scoring=cfg.scoring,
                                  experiment=cfg.experiment, model_params=cfg.model_params)
    out["cv"] = cv
    out["cv_results"] = cv_results(cv)
    out["best_params"] = best
    out["model"] = model
    if model is not None:
        scored = score_frame(model, test, cfg.experiment, label=cfg.target)
        out["scored"] = scored
        metrics = M.compare_runs(scored)
        out["test_metrics"] = metrics
        if run_table:
            row = metrics.first().asDict()
            P.log_run(df.sparkSession, run_table, cfg.experiment, tags={"model": cfg.model},
                      params=best, metrics={k: v for k, v in row.items() if k != "run"})
    if cv_table:
        P.save_cv(cv, cv_table)
    return out
