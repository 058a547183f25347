"""Feature pipeline and classifier factories (#63-#69).

``build_pipeline`` chains: clip -> fill -> scale of the numeric columns (``NumericPrep``, one
kernel call); fill -> group (configured columns) -> index (alphabetical, unseen kept) of the
categorical ones (``CategoryPrep``, one dictionary table) -> OneHotEncoder (dropLast: an unseen
value is all zeros and every known category keeps its slot); VectorAssembler (numeric first);
class weights; classifier. Every stage parameter is addressable by a flat grid name (``ml.search.PREP_FIELDS``,
``ml.search.MODEL_PARAMS``, ``grouping.<column>``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.functions.columns import q
from tablesmith.ml.chains import CategoryPrep, NumericPrep
from tablesmith.ml.stages import ClassWeights
from tablesmith.session import discarded, stored


@dataclass
class PrepConfig:
    """Preprocessing configuration (the reference's nested config, typed)."""
    num_cols: list
    cat_cols: list
    outlier: str = "clip"
    pmin: float = 0.01
    pmax: float = 0.99
    num_impute: str = "median"
    cat_impute: str = "most_frequent"
    cat_fill: str = "Missing"
    grouping: dict = field(default_factory=dict)  # column -> min_freq
    other_label: str = "Other"
    scaling: str = "standard"
    class_weight: object = "none"
    label: str = "label"


class CLogisticRegression(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Logistic regression parameterised by an inverse strength ``C`` and a penalty,
    mapped at fit time to MLlib's ``regParam = 1 / (C * sum of weights)`` (the training
    fold's weight sum), elastic net 0 (l2) or 1 (l1), no standardisation."""
    C = Param(Params._dummy(), "C", "inverse regularisation strength", typeConverter=TypeConverters.toFloat)
    penalty = Param(Params._dummy(), "penalty", "l2 or l1", typeConverter=TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", typeConverter=TypeConverters.toInt)
    featuresCol = Param(Params._dummy(), "featuresCol", "features", typeConverter=TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label", typeConverter=TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "weights", typeConverter=TypeConverters.toString)

    def __init__(self, C=1.0, penalty="l2", maxIter=1000, featuresCol="features", labelCol="label", weightCol="weight"):
        super().__init__()
        self._set(C=C, penalty=penalty, maxIter=maxIter, featuresCol=featuresCol, labelCol=labelCol,
                  weightCol=weightCol)

    def _fit(self, df):
        wcol = self.getOrDefault(self.weightCol)
        total = df.agg(F.sum(F.col(wcol)) if wcol in df.columns else F.count(F.lit(1))).first()[0] or 1.0
        pen = self.getOrDefault(self.penalty)
        if pen not in ("l1", "l2"):
            raise ValueError(f"unknown penalty {pen}")
        lr = LogisticRegression(featuresCol=self.getOrDefault(self.featuresCol),
                                labelCol=self.getOrDefault(self.labelCol),
                                regParam=1.0 / (self.getOrDefault(self.C) * float(total)),
                                elasticNetParam=1.0 if pen == "l1" else 0.0, standardization=False,
                                maxIter=self.getOrDefault(self.maxIter), family="binomial",
                                **({"weightCol": wcol} if wcol in df.columns else {}))
        return lr.fit(df)


class CountedTree(DecisionTreeClassifier):
    """MLlib's decision tree, fitted to a table of its different rows with their weights added up.

    Impurities are sums of weights, so the tree is the same, but the table is as long as the
    rows differ: MLlib's passes over rows of vectors and its copy of all of them in the executors'
    storage are left to one aggregate. MLlib counts rows for ``minInstancesPerNode``, so a least
    count above one fits the rows themselves. Rows are sorted, so that reruns sample alike."""

    def _fit(self, df):
        if self.getMinInstancesPerNode() > 1:
            return super()._fit(df)
        by = [self.getFeaturesCol(), self.getLabelCol(), self.getWeightCol()]
        rows = df.groupBy(*[q(c) for c in by]).agg(F.count(F.lit(1)).alias("__n"))
        rows = rows.select(*[q(c) for c in by[:2]], (F.col(q(by[2])) * F.col("__n")).alias(by[2]))
        table = stored(rows.sortWithinPartitions(*[q(c) for c in by]), "tree-rows")
        try:
            return super()._fit(table)
        finally:
            discarded(table)


# Classifier names accepted by the factory.
MODEL_NAMES = ["LogisticRegression", "DecisionTreeClassifier", "RandomForestClassifier"]


def build_classifier(name: str, params: dict | None = None, label: str = "label", weight: str = "weight"):
    """MLlib classifier from a name and reference-style parameters.

    max_depth None -> 30 (MLlib's maximum); min_samples_leaf -> minInstancesPerNode;
    min_samples_split has no MLlib counterpart and is approximated by
    minInstancesPerNode = ceil(k / 2)."""
    p = dict(params or {})
    if name == "LogisticRegression":
        return CLogisticRegression(C=float(p.get("C", 1.0)), penalty=p.get("penalty", "l2"),
                                   maxIter=int(p.get("max_iter", 1000)), labelCol=label, weightCol=weight)
    depth = p.get("max_depth")
    depth = 30 if depth is None else int(depth)
    if depth > 30:
        raise ValueError(f"max_depth {depth}: MLlib trees go to 30")
    leaf = int(p.get("min_samples_leaf", 1))
    split = p.get("min_samples_split")
    if split is not None:
        leaf = max(leaf, -(-int(split) // 2))
    common = dict(labelCol=label, featuresCol="features", maxDepth=depth, minInstancesPerNode=leaf,
                  maxBins=int(p.get("max_bins", 64)), seed=int(p.get("random_state", 42)), weightCol=weight)
    if name == "DecisionTreeClassifier":
        return CountedTree(impurity="gini", **common)
    if name == "RandomForestClassifier":
        return RandomForestClassifier(numTrees=int(p.get("n_estimators", 100)), featureSubsetStrategy="sqrt",
                                      impurity="gini", **common)
    raise NotImplementedError(f"model not implemented: {name}")


def preprocessing_stages(cfg: PrepConfig) -> list:
    """The preprocessing chain (numeric first in the assembled vector)."""
    stages = []
    if cfg.num_cols:
        stages.append(numeric_prep(cfg))
    if cfg.cat_cols:
        stages += [category_prep(cfg), one_hot(cfg)]
    return stages + [assembler(cfg), ClassWeights(labelCol=cfg.label, outputCol="weight", mode=cfg.class_weight)]


def numeric_prep(cfg: PrepConfig) -> NumericPrep:
    return NumericPrep(inputCols=list(cfg.num_cols), outlier=cfg.outlier, pmin=cfg.pmin, pmax=cfg.pmax, impute=cfg.num_impute, scaling=cfg.scaling)


def category_prep(cfg: PrepConfig) -> CategoryPrep:
    cat = list(cfg.cat_cols)
    return CategoryPrep(inputCols=cat, outputCols=[f"{c}__idx" for c in cat], impute=cfg.cat_impute, fill=cfg.cat_fill,
                        grouping={c: int(n) for c, n in cfg.grouping.items() if c in cat}, other=cfg.other_label)


def one_hot(cfg: PrepConfig) -> OneHotEncoder:
    # the indexes count the unknown one last, so dropLast removes exactly that slot: an unseen
    # value encodes as all zeros
    cat = list(cfg.cat_cols)
    return OneHotEncoder(inputCols=[f"{c}__idx" for c in cat], outputCols=[f"{c}__oh" for c in cat], dropLast=True, handleInvalid="error")


def assembler(cfg: PrepConfig) -> VectorAssembler:
    return VectorAssembler(inputCols=list(cfg.num_cols) + [f"{c}__oh" for c in cfg.cat_cols], outputCol="features", handleInvalid="keep")


def build_pipeline(cfg: PrepConfig, model: str | None = None, model_params: dict | None = None) -> Pipeline:
    """Preprocessing plus (optionally) a classifier chosen by name; unknown names raise."""
    stages = preprocessing_stages(cfg)
    if model:
        stages.append(build_classifier(model, model_params, label=cfg.label))
    return Pipeline(stages=stages)


def score_frame(model, df: DataFrame, run: str, label: str = "label", key: str | None = None,
                threshold: float = 0.5) -> DataFrame:
    """(run, [key], label, score, prediction): probability of class 1 from a fitted
    pipeline; prediction = score >= threshold (#69)."""
    out = model.transform(df)
    score = vector_to_array("probability")[1]
    cols = [F.lit(run).alias("run")] + ([F.col(key)] if key else []) + [
        F.col(label).cast("long").alias("label"), score.alias("score")]
    return out.select(*cols).withColumn("prediction", (F.col("score") >= threshold).cast("long"))


def feature_array(model, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The assembled feature matrix as an array column (for audits and export)."""
    return model.transform(df).select(*(keep or []), vector_to_array("features").alias("features"))


def missing_cells(model, df: DataFrame) -> DataFrame:
    """(n_missing): NULL or NaN cells in the assembled feature matrix (#47)."""
    arr = vector_to_array("features")
    bad = F.aggregate(arr, F.lit(0), lambda acc, x: acc + F.when(F.isnan(x) | x.isNull(), 1).otherwise(0))
    return model.transform(df).agg(F.coalesce(F.sum(bad), F.lit(0)).cast("bigint").alias("n_missing"))
