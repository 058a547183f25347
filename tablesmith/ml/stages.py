"""Preprocessing stages (#54-#62) as pyspark.ml Estimator/Model pairs.

Fitting runs one aggregation (or the exact quantile kernel). A value per column is kept in
the model's params; the grouper's kept categories are a table of any size that is saved with
the model. Transforms are column expressions, and a join for the grouper.
MLlib's own Imputer/StandardScaler/MinMaxScaler/RobustScaler differ from the wanted
semantics (approximate median, sample std, constant -> 0.5, approximate IQR), hence these.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions.columns import clip_keep_null, q
from tablesmith.functions.lookup import entries, looked_up
from tablesmith.functions.ranking import quantiles_long
from tablesmith.operators.frequency import freq_table
from tablesmith.session import stored

def _identity(x):
    return x


class _Base(HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    def _cols(self):
        return list(self.getOrDefault(self.inputCols))


class _FittedValues(Params):
    values = Param(Params._dummy(), "values", "fitted state per column (JSON-able)", typeConverter=_identity)

    def getValues(self):
        return self.getOrDefault(self.values)


# ---------------------------------------------------------------- winsorizer (#54)
class Winsorizer(Estimator, _Base):
    """Clip numeric columns at exact train quantiles ``pmin``/``pmax``; NULL stays NULL.
    ``strategy='none'`` keeps the values (the stage is always present so grids can
    address it)."""
    strategy = Param(Params._dummy(), "strategy", "clip or none", typeConverter=TypeConverters.toString)
    pmin = Param(Params._dummy(), "pmin", "lower quantile", typeConverter=TypeConverters.toFloat)
    pmax = Param(Params._dummy(), "pmax", "upper quantile", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, inputCols=None, strategy="clip", pmin=0.01, pmax=0.99):
        super().__init__()
        self._setDefault(strategy="clip", pmin=0.01, pmax=0.99)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        cols = self._cols()
        strategy = self.getOrDefault(self.strategy)
        limits = {}
        if strategy == "clip" and cols:
            lo, hi = self.getOrDefault(self.pmin), self.getOrDefault(self.pmax)
            for r in quantiles_long(df, cols, sorted({lo, hi})).collect():
                limits.setdefault(r["column"], {})[r["p"]] = r["q"]
            limits = {c: [v.get(lo), v.get(hi)] for c, v in limits.items()}
        elif strategy not in ("clip", "none"):
            raise ValueError(f"unknown outlier strategy {strategy}")
        return WinsorizerModel(inputCols=cols, values=limits)


class WinsorizerModel(Model, _Base, _FittedValues):
    @keyword_only
    def __init__(self, inputCols=None, values=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        lim = self.getValues() or {}
        return df.withColumns({c: clip_keep_null(F.col(q(c)), F.lit(lo), F.lit(hi))
                               for c, (lo, hi) in lim.items() if lo is not None})


# ---------------------------------------------------------------- numeric imputer (#55)
class NumericImputer(Estimator, _Base):
    """Fill NULLs with the exact train median or mean."""
    strategy = Param(Params._dummy(), "strategy", "median or mean", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, strategy="median"):
        super().__init__()
        self._setDefault(strategy="median")
        self._set(**self._input_kwargs)

    def _fit(self, df):
        cols = self._cols()
        s = self.getOrDefault(self.strategy)
        if s == "median":
            vals = {r["column"]: r["q"] for r in quantiles_long(df, cols, [0.5]).collect()}
        elif s == "mean":
            row = df.agg(*[F.avg(F.col(q(c)).cast("double")).alias(c) for c in cols]).first()
            vals = {c: row[c] for c in cols}
        else:
            raise ValueError(f"unknown numeric imputation {s}")
        return ImputerModel(inputCols=cols, values=vals)


class ImputerModel(Model, _Base, _FittedValues):
    @keyword_only
    def __init__(self, inputCols=None, values=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        vals = self.getValues() or {}
        return df.withColumns({c: F.coalesce(F.col(q(c)), F.lit(v)) for c, v in vals.items() if v is not None})


# ---------------------------------------------------------------- categorical imputer (#56, #57)
class CategoricalImputer(Estimator, _Base):
    """Fill NULLs with the most frequent train value (ties to the smallest) or a constant."""
    strategy = Param(Params._dummy(), "strategy", "most_frequent or constant", typeConverter=TypeConverters.toString)
    fillValue = Param(Params._dummy(), "fillValue", "constant fill", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, strategy="most_frequent", fillValue="Missing"):
        super().__init__()
        self._setDefault(strategy="most_frequent", fillValue="Missing")
        self._set(**self._input_kwargs)

    def _fit(self, df):
        cols = self._cols()
        s = self.getOrDefault(self.strategy)
        if s == "constant":
            vals = {c: self.getOrDefault(self.fillValue) for c in cols}
        elif s == "most_frequent":
            rows = (freq_table(df, cols).groupBy("column")
                    .agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")).collect())
            vals = {r["column"]: r["mode"] for r in rows}
        else:
            raise ValueError(f"unknown categorical imputation {s}")
        return ImputerModel(inputCols=cols, values=vals)


# ---------------------------------------------------------------- category grouper (#58)
class CategoryGrouper(Estimator, _Base):
    """Keep the categories seen at least ``minFreq`` times in train (per column through
    ``minFreqs``); everything else, unseen values included, becomes ``otherLabel``.

    The kept set is a table (column, value, n) of any size: the transform looks values up in it
    without shuffling the rows that hold its frequent ones; a saved model carries the table in its
    own folder."""
    minFreq = Param(Params._dummy(), "minFreq", "default threshold", typeConverter=TypeConverters.toInt)
    minFreqs = Param(Params._dummy(), "minFreqs", "threshold per column", typeConverter=_identity)
    otherLabel = Param(Params._dummy(), "otherLabel", "label of folded values", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, minFreq=10, minFreqs=None, otherLabel="Other"):
        super().__init__()
        self._setDefault(minFreq=10, minFreqs={}, otherLabel="Other")
        self._set(**self._input_kwargs)

    def _fit(self, df):
        cols = self._cols()
        per = dict(self.getOrDefault(self.minFreqs) or {})
        default = self.getOrDefault(self.minFreq)
        spark = df.sparkSession
        th = spark.createDataFrame([(c, int(per.get(c, default))) for c in cols], "column string, min_freq int")
        kept = (freq_table(df, cols).join(F.broadcast(th), "column").where(F.col("n") >= F.col("min_freq"))
                .select("column", "value", "n"))
        model = CategoryGrouperModel(inputCols=cols, otherLabel=self.getOrDefault(self.otherLabel))
        model.set_kept(stored(kept, "kept"))
        return model


class _GrouperWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path):
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.kept.write.parquet(f"{path}/kept")


class _GrouperReader(MLReader):
    def load(self, path):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = CategoryGrouperModel()
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        model.set_kept(self.sparkSession.read.schema("column string, value string, n bigint").parquet(f"{path}/kept"))
        return model


class CategoryGrouperModel(Model, HasInputCols, MLWritable, MLReadable):
    """``kept`` is the table (column, value, n) of the categories that stay."""
    otherLabel = Param(Params._dummy(), "otherLabel", "label of folded values", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, otherLabel="Other"):
        super().__init__()
        self._setDefault(otherLabel="Other")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self.kept = self.sizes = None

    def set_kept(self, kept: DataFrame) -> None:
        self.kept, self.sizes = kept, entries(kept)

    def write(self):
        return _GrouperWriter(self)

    @classmethod
    def read(cls):
        return _GrouperReader()

    def _transform(self, df):
        other = F.lit(self.getOrDefault(self.otherLabel))
        cols = self.getOrDefault(self.inputCols)
        hits = {c: f"__kept_{i}" for i, c in enumerate(cols)}
        out = looked_up(df, cols, self.kept, self.sizes, "value", hits)
        return out.withColumns({c: F.when(F.col(h).isNotNull(), F.col(q(c)).cast("string")).otherwise(other) for c, h in hits.items()}).drop(*hits.values())


# ---------------------------------------------------------------- scalers (#59-#61)
class NumericScaler(Estimator, _Base):
    """``standard``: (x - mean) / population std; ``minmax``: (x - min) / (max - min);
    ``robust``: (x - median) / IQR (exact quantiles); a zero scale is replaced by 1;
    ``none``: identity."""
    method = Param(Params._dummy(), "method", "standard, minmax, robust or none", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, method="standard"):
        super().__init__()
        self._setDefault(method="standard")
        self._set(**self._input_kwargs)

    def _fit(self, df):
        cols = self._cols()
        m = self.getOrDefault(self.method)
        vals = {}
        if m == "standard":
            row = df.agg(*[F.avg(F.col(q(c)).cast("double")).alias(f"{c}__c") for c in cols],
                         *[F.stddev_pop(F.col(q(c)).cast("double")).alias(f"{c}__s") for c in cols]).first()
            vals = {c: [row[f"{c}__c"], row[f"{c}__s"]] for c in cols}
        elif m == "minmax":
            row = df.agg(*[F.min(F.col(q(c)).cast("double")).alias(f"{c}__c") for c in cols],
                         *[F.max(F.col(q(c)).cast("double")).alias(f"{c}__m") for c in cols]).first()
            vals = {c: [row[f"{c}__c"], None if row[f"{c}__c"] is None else row[f"{c}__m"] - row[f"{c}__c"]]
                    for c in cols}
        elif m == "robust":
            qs = {}
            for r in quantiles_long(df, cols, [0.25, 0.5, 0.75]).collect():
                qs.setdefault(r["column"], {})[r["p"]] = r["q"]
            vals = {c: [v[0.5], v[0.75] - v[0.25]] for c, v in qs.items()}
        elif m != "none":
            raise ValueError(f"unknown scaling {m}")
        return ScalerModel(inputCols=cols, values={c: [a, (s if s not in (None, 0, 0.0) else 1.0)]
                                                   for c, (a, s) in vals.items()})


class ScalerModel(Model, _Base, _FittedValues):
    @keyword_only
    def __init__(self, inputCols=None, values=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        vals = self.getValues() or {}
        return df.withColumns({c: (F.col(q(c)).cast("double") - F.lit(a)) / F.lit(s)
                               for c, (a, s) in vals.items() if a is not None})


# ---------------------------------------------------------------- class weights (#68)
class ClassWeights(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Per-row weight from the label: ``none`` (1), ``balanced`` (n / (k * n_class)) or
    an explicit {class: weight} map."""
    labelCol = Param(Params._dummy(), "labelCol", "label", typeConverter=TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "weight column", typeConverter=TypeConverters.toString)
    mode = Param(Params._dummy(), "mode", "none, balanced or a dict", typeConverter=_identity)

    @keyword_only
    def __init__(self, labelCol="label", outputCol="weight", mode="none"):
        super().__init__()
        self._setDefault(labelCol="label", outputCol="weight", mode="none")
        self._set(**self._input_kwargs)

    def _fit(self, df):
        mode = self.getOrDefault(self.mode)
        label = self.getOrDefault(self.labelCol)
        out = self.getOrDefault(self.outputCol)
        if mode in (None, "none"):
            return ClassWeightsModel(labelCol=label, outputCol=out, values={})
        if mode != "balanced" and not isinstance(mode, dict):
            raise ValueError(f"unknown class weight {mode}")
        rows = df.where(F.col(q(label)).isNotNull()).groupBy(q(label)).agg(F.count(F.lit(1)).alias("n")).collect()
        return ClassWeightsModel(labelCol=label, outputCol=out, values=class_weights(mode, {r[label]: r["n"] for r in rows}, df.schema[label].dataType))


def class_weights(mode, counts: dict, dtype) -> dict:
    """Weight by class from the classes' counts (no weights: 1 for all)."""
    if mode in (None, "none"):
        return {}
    key = _class_key(dtype)
    counts = {key(c): n for c, n in counts.items()}
    if mode == "balanced":
        n, k = sum(counts.values()), len(counts)
        return {c: n / (k * m) for c, m in counts.items()}
    w = {key(c): float(v) for c, v in mode.items()}
    if set(counts) - set(w):
        raise ValueError(f"no weight for class {sorted(set(counts) - set(w))}")
    return w


def _class_key(dtype):
    """Classes compare as numbers on a numeric label (1, 1.0 and "1" are one class)."""
    return (lambda c: repr(float(c))) if isinstance(dtype, T.NumericType) else str


class ClassWeightsModel(Model, DefaultParamsReadable, DefaultParamsWritable, _FittedValues):
    """Weight of each row's class; a class that was not in training has weight 1."""
    labelCol = Param(Params._dummy(), "labelCol", "label", typeConverter=TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "weight column", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, labelCol="label", outputCol="weight", values=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        w = self.getValues() or {}
        out, label = self.getOrDefault(self.outputCol), self.getOrDefault(self.labelCol)
        if not w:
            return df.withColumn(out, F.lit(1.0))
        numeric = isinstance(df.schema[label].dataType, T.NumericType)
        m = F.create_map(*[x for k, v in w.items() for x in (F.lit(float(k) if numeric else k), F.lit(float(v)))])
        lab = F.col(q(label)).cast("double" if numeric else "string")
        return df.withColumn(out, F.coalesce(F.try_element_at(m, lab), F.lit(1.0)))
