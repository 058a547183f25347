"""Chain stages (#63): the numeric and the categorical preprocessing as one stage each.

``NumericPrep`` fits clip, fill and scale from one call of the rank kernel
(:mod:`tablesmith.ml.statistics`) instead of a pass chain per stage; ``CategoryPrep`` maps each
raw value to the index of its filled and grouped form by one lookup per column. Their models are
made by the search as well, from statistics that all folds and candidates share.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
                             MLWritable, MLWriter)
from pyspark.sql import functions as F

from tablesmith.functions.columns import q
from tablesmith.functions.lookup import looked_up
from tablesmith.ml.stages import ImputerModel, ScalerModel, WinsorizerModel
from tablesmith.ml.statistics import CategoryChain, CategoryStatistics, FittedNumeric, NumericChain, NumericStatistics


def _identity(x):
    return x


class NumericPrep(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Clip, fill and scale numeric columns (the parameters of :class:`NumericChain`)."""
    outlier = Param(Params._dummy(), "outlier", "clip or none", typeConverter=TypeConverters.toString)
    pmin = Param(Params._dummy(), "pmin", "lower quantile", typeConverter=TypeConverters.toFloat)
    pmax = Param(Params._dummy(), "pmax", "upper quantile", typeConverter=TypeConverters.toFloat)
    impute = Param(Params._dummy(), "impute", "median or mean", typeConverter=TypeConverters.toString)
    scaling = Param(Params._dummy(), "scaling", "standard, minmax, robust or none", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, outlier="clip", pmin=0.01, pmax=0.99, impute="median", scaling="standard"):
        super().__init__()
        self._setDefault(outlier="clip", pmin=0.01, pmax=0.99, impute="median", scaling="standard")
        self._set(**self._input_kwargs)

    def chain(self) -> NumericChain:
        return NumericChain(*[self.getOrDefault(p) for p in (self.outlier, self.pmin, self.pmax, self.impute, self.scaling)])

    def _fit(self, df):
        cols = list(self.getOrDefault(self.inputCols))
        chain = self.chain()
        return NumericPrepModel.of(cols, NumericStatistics(df, cols, [chain]).fitted.get((chain, None), FittedNumeric()))


class NumericPrepModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    values = Param(Params._dummy(), "values", "limits, fills and scales by column", typeConverter=_identity)

    @keyword_only
    def __init__(self, inputCols=None, values=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def of(cls, cols: list[str], fitted: FittedNumeric) -> NumericPrepModel:
        return cls(inputCols=cols, values={"limits": fitted.limits, "fills": fitted.fills, "scales": fitted.scales})

    def _transform(self, df):
        v, cols = self.getOrDefault(self.values), list(self.getOrDefault(self.inputCols))
        for model in (WinsorizerModel(inputCols=cols, values=v["limits"]), ImputerModel(inputCols=cols, values=v["fills"]),
                      ScalerModel(inputCols=cols, values=v["scales"])):
            df = model.transform(df)
        return df


class CategoryPrep(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fill, group and index categorical columns (the parameters of :class:`CategoryChain`).

    The indexes follow the order of the outputs' text; an unseen value has the index of ``other``
    where its column is grouped and training had such values, else the index after the last.
    The output columns say how many indexes there are, so a one-hot encoder needs no pass."""
    impute = Param(Params._dummy(), "impute", "most_frequent, constant or none", typeConverter=TypeConverters.toString)
    fill = Param(Params._dummy(), "fill", "constant fill", typeConverter=TypeConverters.toString)
    grouping = Param(Params._dummy(), "grouping", "least count by grouped column", typeConverter=_identity)
    other = Param(Params._dummy(), "other", "label of rare values", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, impute="most_frequent", fill="Missing", grouping=None, other="Other"):
        super().__init__()
        self._setDefault(impute="most_frequent", fill="Missing", grouping={}, other="Other")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def chain(self) -> CategoryChain:
        grouping = tuple(sorted((c, int(n)) for c, n in self.getOrDefault(self.grouping).items()))
        return CategoryChain(self.getOrDefault(self.impute), self.getOrDefault(self.fill), grouping, self.getOrDefault(self.other))

    def _fit(self, df):
        cols, chain = list(self.getOrDefault(self.inputCols)), self.chain()
        return CategoryPrepModel.of(cols, list(self.getOrDefault(self.outputCols)), CategoryStatistics(df, cols, [chain]).dictionary(chain))


class _CategoryWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path):
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.table.write.parquet(f"{path}/dictionary")


class _CategoryReader(MLReader):
    def load(self, path):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = CategoryPrepModel()
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        model.table = self.sparkSession.read.schema(CategoryPrepModel.SCHEMA).parquet(f"{path}/dictionary")
        return model


class CategoryPrepModel(Model, HasInputCols, HasOutputCols, MLWritable, MLReadable):
    """``table`` is the dictionary (column, value, n, output, index), of any size, saved with the
    model; the params hold numbers per column only."""
    SCHEMA = "column string, value string, n bigint, output string, index double"
    sizes = Param(Params._dummy(), "sizes", "entries, outputs, others and nulls by column", typeConverter=_identity)

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, sizes=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self.table = None

    @classmethod
    def of(cls, cols: list[str], outs: list[str], found: dict) -> CategoryPrepModel:
        model = cls(inputCols=cols, outputCols=outs, sizes={k: found[k] for k in ("entries", "outputs", "others", "nulls")})
        model.table = found["table"]
        return model

    def write(self):
        return _CategoryWriter(self)

    @classmethod
    def read(cls):
        return _CategoryReader()

    def _transform(self, df):
        sizes = self.getOrDefault(self.sizes)
        outs = dict(zip(self.getOrDefault(self.inputCols), self.getOrDefault(self.outputCols), strict=True))
        df = looked_up(df, list(outs), self.table, sizes["entries"], "index", outs)
        for c, out in outs.items():
            unknown = float(sizes["outputs"][c])
            unseen = unknown if sizes["others"][c] is None else sizes["others"][c]
            null = sizes["nulls"][c]
            index = F.when(F.col(q(c)).isNull(), F.lit(unseen if null is None else null)).otherwise(F.coalesce(F.col(q(out)), F.lit(unseen)))
            # a nominal attribute with the unknown index last
            df = df.withColumn(out, index.alias(out, metadata={"ml_attr": {"type": "nominal", "num_vals": int(max(unknown, 1)) + 1}}))
        return df
