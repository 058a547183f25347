"""Schema and profile (#8-#18).

Two jobs serve every statistic here: the numeric profile (one aggregate over all numeric
columns, one output row, reshaped to one row per column) and the frequency table
(:mod:`tablesmith.operators.frequency`). Quantiles come from the exact distributed
selection kernel in :mod:`tablesmith.functions.ranking`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions.columns import categorical_columns, numeric_columns, q
from tablesmith.functions.ranking import quantile_table, quantiles_long, sketch, to_long_numeric
from tablesmith.operators.frequency import freq_table
from tablesmith.session import stored

NUMERIC_STATS = ["n", "n_null", "n_negative", "min", "max", "mean", "std", "std_pop"]


def _columns_frame(spark: SparkSession, df: DataFrame, cols=None) -> DataFrame:
    """(column, dtype, position) of the schema: a table of at most #columns rows."""
    names = cols or df.columns
    rows = [(c, df.schema[c].dataType.simpleString(), i) for i, c in enumerate(names)]
    return spark.createDataFrame(rows, "column string, dtype string, position int")


def _long_from_row(wide: DataFrame, cols: list[str], stats: list[str], types: dict | None = None) -> DataFrame:
    """Reshape a one-row aggregate with columns ``{col}__{stat}`` to (column, stat...)."""
    types = types or {}
    structs = [F.struct(F.lit(c).alias("column"),
                        *[F.col(q(f"{c}__{s}")).cast(types.get(s, "double")).alias(s) for s in stats])
               for c in cols]
    return wide.select(F.inline(F.array(*structs)))


def numeric_profile(df: DataFrame, cols: list[str] | None = None, edges: bool = False) -> DataFrame:
    """One pass over the numeric columns: (column, n, n_null, n_negative, min, max, mean,
    std, std_pop). ``std`` is the sample deviation (ddof=1) as pandas reports it. ``edges`` adds
    a quantile sketch of each column (``functions.ranking.sketch``)."""
    cols = cols if cols is not None else numeric_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, " + ", ".join(
            f"{s} {'bigint' if s.startswith('n') else 'double'}" for s in NUMERIC_STATS) + (", edges array<double>" if edges else ""))
    aggs = []
    for c in cols:
        x = F.col(q(c)).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.count_if(x.isNull()).alias(f"{c}__n_null"),
                 F.count_if(x < 0).alias(f"{c}__n_negative"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), *([sketch(x).alias(f"{c}__edges")] if edges else [])]
    wide = df.agg(*aggs)
    # one central-moment aggregate per column: the population deviation follows from the
    # sample one (std_pop = std * sqrt((n - 1) / n); n = 1 gives 0)
    wide = wide.select("*", *[F.when(F.col(f"{c}__n") == 1, F.lit(0.0)).otherwise(
        F.col(f"{c}__std") * F.sqrt((F.col(f"{c}__n") - 1) / F.col(f"{c}__n"))).alias(f"{c}__std_pop")
        for c in cols])
    return _long_from_row(wide, cols, NUMERIC_STATS + (["edges"] if edges else []),
                          {"n": "bigint", "n_null": "bigint", "n_negative": "bigint", "edges": "array<double>"})


def schema_diff(df: DataFrame, expected: list[str], strict: bool = False) -> DataFrame:
    """(column, status, n_present): names present on both sides ('ok'), expected but absent
    ('missing') or present but not expected ('extra'), and the rows with a value (NULL for a
    missing column). Order is ignored. ``strict`` raises on a mismatch."""
    have, want = set(df.columns), set(expected)
    rows = [(c, "ok") for c in sorted(have & want)] + [(c, "missing") for c in sorted(want - have)] + [
        (c, "extra") for c in sorted(have - want)]
    if strict and (want - have or have - want):
        raise ValueError(f"schema mismatch: missing={sorted(want - have)} extra={sorted(have - want)}")
    status = df.sparkSession.createDataFrame(rows, "column string, status string")
    return status.join(present_counts(df), "column", "left")


def data_dictionary(df: DataFrame, target: str) -> DataFrame:
    """(name, type, role, notes, n_present): one row per column, role 'target' or 'feature',
    and the rows with a value."""
    rows = [(f.name, f.dataType.simpleString(), "target" if f.name == target else "feature", "")
            for f in df.schema.fields]
    names = df.sparkSession.createDataFrame(rows, "name string, type string, role string, notes string")
    return names.join(present_counts(df).withColumnRenamed("column", "name"), "name")


def table_shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_cols"))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, n_null) for every column, one aggregate."""
    cols = cols or df.columns
    wide = df.agg(*[F.count_if(F.col(q(c)).isNull()).alias(f"{c}__n_null") for c in cols])
    return _long_from_row(wide, cols, ["n_null"], {"n_null": "bigint"})


def typed_frequencies(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, b, d, s, n): how often each value of each column occurs, NULL included. A
    value stands in the field of its type family (integral as bigint, fractional as double,
    everything else as text; decimals as text and double), so numbers are hashed as numbers.
    One scan and one shuffle whatever the number of columns and types."""
    def parts(c):
        x, dt = F.col(q(c)), df.schema[c].dataType
        whole, frac = isinstance(dt, T.IntegralType), isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType))
        text = not whole and (not frac or isinstance(dt, T.DecimalType))
        no = lambda t: F.lit(None).cast(t)
        return F.struct(F.lit(c).alias("column"), (x.cast("bigint") if whole else no("bigint")).alias("b"),
                        (x.cast("double") if frac else no("double")).alias("d"), (x.cast("string") if text else no("string")).alias("s"))

    return df.select(F.inline(F.array(*[parts(c) for c in cols]))).groupBy("column", "b", "d", "s").agg(
        F.count(F.lit(1)).alias("n"))


_PRESENT = "b IS NOT NULL OR d IS NOT NULL OR s IS NOT NULL"


def present_counts(df: DataFrame) -> DataFrame:
    """(column, n_present): rows with a value, for every column in one aggregate."""
    wide = df.agg(*[F.count(F.col(q(c))).alias(f"{c}__n_present") for c in df.columns])
    return _long_from_row(wide, df.columns, ["n_present"], {"n_present": "bigint"})


def unique_counts(df: DataFrame, cols: list[str] | None = None, rsd: float | None = None) -> DataFrame:
    """(column, n_unique): distinct non-NULL values per column, exact by default; with
    ``rsd`` the count is HyperLogLog (``approx_count_distinct``) in a single aggregate, no
    shuffle of values at all."""
    cols = cols or df.columns
    if rsd is not None:
        wide = df.agg(*[F.approx_count_distinct(F.col(q(c)), rsd).alias(f"{c}__n_unique") for c in cols])
        return _long_from_row(wide, cols, ["n_unique"], {"n_unique": "bigint"})
    names = _columns_frame(df.sparkSession, df, cols).select("column")
    per = typed_frequencies(df, cols).groupBy("column").agg(F.count_if(F.expr(_PRESENT)).alias("n_unique"))
    return names.join(per, "column", "left").select("column", F.coalesce("n_unique", F.lit(0)).cast("bigint").alias("n_unique"))


def min_max(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, min, max) over the numeric columns."""
    return numeric_profile(df, cols).select("column", "min", "max")


def describe_all(df: DataFrame, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """pandas ``describe(include='all')``: count/unique/top/freq for categorical columns,
    count/mean/std/min/quartiles/max for numeric ones, one row per column."""
    num = numeric_columns(df)
    cat = categorical_columns(df)
    parts = []
    if num:
        parts.append(describe_numerical(df, num, probs).withColumnRenamed("n", "count"))
    if cat:
        parts.append(describe_categorical(df, cat, k=1).select(
            "column", F.col("n").alias("count"), F.col("n_unique").alias("unique"),
            F.col("most_freq").alias("top"), F.col("freq_most_freq").alias("freq")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def describe_numerical(df: DataFrame, cols: list[str], probs=(0.25, 0.5, 0.75),
                       accuracy: int | None = None) -> DataFrame:
    """(column, n, mean, std, min, p25, p50, p75, max): exact interpolated quartiles.

    The one-pass profile also takes the sketches that the quantile kernel starts from, so the
    kernel adds only its counting pass.
    ``accuracy`` trades exactness for a single ``percentile_approx`` pass."""
    names = {float(p): "p" + format(round(p * 100, 4), "g").replace(".", "_") for p in probs}
    if accuracy is not None:
        prof, qs = numeric_profile(df, cols), quantiles_long(df, cols, list(names), accuracy=accuracy)
    else:
        prof = stored(numeric_profile(df, cols, edges=True), "profile")
        stats = prof.where("n > 0").select("column", F.col("n").alias("__n"), F.col("edges").alias("__edges"))
        qs = quantile_table(to_long_numeric(df, cols), ["column"], "x", list(names), stats=stats)
    wide = qs.groupBy("column").agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n) for p, n in names.items()])
    return prof.join(wide, "column", "left").select("column", "n", "mean", "std", "min", *names.values(), "max")


def describe_categorical(df: DataFrame, cols: list[str], k: int = 10) -> DataFrame:
    """(column, n, n_unique, most_freq, freq_most_freq, top_values): the mode is the most
    frequent value, ties to the smallest; ``top_values`` lists the k most frequent as
    'value:count' joined by '|'."""
    fr = freq_table(df, cols)
    agg = fr.groupBy("column").agg(
        F.sum("n").cast("bigint").alias("n"),
        F.count(F.lit(1)).cast("bigint").alias("n_unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("most_freq"),
        F.max("n").cast("bigint").alias("freq_most_freq"))
    from tablesmith.functions.ranking import top_k
    top = top_k(fr, ["column"], [F.col("n").desc(), F.col("value").asc()], k, tiebreak="value")
    tops = top.groupBy("column").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("rank", "value", "n"))),
        lambda s: F.concat(s["value"], F.lit(":"), s["n"].cast("string"))), "|").alias("top_values"))
    names = _columns_frame(df.sparkSession, df, cols).select("column")
    return (names.join(agg, "column", "left").join(tops, "column", "left")
            .select("column", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
                    F.coalesce("n_unique", F.lit(0)).cast("bigint").alias("n_unique"),
                    "most_freq", "freq_most_freq", "top_values"))


def quick_profile(df: DataFrame) -> DataFrame:
    """(column, dtype, n_rows, n_cols, n_null, n_unique, min, max): shape, NULLs, distincts
    and numeric range per column, all from the typed frequency table: one scan, one shuffle
    of distinct values."""
    cols = df.columns
    x = F.coalesce(F.col("b").cast("double"), F.col("d"))
    present = F.expr(_PRESENT)
    per = typed_frequencies(df, cols).groupBy("column").agg(
        F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("n_null"),
        F.count_if(present).alias("n_unique"), F.min(x).alias("min"), F.max(x).alias("max"))
    types = _columns_frame(df.sparkSession, df, cols).select("column", "dtype")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return types.join(per, "column", "left").select(
        "column", "dtype", zero("n_rows"), F.lit(len(cols)).cast("bigint").alias("n_cols"), zero("n_null"), zero("n_unique"),
        "min", "max")


def duplicate_count(df: DataFrame) -> DataFrame:
    """(n_rows, n_distinct, n_duplicates): rows that repeat an earlier row, NULLs equal.
    The group-by combines map-side, so a row repeated a billion times is one entry per task."""
    g = df.groupBy(*[q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__c"))
    return g.agg(F.sum("__c").cast("bigint").alias("n_rows"), F.count(F.lit(1)).cast("bigint").alias("n_distinct"),
                 F.sum(F.col("__c") - 1).cast("bigint").alias("n_duplicates"))


def missing_summary(df: DataFrame, target: str) -> DataFrame:
    """(column, n_null, total_nulls, nulls_in_target): per column, with the table total
    and the target's count repeated on every row (a window over one row per column)."""
    every = Window.partitionBy(F.lit(0))
    of_target = F.sum(F.when(F.col("column") == target, F.col("n_null"))).over(every)
    return null_counts(df).select("column", "n_null", F.sum("n_null").over(every).cast("bigint").alias("total_nulls"),
                                  F.coalesce(of_target, F.lit(0)).cast("bigint").alias("nulls_in_target"))
