"""Exploratory aggregates (#26-#36): the data behind every chart, as tables.

All per-column statistics run on the long (column, x) form so one shuffle serves every
column; the small per-column tables joined back (ranges, fences) have one row per column
and are broadcast by construction.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesmith.functions.columns import q
from tablesmith.functions.ranking import quantiles_long, to_long_numeric, top_k
from tablesmith.operators.frequency import freq_table
from tablesmith.session import stored


def _ranges(long_df: DataFrame) -> DataFrame:
    return long_df.groupBy("column").agg(F.min("x").alias("lo"), F.max("x").alias("hi"),
                                         F.count(F.lit(1)).alias("n_obs"))


def _bin_index(x, lo, hi, nbins):
    """Equal-width bin of x in [lo, hi]; the maximum goes into the last bin, a zero-width
    range into bin 0."""
    return F.when(hi > lo, F.least(F.floor((x - lo) / (hi - lo) * nbins), nbins - 1)).otherwise(F.lit(0)).cast("long")


def _auto_quantiles(df: DataFrame, cols: list[str]) -> dict:
    """{(column, p): (quantile, n)} of the range and the quartiles of each column with values."""
    return {(r["column"], r["p"]): (r["q"], r["n"]) for r in quantiles_long(df, cols, [0.0, 0.25, 0.75, 1.0]).collect()}


def auto_bins(df: DataFrame, cols: list[str], qs: dict | None = None) -> dict:
    """numpy's 'auto' rule per column: the smaller of the Sturges and Freedman-Diaconis
    widths (Sturges alone when the IQR is 0), as a number of bins."""
    qs = _auto_quantiles(df, cols) if qs is None else qs
    out = {}
    for c in cols:
        if (c, 0.0) not in qs:
            out[c] = 1
            continue
        lo, n = qs[(c, 0.0)]
        hi = qs[(c, 1.0)][0]
        rng = hi - lo
        if rng <= 0:
            out[c] = 1
            continue
        sturges = rng / (math.log2(n) + 1.0)
        iqr = qs[(c, 0.75)][0] - qs[(c, 0.25)][0]
        fd = 2.0 * iqr * n ** (-1.0 / 3.0)
        width = min(fd, sturges) if fd > 0 else sturges
        out[c] = max(1, int(math.ceil(rng / width)))
    return out


def histogram(df: DataFrame, cols: list[str], bins: int | str | dict = 10) -> DataFrame:
    """(column, bin, bin_lo, bin_hi, n). ``bins`` is a count or a per-column dict, and then
    empty bins are present; or 'auto', whose number of bins can exceed any bound on a
    heavy-tailed column, and then only occupied bins are rows (at most one per value)."""
    spark = df.sparkSession
    auto = bins == "auto"
    long_df = to_long_numeric(df, cols)
    if auto:
        # the quantiles have read the range already
        qs = _auto_quantiles(df, cols)
        per_col = auto_bins(df, cols, qs)
        rng = spark.createDataFrame([(c, qs[(c, 0.0)][0], qs[(c, 1.0)][0], int(per_col[c])) for c in cols if (c, 0.0) in qs],
                                    "column string, lo double, hi double, nbins long")
    else:
        per_col = bins if isinstance(bins, dict) else {c: int(bins) for c in cols}
        nb = spark.createDataFrame([(c, int(per_col[c])) for c in cols], "column string, nbins long")
        rng = _ranges(long_df).join(F.broadcast(nb), "column")
    binned = long_df.join(F.broadcast(rng), "column").withColumn(
        "bin", _bin_index(F.col("x"), F.col("lo"), F.col("hi"), F.col("nbins")))
    counts = binned.groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))
    width = (F.col("hi") - F.col("lo")) / F.col("nbins")
    if auto:
        rows = counts.join(F.broadcast(rng), "column")
    else:
        grid = rng.select("column", "lo", "hi", "nbins", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nbins") - 1)).alias("bin"))
        rows = grid.join(counts, ["column", "bin"], "left")
    return rows.select("column", "bin", (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                       (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                       F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


# Parameters of the density: cells per bandwidth, and how many bandwidths a cell reaches.
KDE_CELLS, KDE_REACH = 16, 8


def kde(df: DataFrame, cols: list[str], grid: int = 200, cut: float = 0.0) -> DataFrame:
    """(column, point, x, density): Gaussian kernel density per column on ``grid`` points from
    min - cut*bw to max + cut*bw (the range of the data by default, as a histogram overlay
    has it), Scott's bandwidth ``std * n**(-1/5)``.

    One pass counts the rows in cells of a sixteenth of the bandwidth, whatever the range, and
    keeps each cell's mean and variance; only occupied cells exist. Each is then spread to the
    grid points within eight bandwidths, with the second-order term of its variance, so the
    result is that of the rows to about 1e-8 of the kernel's height."""
    long_df = to_long_numeric(df, cols)
    st = long_df.groupBy("column").agg(F.min("x").alias("lo"), F.max("x").alias("hi"),
                                       F.count(F.lit(1)).alias("n_obs"), F.stddev_samp("x").alias("sd"))
    st = st.withColumn("bw", F.col("sd") * F.pow(F.col("n_obs").cast("double"), F.lit(-0.2))).where(F.col("bw") > 0)
    st = st.withColumn("g0", F.col("lo") - F.lit(cut) * F.col("bw"))
    st = st.withColumn("step", (F.col("hi") - F.col("lo") + F.lit(2 * cut) * F.col("bw")) / F.lit(grid - 1))
    cell = F.floor((F.col("x") - F.col("lo")) / F.col("bw") * F.lit(float(KDE_CELLS)))
    cells = (long_df.join(F.broadcast(st.select("column", "lo", "bw")), "column").groupBy("column", cell.alias("cell"))
             .agg(F.count(F.lit(1)).alias("c"), F.avg("x").alias("m"), F.var_pop("x").alias("v")).join(F.broadcast(st), "column"))
    at = lambda side: (F.col("m") + side * KDE_REACH * F.col("bw") - F.col("g0")) / F.col("step")
    first, last = F.greatest(F.ceil(at(-1)), F.lit(0)), F.least(F.floor(at(1)), F.lit(grid - 1))
    reach = cells.where(first <= last).select("column", "c", "m", "v", "bw", "g0", "step", F.explode(F.sequence(first, last)).alias("point"))
    z = (F.col("g0") + F.col("point") * F.col("step") - F.col("m")) / F.col("bw")
    share = F.col("c") * F.exp(F.lit(-0.5) * z * z) * (1 + (z * z - 1) * F.col("v") / (2 * F.col("bw") * F.col("bw")))
    mass = reach.groupBy("column", "point").agg(F.sum(share).alias("mass"))
    points = st.select("column", "n_obs", "bw", "g0", "step", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(grid - 1).cast("long"))).alias("point"))
    height = F.col("n_obs") * F.col("bw") * F.lit(math.sqrt(2 * math.pi))
    return points.join(mass, ["column", "point"], "left").select(
        "column", F.col("point").cast("int").alias("point"), (F.col("g0") + F.col("point") * F.col("step")).alias("x"),
        (F.coalesce("mass", F.lit(0.0)) / height).alias("density"))


def box_stats(df: DataFrame, cols: list[str], by: list[str] | None = None, whis: float = 1.5,
              accuracy: int | None = None) -> DataFrame:
    """(by..., column, q1, median, q3, iqr, whisker_lo, whisker_hi, n_outliers): whiskers
    are the furthest points within ``whis`` IQR of the box. Exact quartiles unless
    ``accuracy`` is given (one ``percentile_approx`` pass)."""
    by = list(by or [])
    src = df
    for b in by:
        src = src.where(F.col(q(b)).isNotNull())
    qs = quantiles_long(src, cols, [0.25, 0.5, 0.75], by, accuracy=accuracy)
    keys = by + ["column"]
    box = qs.groupBy(*[q(k) for k in keys]).agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3"))
    box = box.withColumn("iqr", F.col("q3") - F.col("q1"))
    box = box.withColumn("lo_f", F.col("q1") - whis * F.col("iqr")).withColumn("hi_f", F.col("q3") + whis * F.col("iqr"))
    # stored, so that the planner knows its size and doesn't shuffle every value to join a few fences
    box = stored(box, "boxes")
    long_df = to_long_numeric(src, cols, by)
    x = F.col("x")
    agg = (long_df.join(box.select(*[q(k) for k in keys], "lo_f", "hi_f"), keys)
           .groupBy(*[q(k) for k in keys])
           .agg(F.min(F.when(x >= F.col("lo_f"), x)).alias("whisker_lo"),
                F.max(F.when(x <= F.col("hi_f"), x)).alias("whisker_hi"),
                F.count_if((x < F.col("lo_f")) | (x > F.col("hi_f"))).cast("bigint").alias("n_outliers")))
    return box.join(agg, keys).select(*[q(k) for k in keys], "q1", "median", "q3", "iqr", "whisker_lo",
                                      "whisker_hi", "n_outliers")


def category_distribution(df: DataFrame, cols: list[str], min_freq: int = 10, other: str = "Other") -> DataFrame:
    """(column, value, n) after folding values seen fewer than ``min_freq`` times into
    ``other``: a second group-by on the frequency table, not a second pass over rows."""
    fr = freq_table(df, cols)
    folded = F.when(F.col("n") < min_freq, F.lit(other)).otherwise(F.col("value"))
    return fr.groupBy("column", folded.alias("value")).agg(F.sum("n").cast("bigint").alias("n"))


def crosstab_normalized(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """(column, value, label, n, share): class shares within each category (rows sum to
    1); pairs with a NULL side are dropped. The window runs over the aggregated cross
    table, partitioned by (column, value)."""
    src = df.where(F.col(q(target)).isNotNull()).withColumnRenamed(target, "__label")
    cross = freq_table(src, cols, by=["__label"])
    w = Window.partitionBy("column", "value")
    return cross.select("column", "value", F.col("__label").alias("label"), F.col("n").cast("bigint").alias("n"),
                        (F.col("n") / F.sum("n").over(w)).alias("share"))


def crosstab_wide(df: DataFrame, col: str, target: str, classes: list) -> DataFrame:
    """Wide form of one cross table: a share column per class, 0 where absent."""
    long_df = crosstab_normalized(df, [col], target)
    return (long_df.groupBy("value").pivot("label", classes).agg(F.first("share"))
            .fillna(0.0))


# Parameter: numbers in which a variance counts as rounding of a constant column's mean.
ROUNDING = 1e-13


def _gram(centres: list[float]):
    """A batch function: the blocks X'X, X'M, (X*X)'M and M'M of a task's rows, where X are the
    centred values (0 where NULL) and M says where there is one. k * k rows a task."""
    def visit(batches):
        k = len(centres)
        sums = np.zeros((4, k, k))
        centre = np.array(centres)
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]) - centre
            m = ~np.isnan(x)
            x, m = np.where(m, x, 0.0), m.astype(np.float64)
            sums += np.stack([x.T @ x, x.T @ m, (x * x).T @ m, m.T @ m])
        at = np.indices((k, k)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), *[pa.array(s.reshape(-1)) for s in sums]],
                                         names=["i", "j", "xx", "xm", "qm", "n"])
    return visit


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """(col_a, col_b, r): Pearson on pairwise-complete rows, full symmetric matrix. NaN counts as
    missing; a constant column gives NULL (zero variance), not a division error.

    Two passes whatever the number k of columns: the first finds a centre per column (centring
    keeps the one-pass formula accurate), the second multiplies blocks of rows: values by values,
    values and squares by masks, and masks by masks give every pair's sums over the rows that
    have both. A task holds 4 k^2 numbers and one batch, and its k^2 rows are added by (i, j)."""
    k = len(cols)
    xs = [F.when(~F.isnan(F.col(q(c)).cast("double")), F.col(q(c)).cast("double")) for c in cols]
    first = df.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)]).first() if k else []
    centres = [float(m) if m is not None else 0.0 for m in first]
    blocks = df.select(*[x.alias(f"x{i}") for i, x in enumerate(xs)]).mapInArrow(
        _gram(centres), "i int, j int, xx double, xm double, qm double, n double")
    sums = blocks.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("xx", "xm", "qm", "n")])
    a, b = sums.alias("a"), sums.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("xm").alias("ym"), F.col("qm").alias("rm")).alias("b")
    names = F.array(*[F.lit(c) for c in cols])
    centre = F.array(*[F.lit(c) for c in centres])
    var = lambda square, s: F.col(square) - F.col(s) * F.col(s) / F.col("n")
    real = lambda v, i: v > F.col("n") * F.pow(F.lit(ROUNDING) * F.get(centre, F.col(i)), F.lit(2))
    va, vb = var("qm", "xm"), var("rm", "ym")
    r = (F.col("xx") - F.col("xm") * F.col("ym") / F.col("n")) / F.sqrt(va * vb)
    pairs = a.join(b, ["i", "j"])
    return pairs.select(F.get(names, F.col("i")).alias("col_a"), F.get(names, F.col("j")).alias("col_b"),
                        F.when((F.col("n") > 0) & real(va, "i") & real(vb, "j"), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("r"))


def redundant_pairs(df: DataFrame, cols: list[str], threshold: float = 0.95) -> DataFrame:
    """(col_a, col_b, r) for pairs in column order (a before b) with |r| > threshold."""
    pos = {c: i for i, c in enumerate(cols)}
    cm = correlation_matrix(df, cols)
    order = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(pos[c]))])
    return cm.where((order[F.col("col_a")] < order[F.col("col_b")]) & (F.abs("r") > threshold))


def top_categories(df: DataFrame, cols: list[str], k: int = 10) -> DataFrame:
    """(column, rank, value, n): the k most frequent values per column, ties by value."""
    fr = freq_table(df, cols)
    return top_k(fr, ["column"], [F.col("n").desc(), F.col("value").asc()], k, tiebreak="value").select(
        "column", F.col("rank").cast("bigint").alias("rank"), "value", F.col("n").cast("bigint").alias("n"))

