"""Statistics of whole preprocessing chains, for all folds and candidates at once (#54-#63, #72).

A chain is clip -> fill -> scale for numeric columns and fill -> group -> index for categorical
ones. Each of its fitted values follows from a few tables of the training frame:

* order statistics of the raw columns. Clipping keeps order, so the value of a rank after
  clipping is the clipped value of that rank; filling z NULLs with the median shifts the ranks
  above it by z. Clip limits, medians and quartiles of every candidate come from one call of
  the rank kernel;
* mean and variance of the clipped values, one grouped pass for all clips;
* one frequency table (column, value, fold, n) for modes, rare values and dictionaries.

All of them subtract: the training side of fold f is the total without the rows of f. So the
number of scans of the training frame depends neither on the folds nor on the candidates.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions.columns import q
from tablesmith.functions.ranking import WITHOUT, key_stats, running_totals, select_ranks, to_long_numeric
from tablesmith.session import stored

QUARTILES = (0.25, 0.5, 0.75)


@dataclass(frozen=True)
class NumericChain:
    """Parameters of a numeric chain, in stage order."""
    outlier: str = "clip"
    pmin: float = 0.01
    pmax: float = 0.99
    impute: str = "median"
    scaling: str = "standard"

    def __post_init__(self):
        if self.outlier not in ("clip", "none"):
            raise ValueError(f"unknown outlier strategy {self.outlier}")
        if self.impute not in ("median", "mean"):
            raise ValueError(f"unknown numeric imputation {self.impute}")
        if self.scaling not in ("standard", "minmax", "robust", "none"):
            raise ValueError(f"unknown scaling {self.scaling}")
        if self.outlier == "clip" and not 0 <= self.pmin <= self.pmax <= 1:
            raise ValueError(f"clip quantiles {self.pmin} and {self.pmax}")

    @property
    def clip(self) -> tuple:
        return (float(self.pmin), float(self.pmax)) if self.outlier == "clip" else (None, None)


@dataclass(frozen=True)
class CategoryChain:
    """Parameters of a categorical chain. ``grouping`` holds (column, least count) pairs; with
    ``impute='none'`` NULL is an unseen value."""
    impute: str = "most_frequent"
    fill: str = "Missing"
    grouping: tuple = ()
    other: str = "Other"

    def __post_init__(self):
        if self.impute not in ("most_frequent", "constant", "none"):
            raise ValueError(f"unknown categorical imputation {self.impute}")


def _interpolated(at: dict, pos: float) -> float:
    lo, hi = at[math.floor(pos)], at[math.ceil(pos)]
    return lo if lo == hi else lo + (hi - lo) * (pos - math.floor(pos))


def _ends(pos: float) -> set[int]:
    return {math.floor(pos), math.ceil(pos)}


def _clipped(x: float, lo, hi) -> float:
    return x if lo is None else min(max(x, lo), hi)


@dataclass
class FittedNumeric:
    """Fitted values by column, in the form that the stages' models take."""
    limits: dict = field(default_factory=dict)
    fills: dict = field(default_factory=dict)
    scales: dict = field(default_factory=dict)


class NumericStatistics:
    """Fitted values of any number of numeric chains, for the whole frame (view None) and, with
    ``fold_col``, for the training side of every fold (view f: all rows but those of fold f)."""

    def __init__(self, df: DataFrame, cols: list[str], chains: list[NumericChain], fold_col: str | None = None):
        self.cols, self.chains, self.fold_col = list(cols), list(dict.fromkeys(chains)), fold_col
        self.df = df
        self.views: list = [None]
        self.fitted: dict = {}
        if cols and chains:
            self._fit()

    def _fit(self) -> None:
        df, fold = self.df, self.fold_col
        # rows and values by fold, in one aggregate: a row per fold reaches the driver
        counts = df.groupBy(*([q(fold)] if fold else [])).agg(
            F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(q(c))).alias(f"n{i}") for i, c in enumerate(self.cols)]).collect()
        if fold:
            self.views += sorted(r[fold] for r in counts if r[fold] is not None)
        inside = lambda view: [r for r in counts if view is None or r[fold] != view]
        self.n = {(c, w): sum(r[f"n{i}"] for r in inside(w)) for i, c in enumerate(self.cols) for w in self.views}
        self.z = {(c, w): sum(r["__rows"] for r in inside(w)) - self.n[c, w] for c in self.cols for w in self.views}
        self.long = to_long_numeric(df, self.cols, [fold] if fold else [])
        self.stats = key_stats(self.long, ["column"], "x")
        at = {}
        self._ranks(at, lambda c, w: set().union(*[self._first_ranks(chain, self.n[c, w], self.z[c, w]) for chain in self.chains]))
        limits = {}
        for lo, hi in dict.fromkeys(chain.clip for chain in self.chains):
            for key in at:
                last = self.n[key] - 1
                limits[(lo, hi), key] = (None, None) if lo is None else tuple(_interpolated(at[key], last * p) for p in (lo, hi))
        moments = self._moments(limits)
        fills = {}
        for chain in self.chains:
            for key in at:
                lim = limits[chain.clip, key]
                if chain.impute == "mean":
                    fills[chain.clip, "mean", key] = moments[chain.clip, key][0]
                else:
                    pos = (self.n[key] - 1) * 0.5
                    fills[chain.clip, "median", key] = _interpolated({k: _clipped(at[key][k], *lim) for k in _ends(pos)}, pos)
        below = self._below(limits, fills)
        self._ranks(at, lambda c, w: set().union(*[self._mean_ranks(chain, (c, w), below) for chain in self.chains]))
        for chain in self.chains:
            for w in self.views:
                self.fitted[chain, w] = self._values(chain, w, at, limits, fills, moments, below)

    # --- which ranks a chain asks for

    def _first_ranks(self, chain: NumericChain, n: int, z: int) -> set[int]:
        """Ranks known before any value is: limits, the median, the range, and quartiles unless a
        mean fills NULLs."""
        out = {0, n - 1}
        if chain.outlier == "clip":
            out |= _ends((n - 1) * chain.pmin) | _ends((n - 1) * chain.pmax)
        if chain.impute == "median":
            out |= _ends((n - 1) * 0.5)
        if chain.scaling == "robust" and (chain.impute == "median" or not z):
            out |= self._filled_ranks(n, z, math.floor((n - 1) * 0.5) + 1)
        return out

    def _mean_ranks(self, chain, key, below) -> set[int]:
        if chain.scaling != "robust" or chain.impute != "mean" or not self.z[key]:
            return set()
        return self._filled_ranks(self.n[key], self.z[key], below[chain.clip, key])

    @staticmethod
    def _raw(r: int, z: int, before: int) -> int | None:
        """The raw rank behind rank r after z fills stand behind the first ``before`` values."""
        return r if r < before else None if r < before + z else r - z

    def _filled_ranks(self, n: int, z: int, before: int) -> set[int]:
        raws = {self._raw(r, z, before) for p in QUARTILES for r in _ends((n + z - 1) * p)}
        return raws - {None}

    # --- the passes

    def _ranks(self, at: dict, wanted) -> None:
        """Add {rank: value} for the ranks asked of each (column, view) that are not known yet."""
        rows = [(c, w, k, self.n[c, w]) for c in self.cols for w in self.views if self.n[c, w]
                for k in sorted(wanted(c, w) - set(at.get((c, w), {})))]
        if not rows:
            return
        fold = self.fold_col
        kind = self.df.schema[fold].dataType.simpleString() if fold else "int"
        targets = self.df.sparkSession.createDataFrame(rows, f"column string, {WITHOUT} {kind}, k bigint, n bigint")
        got = select_ranks(self.long, ["column"], "x", self.stats, targets if fold else targets.drop(WITHOUT, "n"), part=fold)
        # a row per column, view and rank that some chain asks for
        for r in got.collect():
            at.setdefault((r["column"], r[WITHOUT] if fold else None), {})[r["k"]] = r["value"]

    def _outside(self, table: DataFrame) -> DataFrame:
        """The values of each (column, view) of a small table with its rows: the view's fold left out."""
        rows = self.long.alias("d").join(F.broadcast(table).alias("t"), F.col("d.column") == F.col("t.column"))
        if self.fold_col:
            rows = rows.where(F.col("t.view").isNull() | ~F.col(f"d.{q(self.fold_col)}").eqNullSafe(F.col("t.view")))
        return rows

    def _limits_table(self, rows: list[tuple]) -> DataFrame:
        fold = self.fold_col
        kind = self.df.schema[fold].dataType.simpleString() if fold else "int"
        # a row per column, view and distinct clip
        return self.df.sparkSession.createDataFrame(rows, f"id int, column string, view {kind}, lo double, hi double, fill double")

    def _moments(self, limits: dict) -> dict:
        """Mean and population variance of the clipped values, where a chain asks for them."""
        need = {chain.clip for chain in self.chains if chain.impute == "mean" or chain.scaling == "standard"}
        keys = [(clip, key) for clip, key in limits if clip in need]
        if not keys:
            return {}
        table = self._limits_table([(i, key[0], key[1], *limits[clip, key], None) for i, (clip, key) in enumerate(keys)])
        x = F.when(F.col("t.lo").isNull(), F.col("d.x")).otherwise(F.least(F.greatest("d.x", "t.lo"), F.col("t.hi")))
        rows = self._outside(table).groupBy("t.id").agg(F.avg(x).alias("m"), F.var_pop(x).alias("v")).collect()
        return {keys[r["id"]]: (r["m"], r["v"]) for r in rows}

    def _below(self, limits: dict, fills: dict) -> dict:
        """How many clipped values lie below the mean that fills NULLs, for robust scaling."""
        need = {chain.clip for chain in self.chains if chain.impute == "mean" and chain.scaling == "robust"}
        keys = [(clip, key) for clip, key in limits if clip in need and self.z[key]]
        if not keys:
            return {}
        table = self._limits_table([(i, key[0], key[1], *limits[clip, key], fills[clip, "mean", key]) for i, (clip, key) in enumerate(keys)])
        x = F.when(F.col("t.lo").isNull(), F.col("d.x")).otherwise(F.least(F.greatest("d.x", "t.lo"), F.col("t.hi")))
        rows = self._outside(table).groupBy("t.id").agg(F.count_if(x < F.col("t.fill")).alias("c")).collect()
        return {keys[r["id"]]: r["c"] for r in rows}

    # --- from the statistics to fitted values

    def _values(self, chain, w, at, limits, fills, moments, below) -> FittedNumeric:
        out = FittedNumeric()
        for c in self.cols:
            key = (c, w)
            if not self.n[key]:
                if chain.scaling in ("standard", "minmax"):
                    out.scales[c] = [None, 1.0]
                if chain.impute == "mean":
                    out.fills[c] = None
                continue
            lim = limits[chain.clip, key]
            if chain.outlier == "clip":
                out.limits[c] = list(lim)
            fill = out.fills[c] = fills[chain.clip, chain.impute, key]
            n, z = self.n[key], self.z[key]
            value = lambda k: _clipped(at[key][k], *lim)  # noqa: B023, E731
            if chain.scaling == "standard":
                m, v = moments[chain.clip, key]
                mean = (n * m + z * fill) / (n + z) if z else m
                square = n * v + n * (m - mean) ** 2 + z * (fill - mean) ** 2
                out.scales[c] = [mean, math.sqrt(square / (n + z)) or 1.0]
            elif chain.scaling == "minmax":
                low, high = value(0), value(n - 1)
                out.scales[c] = [low, (high - low) or 1.0]
            elif chain.scaling == "robust":
                before = below[chain.clip, key] if chain.impute == "mean" and z else math.floor((n - 1) * 0.5) + 1
                filled = {}
                for r in set().union(*[_ends((n + z - 1) * p) for p in QUARTILES]):
                    raw = self._raw(r, z, before)
                    filled[r] = fill if raw is None else value(raw)
                q1, q2, q3 = (_interpolated(filled, (n + z - 1) * p) for p in QUARTILES)
                out.scales[c] = [q2, (q3 - q1) or 1.0]
        return out


class CategoryStatistics:
    """Dictionaries of any number of categorical chains and views, from one frequency table.

    ``dictionary(chain, view)`` gives a table (column, value, n, output, index): every training
    value of a column, grouped, with its index among the column's outputs in order of their text;
    and by column the numbers of entries and outputs, and the indexes of unseen values and of NULL
    (None: the unknown index)."""

    def __init__(self, df: DataFrame, cols: list[str], chains: list[CategoryChain], fold_col: str | None = None, views: list | None = None):
        self.cols, self.chains = list(cols), list(dict.fromkeys(chains))
        self.outputs, self.others, self.nulls, self.fills, self.tables = {}, {}, {}, {}, {}
        if not cols or not chains:
            return
        self.spark = df.sparkSession
        folds = [F.col(q(fold_col)).alias("fold")] if fold_col else [F.lit(None).cast("int").alias("fold")]
        base = df.select(*folds, *[F.col(q(c)).cast("string").alias(c) for c in cols])
        freq = (base.unpivot(["fold"], [q(c) for c in cols], "column", "value")
                .groupBy("fold", "column", "value").agg(F.count(F.lit(1)).alias("n")))
        self.freq = stored(freq, "frequencies")
        views = views if views is not None else [None]
        kind = df.schema[fold_col].dataType if fold_col else T.IntegerType()
        # a row per view and value: a view counts what lies outside its fold
        outside = F.filter(F.array(*[F.lit(v).cast(kind) for v in views]), lambda v: v.isNull() | ~v.eqNullSafe(F.col("fold")))
        self.counts = stored(self.freq.withColumn("view", F.explode(outside)).groupBy("view", "column", "value").agg(F.sum("n").alias("n")), "view-counts")
        self._fit(kind, views)

    def _fit(self, kind, views) -> None:
        kinds = kind.simpleString()
        # fills of every imputation: a row per view and column reaches the driver
        modes = {(r["view"], r["column"]): r["mode"] for r in self.counts.where("value IS NOT NULL").groupBy("view", "column").agg(
            F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")).collect()}
        rows = []
        for i, chain in enumerate(self.chains):
            least = dict(chain.grouping)
            for v in views:
                for c in self.cols:
                    fill = chain.fill if chain.impute == "constant" else modes.get((v, c)) if chain.impute == "most_frequent" else None
                    self.fills[chain, v, c] = fill
                    rows.append((i, v, c, fill, int(least[c]) if c in least else None, chain.other))
        plan = self.spark.createDataFrame(rows, f"chain int, view {kinds}, column string, fill string, least int, other string")
        # NULLs join their fill, then each filled value's count decides whether it stays
        filled = (self.counts.alias("c").join(F.broadcast(plan).alias("p"), F.col("c.view").eqNullSafe(F.col("p.view")) & (F.col("c.column") == F.col("p.column")))
                  .select("p.chain", "p.view", "p.column", "c.value", "c.n", F.coalesce("c.value", "p.fill").alias("filled"), "p.least", "p.other"))
        keys = ["chain", "view", "column"]
        sums = filled.where("filled IS NOT NULL").groupBy(*keys, "filled", "least", "other").agg(F.sum("n").alias("n"))
        made = F.when(F.col("least").isNull() | (F.col("n") >= F.col("least")), F.col("filled")).otherwise(F.col("other"))
        maps = stored(sums.select(*keys, "filled", made.alias("output")), "outputs")
        distinct = maps.select(*keys, "output").distinct().withColumn("one", F.lit(1))
        ranked = running_totals(distinct, keys, "output", ["one"])
        indexes = stored(ranked.select(*keys, "output", (F.col("cum_one") - 1).alias("index"), F.col("tot_one").alias("size")), "indexes")
        same = lambda a, b: F.expr(f"{a}.chain = {b}.chain AND {a}.view <=> {b}.view AND {a}.column = {b}.column")
        coded = maps.alias("m").join(indexes.alias("i"), same("m", "i") & (F.col("m.output") == F.col("i.output"))).select("m.*", "i.index")
        entries = (filled.where("value IS NOT NULL").alias("f").join(coded.alias("m"), same("f", "m") & (F.col("f.filled") == F.col("m.filled")))
                   .select("f.chain", "f.view", "f.column", "f.value", "f.n", "m.output", F.col("m.index").cast("double").alias("index")))
        self.entries = stored(entries, "dictionary")
        # what fills a NULL is an output of its own, if training has it; NULLs need not occur there
        nulls = plan.alias("p").join(coded.alias("m"), same("p", "m") & (F.col("p.fill") == F.col("m.filled")))
        self.nulls = {(r["chain"], r["view"], r["column"]): float(r["index"]) for r in nulls.select("p.chain", "p.view", "p.column", "m.index").collect()}
        # a row per chain, view and column reaches the driver
        sizes = indexes.groupBy(*keys).agg(F.max("size").alias("size")).collect()
        self.outputs = {(self.chains[r["chain"]], r["view"], r["column"]): r["size"] for r in sizes}
        grouped = indexes.alias("i").join(F.broadcast(plan).alias("p"), same("i", "p") & F.col("p.least").isNotNull() & (F.col("i.output") == F.col("p.other")))
        self.others = {(self.chains[r["chain"]], r["view"], r["column"]): float(r["index"]) for r in grouped.select("p.chain", "p.view", "p.column", "i.index").collect()}
        self.tables = {(r["chain"], r["view"], r["column"]): r["count"] for r in self.entries.groupBy(*keys).count().collect()}

    def dictionary(self, chain: CategoryChain, view=None) -> dict:
        i = self.chains.index(chain)
        mine = F.col("view").isNull() if view is None else F.col("view") == F.lit(view)
        table = self.entries.where((F.col("chain") == i) & mine).select("column", "value", "n", "output", "index")
        by = lambda d, key, none: {c: d.get((key, view, c), none) for c in self.cols}
        return {"table": table, "entries": by(self.tables, i, 0), "outputs": by(self.outputs, chain, 0), "others": by(self.others, chain, None),
                "nulls": by(self.nulls, i, None)}
