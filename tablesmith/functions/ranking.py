"""Distributed order statistics, running totals and top-k.

Spark's exact ``percentile`` keeps a value->count map per group and merges it in one
task, and a window without ``partitionBy`` moves every row into one partition. Neither
survives a column with billions of distinct values. The kernels here only ever sort a
bounded slice of the data:

* :func:`select_ranks` finds exact order statistics of any number of groups in two passes: a
  quantile sketch brackets every rank, then each row finds its interval among the bracket ends
  and the values inside the brackets are counted. Brackets of more than ``max_window`` rows are
  sketched again first. All of its state is tables.
* :func:`running_totals` computes ordered prefix sums over ranges sampled from the data:
  range totals (small) give each range's base, and the window runs per range.
* :func:`top_k` ranks inside (group, salt) partitions first, so a group with a huge
  number of distinct values is never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesmith.functions.columns import q
from tablesmith.session import checkpoint_dir, discarded, stored


# Parameters: how many equal-depth edges a sketch gives, and its rank error (1 / ACCURACY of
# the rows). The margin of one edge on either side of a bracket is about 10 times that error.
EDGES, ACCURACY = 256, 2_500
# Parameter: rows of a bracket whose values are counted in one window. A bracket has about
# 4 / EDGES of the rows, so 67 million rows of a group are counted without a second sketch.
MAX_WINDOW = 1 << 20
# What a pass does with the values of an interval: only count them, count each value, or sketch.
COUNTED, VALUES, SKETCH = 0, 1, 2
WITHOUT = "__without"


def sketch(x):
    """Equal-depth edges of a column's values. The array of shares is parsed from one text, since
    a literal built from Python costs calls to the JVM."""
    shares = F.expr("array(" + ", ".join(f"{i / EDGES}D" for i in range(EDGES + 1)) + ")")
    return F.percentile_approx(x, shares, ACCURACY)


def _same(left: str, right: str, keys: list[str]):
    """The null-safe join condition of two aliased frames."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{q(k)}").eqNullSafe(F.col(f"{right}.{q(k)}"))
    return cond


def key_stats(data: DataFrame, keys: list[str], x: str) -> DataFrame:
    """(keys, __n, __min, __max, __edges) of the non-null ``x`` per key group, a stored table of
    one row a group: the count, the range and equal-depth edges (one aggregate)."""
    return stored(data.where(F.col(q(x)).isNotNull()).groupBy(*[q(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("__n"), F.min(q(x)).alias("__min"), F.max(q(x)).alias("__max"),
        sketch(F.col(q(x))).alias("__edges")), "sketches")


def _brackets(state: DataFrame, keys: list[str], max_window: int) -> DataFrame:
    """Per group the sorted ends of its targets' brackets (``bounds``) and what to do in each of
    the open intervals between them (``modes``).

    A target's rank lies inside the open interval (lo, hi) of ``size`` rows after ``below``
    others. If these are more than ``max_window``, edges of a sketch of that interval narrow it to
    about 4 / EDGES of its rows: from the edge before the one before the rank to the edge after
    the one after it, taking different edges, so that neither ties nor the rounding of 64-bit
    numbers in a sketch leave the rank outside. The edges in between are bounds too: a value that
    most rows share is an interval of its own. Without an edge inside, the interval has few
    different values, and they are counted."""
    share = (F.col("k") - F.col("below")) / F.col("size")
    first = F.greatest(F.floor(share * EDGES) - 1, F.lit(0))
    last = F.least(F.floor(share * EDGES) + 2, F.lit(EDGES))
    edge = lambda i: F.element_at("edges", (i + 1).cast("int"))
    sketched = F.col("edges").isNotNull() & (F.col("size") > max_window)
    inside = lambda e: (F.col("lo").isNull() | (e > F.col("lo"))) & (F.col("hi").isNull() | (e < F.col("hi")))
    t = state.select(*[q(k) for k in keys], "lo", "hi", "size", "edges", F.when(sketched, edge(first)).alias("a"), F.when(sketched, edge(last)).alias("b"))
    near = F.array_max(F.filter("edges", lambda e: (e < F.col("a")) & inside(e)))
    far = F.array_min(F.filter("edges", lambda e: (e > F.col("b")) & inside(e)))
    t = t.withColumn("from", F.coalesce(F.when(F.col("a").isNotNull(), near), "lo")).withColumn("to", F.coalesce(F.when(F.col("a").isNotNull(), far), "hi"))
    between = lambda e: (F.col("from").isNull() | (e >= F.col("from"))) & (F.col("to").isNull() | (e <= F.col("to"))) & inside(e)
    steps = F.size(F.array_distinct(F.filter("edges", between)))
    some = F.when(F.col("a").isNotNull() & (steps > 0), F.ceil(F.col("size") * (steps + 1) / EDGES)).when(
        F.col("a").isNotNull(), F.lit(0)).otherwise(F.col("size"))
    mids = F.filter(F.array("a", "b"), lambda e: e.isNotNull() & inside(e))
    t = t.select(*[q(k) for k in keys], F.struct(F.col("from").alias("lo"), F.col("to").alias("hi"), mids.alias("mids"),
                                                 F.when(some <= max_window, VALUES).otherwise(SKETCH).alias("mode")).alias("t"))
    g = t.groupBy(*[q(k) for k in keys]).agg(F.collect_set("t").alias("ts"))
    ends = F.flatten(F.transform("ts", lambda t: F.concat(t["mids"], F.array(t["lo"], t["hi"]))))
    g = g.withColumn("bounds", F.array_sort(F.array_distinct(F.filter(ends, lambda e: e.isNotNull()))))
    n = F.size("bounds")

    def mode(i):
        """The most that a target's bracket over the interval before bound ``i`` asks for."""
        covers = lambda t: ((i == 0) & t["lo"].isNull() | (i > 0) & (t["lo"].isNull() | (t["lo"] <= F.get("bounds", i - 1)))) & (
            (i == n) & t["hi"].isNull() | (i < n) & (t["hi"].isNull() | (t["hi"] >= F.get("bounds", i))))
        return F.coalesce(F.array_max(F.transform(F.filter("ts", covers), lambda t: t["mode"])), F.lit(COUNTED))

    return g.select(*[q(k) for k in keys], "bounds", F.transform(F.sequence(F.lit(0), n), mode).alias("modes"))


def _classified(data: DataFrame, groups: DataFrame, keys: list[str], x: str, longest: int, extra: list[str]) -> DataFrame:
    """(keys, extra, code, mode, x): each row with the interval it lies in, once.

    ``code`` is 2 p for the open interval after p bounds and 2 p + 1 for the bound after them;
    p comes by binary search, so a row costs the logarithm of the number of bounds."""
    rows = (data.alias("d").join(groups.alias("g"), _same("d", "g", keys))
            .select(*[F.col(f"d.{q(k)}").alias(k) for k in keys], *[F.col(f"d.{q(e)}").alias(e) for e in extra],
                    F.col(f"d.{q(x)}").alias("x"), "bounds", "modes", F.lit(0).alias("p")))
    for step in (1 << i for i in reversed(range(max(1, longest).bit_length()))):
        # places after the last bound are NULL, and so not below
        rows = rows.withColumn("p", F.when(F.get("bounds", F.col("p") + (step - 1)) < F.col("x"), F.col("p") + step).otherwise(F.col("p")))
    on_bound = F.coalesce(F.get("bounds", F.col("p")) == F.col("x"), F.lit(False))
    return rows.select(*[q(k) for k in keys], *[q(e) for e in extra], (2 * F.col("p") + on_bound.cast("int")).alias("code"),
                       F.when(on_bound, F.lit(COUNTED)).otherwise(F.get("modes", F.col("p"))).alias("mode"), "x")


def _count_values(data, groups, keys, x, longest, extra):
    """(keys, extra, code, v, c): rows per interval, by value in the intervals that ask for it."""
    rows = _classified(data, groups, keys, x, longest, extra)
    return rows.groupBy(*[q(k) for k in keys], *[q(e) for e in extra], "code", F.when(F.col("mode") == VALUES, F.col("x")).alias("v")).agg(
        F.count(F.lit(1)).alias("c"))


def _count_sketches(data, groups, keys, x, longest, extra):
    """(keys, extra, code, c, edges): rows per interval and a sketch of those that ask for it."""
    rows = _classified(data, groups, keys, x, longest, extra)
    if not extra:
        # both from one pass over the data
        return rows.groupBy(*[q(k) for k in keys], "code").agg(
            F.count(F.lit(1)).alias("c"), sketch(F.when(F.col("mode") == SKETCH, F.col("x"))).alias("edges"))
    per = rows.groupBy(*[q(k) for k in keys], *[q(e) for e in extra], "code").agg(F.count(F.lit(1)).alias("c"))
    edges = rows.where(F.col("mode") == SKETCH).groupBy(*[q(k) for k in keys], "code").agg(sketch(F.col("x")).alias("edges"))
    return per.alias("d").join(edges.alias("e"), _same("d", "e", [*keys, "code"]), "left").select("d.*", "e.edges")


def select_ranks(data: DataFrame, keys: list[str], x: str, stats: DataFrame, targets: DataFrame, *, part: str | None = None,
                 max_window: int | None = None) -> DataFrame:
    """Exact order statistics of any number of groups: (keys, k, value, less).

    ``stats`` is the output of :func:`key_stats`; ``targets`` holds (keys, k) with ``k`` a
    0-based rank among the non-null ``x`` of its group; ``less`` counts the group's rows below
    the value. With ``part``, targets have the columns ``__without`` and ``n`` too: they rank the
    ``n`` rows of the group outside of that part (all rows where it is NULL), and all parts are
    answered by the same passes over the data.

    A sketch's edges bracket each rank by about 4 / EDGES of the rows, whatever the shape of the
    values. One pass then finds each row's interval by binary search over its group's bracket
    ends (every row counts once) and counts values inside the brackets only; the ends are
    intervals of their own, so a value that most rows share is one count. Brackets of more than
    ``max_window`` rows are sketched again first. So up to 67 million rows take one pass after
    the sketch and 64 times more rows one pass more; a rank that a sketch misses goes on in the
    interval that the counts show it to be in. Statistics, targets and brackets stay tables; only
    counts of them come to the driver."""
    window = MAX_WINDOW if max_window is None else max_window
    data = data.where(F.col(q(x)).isNotNull())
    tkeys = [*keys, WITHOUT] if part else list(keys)
    extra = [part] if part else []
    cols = [q(k) for k in keys]
    tcols = [q(k) for k in tkeys]
    x_type = data.schema[x].dataType
    none = F.lit(None).cast(x_type)
    state = stored(targets.alias("t").join(stats.alias("s"), _same("t", "s", keys)).select(
        *[F.col(f"t.{k}") for k in tcols], F.col("t.k").cast("bigint").alias("k"), none.alias("lo"), none.alias("hi"),
        F.lit(0).cast("bigint").alias("below"), F.col("t.n" if part else "s.__n").alias("size"), F.col("s.__edges").alias("edges"))
        .dropDuplicates([*tkeys, "k"]), "ranks")
    found = []
    while True:
        groups = stored(_brackets(state, keys, window), "brackets")
        asks = groups.agg(F.max(F.size("bounds")), F.count_if(F.array_max("modes") == SKETCH), F.count(F.lit(1))).first()
        if not asks[2]:
            return _no_ranks(data, tkeys, x_type)
        wide = F.array_max("modes") == SKETCH
        made, counts = [], []
        for n, kind, those in ((asks[2] - asks[1], VALUES, groups.where(~wide)), (asks[1], SKETCH, groups.where(wide))):
            if not n:
                continue
            count = _count_values if kind == VALUES else _count_sketches
            counted = stored(count(data, those, keys, x, asks[0], extra), "counts")
            counts.append(counted)
            made.append(_located(state, those, counted, keys, tkeys, part, kind, x_type))
        out = made[0] if len(made) == 1 else made[0].unionByName(made[1])
        out = stored(out, "located")
        discarded(groups, *counts)
        found.append(out.where("resolved").select(*tcols, "k", "value", "less"))
        state = out.where("NOT resolved").select(*tcols, "k", "lo", "hi", "below", "size", "edges")
        if state.isEmpty():
            break
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def _no_ranks(data: DataFrame, tkeys: list[str], x_type) -> DataFrame:
    cols = [data[q(k)] if k in data.columns else F.lit(None).cast("string").alias(k) for k in tkeys]
    return data.limit(0).select(*cols, F.lit(0).cast("bigint").alias("k"), F.lit(None).cast(x_type).alias("value"),
                                F.lit(0).cast("bigint").alias("less"))


def _located(state, groups, counted, keys, tkeys, part, kind, x_type):
    """Each target of the groups with its value, or with the interval in which its rank lies."""
    cols, tcols = [q(k) for k in keys], [q(k) for k in tkeys]
    per = counted.groupBy(*cols, *([q(part)] if part else []), "code").agg(
        F.sum("c").alias("c"), *([F.max("edges").alias("edges")] if kind == SKETCH else []))
    values = counted.where(F.col("v").isNotNull()) if kind == VALUES else None
    mine = state.alias("t").join(groups.alias("g"), _same("t", "g", keys)).select("t.*", "g.bounds", "g.modes")
    if part:
        # the counts of everything but one part, for each part that a target leaves out
        asked = mine.select(*tcols).distinct()

        def outside(rows, by, fold):
            kept = F.col(f"a.{WITHOUT}").isNull() | ~F.col(f"r.{q(part)}").eqNullSafe(F.col(f"a.{WITHOUT}"))
            return (rows.alias("r").join(asked.alias("a"), _same("r", "a", keys)).where(kept)
                    .groupBy(*[F.col(f"a.{k}") for k in tcols], *[f"r.{b}" for b in by]).agg(*fold))

        per = outside(per, ["code"], [F.sum("r.c").alias("c"), *([F.max("r.edges").alias("edges")] if kind == SKETCH else [])])
        values = outside(values, ["code", "v"], [F.sum("r.c").alias("c")]) if kind == VALUES else None
    before = Window.partitionBy(*tcols).orderBy("code").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0)))
    rank = lambda r, b, c: (F.col(b) <= F.col(r)) & (F.col(r) < F.col(b) + F.col(c))
    at = (mine.drop("edges").alias("t").join(per.alias("p"), _same("t", "p", tkeys) & rank("t.k", "p.before", "p.c"))
          .select("t.*", "p.code", "p.before", "p.c", *(["p.edges"] if kind == SKETCH else [])))
    p = (F.col("code") / 2).cast("int")
    on_bound = F.col("code") % 2 == 1
    at = at.select(
        *tcols, "k", "code", F.when(on_bound, F.get("bounds", p)).alias("value"), F.when(on_bound, F.col("before")).alias("less"),
        F.when(p > 0, F.get("bounds", p - 1)).alias("lo"), F.get("bounds", p).alias("hi"), F.col("before").alias("below"), F.col("c").alias("size"),
        (F.col("edges") if kind == SKETCH else F.lit(None).cast(f"array<{x_type.simpleString()}>")).alias("edges"))
    if kind == VALUES:
        upto = Window.partitionBy(*tcols, "code").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cum = values.withColumn("cum", F.sum("c").over(upto))
        inside = (F.col("v.cum") - F.col("v.c") <= F.col("a.k") - F.col("a.below")) & (F.col("a.k") - F.col("a.below") < F.col("v.cum"))
        at = (at.alias("a").join(cum.alias("v"), _same("a", "v", [*tkeys, "code"]) & inside, "left")
              .select(*[F.col(f"a.{k}") for k in tcols], "a.k", F.coalesce("a.value", "v.v").alias("value"),
                      F.coalesce("a.less", F.col("a.below") + F.col("v.cum") - F.col("v.c")).alias("less"),
                      "a.lo", "a.hi", "a.below", "a.size", "a.edges"))
    else:
        at = at.drop("code")
    return at.withColumn("resolved", F.col("value").isNotNull())


def rank_select(data: DataFrame, keys: list[str], x: str, stats, targets: list[tuple], *, max_window: int | None = None) -> dict:
    """:func:`select_ranks` for a few targets ``(key_tuple, k)``: ``{(key_tuple, k): (value, less)}``.
    ``stats`` is the output of :func:`key_stats`, or a list of its rows as dicts."""
    spark = data.sparkSession
    fields = [data.schema[k] for k in keys]
    x_type = data.schema[x].dataType
    if not isinstance(stats, DataFrame):
        schema = T.StructType([*fields, T.StructField("__n", T.LongType()), T.StructField("__edges", T.ArrayType(x_type))])
        stats = spark.createDataFrame([(*[s[k] for k in keys], s["__n"], s.get("__edges")) for s in stats], schema)
    asked = spark.createDataFrame([(*key, int(k)) for key, k in targets], T.StructType([*fields, T.StructField("k", T.LongType())]))
    wrong = asked.alias("t").join(stats.alias("s"), _same("t", "s", keys), "left").where("s.__n IS NULL OR k < 0 OR k >= s.__n").first()
    if wrong:
        raise ValueError(f"rank {wrong['k']} outside of its group")
    got = select_ranks(data, keys, x, stats, asked, max_window=max_window).collect()
    return {(tuple(r[k] for k in keys), r["k"]): (r["value"], r["less"]) for r in got}


def quantile_table(data: DataFrame, keys: list[str], x: str, probs: list[float], stats: DataFrame | None = None, **kw) -> DataFrame:
    """Exact linearly interpolated quantiles (the pandas/Spark ``percentile`` definition) of ``x``
    per key group: position ``(n-1)*p`` between the two neighbouring order statistics.
    (keys, n, p, q), a row for each group and probability. ``stats`` (as from :func:`key_stats`)
    can be passed when a profile has already computed them."""
    stats = stats if stats is not None else key_stats(data, keys, x)
    cols = [q(k) for k in keys]
    ps = F.array(*[F.lit(float(p)) for p in probs])
    place = lambda p: (F.col("__n") - 1) * p
    ends = F.flatten(F.transform(ps, lambda p: F.array(F.floor(place(p)), F.ceil(place(p)))))
    targets = stats.where("__n > 0").select(*cols, F.explode(F.array_distinct(ends)).alias("k"))
    got = select_ranks(data, keys, x, stats, targets, **kw)
    values = got.groupBy(*cols).agg(F.map_from_entries(F.collect_list(F.struct("k", F.col("value").cast("double")))).alias("m"))

    def value(p):
        lo, hi = (F.element_at("m", f(place(p))) for f in (F.floor, F.ceil))
        return F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (place(p) - F.floor(place(p))))

    rows = values.alias("v").join(stats.select(*cols, "__n").alias("s"), _same("v", "s", keys)).select("v.*", "s.__n")
    return rows.select(*cols, F.col("__n").alias("n"), F.inline(F.transform(ps, lambda p: F.struct(p.alias("p"), value(p).alias("q")))))


def quantiles_long(df: DataFrame, cols: list[str], probs: list[float], by: list[str] | None = None,
                   accuracy: int | None = None, **kw) -> DataFrame:
    """Quantiles of several numeric columns at once: (by..., column, p, q, n).

    Exact by default, in passes that start at once (their result is a table). With ``accuracy``
    the values come from one ``percentile_approx`` pass instead (rank error about
    n / accuracy, no refinement passes), lazily."""
    by = list(by or [])
    long_df = to_long_numeric(df, cols, by)
    keys = [q(k) for k in by] + ["column"]
    ps = [float(p) for p in probs]
    if accuracy is not None:
        agg = long_df.groupBy(*keys).agg(F.percentile_approx("x", ps, accuracy).alias("__qs"),
                                         F.count(F.lit(1)).alias("n"))
        return agg.select(*keys, F.inline(F.arrays_zip(F.array(*[F.lit(p) for p in ps]).alias("p"),
                                                       F.col("__qs").alias("q"))), "n").select(
            *keys, "p", F.col("q").cast("double").alias("q"), "n")
    return quantile_table(long_df, by + ["column"], "x", ps, **kw).select(*keys, "p", "q", "n")


def to_long_numeric(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """(by..., column, x double) with the NULLs of every column dropped."""
    by = list(by or [])
    base = df.select(*[F.col(q(b)) for b in by], *[F.col(q(c)).cast("double").alias(c) for c in cols])
    return (base.unpivot([q(b) for b in by], [q(c) for c in cols], "column", "x")
            .where(F.col("x").isNotNull()))


def running_totals(df: DataFrame, part: list[str], order: str, sums: list[str], *, descending: bool = False,
                   ranges: int | None = None) -> DataFrame:
    """Inclusive running sums (``cum_<name>``) of ``sums`` ordered by ``order`` within
    ``part``, and the sums over the whole part (``tot_<name>``).

    ``order`` must be unique within ``part`` (aggregate to distinct values first; NULL counts
    as the lowest value). The rows are dealt to ``ranges`` ranges of (part, order) whose
    boundaries are sampled from the data, so crowded values get as many ranges as they need;
    the dealt table is written once to the checkpoint folder. Totals per range (a row for
    each part and range) give every range its base, and the row-level window runs inside the
    ranges only."""
    checkpoint_dir(df.sparkSession)
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [q(p) for p in part]
    dealt = (df.repartitionByRange(n, *keys, q(order)).withColumn("__b", F.spark_partition_id())
             .checkpoint(eager=True))
    totals = dealt.groupBy(*keys, "__b").agg(*[F.sum(q(s)).alias("__t_" + s) for s in sums])
    step = F.col("__b").desc() if descending else F.col("__b").asc()
    before = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    base = totals.select(*keys, "__b",
                         *[F.coalesce(F.sum("__t_" + s).over(before), F.lit(0)).alias("__base_" + s) for s in sums],
                         *[F.sum("__t_" + s).over(whole).alias("tot_" + s) for s in sums])
    o = F.col(q(order))
    inside = Window.partitionBy(*keys, "__b").orderBy(o.desc() if descending else o.asc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = dealt.join(base, [*part, "__b"]) if not part else dealt.alias("d").join(
        base.alias("b"), [F.col(f"d.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys] + [F.col("d.__b") == F.col("b.__b")]
    ).select("d.*", *[f"b.`__base_{s}`" for s in sums], *[f"b.`tot_{s}`" for s in sums])
    for s in sums:
        out = out.withColumn("cum_" + s, F.col("__base_" + s) + F.coalesce(F.sum(q(s)).over(inside), F.lit(0)))
    return out.drop("__b", *["__base_" + s for s in sums])


def top_k(df: DataFrame, part: list[str], order: list, k: int, *, salt: int = 64, tiebreak: str | None = None,
          rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows per ``part`` under ``order`` (a list of Columns), exact.

    Stage one keeps the top k inside (part, salt) partitions, stage two ranks the at most
    ``k * salt`` survivors per group.
    """
    key = F.col(q(tiebreak)) if tiebreak else F.lit(0)
    s = F.pmod(F.xxhash64(key), F.lit(salt))
    stage1 = df.withColumn("__s", s).withColumn("__r1", F.row_number().over(
        Window.partitionBy(*[q(p) for p in part], "__s").orderBy(*order))).where(F.col("__r1") <= k)
    w2 = Window.partitionBy(*[q(p) for p in part]).orderBy(*order)
    return (stage1.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= k)
            .drop("__s", "__r1"))
