"""Exact, reproducible stratified splits and folds (#49-#53).

Rows are ordered inside their class by ``(xxhash64(seed, key), key)``, a random but
repeatable order that does not depend on partitioning. A class with ``n_c`` rows gives
its first ``t_c`` rows to the test side; folds are consecutive blocks. Only the block
boundaries are computed (exact order statistics via
:func:`tablesmith.functions.ranking.select_ranks`); each row is then assigned by comparing
its own sort key with its class's boundaries, so no window or sort spans a class.
Class counts, allocations and boundaries are tables, so there may be any number of classes.
``randomSplit``/``sampleBy`` are not used: their sizes are random, these are exact.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesmith.functions.columns import q
from tablesmith.functions.ranking import key_stats, running_totals, select_ranks
from tablesmith.session import stored


def approximate_mode(counts: list[int], n_draws: int) -> list[int]:
    """Split ``n_draws`` over classes in proportion to ``counts``: floors plus the
    largest remainders (ties to the earlier class). Integer arithmetic only."""
    total = sum(counts)
    if total == 0:
        return [0] * len(counts)
    floors = [(n_draws * c) // total for c in counts]
    rems = [(n_draws * c) % total for c in counts]
    need = n_draws - sum(floors)
    order = sorted(range(len(counts)), key=lambda i: (-rems[i], i))
    for i in order[:need]:
        floors[i] += 1
    return floors


def fold_allocation(counts: list[int], k: int) -> list[list[int]]:
    """Per class, the number of rows in each of ``k`` folds, as stratified k-fold
    allocates them: classes laid out in order, positions dealt round-robin to folds."""
    out = []
    start = 0
    for c in counts:
        per = []
        for i in range(k):
            # positions p in [start, start + c) with p % k == i
            first = start + ((i - start) % k)
            per.append(0 if first >= start + c else (start + c - 1 - first) // k + 1)
        out.append(per)
        start += c
    return out


def _sort_key(df: DataFrame, key: list[str], seed: int):
    return F.xxhash64(F.lit(seed), *[F.col(q(c)) for c in key])


class Report(dict):
    """What a split or folding did: counts, ``classes`` (a table with a row per class) and, when
    asked for, ``per_class`` (that table as a dict, which is collected then)."""

    def __missing__(self, name):
        if name != "per_class":
            raise KeyError(name)
        self[name] = {r["label"]: {k: r[k] for k in r.asDict() if k != "label"} for r in self["classes"].collect()}
        return self[name]


def _class_table(df: DataFrame, label: str) -> tuple[DataFrame, int, int]:
    """(label, n) per class as a stored table, the rows with a class and those without."""
    counts = stored(df.groupBy(F.col(q(label)).alias("label")).agg(F.count(F.lit(1)).alias("n")), "classes")
    r = counts.agg(F.sum(F.when(F.col("label").isNotNull(), F.col("n"))).alias("n"),
                   F.sum(F.when(F.col("label").isNull(), F.col("n"))).alias("z")).first()
    return counts.where("label IS NOT NULL"), r["n"] or 0, r["z"] or 0


def _split_sizes(classes: DataFrame, n: int, n_test: int) -> DataFrame:
    """(label, n, train, test): floors of the train shares and the largest remainders, ties to the
    smaller class (the rule of :func:`approximate_mode`), by running totals over the class table."""
    share = F.col("n").cast("decimal(38,0)") * F.lit(n - n_test).cast("decimal(20,0)")
    total = F.lit(max(n, 1)).cast("decimal(20,0)")
    base = classes.select("label", "n", F.floor(share / total).cast("bigint").alias("guess"), share.alias("share"))
    # decimal division rounds: settle the floor with exact products
    part = F.col("guess").cast("decimal(38,0)") * total
    base = base.withColumn("floor", F.when(part > F.col("share"), F.col("guess") - 1)
                           .when(part + total <= F.col("share"), F.col("guess") + 1).otherwise(F.col("guess")))
    base = base.withColumn("rem", (F.col("share") - F.col("floor").cast("decimal(38,0)") * total).cast("bigint"))
    base = stored(base.select("label", "n", "floor", F.struct((-F.col("rem")).alias("r"), "label").alias("place"), F.lit(1).alias("one")), "sizes")
    need = n - n_test - (base.agg(F.sum("floor")).first()[0] or 0)
    train = F.col("floor") + F.when(F.col("cum_one") <= need, 1).otherwise(0)
    return running_totals(base, [], "place", ["one"]).select("label", "n", train.alias("train"), (F.col("n") - train).alias("test"))


def _fold_sizes(classes: DataFrame, k: int) -> DataFrame:
    """(label, n, sizes): rows of each class in each fold (the rule of :func:`fold_allocation`)."""
    start = F.col("cum_n") - F.col("n")

    def size(i):
        first = start + F.pmod(i - start, F.lit(k))
        return F.when(first >= start + F.col("n"), 0).otherwise(F.floor((start + F.col("n") - 1 - first) / k) + 1).cast("bigint")

    return running_totals(classes, [], "label", ["n"]).select(
        "label", "n", F.transform(F.sequence(F.lit(0), F.lit(k - 1)).cast("array<bigint>"), size).alias("sizes"))


def _boundaries(df: DataFrame, label: str, key: list[str], seed: int, blocks: DataFrame) -> DataFrame:
    """(label, ths): each class's boundary rows in order. ``blocks`` holds (label, starts), the
    0-based ranks at which blocks begin; a boundary is the sort key (h, key...) of the row at that
    rank and the number of rows of the same key that stand before it (0 for a unique key)."""
    h = _sort_key(df, key, seed)
    data = df.where(F.col(q(label)).isNotNull()).select(F.col(q(label)).alias("label"), h.alias("__h"),
                                                        *[F.col(q(c)).alias(f"k{i + 1}") for i, c in enumerate(key)])
    targets = blocks.select("label", F.explode("starts").alias("k"))
    got = select_ranks(data, ["label"], "__h", key_stats(data, ["label"], "__h"), targets)
    got = stored(got.select("label", F.col("k").alias("r"), F.col("value").alias("hv"), (F.col("k") - F.col("less")).alias("off")), "boundaries")
    # rows sharing a hash value are ordered by key: resolve the (rare) ties exactly; equal keys
    # count as one row here, so a key that repeats without end is no burden
    ks = [f"k{i + 1}" for i in range(len(key))]
    same = (data.alias("d").join(got.alias("g"), (F.col("d.label") == F.col("g.label")) & (F.col("d.__h") == F.col("g.hv")))
            .groupBy("g.label", "g.r", "g.off", F.col("g.hv").alias("k0"), *[f"d.{c}" for c in ks]).agg(F.count(F.lit(1)).alias("m")))
    before = F.coalesce(F.sum("m").over(Window.partitionBy("label", "r").orderBy(*ks).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = same.withColumn("b", before).where((F.col("b") <= F.col("off")) & (F.col("off") < F.col("b") + F.col("m")))
    th = F.struct("r", F.struct("k0", *ks).alias("at"), (F.col("off") - F.col("b")).alias("same"))
    return at.groupBy("label").agg(F.array_sort(F.collect_list(th)).alias("ths"))


def _with_blocks(df: DataFrame, label: str, key: list[str], seed: int, blocks: DataFrame, payload: str) -> DataFrame:
    """``df`` without NULL labels, with ``__block`` (how many of its class's boundaries are at
    or before the row) and ``__payload``, the column ``payload`` of its class in ``blocks``.

    Rows that share a boundary's key (the key is not unique) are numbered by a hash of the
    whole row, so that the blocks have exact sizes all the same; other rows are only compared."""
    bounds = _boundaries(df, label, key, seed, blocks)
    th = stored(blocks.join(bounds, "label", "left").select(F.col("label").alias("__c"), "ths", F.col(payload).alias("__payload")), "blocks")
    mine = F.struct(_sort_key(df, key, seed).alias("k0"), *[F.col(q(c)).alias(f"k{i + 1}") for i, c in enumerate(key)])
    rows = df.join(th, F.col(q(label)) == F.col("__c")).drop("__c").withColumn("__mine", mine)
    none = F.lit(0)
    if not th.where(F.exists("ths", lambda t: t["same"] > 0)).limit(1).count():
        reached = F.filter("ths", lambda t: t["at"] <= F.col("__mine"))
        return rows.withColumn("__block", F.when(F.col("ths").isNull(), none).otherwise(F.size(reached))).drop("ths", "__mine")
    shared = F.coalesce(F.exists("ths", lambda t: t["at"] == F.col("__mine")), F.lit(False))
    rows = rows.withColumn("__shared", shared)
    order = Window.partitionBy(q(label), "__mine").orderBy(F.xxhash64(*[F.col(q(c)) for c in df.columns]))
    numbered = rows.where("__shared").withColumn("__i", F.row_number().over(order)).unionByName(
        rows.where("NOT __shared").withColumn("__i", F.lit(0)))
    reached = F.filter("ths", lambda t: (t["at"] < F.col("__mine")) | ((t["at"] == F.col("__mine")) & (F.col("__i") > t["same"])))
    return numbered.withColumn("__block", F.when(F.col("ths").isNull(), none).otherwise(F.size(reached))).drop("ths", "__mine", "__shared", "__i")


def stratified_split(df: DataFrame, label: str, key: list[str] | str, test_size: float = 0.2, seed: int = 42,
                     side_col: str = "side") -> tuple[DataFrame, Report]:
    """Add ``side`` ('train'/'test') with exact per-class sizes: the total test size is
    ceil(n * test_size) and the train size per class follows the largest-remainder rule.
    Rows with a NULL label are dropped (their number is reported).

    ``key`` should identify rows (natural key, or all columns after dedup); rows that share a
    key are dealt by a hash of the whole row. Returns the frame and a :class:`Report`."""
    key = [key] if isinstance(key, str) else list(key)
    classes, n, n_null = _class_table(df, label)
    n_test = int(math.ceil(test_size * n)) if n else 0
    sizes = stored(_split_sizes(classes, n, n_test), "sizes")
    # block 0 is test, unless the class has no test row (a class without boundary has one block)
    inner = (F.col("test") > 0) & (F.col("test") < F.col("n"))
    blocks = sizes.select("label", F.when(inner, F.array("test")).otherwise(F.slice(F.array("test"), 1, 0)).alias("starts"),
                          F.when(F.col("test") == 0, F.array(F.lit("train"))).otherwise(F.array(F.lit("test"), F.lit("train"))).alias("sides"))
    out = _with_blocks(df, label, key, seed, blocks, "sides")
    out = out.withColumn(side_col, F.get("__payload", F.col("__block"))).drop("__payload", "__block")
    return out, Report(n=n, n_test=n_test, n_null_label=n_null, classes=sizes)


def stratified_folds_report(df: DataFrame, label: str, key: list[str] | str, k: int = 5, seed: int = 42,
                            fold_col: str = "fold") -> tuple[DataFrame, Report]:
    """:func:`stratified_folds` and its report: rows dealt, rows left out for a NULL label, and
    the table of classes with their rows by fold."""
    key = [key] if isinstance(key, str) else list(key)
    classes, n, n_null = _class_table(df, label)
    sizes = stored(_fold_sizes(classes, k), "sizes")
    used = F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.get("sizes", i) > 0)
    # the rows before a fold's block, for all used folds but the first
    before = F.transform("used", lambda i: F.aggregate(F.slice("sizes", F.lit(1), i), F.lit(0).cast("bigint"), lambda s, x: s + x))
    blocks = sizes.withColumn("used", used).select("label", "used", F.slice(before, F.lit(2), F.greatest(F.size("used") - 1, F.lit(0))).alias("starts"))
    out = _with_blocks(df, label, key, seed, blocks, "used")
    return (out.withColumn(fold_col, F.get("__payload", F.col("__block"))).drop("__payload", "__block"),
            Report(n=n, n_null_label=n_null, classes=sizes))


def stratified_folds(df: DataFrame, label: str, key: list[str] | str, k: int = 5, seed: int = 42,
                     fold_col: str = "fold") -> DataFrame:
    """Add an int ``fold`` in [0, k): per class, consecutive blocks of the hash order with
    the sizes stratified k-fold gives. Usable as ``CrossValidator(foldCol=...)``.

    A row's fold is the number of block starts at or before its sort key, mapped through
    the class's list of non-empty folds. Rows with a NULL label are left out;
    :func:`stratified_folds_report` counts them."""
    return stratified_folds_report(df, label, key, k, seed, fold_col)[0]


def split_quality(split: DataFrame, label: str, side_col: str = "side") -> DataFrame:
    """(side, label, n, share, n_side, n_null_label): class shares per side."""
    g = split.groupBy(q(side_col), F.col(q(label)).alias("label")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    w = Window.partitionBy(q(side_col))
    nn = F.sum(F.when(F.col("label").isNull(), F.col("n")).otherwise(0)).over(w)
    return g.select(F.col(q(side_col)).alias("side"), "label", "n",
                    (F.col("n") / F.sum(F.when(F.col("label").isNotNull(), F.col("n"))).over(w)).alias("share"),
                    F.sum("n").over(w).cast("bigint").alias("n_side"), nn.cast("bigint").alias("n_null_label"))


def save_splits(split: DataFrame, path: str, side_col: str = "side", fmt: str = "parquet") -> None:
    """One dataset partitioned by side: features and label stay together."""
    split.write.mode("overwrite").partitionBy(side_col).format(fmt).save(path)
