"""Feature selection and checks (#43-#48)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesmith.functions.columns import is_numeric, q
from tablesmith.operators.frequency import freq_table
from tablesmith.operators.profile import null_counts


def feature_roles(df: DataFrame, drop: list[str] | None = None, target: str | None = None) -> DataFrame:
    """(column, position, role, kind): role is 'feature', 'dropped' or 'target'; kind is
    'numeric' or 'categorical' from the schema (#18, #45)."""
    drop = set(drop or [])
    rows = []
    for i, f in enumerate(df.schema.fields):
        role = "target" if f.name == target else "dropped" if f.name in drop else "feature"
        rows.append((f.name, i, role, "numeric" if is_numeric(f.dataType) else "categorical"))
    return df.sparkSession.createDataFrame(rows, "column string, position int, role string, kind string")


def role_lists(roles: DataFrame) -> dict:
    """The three lists (final, numeric, categorical) from a role table; at most #columns rows."""
    rows = sorted(roles.where(F.col("role") == "feature").collect(), key=lambda r: r["position"])
    return {"final_features": [r["column"] for r in rows],
            "final_num_features": [r["column"] for r in rows if r["kind"] == "numeric"],
            "final_cat_features": [r["column"] for r in rows if r["kind"] == "categorical"]}


def feature_flags(roles: DataFrame, redundant: list[str] | None = None,
                  irrelevant: list[str] | None = None) -> DataFrame:
    """The analyst's decisions as a column -> flag table joined onto the roles:
    (column, role, kind, flag) with flag 'redundant', 'irrelevant' or NULL."""
    spark = roles.sparkSession
    flags = [(c, "redundant") for c in (redundant or [])] + [(c, "irrelevant") for c in (irrelevant or [])]
    fl = spark.createDataFrame(flags, "column string, flag string")
    return roles.join(F.broadcast(fl), "column", "left").select("column", "role", "kind", "flag")


def propose_groupings(df: DataFrame, cols: list[str], min_freqs: dict | None = None, default_min_freq: int = 10,
                      other_label: str = "Other") -> DataFrame:
    """The values to fold per column: (column, value, n, min_freq, other_label), one row
    per value seen fewer than ``min_freq`` times; columns without a rare value have no
    rows. Long form on purpose: a high-cardinality column can have nearly all of its
    values rare, so they are never gathered into one array. One frequency shuffle for
    all columns; see :func:`grouping_summary` for the per-column count."""
    spark = df.sparkSession
    min_freqs = min_freqs or {}
    th = spark.createDataFrame([(c, int(min_freqs.get(c, default_min_freq))) for c in cols],
                               "column string, min_freq int")
    rare = freq_table(df, cols).join(F.broadcast(th), "column").where(F.col("n") < F.col("min_freq"))
    return rare.select("column", "value", F.col("n").cast("bigint").alias("n"), "min_freq",
                       F.lit(other_label).alias("other_label"))


def grouping_summary(proposal: DataFrame) -> DataFrame:
    """(column, n_rare, min_freq, other_label) from :func:`propose_groupings`."""
    return proposal.groupBy("column", "min_freq", "other_label").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rare")).select("column", "n_rare", "min_freq", "other_label")


def feature_issues(df: DataFrame, roles: DataFrame, max_card: int = 20) -> DataFrame:
    """Columns the preprocessing must handle: (column, kind, n_null, n_unique,
    high_cardinality) for features with NULLs or categoricals with more than ``max_card``
    distinct values (#46)."""
    feats = roles.where(F.col("role") == "feature").select("column", "kind")
    names = [r["column"] for r in feats.collect()]
    nulls = null_counts(df, names)
    cats = [r["column"] for r in feats.where(F.col("kind") == "categorical").collect()]
    uniq = (freq_table(df, cats).groupBy("column").agg(F.count(F.lit(1)).cast("bigint").alias("n_unique"))
            if cats else df.sparkSession.createDataFrame([], "column string, n_unique bigint"))
    out = (F.broadcast(feats).join(nulls, "column").join(uniq, "column", "left")
           .withColumn("high_cardinality", (F.col("kind") == "categorical") & (F.coalesce("n_unique", F.lit(0)) > max_card)))
    return out.where((F.col("n_null") > 0) | F.col("high_cardinality")).select(
        "column", "kind", "n_null", "n_unique", "high_cardinality")


def surviving_categories(df: DataFrame, thresholds: dict[str, list[int]]) -> DataFrame:
    """For each column and candidate ``min_freq``: categories kept by a grouper plus one
    for the 'Other' bucket: (column, min_freq, n_categories). A grid combination's count
    is the row of each column at its threshold, so no model is fitted to count."""
    spark = df.sparkSession
    th = spark.createDataFrame([(c, int(t)) for c, ts in thresholds.items() for t in ts],
                               "column string, min_freq int")
    fr = freq_table(df, list(thresholds))
    return (fr.join(F.broadcast(th), "column")
            .groupBy("column", "min_freq")
            .agg((F.count_if(F.col("n") >= F.col("min_freq")) + 1).cast("bigint").alias("n_categories")))


def select_for_model(df: DataFrame, features: list[str], target: str, key: str | None = None) -> DataFrame:
    """Projection on features + target (+ a stable row key) (#49)."""
    cols = ([key] if key else []) + list(features) + [target]
    return df.select(*[q(c) for c in cols])
