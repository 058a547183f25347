"""Registry of named queries: a Spark plan builder plus, where one exists, the
equivalent SQL that DuckDB runs on the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from tablesmith.plans import (  # noqa: F401
        q_sources, q_target, q_profile, q_explore, q_features, q_split, q_metrics, q_models)
