"""Every query with an oracle matches DuckDB on the same parquet tables; every query
without one runs and returns rows."""

import re

import pytest

import __spark_entry__ as E
from tablesmith.plans import oracle_check as OC

from sf_paths import SMALL

# the optional training-data queries have tests of their own
QUERIES = {k: v for k, v in E.queries().items() if not re.match(r"op[0-9]+_|pipeline$", k)}
ORACLES = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}

@pytest.fixture(scope="module")
def con():
    return OC.duck(SMALL)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, con, key):
    problems, _, _, _ = OC.compare(spark, con, key, QUERIES[key], ORACLES[key], SMALL)
    assert not problems, problems


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "column" in df.columns
