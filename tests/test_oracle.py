"""Every register query against its SQL on the same tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

from ledgerwatch.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def text(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return ""
    return repr(round(float(x), 6)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)


def rows(df):
    return sorted(zip(*([text(x) for x in df[c].tolist()] for c in sorted(df.columns)), strict=True))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_equals_sql(spark, duck, name):
    got, want = registry.QUERIES[name](spark, SF).toPandas(), duck.sql(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0
