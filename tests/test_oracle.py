"""Every query of the survey library against its DuckDB oracle SQL on the sf0.001 tables."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module
from tests.conftest import SF_SMALL
from waveband.plans.oracle import ORACLE_SQL as ORACLE
from waveband.plans.registry import QUERIES as REGISTERED

RAW_TABLES = ["region", "nation", "customer", "part", "orders", "lineitem"]
QUERIES = {name: query for name, query in entry_module.queries().items() if name in REGISTERED}


def _cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return v.date().isoformat() if (v.hour, v.minute, v.second) == (0, 0, 0) else str(v)
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) or hasattr(v, "dtype"):
        return float(v)
    return str(v)


def _normalise(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)].astype(object)
    return sorted((tuple(_cell(v) for v in r) for r in df.itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in RAW_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_SMALL}/{name}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) == set(REGISTERED)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _normalise(got) == _normalise(want)


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.columns[:4] == ["quarter", "demographic_type", "demographic", "age_break"]
    assert df.count() > 0
