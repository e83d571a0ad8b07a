"""Queries that SQL can express, against DuckDB over whole tables."""

from __future__ import annotations

import duckdb
import pytest

pytest.importorskip("waveband.llm")
from waveband.llm.oracle import ORACLE_SQL  # noqa: E402
from waveband.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    got = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    done = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in done.description]
    assert sorted(names) == columns
    want = sorted((tuple(row[names.index(c)] for c in columns) for row in done.fetchall()), key=repr)
    assert got == want
