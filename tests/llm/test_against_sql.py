"""Queries with SQL, over the smallest tables, against DuckDB."""

from pathlib import Path

import duckdb
import pytest

from panelwave.llm.queries import QUERIES, SQL

DATA = Path("/root/testdata/sf0.01")


@pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    frame = QUERIES[name](spark, str(DATA))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    result = con.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    got = sorted(tuple(r[c] for c in names) for r in frame.collect())
    assert got == sorted(result.fetchall())
