"""Every query that has SQL, against DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from panelwave.workload.catalog import QUERIES, SQL

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA / name}.parquet'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, repr(v)) for v in row))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, str(DATA))
    columns = sorted(frame.columns)
    got = [tuple(r[c] for c in columns) for r in frame.collect()]
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = [tuple(row[names.index(c)] for c in columns) for row in result.fetchall()]
    assert ordered(got) == ordered(want)


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)
