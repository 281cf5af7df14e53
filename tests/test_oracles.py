"""Every registered query against its DuckDB oracle on the smallest driver scale."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import TABLES, rows_of

SF = os.environ.get("SNAPRECON_TEST_SF", "/root/testdata/sf0.001")
QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = sorted(rows_of(df.columns, [tuple(r) for r in df.collect()]), key=repr)
    if name not in ORACLES:
        assert got is not None
        return
    res = con.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    want = sorted(rows_of(cols, res.fetchall()), key=repr)
    assert sorted(df.columns) == sorted(cols)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "matched_count" in df.columns
