"""Every registered query against its DuckDB oracle on the smallest tables (sf0.001)."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import _digest  # noqa: E402

SF = os.environ.get("VIGIL_TEST_SF", "/root/testdata/sf0.001")
QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    from vigil.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF)
    scols, srows = sdf.columns, [tuple(r) for r in sdf.collect()]
    cur = duck.execute(SQL[name])
    dcols, drows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(scols, srows)[0] == _digest(dcols, drows)[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 5 and "status" in df.columns
