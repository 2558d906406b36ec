"""Driver contract and SQL-oracle parity of every registered query (sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as entry
from kestrel.sources.tables import TABLES
from tools.oracle_check import _rows

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["feature", "metric", "deviation", "threshold", "drift_detected"]
    assert len(rows) == 3


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 140


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle_parity(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _rows(df.columns, srows) == _rows(ocols, orows)
