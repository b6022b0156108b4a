"""Every registered query with an oracle returns the oracle's rows (sf0.001).

Same comparison as the driver's gate: column names, row count and the
multiset of rows (floats compared exactly after -0.0 normalisation)."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import rows_of
from turnstone.sources.tables import TABLES

from conftest import SF_SMALL

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    s_rows = [r.asDict(recursive=True) for r in sdf.collect()]
    rel = duck.sql(ORACLES[name])
    d_rows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    cols = sorted(sdf.columns)
    assert cols == sorted(rel.columns)
    assert len(s_rows) == len(d_rows)
    assert rows_of(s_rows, cols) == rows_of(d_rows, cols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "turnover_rate_pct" in df.columns


def test_every_query_has_a_callable():
    q = E.queries()
    assert set(ORACLES) <= set(q)
    assert len(q) >= 70
