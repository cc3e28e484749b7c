"""Every batch query key against its DuckDB oracle on sf0.001 (the driver uses sf0.01)."""

import duckdb
import pytest

from chargepulse.plans.catalog import ORACLE, QUERIES
from chargepulse.sources.fixtures import TABLES

from conftest import SF001
from tools.oracle_check import canon


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql, queries
    from chargepulse.streaming.catalog import STREAM_QUERIES
    assert {*QUERIES, *STREAM_QUERIES} <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF001)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(ORACLE[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert canon(scols, srows) == canon(ocols, orows)


def test_entry(spark):
    from __spark_entry__ import entry
    assert entry(spark).count() > 0
