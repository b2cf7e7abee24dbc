"""The driver contract: entry runs; every registered query equals its oracle at sf0.001."""

import duckdb
import pytest

from __spark_entry__ import entry
from shroud.registry import all_oracles, all_queries
from tools.check_oracle import TABLES, rows_multiset

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    df = entry(spark)
    assert df.count() >= 0 and "c_name" in df.columns


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(all_queries()))
def test_query_matches_oracle(spark, con, key):
    df = all_queries()[key](spark, SF)
    srows, scols = [tuple(r) for r in df.collect()], list(df.columns)
    res = con.execute(all_oracles()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert rows_multiset(scols, srows) == rows_multiset(ocols, orows)
