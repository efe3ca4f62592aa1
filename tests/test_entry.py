"""Driver contract: entry runs, queries and oracle keys line up, and every
query with an oracle matches it on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tools.oracle_check import TABLES, digest
from touchline.oracle import oracle_sql
from touchline.plans.catalog import QUERIES


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["session_id", "user_pseudo_id", "date", "session_start", "source", "medium",
                          "campaign", "channel"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(entry_mod.queries())
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_small, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_small, con, name):
    df = entry_mod.queries()[name](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry_mod.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
