"""Every query that has SQL gives the same rows in another engine."""

from collections import Counter

import duckdb
import pandas as pd
import pytest

from tickloom import oracle, oracle_contracts, oracle_plans, queries, queries_contracts, queries_plans

ORACLES, QUERIES = oracle.ORACLES | oracle_contracts.ORACLES | oracle_plans.ORACLES, queries.QUERIES | queries_contracts.QUERIES | queries_plans.QUERIES

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents conversations".split()


@pytest.fixture(scope="module")
def other():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(frame: pd.DataFrame) -> Counter:
    frame = frame[sorted(frame.columns)].astype(object)
    return Counter(tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, other, name):
    got, want = QUERIES[name](spark, SF).toPandas(), other.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) and rows(got) == rows(want)


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
