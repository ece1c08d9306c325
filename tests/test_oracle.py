"""Every registered query against its DuckDB oracle on the smallest test scale
(the driver repeats this at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import TABLES, rows_of
from letwise.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    missing = set(catalog.QUERIES) - set(E.oracle_sql())
    assert not missing, missing
    assert set(catalog.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert rows_of(df.columns, s_rows) == rows_of(d_cols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["state", "CPI", "n_listings", "n_rent", "mean_rent", "median_rent"]
