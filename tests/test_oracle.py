"""Every registered query against its DuckDB oracle (order-insensitive)."""

import decimal
import importlib

import duckdb
import pytest

from tests.conftest import SF_SMALL

entry = importlib.import_module("__spark_entry__")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    return v


def key(r):
    return tuple((x is None, str(x)) for x in r)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    from hourglass.plans import catalog

    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["url", "granularity", "bucket", "total_pageviews"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=key)
    rel = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in rel.fetchall()), key=key)
    assert got == want
