"""Every catalog query against its DuckDB oracle SQL on sf0.001."""

import duckdb
import pytest

from conftest import SF0001
from __spark_entry__ import entry, oracle_sql, queries
from quarry.plans.catalog import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "events", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def _norm(df):
    cols = sorted(df.columns)
    rows = []
    for rec in df[cols].itertuples(index=False, name=None):
        rows.append(tuple(None if v is None or (isinstance(v, float) and v != v) else str(v) for v in rec))
    return cols, sorted(rows, key=repr)


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    got = queries()[name](spark, SF0001).toPandas()
    want = duck.sql(oracle_sql()[name]).df()
    gc, gr = _norm(got)
    wc, wr = _norm(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["query_id", "rank", "page_id", "url", "score"]
    assert df.count() > 0
