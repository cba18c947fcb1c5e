"""Every registered query against its SQL oracle (DuckDB) on the smallest test data."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from pitwall.plans import catalog

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def duck(small_dir):
    import os
    con = duckdb.connect()
    for t in TABLES:
        p = f"{small_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    return None if isinstance(v, float) and math.isnan(v) else v


def _key(row):
    return tuple((x is None, type(x).__name__ if x is not None else "", x if x is not None else 0)
                 for x in row)


def test_every_query_has_an_oracle():
    missing = set(NAMES) - set(E.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, small_dir, name):
    df = E.queries()[name](spark, small_dir)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = sorted(df.columns)
    si = [df.columns.index(c) for c in order]
    di = [rel.columns.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in df.collect()), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in rel.fetchall()), key=_key)
    assert len(a) == len(b)
    assert a == b


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "championship_position" in df.columns
