"""Registered queries against their SQL, and against labels held out from fitting."""

import os

import pytest

from pitwall.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, duck, small_dir, name):
    df = queries.QUERIES[name](spark, small_dir)
    rel = duck.sql(queries.ORACLE_SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    mine = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    at = [rel.columns.index(c) for c in cols]
    theirs = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)
    assert mine == theirs


def test_names():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_oracle_values_are_sql():
    assert all(isinstance(sql, str) for sql in queries.ORACLE_SQL.values())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_language_on_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = queries.QUERIES["op2_language_id"](spark, SF).join(docs, "doc_id").filter("held_out")
    rows = got.collect()
    assert len(rows) > 100
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_toxicity_on_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = queries.QUERIES["op5_toxicity_ftrl"](spark, sf).join(labels, "doc_id").filter("held_out").collect()
    clean, toxic = [r for r in rows if not r.toxic], [r for r in rows if r.toxic]
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)
    # about a quarter of the toxic rows are labelled by chance and hold no sign of it
    assert sum(r.predicted for r in toxic) >= 0.45 * len(toxic)
