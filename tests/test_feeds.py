"""Rejects, column discovery, stored order, views."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from pitwall.operators import layout, versions
from pitwall.plans import views
from pitwall.sources import landing


def _lines(spark, rows):
    folder = tempfile.mkdtemp(prefix="pitwall-feed-") + "/lines"
    spark.createDataFrame([(r,) for r in rows], "value string").write.text(folder)
    return spark.read.text(folder)


def test_rejects_name_their_reason_and_line(spark):
    rows = ['{"k": 1, "n": 2, "v": "a"}', '{"k": 1, "n":', 'plain words', '[1, 2]', '{"n": 2}', '{"k": 3}', "", "  ",
            '{"k": "x", "n": 1}', '{"k": 4, "n": 5, "extra": {"a": 1}}', "null"]
    schema = spark.createDataFrame([], "k long, n long, v string").schema
    records = landing.with_rejects(_lines(spark, rows), schema, ["k", "n"])
    good = landing.accepted(records)
    assert good.columns == ["k", "n", "v"]
    assert sorted(map(tuple, good.collect()), key=repr) == [(1, 2, "a"), (4, 5, None)]
    bad = {r.line: r.reason for r in landing.rejects(records).collect()}
    assert bad.pop('{"n": 2}') == "no k" and bad.pop('{"k": 3}') == "no n"
    assert bad.pop("[1, 2]") in ("malformed", "no k") and bad.pop("null") in ("malformed", "no k")
    assert bad == {rows[1]: "malformed", rows[2]: "malformed", rows[8]: "malformed"}
    assert all(r.file for r in landing.rejects(records).collect())
    assert landing.with_rejects(_lines(spark, []), schema, ["k"]).collect() == []


def test_discovered_columns(spark):
    rows = [f'{{"k": {i}}}' for i in range(500)]
    rows[123] = '{"k": 123, "late": "x", "deep": {"a": [1, 2]}}'
    rows[77] = '{"k": 77, "x": 1}'
    rows[78] = '{"k": 78, "x": 1.5, "gone": null}'
    rows[79] = "not a record"
    found = landing.read_discovered(_lines(spark, rows))
    assert dict(found.dtypes) == {"k": "bigint", "late": "string", "x": "double", "gone": "string", "deep": "struct<a:array<bigint>>"}
    assert found.filter("k IS NOT NULL").count() == 499
    assert found.filter("k = 123").first().deep.a == [1, 2] and found.filter("k = 78").first().x == 1.5
    with pytest.raises(ValueError):
        landing.read_discovered(_lines(spark, ["1", "2"]))


def test_stored_order_is_checked(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, *range(5)]), "x" * 50) for _ in range(3000)]
    df, path = spark.createDataFrame(rows, "a int, b int, v string"), tempfile.mkdtemp(prefix="pitwall-order-")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout.write_ordered(df.repartition(4), path, "good", ["a", "b"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    good = spark.read.parquet(versions.version_path(path, "good"))
    assert len(good.inputFiles()) > 1
    assert tuple(layout.layout(good, ["a", "b"]).first()) == (3000, 0, 0)
    last = good.select("a", F.col("_metadata.file_path").alias("f")).filter("a IS NULL").select("f").distinct().collect()
    assert len(last) >= 1
    versions.stage(df.repartition(4), path, "loose", order=["a", "b"])          # sorted files that overlap
    found = layout.layout(spark.read.parquet(versions.version_path(path, "loose")), ["a", "b"]).first()
    assert found.overlaps == 3 and found.unordered == 0
    versions.stage(df.coalesce(1), path, "none")
    assert layout.layout(spark.read.parquet(versions.version_path(path, "none")), ["a", "b"]).first().unordered > 0
    versions.stage(df.limit(0), path, "empty")
    assert tuple(layout.layout(spark.read.schema(df.schema).parquet(versions.version_path(path, "empty")), ["a"]).first()) == (0, 0, 0)


def test_views(spark):
    models = {"m_one": spark.range(5).toDF("a"), "m_two": spark.range(3).toDF("a")}
    spark.range(9).createOrReplaceTempView("m_two")
    out = views.query(spark, models, models, "SELECT count(*) AS n FROM m_one JOIN m_two USING (a)")
    assert out.first().n == 3
    assert spark.table("m_two").count() == 9 and not spark.catalog.tableExists("m_one")
    made = views.register(models, prefix="p_")
    assert made == ["p_m_one", "p_m_two"] and spark.sql("SELECT max(a) AS a FROM p_m_one").first().a == 4
    views.drop(spark, [*made, "m_two"])
    with pytest.raises(Exception):
        views.query(spark, models, ["m_one"], "SELECT nonsense FROM m_one")
    assert not spark.catalog.tableExists("m_one")
