"""Stored tables: publication, keyed append, spell layout."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from pitwall.operators import ingest, keyed, scd, spells, versions
from pitwall.plans import catalog, pipeline
from pitwall.sources import fixtures


def _scratch() -> str:
    return tempfile.mkdtemp(prefix="pitwall-tables-")


# --- publication ------------------------------------------------------------------------

def test_readers_see_whole_versions(spark):
    path = _scratch() + "/t"
    with pytest.raises(versions.NotPublished):
        versions.read(spark, path)
    one = spark.range(100).withColumn("v", F.lit("one"))
    assert versions.publish(one, path, "a") == 1
    before = versions.read(spark, path)
    two = spark.range(50).withColumn("v", F.lit("two"))
    versions.stage(two, path, "b")                              # written, not committed
    assert {r.v for r in versions.read(spark, path).collect()} == {"one"}
    assert versions.commit(spark, path, "b", 50) == 2
    assert versions.read(spark, path).count() == 50
    assert before.count() == 100                                # a reader that began keeps its version


def test_failed_jobs_and_refused_versions_change_nothing(spark):
    path = _scratch() + "/t"
    versions.publish(spark.range(10), path, "good")
    broken = spark.range(0, 1000, 1, 8).select(
        F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        versions.publish(broken, path, "broken")

    def refuse(written):
        assert written.count() == 5
        raise catalog.Refused("no")
    with pytest.raises(catalog.Refused):
        versions.publish(spark.range(5), path, "refused", check=refuse)
    assert versions.committed(spark, path)["version"] == "good" and versions.read(spark, path).count() == 10
    with pytest.raises(Exception):                              # a version is written once
        versions.publish(spark.range(3), path, "good")
    assert versions.read(spark, path).count() == 10
    assert versions.expire(spark, path, keep=1) == ["broken", "refused"]
    assert versions.publish(spark.range(7), path, "next") == 2
    assert versions.expire(spark, path, keep=1) == ["good"] and versions.read(spark, path).count() == 7


def test_empty_version_and_two_publishers(spark):
    path = _scratch() + "/t"
    versions.publish(spark.range(10).filter("id < 0"), path, "empty")
    assert versions.read(spark, path).collect() == []
    versions.commit(spark, path, "x", 1)
    row = spark.createDataFrame([(2, "y", 1, None)], versions.COMMIT)
    row.coalesce(1).write.mode("append").parquet(f"{path}/commits/{2:010d}")
    with pytest.raises(RuntimeError, match="two publishers"):
        versions.read(spark, path)


def test_refused_build_leaves_the_last_release(spark, small_dir):
    root = _scratch()
    old = versions.version_path(pipeline.layer_path(root, "dim_drivers"), "old")
    spark.range(3).write.parquet(old)
    versions.release(spark, f"{root}/releases", "old", {"dim_drivers": old})
    # a check that the data fails, made a condition of the release
    must = frozenset({("fct_race_results", "finish_position", "not_null"), ("dim_drivers", "driver_number", "unique")})
    with pytest.raises(pipeline.ChecksFailed) as refused:
        pipeline.build(spark, fixtures.raw_tables(spark, small_dir), root, "new", "run-2", required=must)
    assert {(r["table_name"], r["column_name"]) for r in refused.value.failures} <= {t[:2] for t in must}
    built = pipeline.built(spark, root)
    assert list(built) == ["dim_drivers"] and built["dim_drivers"].count() == 3
    # what was refused is all there, for a look at it, and in the log
    assert spark.read.parquet(versions.version_path(pipeline.layer_path(root, "fct_lap_times"), "new")).count() > 0
    log = spark.read.parquet(pipeline.layer_path(root, "dq_report"))
    assert {r.run_id for r in log.select("run_id").distinct().collect()} == {"run-2"}


# --- keyed append -----------------------------------------------------------------------

SCHEMA = "s long, d int, l int, v string, t long"


def _feed(spark, rng, sessions, n=60):
    rows = [(rng.choice(sessions), rng.randint(1, 5), rng.choice([None, *range(1, 30)]), f"v{rng.random()}", rng.randint(0, 9))
            for _ in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("null_keys", ["insert", "reject"])
def test_equals_the_plain_append(spark, null_keys):
    rng, path = random.Random(4), _scratch() + "/t"
    want = spark.createDataFrame([], SCHEMA)
    for i, sessions in enumerate(([1, 2], [2, 3], [9], [1, 9, 4])):
        rows, batch = _feed(spark, rng, sessions)
        got = keyed.append_absent(batch, path, f"b{i}", ["s", "d", "l"], ["t"], null_keys)
        keyless = sum(r[2] is None for r in rows)
        before = want.count()
        if null_keys == "reject":
            batch = batch.filter("l IS NOT NULL")
        want = spark.createDataFrame(ingest.append_absent(batch, want, ["s", "d", "l"], ["t"]).collect(), SCHEMA)
        assert got["sent"] == len(rows) and got["inserted"] == want.count() - before
        assert got["rejected"] == (keyless if null_keys == "reject" else 0)
    stored = keyed.read(spark, path, want.schema)
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, want.collect()))


def test_reads_only_files_that_can_hold_a_key(spark):
    path = _scratch() + "/t"
    for s in range(20):
        batch = spark.range(200).selectExpr(f"{s}L AS s", "CAST(id % 4 AS INT) AS d", "CAST(id DIV 4 AS INT) AS l", "'v' AS v", "0L AS t")
        got = keyed.append_absent(batch.coalesce(1), path, f"load-{s}", ["s", "d", "l"], ["t"])
        assert (got["inserted"], got["files"], got["files_read"]) == (200, s, 0)       # a new session meets no file
    again = spark.range(0, 200, 40).selectExpr("7L AS s", "CAST(id % 4 AS INT) AS d", "CAST(id DIV 4 AS INT) AS l", "'w' AS v", "1L AS t")
    got = keyed.append_absent(again, path, "again", ["s", "d", "l"], ["t"])
    assert (got["inserted"], got["files"], got["files_read"]) == (0, 20, 1)            # a re-sent one meets its own
    beyond = spark.range(1).selectExpr("7L AS s", "1 AS d", "900 AS l", "'w' AS v", "1L AS t")
    got = keyed.append_absent(beyond, path, "beyond", ["s", "d", "l"], ["t"])
    assert (got["inserted"], got["files_read"]) == (1, 1 if got["files_read"] else 0)
    assert keyed.read(spark, path, batch.schema).count() == 4001


def test_no_file_with_a_key_is_missing_from_the_candidates(spark):
    rng, path = random.Random(8), _scratch() + "/t"
    for i in range(6):
        rows, batch = _feed(spark, rng, list(range(8)), 300)
        keyed.append_absent(batch.repartition(3), path, f"b{i}", ["s", "d", "l"], ["t"])
    stored = keyed.read(spark, path, batch.schema).select("*", F.col("_metadata.file_path").alias("file"))
    for _ in range(5):
        _, probe = _feed(spark, rng, list(range(10)), 5)
        holding = {r.file for r in stored.join(probe.select("s", "d", "l"), ["s", "d", "l"], "left_semi").collect()}
        assert holding <= set(keyed.candidate_files(probe, keyed.index(spark, path), ["s", "d", "l"]))


def test_files_of_an_append_are_ranges_of_the_key(spark):
    """An index entry per file and session that meet: about files + sessions, not files x sessions."""
    path, keys = _scratch() + "/t", ["s", "d", "l"]
    batch = spark.range(0, 4000, 1, 4).selectExpr("id % 40 AS s", "CAST(id DIV 40 % 4 AS INT) AS d", "CAST(id DIV 160 AS INT) AS l",
                                                  "'v' AS v", "0L AS t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert keyed.append_absent(batch, path, "one", keys, ["t"])["inserted"] == 4000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = len(keyed.files(spark, path))
    assert files > 1 and keyed.index(spark, path).count() <= 40 + files
    some = batch.filter("s = 7")
    assert len(keyed.candidate_files(some, keyed.index(spark, path), keys)) < files
    assert keyed.append_absent(batch, path, "again", keys, ["t"])["inserted"] == 0


@pytest.mark.parametrize("keys", [["s"], ["s", "d"], ["s", "d", "l"]])
def test_index_bounds_equal_those_of_whole_keys(spark, keys):
    rng = random.Random(5)
    rows = [tuple(rng.choice([None, *range(4)]) for _ in range(3)) + (i % 3,) for i in range(400)]
    df = spark.createDataFrame(rows, "s long, d int, l int, file int")
    df = df.withColumn("has", keyed._has_key(keys)).withColumn("lead", F.when(F.col("has"), F.col("s")))
    want = {}
    for s, d, l, file in rows:
        key = (s, d, l)[:len(keys)]
        n, some = want.setdefault((file, None if None in key else s), [0, []])
        want[file, None if None in key else s] = [n + 1, some if None in key else [*some, key[1:] or (0,)]]
    got = {(r.file, r.lead): [r.rows, r.low and tuple(r.low), r.high and tuple(r.high)] for r in keyed._ranges(df, keys).collect()}
    assert got == {k: [n, min(some, default=None), max(some, default=None)] for k, (n, some) in want.items()}


def test_first_row_per_key_sorts_once_and_collapses_copies_first(spark):
    rows = [(1, None, "b"), (1, 2, "a"), (1, None, "a"), (2, 5, None), (2, 5, "z"), (2, 5, None), (None, 1, "x"), (None, 1, "x")]
    first = ingest.first_per_key(spark.createDataFrame(rows, "k int, o int, v string"), ["k"], ["o"])
    assert sorted(map(tuple, first.collect()), key=repr) == sorted([(1, None, "a"), (2, 5, None), (None, 1, "x"), (None, 1, "x")], key=repr)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")   # kept per task first


# --- marts --------------------------------------------------------------------------------

def test_laps_meet_stored_aggregates_without_a_shuffle(spark, small_dir):
    laps = catalog.q_fct_lap_times(spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert laps.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in laps and "Window" not in laps
    m = catalog.models(spark, small_dir, stored=("lap_base", "stg_stints", "stg_drivers", "stg_sessions"))
    enriched = m["int_laps_enriched"]._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in enriched.splitlines() if "Join LeftOuter" in line]
    assert len(joins) == 4 and "lap_number" in joins[-1] and "lap_start" not in joins[-1]   # the telemetry first


def test_lap_mart_is_written_once_for_its_layout(spark, small_dir):
    from pitwall.session import checkpoint_dir
    top = f"{checkpoint_dir(spark)}/pitwall-tables"
    had = {f for f in os.listdir(top)} if os.path.isdir(top) else set()
    found = {r.model: r for r in catalog.q_mart_layout(spark, small_dir).collect()}
    assert set(found) == set(pipeline.ORDER_OF) and all(r.rows > 0 and (r.overlaps, r.unordered) == (0, 0) for r in found.values())
    assert len([f for f in set(os.listdir(top)) - had if f.startswith("fct_lap_times-")]) == 1


def test_replayed_and_broken_batches(spark):
    path = _scratch() + "/t"
    batch = spark.range(10).selectExpr("id AS k", "0 AS t")
    assert keyed.append_absent(batch, path, "one", ["k"], ["t"])["inserted"] == 10
    assert keyed.append_absent(batch, path, "one", ["k"], ["t"])["inserted"] == 0
    spark.range(5, 20).selectExpr("id AS k", "0 AS t").write.parquet(f"{path}/data/two")     # no index: never committed
    assert keyed.read(spark, path, batch.schema).count() == 10
    assert keyed.append_absent(spark.range(5, 20).selectExpr("id AS k", "0 AS t"), path, "two", ["k"], ["t"])["inserted"] == 10
    assert sorted(r.k for r in keyed.read(spark, path, batch.schema).collect()) == list(range(20))
    empty = batch.limit(0)
    assert keyed.append_absent(empty, path, "none", ["k"], ["t"])["inserted"] == 0
    assert keyed.read(spark, _scratch() + "/absent", batch.schema).collect() == []


# --- spells -----------------------------------------------------------------------------

def test_rounds_equal_the_replay_and_leave_closed_files(spark):
    rng, path = random.Random(2), _scratch() + "/t"
    schema = "k int, team string, note string"
    seen, names = [], set()
    for n in range(4):
        rows = [(k, rng.choice(["a", "b", None]), f"{n}-{k}") for k in range(30) if rng.random() < 0.8]
        ts = dt.datetime(2020, 1, 1 + n)
        seen += [(*r, ts, n) for r in rows]
        assert spells.advance(spark.createDataFrame(rows, schema), path, f"r{n}", "k", ["team"], ["team", "note"], ts) == n + 1
        closed = {f for r in range(n + 1) for f in _files(f"{path}/rounds/r{r}/state=closed")}
        assert names <= closed                                  # nothing closed was rewritten
        names = closed
    history = spark.createDataFrame(seen, schema + ", at timestamp_ntz, n int")
    want = scd.replay(history, "k", ["team"], ["n"], "at", ["team", "note"])
    got = spells.read(spark, path)
    cols = sorted(want.columns)
    assert sorted(map(repr, got.select(*cols).collect())) == sorted(map(repr, want.select(*cols).collect()))


def test_a_round_reads_only_open_spells(spark):
    path = _scratch() + "/t"
    for n in range(3):
        rows = spark.range(50).selectExpr("CAST(id AS INT) AS k", f"concat('t', id * 0 + {n}) AS team")
        spells.advance(rows, path, f"r{n}", "k", ["team"], ["team"], dt.datetime(2020, 1, 1 + n))
    rounds, schema = spells._history(spark, path)
    opened = spells._spells(spark, path, rounds[-1:], spells.OPEN, schema)
    assert opened.count() == 50 and all("state=open" in f for f in opened.select("_metadata.file_path").toPandas()["file_path"])
    spark.range(3).write.parquet(f"{path}/rounds/lost/state=open")                # a round without a commit
    assert spells.read(spark, path).count() == 150
    with pytest.raises(ValueError):
        spells.advance(rows, path, "r2", "k", ["team"], ["team"], dt.datetime(2021, 1, 1))


def _files(folder: str) -> set[str]:
    return {os.path.join(folder, f) for f in os.listdir(folder) if f.endswith(".parquet")} if os.path.isdir(folder) else set()
