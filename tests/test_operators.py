"""Operators: as-of join, telemetry summary, SCD-2, idempotent append, DQ, plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitwall.operators import asof, ingest, quality, scd, telemetry
from pitwall.plans import catalog

T0 = dt.datetime(2024, 3, 2, 15, 0, 0)


def ts(sec):
    return T0 + dt.timedelta(seconds=sec)


# ----------------------------------------------------------------------------- as-of join

def _samples(spark, rows):
    return spark.createDataFrame(
        rows, "session_key long, driver_number long, sample_id long, date timestamp_ntz, "
              "n_gear long, speed double, throttle double, rpm double, brake double, drs long, "
              "meeting_key long")


def _starts(spark, rows):
    return spark.createDataFrame(
        rows, "session_key long, driver_number long, lap_number long, lap_start timestamp_ntz")


def test_asof_rules(spark):
    starts = _starts(spark, [(1, 7, 1, ts(100)), (1, 7, 2, ts(190)), (1, 7, 3, ts(190)),
                             (1, 7, 4, ts(300)), (1, 7, 5, None), (1, 8, 1, ts(0))])
    samples = _samples(spark, [
        (1, 7, 1, ts(50), 1, 1.0, 1.0, 1.0, 0.0, 0, 10),     # before the first lap → dropped
        (1, 7, 2, ts(100), 1, 1.0, 1.0, 1.0, 0.0, 0, 10),    # exactly on lap 1 start
        (1, 7, 3, ts(189), 1, 1.0, 1.0, 1.0, 0.0, 0, 10),
        (1, 7, 4, ts(190), 1, 1.0, 1.0, 1.0, 0.0, 0, 10),    # equal starts: later lap (3) wins
        (1, 7, 5, ts(5000), 1, 1.0, 1.0, 1.0, 0.0, 0, 10),   # after the last lap → last lap
        (1, 7, 6, None, 1, 1.0, 1.0, 1.0, 0.0, 0, 10),       # bad date → dropped
        (1, 9, 7, ts(200), 1, 1.0, 1.0, 1.0, 0.0, 0, 10),    # driver without laps → dropped
        (2, 7, 8, ts(200), 1, 1.0, 1.0, 1.0, 0.0, 0, 10),    # other session → dropped
    ])
    got = sorted((r.sample_id, r.lap_number) for r in telemetry.assign_laps(samples, starts).collect())
    assert got == [(2, 1), (3, 1), (4, 3), (5, 4)]


def test_asof_bucketed_equals_direct_and_brute_force(spark, small_dir):
    m = catalog.models(spark, small_dir)
    samples, starts = m["car_data"], m["lap_starts"]
    keys = ["session_key", "driver_number"]
    a = asof.asof_join(samples, starts, keys, "date", "lap_start", "lap_number")
    b = asof.asof_join_direct(samples, starts, keys, "date", "lap_start", "lap_number")
    ra = sorted((r.sample_id, r.lap_number) for r in a.select("sample_id", "lap_number").collect())
    rb = sorted((r.sample_id, r.lap_number) for r in b.select("sample_id", "lap_number").collect())
    assert ra == rb and len(ra) > 0
    # brute force in pandas, one key at a time
    s = samples.select("session_key", "driver_number", "sample_id", "date").toPandas()
    l = starts.toPandas()
    expect = []
    for (sk, dn), grp in s.dropna(subset=["date", "driver_number"]).groupby(["session_key", "driver_number"]):
        laps = l[(l.session_key == sk) & (l.driver_number == dn)].sort_values(["lap_start", "lap_number"])
        for _, row in grp.iterrows():
            before = laps[laps.lap_start <= row.date]
            if len(before):
                expect.append((int(row.sample_id), int(before.iloc[-1].lap_number)))
    assert ra == sorted(expect)


def test_gear_changes_and_shares(spark):
    # lap 3 is 4x the median lap length, so it spans several buckets (edges are stitched)
    starts = _starts(spark, [(1, 7, 1, ts(0)), (1, 7, 2, ts(1000)), (1, 7, 3, ts(2000)),
                             (1, 7, 4, ts(6000))])
    gears = [1, None, 2, 2, 3]                     # lap 1: 2 changes
    rows = [(1, 7, i, ts(10 * i), g, 100.0 + i, 50.0, 9000.0, b, d, 10)
            for i, (g, b, d) in enumerate(zip(gears, [None, 0.0, 100.0, 100.0, 0.0],
                                              [None, 8, 10, 12, 14]))]
    rows += [(1, 7, 10 + i, ts(1000 + i), None, 5.5, None, None, None, None, 10) for i in range(3)]
    # lap 3: gears spread over a long time so the lap spans several buckets
    lap3 = [3, 3, 4, 4, 5, 4, 4, 4, 6, 6]
    rows += [(1, 7, 100 + i, ts(2000 + 400 * i), g, 1.0, 1.0, 1.0, 0.0, 0, 10) for i, g in enumerate(lap3)]
    out = {r.lap_number: r for r in telemetry.car_data_lap_agg(_samples(spark, rows), starts).collect()}
    assert out[1].gear_changes == 2 and out[1].sample_count == 5
    assert out[1].avg_brake == 50.0                # NULL brake left out of both sides
    assert out[1].drs_usage_pct == 75.0            # 3 of 4 non-NULL DRS values open
    assert out[1].max_speed == 104 and out[1].min_speed == 100
    assert out[2].gear_changes == 0 and out[2].avg_throttle is None
    assert out[3].gear_changes == 4 and out[3].sample_count == 10
    assigned = telemetry.assign_laps(_samples(spark, rows), starts)
    assert assigned.filter("lap_number = 3").select("_bucket").distinct().count() >= 3


def test_rounded_mean_is_exact_half_up(spark):
    df = spark.createDataFrame([(1, 6.55), (1, 6.56), (2, 0.125), (2, 0.0)], "k int, x double")
    got = dict(df.groupBy("k").agg(telemetry.rounded_mean(F.col("x")).alias("m")).collect())
    assert got == {1: 6.56, 2: 0.06}


# ----------------------------------------------------------------------------------- SCD-2

def _hist(spark, rows):
    return spark.createDataFrame(rows, "driver_number int, team_name string, driver_name string, "
                                       "latest_session_key long, run_ts timestamp_ntz")


def test_scd_replay_spells(spark):
    seq = [("A", "x"), ("A", "y"), ("B", "y"), ("A", "y")]           # A, A, B, A
    rows = [(1, t, n, k, ts(k)) for k, (t, n) in enumerate(seq)]
    rows += [(2, None, "n", 0, ts(0)), (2, "C", "n", 1, ts(1))]        # NULL → C
    snap = scd.replay(_hist(spark, rows), "driver_number", ["team_name"],
                      ["latest_session_key"], "run_ts", ["team_name", "driver_name", "latest_session_key"])
    got = {(r.driver_number, r.team_name, r.driver_name, r.valid_from, r.valid_to)
           for r in snap.collect()}
    assert got == {(1, "A", "x", ts(0), ts(2)), (1, "A", "y", ts(3), None), (1, "B", "y", ts(2), ts(3)),
                   (2, None, "n", ts(0), ts(1)), (2, "C", "n", ts(1), None)}


def test_scd_increment_equals_replay_fold(spark):
    seq = {1: ["A", "A", "B", "A"], 2: [None, "C", "C", "C"], 3: [None, None, "D", "E"]}
    rows = [(d, t, f"n{k}", k, ts(k)) for d, teams in seq.items() for k, t in enumerate(teams)]
    hist = _hist(spark, rows)
    attrs = ["team_name", "driver_name", "latest_session_key"]
    snap = scd.replay(hist.filter("latest_session_key = 0"), "driver_number", ["team_name"],
                      ["latest_session_key"], "run_ts", attrs)
    for k in (1, 2, 3):
        cur = hist.filter(F.col("latest_session_key") == k).select("driver_number", *attrs)
        snap = scd.increment(snap, cur, "driver_number", ["team_name"], attrs, ts(k))
    full = scd.replay(hist, "driver_number", ["team_name"], ["latest_session_key"], "run_ts", attrs)
    cols = ["driver_number", "team_name", "driver_name", "valid_from", "valid_to", "scd_id"]
    assert sorted(map(tuple, snap.select(*cols).collect()), key=str) == \
        sorted(map(tuple, full.select(*cols).collect()), key=str)
    open_per_driver = snap.filter("valid_to IS NULL").groupBy("driver_number").count().collect()
    assert all(r["count"] == 1 for r in open_per_driver)


# --------------------------------------------------------------------------- append / DQ

def test_insert_absent_first_wins_and_idempotent(spark):
    target = spark.createDataFrame([(1, 1, "old")], "k int, j int, v string")
    batch = spark.createDataFrame([(1, 1, "dup", 1), (2, 1, "first", 1), (2, 1, "second", 2),
                                   (None, 1, "nullkey", 3)], "k int, j int, v string, o int")
    b = batch.drop("o")
    once = ingest.append_absent(batch, target.withColumn("o", F.lit(0)), ["k", "j"], ["o"]).drop("o")
    assert sorted(map(tuple, once.collect()), key=str) == \
        sorted([(1, 1, "old"), (2, 1, "first"), (None, 1, "nullkey")], key=str)
    twice = ingest.append_absent(b.filter("k IS NOT NULL"), once, ["k", "j"], ["v"])
    assert twice.count() == once.count()


def test_dq_checks(spark):
    df = spark.createDataFrame([(1, "SOFT"), (1, "PURPLE"), (None, "PURPLE"), (2, None), (3, "X")],
                               "k int, compound string")
    rep = quality.report({"t": df}, [quality.TableChecks(
        "t", not_null=("k", "compound"), unique=("k",), accepted={"compound": ("SOFT",)},
        non_empty=True)])
    got = {(r.column_name, r.check_name): (r.failures, r.passed) for r in rep.collect()}
    assert got == {("k", "not_null"): (1, False), ("compound", "not_null"): (1, False),
                   ("k", "unique"): (1, False), ("compound", "accepted_values"): (2, False),
                   (None, "non_empty"): (0, True)}


# ---------------------------------------------------------------------------------- plans

def _plan(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plan_has_no_cartesian_or_python(spark, small_dir, name):
    plan = _plan(catalog.run(name, spark, small_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "PythonUDF"):
        assert bad not in plan, f"{name}: {bad}"


def test_scans_prune_columns(spark, small_dir, tmp_path):
    from pitwall.plans import staging
    catalog.models(spark, small_dir)["raw_laps"].write.parquet(f"{tmp_path}/laps")
    df = staging.stg_laps(spark.read.parquet(f"{tmp_path}/laps")).select("session_key", "lap_duration")
    plan = _plan(df)
    read = [line for line in plan.splitlines() if line.startswith("ReadSchema:")]
    assert read == ["ReadSchema: struct<session_key:bigint,driver_number:int,lap_number:int,"
                    "lap_duration:double>"]
    assert "PushedFilters: [IsNotNull(session_key), IsNotNull(driver_number), IsNotNull(lap_number)]" in plan


def test_write_absent_counts_and_run_log(spark):
    import tempfile
    path = tempfile.mkdtemp(prefix="pitwall-wa-") + "/t"
    b1 = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k long, v string, o long")
    assert ingest.write_absent(b1, path, ["k"], ["o"]) == {"sent": 2, "inserted": 2, "rejected": 0}
    b2 = spark.createDataFrame([(2, "x", 1), (3, "c", 1), (3, "d", 2)], "k long, v string, o long")
    assert ingest.write_absent(b2, path, ["k"], ["o"]) == {"sent": 3, "inserted": 1, "rejected": 0}
    # a replay inserts nothing, and rows without a key never get in
    b3 = b2.unionByName(spark.createDataFrame([(None, "n", 1)], b2.schema))
    for _ in range(2):
        assert ingest.write_absent(b3, path, ["k"], ["o"]) == {"sent": 4, "inserted": 0, "rejected": 1}
    assert spark.read.parquet(path).count() == 3
    # a table that cannot be read is an error, not an empty table
    from pathlib import Path
    broken = Path(tempfile.mkdtemp(prefix="pitwall-wa-")) / "t"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        ingest.write_absent(b1, str(broken), ["k"], ["o"])
    counts = ingest.load_counts({"a": b1, "b": b2})
    row = ingest.run_log_row(counts, "run-7").first()
    assert row.run_id == "run-7" and row.total_rows == 5
    assert row.rows_loaded == '{"a":2,"b":3}'


def test_max_ratio_rejects_slow_laps(spark, small_dir):
    from pitwall.plans import enrich
    m = catalog.models(spark, small_dir)
    stg = {n: m[n] for n in ("stg_laps", "stg_stints", "stg_drivers", "stg_sessions",
                             "stg_car_data_lap_agg")}
    base = enrich.int_laps_enriched(stg)
    strict = enrich.int_laps_enriched(stg, max_ratio=1.0)
    n_base = base.filter("is_valid_lap").count()
    n_strict = strict.filter("is_valid_lap").count()
    assert 0 < n_strict < n_base and strict.count() == base.count()


def test_asof_spreads_a_hot_key_over_many_join_keys(spark):
    # one driver with 100 laps of ~90 s and 3.2 samples/s (a third of a race's telemetry)
    laps = [(1, 44, n, ts(90 * n + (n % 7))) for n in range(1, 101)]
    starts = _starts(spark, laps)
    samples = spark.range(0, 29000).select(
        F.lit(1).cast("long").alias("session_key"), F.lit(44).cast("long").alias("driver_number"),
        F.col("id").alias("sample_id"),
        (F.lit(ts(90)).cast("timestamp") + F.make_dt_interval(secs=(F.col("id") * 0.3125).cast("decimal(18,6)")))
        .cast("timestamp_ntz").alias("date"))
    out = asof.asof_join(samples, starts, ["session_key", "driver_number"], "date", "lap_start",
                         "lap_number")
    assert out.count() == 29000 - 4                   # the 4 samples before lap 1 (91 s) drop
    direct = asof.asof_join_direct(samples, starts, ["session_key", "driver_number"], "date",
                                   "lap_start", "lap_number")
    assert sorted(map(tuple, out.select("sample_id", "lap_number").collect())) == \
        sorted(map(tuple, direct.select("sample_id", "lap_number").collect()))


def _largest_task(spark, df, **conf):
    """Rows of the largest output partition, without broadcasts and partition coalescing."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", **conf}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = df().groupBy(F.spark_partition_id()).count().collect()
        return max(r["count"] for r in rows), sum(r["count"] for r in rows)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("laps", [120, 1])               # with one lap, all samples are its tail
def test_asof_hot_key_spreads_over_tasks(spark, laps):
    starts = _starts(spark, [(1, 44, n, ts(90 * n)) for n in range(1, laps + 1)])
    samples = spark.range(0, 200_000).select(
        F.lit(1).cast("long").alias("session_key"), F.lit(44).cast("long").alias("driver_number"),
        F.col("id").alias("sample_id"),
        (F.lit(ts(90)).cast("timestamp") + F.make_dt_interval(secs=(F.col("id") * 0.3).cast("decimal(18,6)")))
        .cast("timestamp_ntz").alias("date"))
    most, total = _largest_task(spark, lambda: asof.asof_join(
        samples, starts, ["session_key", "driver_number"], "date", "lap_start", "lap_number"))
    assert total == 200_000 and most < total / 5


def test_enriched_laps_split_a_hot_driver(spark):
    """One driver-session with most laps, above lap 9999 in an open stint."""
    from pitwall.plans import enrich
    laps = spark.range(1, 200_001).select(
        F.lit(1).cast("long").alias("session_key"), F.lit(44).alias("driver_number"),
        F.col("id").cast("int").alias("lap_number"), F.lit(90.0).alias("lap_duration"), F.rand(1).alias("x"))
    stints = spark.createDataFrame([(1, 44, 1, "SOFT", 0, 1, 5000, True), (1, 44, 2, "HARD", 0, 5001, None, True)],
                                   "session_key long, driver_number int, stint_number int, compound string, "
                                   "tyre_age_at_start int, lap_start int, lap_end int, is_fresh_tyre boolean")
    make = lambda: enrich.laps_with_stints(laps.repartition(16), stints)
    got = make().groupBy("stint_number").count().collect()
    assert {r.stint_number: r["count"] for r in got} == {1: 5000, 2: 195_000}
    most, total = _largest_task(spark, make, **{
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k"})
    assert total == 200_000 and most < total / 3


def test_cumulative_points_equal_season_sums(spark, small_dir):
    season = catalog.run("fct_driver_season", spark, small_dir)
    last = (season.groupBy("season_year", "driver_number")
                  .agg(F.max_by("cumulative_points", "race_number_in_season").alias("last_cum"),
                       F.sum("race_points").alias("total"),
                       F.max("race_number_in_season").alias("n"), F.count(F.lit(1)).alias("rows")))
    bad = last.filter("last_cum <> total OR n <> rows").count()
    assert bad == 0 and last.count() > 0


def test_dedup_and_first_wins_with_a_hot_key(spark):
    from pitwall.operators.dedup import latest_per_key
    # a third of all rows are re-sent copies of one key
    hot = spark.range(0, 30000).select(F.lit(7).alias("k"), F.col("id").alias("o"),
                                       (F.col("id") % 5).cast("string").alias("v"))
    cold = spark.range(0, 60000).select((F.col("id") + 100).alias("k"), F.lit(0).cast("long").alias("o"),
                                        F.lit("x").alias("v"))
    rows = hot.unionByName(cold)
    latest = latest_per_key(rows, ["k"], order=[("o", True)])
    first = ingest.first_per_key(rows, ["k"], ["o"])
    assert latest.count() == first.count() == 60001
    assert latest.filter("k = 7").first().o == 29999
    assert first.filter("k = 7").first().o == 0
    # the pick is an aggregate with a map-side (partial) step before the shuffle
    plan = _plan(latest)
    tree = plan.split("\n\n\n")[0]
    assert tree.count("SortAggregate") >= 2 and "Window" not in tree
