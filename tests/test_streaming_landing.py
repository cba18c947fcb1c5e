"""Landed JSON feeds, lineage stamps, layer writes and the streaming appenders."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from pitwall.operators import telemetry
from pitwall.plans import catalog, pipeline
from pitwall.sources import fixtures, landing, schemas
from pitwall.streaming.landing_stream import append_stream, telemetry_stream


def _scratch():
    return tempfile.mkdtemp(prefix="pitwall-t-")


def test_json_landing_roundtrip_matches_parquet_path(spark, small_dir):
    m = catalog.models(spark, small_dir)
    raw = fixtures.derived_tables(spark, small_dir)["car_data"]
    out = _scratch()
    # land per-session files (one read later concatenates them all)
    raw.write.partitionBy("session_key").mode("overwrite").json(f"{out}/car_data")
    back = landing.read_landed_json(spark, f"{out}/car_data", schemas.CAR_DATA_TEXT.add("sample_id", "long"))
    agg = telemetry.car_data_lap_agg(landing.typed_car_data(back), m["lap_starts"])
    a = sorted(map(tuple, agg.collect()))
    b = sorted(map(tuple, m["telemetry_lap_agg"].select(*agg.columns).collect()))
    assert a == b and len(a) > 0


def test_conform_union_stamp_and_json_text(spark):
    a = spark.createDataFrame([(1, 2, 3, 90.5)], "session_key long, driver_number int, lap_number int, lap_duration double")
    b = spark.createDataFrame([(1, 2, 4, "x", [1, 2])],
                              "session_key long, driver_number int, lap_number int, junk string, segs array<int>")
    u = landing.union_feeds([a, b])
    c = landing.conform(u, schemas.LAPS, schemas.LAPS_ALLOWED)
    assert "junk" not in c.columns and "segs" not in c.columns and "st_speed" in c.columns
    assert c.count() == 2
    st = landing.stamp_lineage(a, dt.datetime(2024, 1, 1), "run-1").first()
    assert st._run_id == "run-1" and st._loaded_at == dt.datetime(2024, 1, 1)
    js = landing.nested_to_json(b).first()
    assert js.segs == "[1,2]"


def test_pipeline_build_writes_layers(spark, small_dir):
    root = _scratch()
    paths = pipeline.build(spark, fixtures.raw_tables(spark, small_dir), root)
    assert os.path.dirname(paths["fct_lap_times"]) == f"{root}/marts/fct_lap_times/versions"
    assert os.path.dirname(paths["int_laps_enriched"]) == f"{root}/intermediate/int_laps_enriched/versions"
    built = pipeline.built(spark, root)
    assert set(built) == set(paths) - {"dq_report"}
    assert built["fct_driver_season"].inputFiles() == spark.read.parquet(paths["fct_driver_season"]).inputFiles()
    n = spark.read.parquet(paths["fct_driver_season"]).count()
    assert n == catalog.run("fct_driver_season", spark, small_dir).count()
    assert os.path.isdir(f"{root}/marts/fct_lap_times")
    shown = pipeline.display_order("fct_race_results", spark.read.parquet(paths["fct_race_results"]))
    rows = [(r.season_year, r.meeting_key, r.finish_position) for r in shown.collect()]
    assert rows == sorted(rows, key=lambda t: tuple((x is None, x) for x in t))


def test_append_stream_is_idempotent(spark):
    root = _scratch()
    schema = "k long, v string, o long"
    spark.createDataFrame([(1, "a", 1), (2, "b", 1)], schema).write.json(f"{root}/in/f1")
    q = append_stream(spark, f"{root}/in/*", spark.createDataFrame([], schema).schema,
                      f"{root}/out", ["k"], ["o"], f"{root}/ckpt")
    q.awaitTermination()
    spark.createDataFrame([(2, "late copy", 2), (3, "c", 1)], schema).write.json(f"{root}/in/f2")
    q = append_stream(spark, f"{root}/in/*", spark.createDataFrame([], schema).schema,
                      f"{root}/out", ["k"], ["o"], f"{root}/ckpt")
    q.awaitTermination()
    got = sorted((r.k, r.v) for r in spark.read.parquet(f"{root}/out").collect())
    assert got == [(1, "a"), (2, "b"), (3, "c")]


def test_telemetry_stream_matches_batch(spark, small_dir):
    m = catalog.models(spark, small_dir)
    raw = fixtures.derived_tables(spark, small_dir)["car_data"].drop("sample_id")
    root = _scratch()
    # the same sessions arrive in two halves
    raw.filter(F.abs(F.hash("date")) % 2 == 0).write.json(f"{root}/in/part1")
    q = telemetry_stream(spark, f"{root}/in/*", m["lap_starts"], f"{root}/out", f"{root}/ckpt")
    q.awaitTermination()
    raw.filter(F.abs(F.hash("date")) % 2 == 1).write.json(f"{root}/in/part2")
    q = telemetry_stream(spark, f"{root}/in/*", m["lap_starts"], f"{root}/out", f"{root}/ckpt")
    q.awaitTermination()
    cols = ["session_key", "driver_number", "lap_number", "avg_speed", "gear_changes", "sample_count"]
    got = sorted(map(tuple, spark.read.parquet(f"{root}/out").select(*cols).collect()))
    want = sorted(map(tuple, m["telemetry_lap_agg"].select(*cols).collect()))
    assert got == want


def test_snapshot_runs_write_new_versions(spark, small_dir):
    m = catalog.models(spark, small_dir)
    drivers = m["stg_drivers"]
    root = _scratch()
    early = drivers.filter("session_key < 199801")
    p1 = pipeline.snapshot_run(spark, root, early, dt.datetime(1998, 1, 1), None, "v1")
    p2 = pipeline.snapshot_run(spark, root, drivers, dt.datetime(2002, 1, 1), "v1", "v2")
    v1, v2 = spark.read.parquet(p1), spark.read.parquet(p2)
    assert v1.filter("valid_to IS NOT NULL").count() == 0
    # one open spell per driver; every v1 spell is still there (closed or open)
    assert v2.filter("valid_to IS NULL").groupBy("driver_number").count().filter("count > 1").count() == 0
    assert v2.join(v1.select("scd_id"), "scd_id", "left_semi").count() == v1.count()
    with pytest.raises(ValueError):
        pipeline.snapshot_run(spark, root, drivers, dt.datetime(2003, 1, 1), "v2", "v2")


def test_load_telemetry_summary_is_idempotent(spark, small_dir):
    m = catalog.models(spark, small_dir)
    path = _scratch() + "/raw/car_data_lap_agg"
    first = pipeline.load_telemetry_summary(m["car_data"], m["lap_starts"], path,
                                            dt.datetime(2024, 2, 1), "run-1")
    again = pipeline.load_telemetry_summary(m["car_data"], m["lap_starts"], path,
                                            dt.datetime(2024, 2, 2), "run-2")
    n = m["telemetry_lap_agg"].count()
    assert first == {"sent": n, "inserted": n, "rejected": 0} and again == {"sent": n, "inserted": 0, "rejected": 0}
    stored = spark.read.parquet(path)
    assert stored.count() == n and stored.filter("_run_id = 'run-1'").count() == n


def test_landed_text_feed_conforms_to_typed_laps(spark):
    root = _scratch()
    rows = ['{"session_key": "9158", "driver_number": "1", "lap_number": "2", '
            '"date_start": "2023-09-16T13:03:35.200000+00:00", "lap_duration": "91.5", '
            '"is_pit_out_lap": "false", "segments_sector_1": [2048, 2049]}',
            '{"session_key": "9158", "driver_number": "1", "lap_number": "3", '
            '"date_start": "2023-09-16T13:05:06", "lap_duration": null}']
    with open(f"{root}/laps.json", "w") as fh:
        fh.write("\n".join(rows))
    text = landing.read_landed_json(spark, f"{root}/laps.json", schemas.as_text(schemas.LAPS))
    laps = landing.conform(text, schemas.LAPS, schemas.LAPS_ALLOWED)
    got = {r.lap_number: r for r in laps.collect()}
    assert got[2].date_start == dt.datetime(2023, 9, 16, 13, 3, 35, 200000)
    assert got[3].date_start == dt.datetime(2023, 9, 16, 13, 5, 6)
    assert got[2].lap_duration == 91.5 and got[2].is_pit_out_lap is False
    assert got[3].lap_duration is None and "segments_sector_1" not in laps.columns


def test_gaps_become_text(spark, tmp_path):
    feed = spark.createDataFrame([(1, 12.345, "+1 LAP", [1, 2]), (2, None, None, None)],
                                 "k int, gap double, txt string, list array<int>")
    rows = landing.stringify(feed, "gap", "txt", "list").collect()
    assert [tuple(r) for r in rows] == [(1, "12.345", "+1 LAP", "[1,2]"), (2, None, None, None)]
    # numbers in landed JSON read through an all-text schema keep their text
    (tmp_path / "r.json").write_text('{"gap_to_leader": 0}\n{"gap_to_leader": 12.5}\n{"gap_to_leader": "+1 LAP"}\n')
    back = landing.read_landed_json(spark, str(tmp_path / "r.json"), "gap_to_leader string")
    assert sorted(r.gap_to_leader for r in back.collect()) == ["+1 LAP", "0", "12.5"]


def test_lenient_numbers(spark):
    raw = spark.createDataFrame([("12.0", "Infinity", "7"), ("x", "NaN", None), ("14", "3.5", "8.0")],
                                "drs string, speed string, n_gear string")
    rows = landing.typed_car_data(raw).select("drs", "speed", "n_gear").collect()
    assert [tuple(r) for r in rows] == [(12, None, 7), (None, None, None), (14, 3.5, 8)]
