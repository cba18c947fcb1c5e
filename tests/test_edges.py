"""Hand-made edge fixtures for the model rules (cases the formula fixtures do not hit)."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from pitwall.functions import columns as C
from pitwall.plans import enrich, marts, staging
from pitwall.sources import schemas

T0 = dt.datetime(2024, 3, 2, 15, 0, 0)


def frame(spark, schema, rows):
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def test_gap_parse_and_flags(spark):
    rows = [
        dict(session_key=1, driver_number=1, position=1, gap_to_leader="0", duration="5400.5"),
        dict(session_key=1, driver_number=2, position=2, gap_to_leader="0.0"),
        dict(session_key=1, driver_number=3, position=3, gap_to_leader="12.345"),
        dict(session_key=1, driver_number=4, position=4, gap_to_leader="+1 LAP"),
        dict(session_key=1, driver_number=5, position=5, gap_to_leader="+2 LAPS"),
        dict(session_key=1, driver_number=6, position=None, gap_to_leader=None, dnf=True),
        dict(session_key=1, driver_number=7, position=1, gap_to_leader=None, dsq=True),
        dict(session_key=1, driver_number=8, position=None, gap_to_leader=None),
        dict(session_key=None, driver_number=9, position=1, gap_to_leader="0"),
    ]
    out = {r.driver_number: r for r in staging.stg_session_results(
        frame(spark, schemas.SESSION_RESULTS, rows)).collect()}
    assert 9 not in out                                    # NULL key dropped
    assert out[1].gap_to_leader_secs == 0.0 and out[1].race_duration_secs == 5400.5
    assert out[2].gap_to_leader_secs == 0.0
    assert out[3].gap_to_leader_secs == 12.345
    assert out[4].gap_to_leader_secs is None and out[4].is_lapped is True
    assert out[5].is_lapped is True
    assert out[6].is_lapped is None                        # NULL gap → NULL flag
    assert out[6].finished is False and out[6].is_winner is False
    assert out[7].is_winner is True and out[7].finished is False   # dsq not checked
    assert out[8].is_winner is None                        # NULL position, no flag


def test_bad_gap_text_fails_unless_lenient(spark):
    df = frame(spark, schemas.SESSION_RESULTS,
               [dict(session_key=1, driver_number=1, gap_to_leader="n/a")])
    with pytest.raises(Exception):
        staging.stg_session_results(df).collect()
    assert staging.stg_session_results(df, lenient=True).first().gap_to_leader_secs is None


def test_team_colour_and_driver_dedup(spark):
    sessions = frame(spark, schemas.SESSIONS, [dict(session_key=10, year=2024)])
    rows = [
        dict(driver_number=1, session_key=10, team_colour="#AABBCC", team_name=" A ",
             _loaded_at=T0),
        dict(driver_number=2, session_key=10, team_colour="AABBCC", team_name="B",
             _loaded_at=T0),
        dict(driver_number=3, session_key=10, team_colour=None, team_name="C", _loaded_at=T0),
        # copies: newest load wins, but a NULL load time sorts first (wins)
        dict(driver_number=4, session_key=10, team_name="old", _loaded_at=T0),
        dict(driver_number=4, session_key=10, team_name="new",
             _loaded_at=T0 + dt.timedelta(days=1)),
        dict(driver_number=5, session_key=10, team_name="dated", _loaded_at=T0),
        dict(driver_number=5, session_key=10, team_name="undated", _loaded_at=None),
        dict(driver_number=None, session_key=10, team_name="x"),
    ]
    out = {r.driver_number: r for r in staging.stg_drivers(
        frame(spark, schemas.DRIVERS, rows), staging.stg_sessions(sessions)).collect()}
    assert set(out) == {1, 2, 3, 4, 5}
    assert out[1].team_colour == "#AABBCC" and out[1].team_name == "A"
    assert out[2].team_colour == "#AABBCC"
    assert out[3].team_colour is None
    assert out[4].team_name == "new" and out[5].team_name == "undated"
    assert out[1].season_year == 2024 and out[1].rn == 1


def test_pit_fallbacks_and_fast_stop_bound(spark):
    rows = [dict(session_key=1, driver_number=1, lap_number=10, stop_duration=2.5),
            dict(session_key=1, driver_number=1, lap_number=20, stop_duration=None,
                 pit_duration=2.4, lane_duration=None),
            dict(session_key=1, driver_number=None, lap_number=3)]
    out = sorted(staging.stg_pit(frame(spark, schemas.PIT, rows)).collect(),
                 key=lambda r: r.lap_number)
    assert len(out) == 2
    assert out[0].is_fast_stop is False                    # 2.5 is not < 2.5
    assert out[1].stop_duration_secs == 2.4 and out[1].lane_duration_secs == 2.4
    assert out[1].is_fast_stop is True


def test_stints_interval_join_fan_out_and_gaps(spark):
    laps = staging.stg_laps(frame(spark, schemas.LAPS, [
        dict(session_key=1, driver_number=1, lap_number=n, lap_duration=90.0)
        for n in (1, 5, 6, 12, 30)]))
    stints = staging.stg_stints(frame(spark, schemas.STINTS, [
        dict(session_key=1, driver_number=1, stint_number=1, lap_start=1, lap_end=6,
             compound=" soft", tyre_age_at_start=0),
        dict(session_key=1, driver_number=1, stint_number=2, lap_start=5, lap_end=10,
             compound="Medium", tyre_age_at_start=2),                  # overlaps 1
        dict(session_key=1, driver_number=1, stint_number=3, lap_start=20, lap_end=None,
             compound=None, tyre_age_at_start=1),                      # open stint
    ]))
    got = sorted((r.lap_number, r.stint_number, r.lap_in_stint)
                 for r in enrich.laps_with_stints(laps, stints).collect())
    assert got == [(1, 1, 1), (5, 1, 5), (5, 2, 1), (6, 1, 6), (6, 2, 2),
                   (12, None, None), (30, 3, 11)]
    st = {r.stint_number: r for r in stints.collect()}
    assert st[1].compound == "SOFT" and st[1].is_fresh_tyre is True
    assert st[3].stint_laps == 1 - 20                       # open stint: 1 - lap_start


def test_teammates_one_two_three_and_null_team(spark):
    pace = spark.createDataFrame(
        [(1, d, t, float(90 + d), float(91 + d), f"D{d}") for d, t in
         [(1, "A"), (2, "A"), (3, "B"), (4, "C"), (5, "C"), (6, "C"), (7, None), (8, None)]],
        "session_key int, driver_number int, team_name string, fastest_lap_secs double, "
        "median_lap_secs double, driver_code string")
    pairs = sorted((r.driver_number, r.teammate_driver_number)
                   for r in marts.teammate_pairs(pace).collect())
    assert pairs == [(1, 2), (4, 5), (4, 6), (5, 6)]


def test_lap_time_text_and_macros(spark):
    df = spark.createDataFrame([(91.234,), (59.9996,), (605.0,), (0.5,)], "s double")
    txt = [r[0] for r in df.select(C.format_lap_time("s")).collect()]
    assert txt == ["1:31.234", "1:00.000", "10:05.000", "0:00.500"]
    pts = spark.range(0, 13).select(C.race_points(F.col("id").cast("int")).alias("p"))
    assert [r.p for r in pts.collect()] == [0, 25, 18, 15, 12, 10, 8, 6, 4, 2, 1, 0, 0]
    comp = spark.createDataFrame([("soft",), ("Medium",), ("x",), (None,)], "c string")
    assert [r[0] for r in comp.select(C.compound_colour("c")).collect()] == \
        ["#FF3333", "#FFD700", "#AAAAAA", "#AAAAAA"]
    v = spark.createDataFrame([(90.0, None), (None, False), (0.0, False), (90.0, True)],
                              "d double, p boolean")
    assert [r[0] for r in v.select(C.is_valid_lap("d", "p")).collect()] == [True, False, False, False]
    pct = spark.createDataFrame([(91.0, 90.0), (90.0, 0.0)], "a double, b double")
    assert [r[0] for r in pct.select(C.pct_off_pace("a", "b")).collect()] == [1.111, None]


def test_points_bonus_rules(spark):
    res = spark.createDataFrame([
        Row(season_year=2024, session_key=1, meeting_key=1, country_name="x", race_date=T0,
            driver_number=d, driver_name="n", driver_code="c", team_name="t",
            finish_position=p, is_winner=p == 1, finished=f, dnf=not f, set_fastest_lap=fl)
        for d, p, f, fl in [(1, 1, True, False), (2, 10, True, True), (3, 11, True, True),
                            (4, 5, False, True), (5, None, False, False)]])
    got = {r.driver_number: (r.base_points, r.fastest_lap_bonus, r.race_points)
           for r in marts.race_points_rows(res).collect()}
    assert got == {1: (25, 0, 25), 2: (1, 1, 2), 3: (0, 0, 0), 4: (10, 0, 10)}


def test_iso_parse_zone_rules(spark):
    df = spark.createDataFrame([("2024-03-02T13:04:05.123456+00:00",), ("2024-03-02T13:04:05Z",),
                                ("2024-03-02T15:04:05+02:00",), ("2024-03-02T13:04:05",),
                                ("bad",), (None,)], "t string")
    strict = [r[0] for r in df.select(C.parse_iso_timestamp("t", require_zone=True)
                                      .cast("timestamp_ntz")).collect()]
    lenient = [r[0] for r in df.select(C.parse_iso_timestamp("t").cast("timestamp_ntz")).collect()]
    want = [dt.datetime(2024, 3, 2, 13, 4, 5, 123456), dt.datetime(2024, 3, 2, 13, 4, 5),
            dt.datetime(2024, 3, 2, 13, 4, 5)]
    assert strict == want + [None, None, None]
    assert lenient == want + [dt.datetime(2024, 3, 2, 13, 4, 5), None, None]
