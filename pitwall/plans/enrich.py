"""Intermediate models: the enriched lap table and the race context per driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

col = F.col


def laps_with_stints(laps: DataFrame, stints: DataFrame) -> DataFrame:
    """Interval join: each lap gets the stint whose ``[lap_start, lap_end]`` holds it
    (an open stint has no last lap). Left join — a lap outside every stint keeps NULL
    stint columns; overlapping stints give one row per stint.

    Equality on (session, driver) plus the range as a residual condition, so Spark plans a
    hash or sort-merge join per driver-session (a handful of stints each), never a
    nested loop.
    """
    s = stints.select(
        col("session_key").alias("_s_session"), col("driver_number").alias("_s_driver"),
        "stint_number", "compound", "tyre_age_at_start", "lap_start", "lap_end", "is_fresh_tyre")
    cond = ((laps.session_key == s._s_session) & (laps.driver_number == s._s_driver)
            & (laps.lap_number >= s.lap_start)
            & (s.lap_end.isNull() | (laps.lap_number <= s.lap_end)))
    return (laps.join(s, cond, "left")
                .withColumn("lap_in_stint", col("lap_number") - col("lap_start") + 1)
                .drop("_s_session", "_s_driver", "lap_start", "lap_end"))


def int_laps_enriched(stg: dict[str, DataFrame], max_ratio: float | None = None) -> DataFrame:
    """Laps with stint, driver, session and telemetry context and the validity flag.

    ``is_valid_lap`` = timed and not a pit-out lap. ``max_ratio`` (off by default, as in the
    reference's code) also rejects laps slower than ``max_ratio`` × the session median of
    timed laps (e.g. 1.3 for safety-car laps); the median is a per-session aggregate
    joined back, not a window over the session.

    The telemetry, as large as the laps, is joined first: its join shuffles bare laps, and the
    small tables meet the result without another shuffle where Spark knows that they are small."""
    drivers = stg["stg_drivers"].select(
        "driver_number", "session_key", "driver_name", "driver_code", "team_name", "team_colour")
    sessions = stg["stg_sessions"].select(
        "session_key", col("meeting_key").alias("_sess_meeting"), "season_year", "country_name",
        "circuit_name", "session_start_at")
    tele = stg["stg_car_data_lap_agg"].select(
        "session_key", "driver_number", "lap_number", "avg_speed", "max_speed", "avg_throttle",
        "avg_rpm", "max_rpm", "avg_brake", "drs_usage_pct", "gear_changes",
        "has_sufficient_telemetry")
    driven = stg["stg_laps"].join(tele, ["session_key", "driver_number", "lap_number"], "left")
    laps = laps_with_stints(driven, stg["stg_stints"])
    j = (laps.join(drivers, ["session_key", "driver_number"], "left")
             .join(sessions, "session_key", "left"))
    valid = col("has_timing") & ~col("is_pit_out_lap")
    if max_ratio is not None:
        medians = (laps.filter(col("has_timing")).groupBy(col("session_key").alias("_m_session"))
                       .agg(F.median("lap_duration").alias("_session_median")))
        j = j.join(medians, j.session_key == medians._m_session, "left")
        valid = valid & F.coalesce(col("lap_duration") <= col("_session_median") * max_ratio,
                                   F.lit(True))
    return j.select(
        "session_key", "meeting_key", "driver_number", "lap_number",
        "season_year", "country_name", "circuit_name", "session_start_at",
        "driver_name", "driver_code", "team_name", "team_colour",
        "lap_duration", "duration_sector_1", "duration_sector_2", "duration_sector_3",
        "i1_speed", "i2_speed", "st_speed",
        "stint_number", "compound", "tyre_age_at_start", "is_fresh_tyre", "lap_in_stint",
        "is_pit_out_lap", "has_timing",
        valid.alias("is_valid_lap"),
        "avg_speed", "max_speed", "avg_throttle", "avg_rpm", "max_rpm", "avg_brake",
        "drs_usage_pct", "gear_changes", "has_sufficient_telemetry",
        "lap_started_at")


def pit_summary(pit_stg: DataFrame) -> DataFrame:
    return pit_stg.groupBy("session_key", "driver_number").agg(
        F.count(F.lit(1)).alias("total_pit_stops"),
        F.min("stop_duration_secs").alias("fastest_stop_secs"),
        F.sum("stop_duration_secs").alias("total_stop_time_secs"),
        F.sum("lane_duration_secs").alias("total_pit_lane_time_secs"))


def int_race_context(stg: dict[str, DataFrame], require_pit: bool = True) -> DataFrame:
    """Result rows with driver, session, meeting and pit-stop context.

    ``require_pit=True`` keeps the reference's rule: drivers without any pit record are
    left out (and so miss the results and the standings)."""
    r = stg["stg_session_results"]
    drivers = stg["stg_drivers"].select(
        "driver_number", "session_key", "driver_name", "driver_code", "team_name", "team_colour")
    sessions = stg["stg_sessions"].select(
        "session_key", "season_year", "country_name", "circuit_name",
        col("session_start_at").alias("race_date"))
    meetings = stg["stg_meetings"].select("meeting_key", "meeting_name", "location")
    j = (r.join(drivers, ["session_key", "driver_number"], "left")
          .join(sessions, "session_key", "left")
          .join(meetings, "meeting_key", "left")
          .join(pit_summary(stg["stg_pit"]), ["session_key", "driver_number"], "left"))
    out = j.select(
        "session_key", "meeting_key", "season_year", "country_name", "circuit_name",
        "race_date", "meeting_name", "location",
        "driver_number", "driver_name", "driver_code", "team_name", "team_colour",
        "finish_position", "number_of_laps", "gap_to_leader_secs", "gap_to_leader_raw",
        "race_duration_secs", "is_winner", "is_lapped", "finished", "dnf", "dns", "dsq",
        F.coalesce(col("total_pit_stops"), F.lit(0)).alias("total_pit_stops"),
        "fastest_stop_secs", "total_stop_time_secs", "total_pit_lane_time_secs")
    return out.filter(col("total_pit_stops") > 0) if require_pit else out
