"""Staging models: one cleaned, typed, renamed view per raw table.

Each function takes the raw DataFrame(s) and returns a lazy DataFrame. Key filters are
plain ``isNotNull`` predicates, so Catalyst pushes them into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.functions.columns import (FAST_STOP_SECS, MIN_TELEMETRY_SAMPLES,
                                       normalise_colour)
from pitwall.operators.dedup import latest_per_key
from pitwall.plans.lazy import Lazy

col, trim = F.col, F.trim


def _keys_present(*names: str):
    cond = F.lit(True)
    for n in names:
        cond = cond & col(n).isNotNull()
    return cond


def stg_meetings(meetings: DataFrame) -> DataFrame:
    return meetings.filter(_keys_present("meeting_key")).select(
        "meeting_key",
        col("year").alias("season_year"),
        trim("country_name").alias("country_name"),
        trim("country_code").alias("country_code"),
        trim("circuit_short_name").alias("circuit_name"),
        trim("location").alias("location"),
        trim("meeting_name").alias("meeting_name"),
        trim("meeting_official_name").alias("meeting_official_name"),
        col("date_start").alias("meeting_start_at"),
        col("date_end").alias("meeting_end_at"),
        "gmt_offset", "_loaded_at")


def stg_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.filter(_keys_present("session_key")).select(
        "session_key", "meeting_key",
        col("year").alias("season_year"),
        trim("session_name").alias("session_name"),
        trim("session_type").alias("session_type"),
        trim("circuit_short_name").alias("circuit_name"),
        trim("country_name").alias("country_name"),
        trim("location").alias("location"),
        col("date_start").alias("session_start_at"),
        col("date_end").alias("session_end_at"),
        "gmt_offset",
        # compared on the raw, untrimmed name
        (col("session_name") == "Race").alias("is_race"),
        "_loaded_at")


def stg_drivers(drivers: DataFrame, sessions_stg: DataFrame) -> DataFrame:
    """Trimmed driver rows per session, newest load per (driver, session), with a hash of
    the attributes the snapshot could watch."""
    seasons = sessions_stg.select("session_key", "season_year")
    staged = (drivers.filter(_keys_present("driver_number", "session_key"))
              .join(seasons, "session_key", "left")
              .select(
                  "driver_number", "session_key", "meeting_key",
                  trim("full_name").alias("driver_name"),
                  trim("broadcast_name").alias("broadcast_name"),
                  trim("name_acronym").alias("driver_code"),
                  trim("first_name").alias("first_name"),
                  trim("last_name").alias("last_name"),
                  trim("team_name").alias("team_name"),
                  normalise_colour("team_colour").alias("team_colour"),
                  trim("country_code").alias("country_code"),
                  "headshot_url", "season_year", "_loaded_at"))
    deduped = latest_per_key(staged, ["driver_number", "session_key"],
                             order=[("_loaded_at", True)])
    digest = F.md5(F.concat(*[F.coalesce(col(c), F.lit(""))
                              for c in ("driver_name", "driver_code", "team_name", "country_code")]))
    return deduped.select(
        "driver_number", "session_key", "meeting_key", "driver_name", "broadcast_name",
        "driver_code", "first_name", "last_name", "team_name", "team_colour", "country_code",
        "headshot_url", "season_year", "_loaded_at",
        F.lit(1).cast("long").alias("rn"), digest.alias("change_hash"))


def stg_laps(laps: DataFrame) -> DataFrame:
    return laps.filter(_keys_present("session_key", "driver_number", "lap_number")).select(
        "session_key", "meeting_key", "driver_number", "lap_number",
        "lap_duration", "duration_sector_1", "duration_sector_2", "duration_sector_3",
        "i1_speed", "i2_speed", "st_speed",
        F.coalesce(col("is_pit_out_lap"), F.lit(False)).alias("is_pit_out_lap"),
        col("lap_duration").isNotNull().alias("has_timing"),
        col("date_start").alias("lap_started_at"),
        "_loaded_at")


def stg_stints(stints: DataFrame) -> DataFrame:
    return stints.filter(_keys_present("session_key", "driver_number", "stint_number")).select(
        "session_key", "meeting_key", "driver_number", "stint_number", "lap_start", "lap_end",
        F.upper(trim("compound")).alias("compound"),
        "tyre_age_at_start",
        (F.coalesce(col("lap_end"), F.lit(0)) - col("lap_start") + 1).alias("stint_laps"),
        (col("tyre_age_at_start") == 0).alias("is_fresh_tyre"),
        "_loaded_at")


def stg_pit(pit: DataFrame) -> DataFrame:
    stop = F.coalesce(col("stop_duration"), col("pit_duration"))
    return pit.filter(_keys_present("session_key", "driver_number")).select(
        "session_key", "meeting_key", "driver_number", "lap_number",
        col("date").alias("pit_entry_at"),
        stop.alias("stop_duration_secs"),
        F.coalesce(col("lane_duration"), col("pit_duration")).alias("lane_duration_secs"),
        (stop < FAST_STOP_SECS).alias("is_fast_stop"),
        "_loaded_at")


def stg_session_results(results: DataFrame, lenient: bool = False) -> DataFrame:
    """Parsed gap and flags. Gap text: '0' → 0; '+n LAP(S)' → NULL; else a number. With
    ``lenient=False`` (the reference behaviour) unparsable gap text fails the job."""
    gap = col("gap_to_leader")
    lapped = gap.like("+%LAP%")
    to_num = (lambda c: c.try_cast("double")) if lenient else (lambda c: c.cast("double"))
    gap_secs = (F.when(gap == "0", F.lit(0.0))
                 .when(lapped, F.lit(None).cast("double"))
                 .when(gap.isNull(), F.lit(None).cast("double"))
                 .otherwise(to_num(gap)))
    dnf, dns, dsq = (F.coalesce(col(c), F.lit(False)) for c in ("dnf", "dns", "dsq"))
    return results.filter(_keys_present("session_key", "driver_number")).select(
        "session_key", "meeting_key", "driver_number",
        col("position").alias("finish_position"),
        "number_of_laps",
        gap.alias("gap_to_leader_raw"),
        gap_secs.alias("gap_to_leader_secs"),
        lapped.alias("is_lapped"),
        F.when(col("duration").isNotNull(), to_num(col("duration"))).alias("race_duration_secs"),
        dnf.alias("dnf"), dns.alias("dns"), dsq.alias("dsq"),
        (~dnf & ~dns & ~dsq).alias("finished"),
        ((col("position") == 1) & ~dnf & ~dns).alias("is_winner"),
        "_loaded_at")


def stg_car_data_lap_agg(agg: DataFrame) -> DataFrame:
    return agg.filter(_keys_present("session_key", "driver_number", "lap_number")).select(
        "session_key", "meeting_key", "driver_number", "lap_number",
        "avg_speed", "max_speed", "min_speed", "avg_throttle", "avg_rpm", "max_rpm",
        "avg_brake", "drs_usage_pct", "gear_changes", "sample_count",
        (col("sample_count") >= MIN_TELEMETRY_SAMPLES).alias("has_sufficient_telemetry"),
        "_loaded_at")


def build_staging(raw) -> Lazy:
    """All eight staging models over ``raw`` (name → DataFrame); built on first access."""
    # calendar dimensions: broadcast to every join that reads them, after a size check
    stg = Lazy({
        "stg_meetings": lambda: stg_meetings(raw["meetings"]),
        "stg_sessions": lambda: stg_sessions(raw["sessions"]),
        "stg_drivers": lambda: stg_drivers(raw["drivers"], stg["stg_sessions"]),
        "stg_laps": lambda: stg_laps(raw["laps"]),
        "stg_stints": lambda: stg_stints(raw["stints"]),
        "stg_pit": lambda: stg_pit(raw["pit"]),
        "stg_session_results": lambda: stg_session_results(raw["session_results"]),
        "stg_car_data_lap_agg": lambda: stg_car_data_lap_agg(raw["car_data_lap_agg"]),
    })
    return stg
