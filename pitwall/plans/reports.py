"""Data-quality report over the models, and presentation columns for BI tools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.functions.columns import (COMPOUNDS, compound_colour, format_lap_time,
                                       is_valid_lap, pct_off_pace, race_points)
from pitwall.operators.quality import TableChecks, report, watch
from pitwall.plans.marts import session_lap_stats

# The declared tests of the warehouse (49) plus the runtime non-empty check.
DQ_SPECS = (
    TableChecks("stg_meetings", not_null=("meeting_key", "season_year", "country_name"),
                unique=("meeting_key",)),
    TableChecks("stg_sessions", not_null=("session_key", "meeting_key"), unique=("session_key",)),
    TableChecks("stg_drivers", not_null=("driver_number", "session_key", "team_name")),
    TableChecks("stg_laps", not_null=("session_key", "driver_number", "lap_number")),
    TableChecks("stg_stints", not_null=("session_key", "driver_number"),
                accepted={"compound": COMPOUNDS}),
    TableChecks("stg_pit", not_null=("session_key", "driver_number")),
    TableChecks("stg_session_results", not_null=("session_key", "driver_number", "finish_position")),
    TableChecks("stg_car_data_lap_agg", not_null=("session_key", "driver_number", "lap_number")),
    TableChecks("fct_race_results",
                not_null=("session_key", "driver_number", "finish_position", "season_year")),
    TableChecks("fct_lap_times", not_null=("session_key", "driver_number", "lap_number", "lap_time_secs"),
                accepted={"compound": COMPOUNDS}),
    TableChecks("fct_pit_strategy",
                not_null=("session_key", "driver_number", "stint_number", "compound")),
    TableChecks("fct_driver_season",
                not_null=("season_year", "driver_number", "session_key", "cumulative_points",
                          "championship_position")),
    TableChecks("fct_driver_pace", not_null=("session_key", "driver_number", "fastest_lap_secs")),
    TableChecks("dim_drivers", not_null=("driver_number", "driver_code", "team_name"),
                unique=("driver_number",)),
    TableChecks("raw_drivers", non_empty=True),
)


def dq_report(tables: dict[str, DataFrame], observed: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """``observed``: per table that was just written, the counts taken by its write job."""
    return report(tables, DQ_SPECS, observed)


def watched(table: str) -> list[Column]:
    """The counts that the write job of a table is to observe."""
    return next((watch(s) for s in DQ_SPECS if s.table == table), [])


def lap_presentation(laps: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Timed laps with display columns: lap time text, strict validity (time > 0 too),
    compound colour, and % off the session's fastest valid lap (``stats``, where it is stored)."""
    stats = session_lap_stats(laps) if stats is None else stats
    timed = laps.filter(F.col("has_timing")).join(stats, "session_key", "left")
    return timed.select(
        "session_key", "driver_number", "lap_number", "compound",
        format_lap_time("lap_duration").alias("lap_time_text"),
        is_valid_lap("lap_duration", "is_pit_out_lap").alias("is_valid_lap"),
        compound_colour("compound").alias("compound_colour"),
        pct_off_pace("lap_duration", "session_fastest_lap_secs").alias("pct_off_pace"))


def race_rounds(stg: dict[str, DataFrame]) -> DataFrame:
    """Round number of each race in its season (rank by start time) and the points each
    classified position earns."""
    w = Window.partitionBy("season_year").orderBy("session_start_at")
    rounds = stg["stg_sessions"].select(
        "session_key", "season_year", F.rank().over(w).cast("long").alias("race_round"))
    res = stg["stg_session_results"].select("session_key", "driver_number", "finish_position")
    return res.join(rounds, "session_key", "left").select(
        "season_year", "session_key", "race_round", "driver_number", "finish_position",
        race_points("finish_position").alias("points"))
