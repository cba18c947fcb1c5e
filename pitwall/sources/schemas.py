"""Declared schemas of the raw (landed) tables.

Every raw table carries the lineage columns ``_loaded_at`` and ``_run_id``. Timestamps of
the warehouse tables are wall-clock UTC without zone (``timestamp_ntz``); landed JSON keeps
dates as ISO-8601 text and is parsed leniently by ``pitwall.sources.landing``.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, D, S, B = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.BooleanType()
TS = T.TimestampNTZType()

LINEAGE = [("_loaded_at", TS), ("_run_id", S)]


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in list(fields) + LINEAGE])


MEETINGS = _struct([
    ("meeting_key", L), ("year", I), ("country_name", S), ("country_code", S),
    ("circuit_short_name", S), ("location", S), ("meeting_name", S),
    ("meeting_official_name", S), ("date_start", TS), ("date_end", TS), ("gmt_offset", S),
])

SESSIONS = _struct([
    ("session_key", L), ("meeting_key", L), ("year", I), ("session_name", S),
    ("session_type", S), ("circuit_short_name", S), ("country_name", S), ("location", S),
    ("date_start", TS), ("date_end", TS), ("gmt_offset", S),
])

DRIVERS = _struct([
    ("driver_number", I), ("session_key", L), ("meeting_key", L), ("full_name", S),
    ("broadcast_name", S), ("name_acronym", S), ("first_name", S), ("last_name", S),
    ("team_name", S), ("team_colour", S), ("country_code", S), ("headshot_url", S),
])

LAPS = _struct([
    ("session_key", L), ("meeting_key", L), ("driver_number", I), ("lap_number", I),
    ("date_start", TS), ("lap_duration", D), ("duration_sector_1", D),
    ("duration_sector_2", D), ("duration_sector_3", D), ("i1_speed", D), ("i2_speed", D),
    ("st_speed", D), ("is_pit_out_lap", B),
])

STINTS = _struct([
    ("session_key", L), ("meeting_key", L), ("driver_number", I), ("stint_number", I),
    ("lap_start", I), ("lap_end", I), ("compound", S), ("tyre_age_at_start", I),
])

PIT = _struct([
    ("session_key", L), ("meeting_key", L), ("driver_number", I), ("lap_number", I),
    ("date", TS), ("stop_duration", D), ("lane_duration", D), ("pit_duration", D),
])

SESSION_RESULTS = _struct([
    ("session_key", L), ("meeting_key", L), ("driver_number", I), ("position", I),
    ("number_of_laps", I), ("gap_to_leader", S), ("duration", S), ("dnf", B), ("dns", B),
    ("dsq", B),
])

CAR_DATA_LAP_AGG = _struct([
    ("session_key", L), ("meeting_key", L), ("driver_number", I), ("lap_number", I),
    ("avg_speed", D), ("max_speed", L), ("min_speed", L), ("avg_throttle", D), ("avg_rpm", D),
    ("max_rpm", L), ("avg_brake", D), ("drs_usage_pct", D), ("gear_changes", L),
    ("sample_count", L),
])

RAW = {
    "meetings": MEETINGS,
    "sessions": SESSIONS,
    "drivers": DRIVERS,
    "laps": LAPS,
    "stints": STINTS,
    "pit": PIT,
    "session_results": SESSION_RESULTS,
    "car_data_lap_agg": CAR_DATA_LAP_AGG,
}

# Columns the lap feed may carry into raw.laps; anything else the API sends is dropped.
LAPS_ALLOWED = tuple(f.name for f in LAPS if not f.name.startswith("_"))

# Telemetry samples as landed: every field text or loosely typed; cast leniently.
CAR_DATA_TEXT = T.StructType([
    T.StructField(n, S, True) for n in (
        "date", "session_key", "meeting_key", "driver_number", "speed", "throttle", "rpm",
        "brake", "drs", "n_gear")
])

# Lap boundaries as landed (lap feed subset used for telemetry assignment).
LAP_STARTS_TEXT = T.StructType([
    T.StructField(n, S, True) for n in ("session_key", "driver_number", "lap_number", "date_start")
])

SCHEDULE = T.StructType([T.StructField(n, t, True) for n, t in [
    ("session_key", L), ("meeting_key", L), ("year", I), ("country_name", S),
    ("circuit_short_name", S), ("session_name", S), ("session_type", S), ("date_start", TS),
    ("date_end", TS), ("gmt_offset", S), ("trigger_after", TS), ("status", S),
    ("retry_count", I), ("last_error", S), ("extracted_at", TS), ("updated_at", TS),
]])


def as_text(schema: T.StructType) -> T.StructType:
    """The same fields, all text: read landed JSON this way, then ``landing.conform``."""
    return T.StructType([T.StructField(f.name, S, True) for f in schema.fields])
