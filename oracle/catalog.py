"""Final SELECT of each registered query (the WITH clause is added by ``oracle.sql``)."""

from __future__ import annotations

import oracle.sql  # noqa: F401  (registers the building blocks)

_STAGING = ("stg_meetings", "stg_sessions", "stg_drivers", "stg_laps", "stg_stints", "stg_pit",
            "stg_session_results", "stg_car_data_lap_agg")

FINAL: dict[str, str] = {
    **{n: f"SELECT * FROM {n}" for n in _STAGING},
    "stint_interval_join": "SELECT * FROM stint_interval_join",
    "int_laps_enriched": "SELECT * FROM int_laps_enriched",
    "int_race_context": "SELECT * FROM int_race_context",
    "fct_lap_times": "SELECT * FROM fct_lap_times",
    "fct_race_results": "SELECT * FROM fct_race_results",
    "season_running_totals": "SELECT * FROM season_running_totals",
    "fct_driver_season": "SELECT * FROM fct_driver_season",
    "teammate_pairs": "SELECT * FROM teammate_pairs",
    "fct_driver_pace": "SELECT * FROM fct_driver_pace",
    "tyre_degradation": "SELECT * FROM tyre_degradation",
    "compound_sequence": "SELECT * FROM compound_sequence",
    "pit_stop_numbers": "SELECT * FROM pit_stop_numbers",
    "fct_pit_strategy": "SELECT * FROM fct_pit_strategy",
    "telemetry_asof": "SELECT session_key, driver_number, sample_id, lap_number FROM telemetry_asof",
    "telemetry_lap_agg": "SELECT * FROM telemetry_lap_agg",
    "gear_changes": "SELECT session_key, driver_number, lap_number, gear_changes FROM telemetry_lap_agg",
    "telemetry_from_json": "SELECT * FROM telemetry_lap_agg",
    "session_driver_list": """SELECT session_key,
       array_to_string(list_sort(list(DISTINCT driver_number)), ',') AS driver_numbers,
       count(DISTINCT driver_number) AS driver_count
FROM raw_drivers WHERE driver_number IS NOT NULL GROUP BY session_key""",
    "scd_drivers_replay": "SELECT * FROM scd_drivers_replay",
    "scd_drivers_increment": "SELECT * FROM scd_drivers_increment",
    "dim_drivers": "SELECT * FROM dim_drivers",
    "insert_absent": "SELECT * FROM insert_absent",
    "schema_conform": "SELECT * FROM schema_conform",
    "load_counts": "SELECT * FROM load_counts",
    "worklist_calendar": "SELECT * FROM worklist_calendar",
    "worklist_next": "SELECT * FROM worklist_next",
    "worklist_ready": "SELECT * FROM worklist_ready",
    "worklist_backfill": "SELECT * FROM worklist_backfill",
    "lineage_stamp": """SELECT * EXCLUDE (_loaded_at, _run_id), TIMESTAMP '2002-06-01 00:00:00' AS _loaded_at,
       'run-1' AS _run_id FROM raw_laps""",
    "nested_json": """SELECT session_key, driver_number, lap_number, date_start,
       '{"meeting_key":' || meeting_key || coalesce(',"is_pit_out_lap":' || is_pit_out_lap, '')
         || coalesce(',"lap_number":' || lap_number, '') || '}' AS place,
       '[' || meeting_key || ',' || session_key || ']' AS keys FROM raw_laps""",
    "gap_text": """SELECT session_key, driver_number,
       CAST(TRY_CAST(gap_to_leader AS DOUBLE) AS VARCHAR) AS gap_to_leader FROM raw_session_results""",
    "run_log": """SELECT 'run-1' AS run_id,
       '{' || string_agg('"' || table_name || '":' || row_count, ',' ORDER BY table_name) || '}' AS rows_loaded,
       CAST(sum(row_count) AS BIGINT) AS total_rows FROM load_counts WHERE table_name <> 'TOTAL'""",
    "dq_log": """SELECT *, 'run-1' AS run_id, TIMESTAMP '2002-06-01 00:00:00' AS checked_at,
       CAST(200001 AS BIGINT) AS session_key,
       CASE WHEN column_name IS NULL THEN '{"failures":' ELSE '{"column_name":"' || column_name || '","failures":' END
         || failures || '}' AS details
FROM dq_report""",
    "lap_presentation": "SELECT * FROM lap_presentation",
    "race_rounds": "SELECT * FROM race_rounds",
    "dq_report": "SELECT * FROM dq_report",
    "mart_publish": "SELECT * FROM fct_race_results",
    "insert_absent_pruned": "SELECT * FROM insert_absent",
    "scd_drivers_rounds": "SELECT * FROM scd_drivers_rounds",
    "landing_rejects": """SELECT reason, count(*) AS row_count, count(lap_duration) AS timed_rows FROM (
  SELECT CASE WHEN (session_key + driver_number) % 17 = 3 THEN 'malformed'
              WHEN session_key IS NULL THEN 'no session_key' WHEN driver_number IS NULL THEN 'no driver_number'
              WHEN lap_number IS NULL THEN 'no lap_number' ELSE 'accepted' END AS reason,
         CASE WHEN (session_key + driver_number) % 17 = 3 THEN NULL ELSE lap_duration END AS lap_duration
  FROM raw_laps) r GROUP BY reason""",
    "schema_discover": """SELECT session_key, CAST(driver_number AS BIGINT) AS driver_number,
       CAST(lap_number AS BIGINT) AS lap_number, CASE WHEN session_key % 12 = 5 THEN st_speed END AS trap_speed,
       CASE WHEN session_key % 12 = 5 AND lap_number = 2 THEN 'lap ' || lap_number END AS remark FROM raw_laps""",
    "mart_layout": " UNION ALL ".join(
        f"SELECT '{m}' AS model, count(*) AS rows, CAST(0 AS BIGINT) AS overlaps, CAST(0 AS BIGINT) AS unordered FROM {m}"
        for m in ("fct_lap_times", "fct_race_results", "fct_driver_season", "fct_driver_pace", "fct_pit_strategy",
                  "dim_drivers")),
    "view_sql": """SELECT s.season_year, t.team_name, sum(t.laps)::BIGINT AS laps, sum(t.timed)::BIGINT AS timed_laps,
       max(t.last_lap) AS last_lap
FROM (SELECT l.session_key, d.team_name, count(*) AS laps, count(l.lap_duration) AS timed, max(l.lap_number) AS last_lap
      FROM stg_laps l LEFT JOIN stg_drivers d USING (session_key, driver_number) GROUP BY ALL) t
JOIN stg_sessions s USING (session_key) GROUP BY ALL""",
}
