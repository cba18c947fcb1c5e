"""SQL of the enriched laps and the marts, written from the rules of SURVEY §2.

The shapes differ from the library's on purpose, so that agreement means something: stints are
unfolded into laps and matched by equality, session and driver figures are windows over the
rows themselves, first values are ``arg_min``, standings count better drivers, teammates come
from a list per team.
"""

from __future__ import annotations

# Points of the first ten places.
POINTS = [25, 18, 15, 12, 10, 8, 6, 4, 2, 1]

MARTS = {
    "unfolded_stints": """
SELECT session_key, driver_number, stint_number, compound, tyre_age_at_start, is_fresh_tyre, lap_start,
       unnest(range(lap_start, 1 + coalesce(lap_end, (
         SELECT max(k.lap_number) FROM stg_laps k
         WHERE k.session_key = stg_stints.session_key AND k.driver_number = stg_stints.driver_number)))) AS lap_number
FROM stg_stints""",

    "stint_interval_join": """
SELECT stg_laps.*, x.stint_number, x.compound, x.tyre_age_at_start, x.is_fresh_tyre,
       1 + stg_laps.lap_number - x.lap_start AS lap_in_stint
FROM stg_laps LEFT JOIN unfolded_stints x USING (session_key, driver_number, lap_number)""",

    "driver_cards": """
SELECT session_key, driver_number, driver_name, driver_code, team_name, team_colour FROM stg_drivers""",

    "race_cards": """
SELECT session_key, season_year, country_name, circuit_name, session_start_at FROM stg_sessions""",

    "int_laps_enriched": """
SELECT * EXCLUDE (_loaded_at), has_timing AND is_pit_out_lap = FALSE AS is_valid_lap
FROM stint_interval_join
LEFT JOIN driver_cards USING (session_key, driver_number)
LEFT JOIN race_cards USING (session_key)
LEFT JOIN (SELECT * EXCLUDE (meeting_key, min_speed, sample_count, _loaded_at) FROM stg_car_data_lap_agg)
  USING (session_key, driver_number, lap_number)""",

    "int_race_context": """
SELECT * EXCLUDE (session_start_at, _loaded_at), session_start_at AS race_date
FROM stg_session_results
JOIN (SELECT session_key, driver_number, count(*) AS total_pit_stops,
             list_min(list(stop_duration_secs)) AS fastest_stop_secs,
             list_sum(list(stop_duration_secs)) AS total_stop_time_secs,
             list_sum(list(lane_duration_secs)) AS total_pit_lane_time_secs
      FROM stg_pit GROUP BY ALL) USING (session_key, driver_number)
LEFT JOIN driver_cards USING (session_key, driver_number)
LEFT JOIN race_cards USING (session_key)
LEFT JOIN (SELECT meeting_key, meeting_name, location FROM stg_meetings) USING (meeting_key)""",

    "fct_lap_times": """
SELECT * EXCLUDE (lap_duration, duration_sector_1, duration_sector_2, duration_sector_3, session_start_at,
                  team_colour, has_timing, max_rpm, has_sufficient_telemetry),
       lap_duration AS lap_time_secs, duration_sector_1 AS sector_1_secs,
       duration_sector_2 AS sector_2_secs, duration_sector_3 AS sector_3_secs,
       lap_duration - session_fastest_lap_secs AS gap_to_fastest_secs,
       round((lap_duration - session_fastest_lap_secs) / session_fastest_lap_secs * 100, 3) AS pct_off_fastest
FROM (
  SELECT *, median(lap_duration) OVER race AS median_lap_secs,
         min(CASE WHEN is_valid_lap THEN lap_duration END) OVER race AS session_fastest_lap_secs,
         min(CASE WHEN is_valid_lap THEN lap_duration END) OVER own AS driver_fastest_lap_secs
  FROM int_laps_enriched WHERE lap_duration IS NOT NULL
  WINDOW race AS (PARTITION BY session_key), own AS (PARTITION BY session_key, driver_number))""",

    "best_laps": """
SELECT session_key, driver_number, list_min(times) AS fastest_lap_secs, len(times) AS valid_laps_count,
       min(list_min(times)) OVER (PARTITION BY session_key) AS race_fastest_lap_secs
FROM (SELECT session_key, driver_number, list(lap_duration) AS times
      FROM int_laps_enriched WHERE is_valid_lap GROUP BY ALL)""",

    "fct_race_results": """
SELECT * EXCLUDE (location), fastest_lap_secs - race_fastest_lap_secs AS gap_to_fastest_lap_secs,
       fastest_lap_secs = race_fastest_lap_secs AS set_fastest_lap
FROM int_race_context
LEFT JOIN (SELECT * EXCLUDE (race_fastest_lap_secs) FROM best_laps) USING (session_key, driver_number)
LEFT JOIN (SELECT DISTINCT session_key, race_fastest_lap_secs FROM best_laps) USING (session_key)""",

    "race_points_rows": f"""
SELECT season_year, session_key, meeting_key, country_name, race_date, driver_number, driver_name,
       driver_code, team_name, finish_position, is_winner, finished, dnf, set_fastest_lap,
       base_points, fastest_lap_bonus, base_points + fastest_lap_bonus AS race_points
FROM (SELECT *, coalesce({POINTS}[finish_position], 0) AS base_points,
             coalesce((set_fastest_lap AND finished AND finish_position BETWEEN 1 AND 10)::INTEGER, 0) AS fastest_lap_bonus
      FROM fct_race_results)
WHERE NOT (finished = FALSE AND finish_position IS NULL)""",

    "season_running_totals": """
SELECT * EXCLUDE (sofar), list_sum([x.points FOR x IN sofar])::BIGINT AS cumulative_points,
       len([x FOR x IN sofar IF x.win])::BIGINT AS cumulative_wins,
       len([x FOR x IN sofar IF x.place <= 3 AND x.done])::BIGINT AS cumulative_podiums,
       len([x FOR x IN sofar IF x.out])::BIGINT AS cumulative_dnfs,
       len(sofar)::BIGINT AS race_number_in_season
FROM (
  SELECT *, list({'points': race_points, 'win': is_winner, 'place': finish_position, 'done': finished, 'out': dnf})
              OVER (PARTITION BY season_year, driver_number ORDER BY race_date, session_key
                    ROWS UNBOUNDED PRECEDING) AS sofar
  FROM race_points_rows)""",

    "fct_driver_season": """
SELECT t.*, 1 + (SELECT count(*) FROM season_running_totals o
                 WHERE o.season_year = t.season_year AND o.session_key = t.session_key
                   AND o.cumulative_points > t.cumulative_points) AS championship_position
FROM season_running_totals t""",

    "driver_race_pace": """
SELECT * EXCLUDE (times, s1, s2, s3, throttle, drs, brake, speeds),
       len(times) AS total_valid_laps, list_min(times) AS fastest_lap_secs, list_avg(times) AS avg_lap_secs,
       CASE WHEN len(times) > 1 THEN list_stddev_samp(times) END AS lap_time_stddev,
       list_median(times) AS median_lap_secs, list_min(s1) AS best_sector_1_secs,
       list_min(s2) AS best_sector_2_secs, list_min(s3) AS best_sector_3_secs,
       list_min(s1) + list_min(s2) + list_min(s3) AS theoretical_best_lap_secs,
       list_max(speeds) AS top_speed_kmh, list_avg(throttle) AS avg_throttle_pct,
       list_avg(drs) AS avg_drs_usage_pct, list_avg(brake) AS avg_brake_pct
FROM (
  SELECT session_key, meeting_key, season_year, country_name, circuit_name, driver_number, driver_name,
         driver_code, team_name, team_colour, list(lap_duration) AS times, list(duration_sector_1) AS s1,
         list(duration_sector_2) AS s2, list(duration_sector_3) AS s3, list(st_speed) AS speeds,
         list(avg_throttle) AS throttle, list(drs_usage_pct) AS drs, list(avg_brake) AS brake
  FROM int_laps_enriched WHERE is_valid_lap GROUP BY ALL)""",

    "teammate_pairs": """
SELECT session_key, me.driver_number AS driver_number, mate.driver_number AS teammate_driver_number,
       mate.driver_code AS teammate_driver_code, me.best - mate.best AS gap_to_teammate_fastest_secs,
       me.mid - mate.mid AS gap_to_teammate_median_secs, me.best < mate.best AS beat_teammate_on_pace
FROM (
  SELECT session_key, team, me, unnest(team) AS mate FROM (
    SELECT session_key, team, unnest(team) AS me FROM (
      SELECT session_key, list({'driver_number': driver_number, 'driver_code': driver_code,
                                'best': fastest_lap_secs, 'mid': median_lap_secs}) AS team
      FROM driver_race_pace WHERE team_name IS NOT NULL GROUP BY session_key, team_name)))
WHERE mate.driver_number > me.driver_number""",

    "fct_driver_pace": """
SELECT *, fastest_lap_secs - (SELECT min(o.fastest_lap_secs) FROM driver_race_pace o
                              WHERE o.session_key = p.session_key) AS gap_to_session_fastest_secs,
       fastest_lap_secs - theoretical_best_lap_secs AS execution_delta_secs
FROM driver_race_pace p LEFT JOIN teammate_pairs USING (session_key, driver_number)""",

    "tyre_degradation": """
SELECT session_key, driver_number, stint_number, compound, lap_in_stint, lap_number, lap_duration,
       lap_duration - arg_min(lap_duration, lap_number) OVER (
         PARTITION BY session_key, driver_number, stint_number) AS deg_from_stint_start_secs
FROM int_laps_enriched WHERE is_valid_lap""",

    "compound_sequence": """
SELECT session_key, driver_number,
       array_to_string(list(compound ORDER BY stint_number) FILTER (WHERE compound IS NOT NULL), ' → ') AS tyre_strategy
FROM stg_stints GROUP BY ALL""",

    "pit_stop_numbers": """
SELECT session_key, driver_number, lap_number AS pit_lap, stop_duration_secs, lane_duration_secs,
       is_fast_stop, pit_entry_at,
       count(*) OVER (PARTITION BY session_key, driver_number
                      ORDER BY lap_number, pit_entry_at NULLS LAST, stop_duration_secs
                      ROWS UNBOUNDED PRECEDING) AS stop_number
FROM stg_pit""",

    "fct_pit_strategy": """
SELECT * EXCLUDE (pit_entry_at, team_colour, session_start_at, join_lap), join_lap AS pit_lap
FROM (SELECT DISTINCT session_key, driver_number, stint_number, compound, tyre_age_at_start, lap_start, lap_end,
             stint_laps, is_fresh_tyre FROM stg_stints)
LEFT JOIN (SELECT session_key, driver_number, stint_number,
                  list_avg(list(deg_from_stint_start_secs)) AS avg_deg_rate_secs_per_lap
           FROM tyre_degradation GROUP BY ALL) USING (session_key, driver_number, stint_number)
LEFT JOIN compound_sequence USING (session_key, driver_number)
LEFT JOIN driver_cards USING (session_key, driver_number)
LEFT JOIN race_cards USING (session_key)
LEFT JOIN (SELECT session_key, meeting_key FROM stg_sessions) USING (session_key)
LEFT JOIN (SELECT * EXCLUDE (pit_lap), pit_lap AS join_lap, pit_lap AS lap_end FROM pit_stop_numbers)
  USING (session_key, driver_number, lap_end)""",
}

# Sums, averages and interpolated medians of doubles: their last bits depend on the order or
# form of the arithmetic, so both sides snap them to the same binary grid.
_PIT = "total_stop_time_secs total_pit_lane_time_secs"
ROUNDED = {
    "int_race_context": _PIT, "fct_race_results": _PIT, "mart_publish": _PIT, "fct_lap_times": "median_lap_secs",
    "teammate_pairs": "gap_to_teammate_median_secs", "fct_pit_strategy": "avg_deg_rate_secs_per_lap",
    "fct_driver_pace": "avg_lap_secs lap_time_stddev median_lap_secs avg_throttle_pct avg_drs_usage_pct "
                       "avg_brake_pct gap_to_teammate_median_secs",
}

# Declared checks, per table: columns that must not be null, that must be unique, and accepted
# values; stated here from the declarations, not taken from the library.
_COMPOUNDS = ("SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET")
CHECKS = [
    ("stg_meetings", "meeting_key season_year country_name", "meeting_key", ""),
    ("stg_sessions", "session_key meeting_key", "session_key", ""),
    ("stg_drivers", "driver_number session_key team_name", "", ""),
    ("stg_laps", "session_key driver_number lap_number", "", ""),
    ("stg_stints", "session_key driver_number", "", "compound"),
    ("stg_pit", "session_key driver_number", "", ""),
    ("stg_session_results", "session_key driver_number finish_position", "", ""),
    ("stg_car_data_lap_agg", "session_key driver_number lap_number", "", ""),
    ("fct_race_results", "session_key driver_number finish_position season_year", "", ""),
    ("fct_lap_times", "session_key driver_number lap_number lap_time_secs", "", "compound"),
    ("fct_pit_strategy", "session_key driver_number stint_number compound", "", ""),
    ("fct_driver_season", "season_year driver_number session_key cumulative_points championship_position", "", ""),
    ("fct_driver_pace", "session_key driver_number fastest_lap_secs", "", ""),
    ("dim_drivers", "driver_number driver_code team_name", "driver_number", ""),
]


def checks_sql() -> str:
    rows = []

    def row(table, column, check, failures):
        name = f"'{column}'" if column else "NULL::VARCHAR"
        rows.append(f"SELECT '{table}' AS table_name, {name} AS column_name, '{check}' AS check_name, "
                    f"({failures})::BIGINT AS failures")

    for table, present, unique, accepted in CHECKS:
        for c in present.split():
            row(table, c, "not_null", f"SELECT count(*) - count({c}) FROM {table}")
        for c in unique.split():
            row(table, c, "unique", f"SELECT count(*) FROM (SELECT {c} FROM {table} GROUP BY {c} "
                                    f"HAVING count({c}) > 1)")
        for c in accepted.split():
            row(table, c, "accepted_values", f"SELECT count(DISTINCT {c}) FROM {table} WHERE {c} NOT IN {_COMPOUNDS}")
    row("raw_drivers", "", "non_empty", "SELECT CASE WHEN EXISTS (FROM raw_drivers) THEN 0 ELSE 1 END")
    return "SELECT *, failures = 0 AS passed FROM (\n" + "\nUNION ALL ".join(rows) + ")"
