"""Mart models: lap times, race results, season standings, driver pace, pit strategy.

Aggregates are computed first and joined back (pre-aggregation before the join), so the
wide enriched lap table is shuffled at most once per grouping key. Window partitions are
all bounded by the sport, not by data volume: drivers per race (~20), races per season
(~24), laps per stint (tens), stints and stops per driver-race (a handful).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwall.functions.columns import pct_off_pace, points_table

col = F.col


# ----------------------------------------------------------------------------- lap times

def session_lap_stats(laps: DataFrame) -> DataFrame:
    """Per session: exact median of all timed laps; fastest valid lap.

    ``median`` is Spark's exact percentile: its buffer is a value → count map, merged
    map-side, so a large session costs its distinct lap times, not its rows."""
    return laps.filter(col("has_timing")).groupBy("session_key").agg(
        F.median("lap_duration").alias("median_lap_secs"),
        F.min(F.when(col("is_valid_lap"), col("lap_duration"))).alias("session_fastest_lap_secs"))


def driver_best_lap(laps: DataFrame) -> DataFrame:
    return laps.groupBy("session_key", "driver_number").agg(
        F.min(F.when(col("is_valid_lap"), col("lap_duration"))).alias("driver_fastest_lap_secs"))


def fct_lap_times(laps: DataFrame, stats: DataFrame | None = None, best: DataFrame | None = None) -> DataFrame:
    """``stats`` and ``best``: the two aggregates where they are stored. Spark then knows that they
    are small before it would shuffle the laps for them."""
    stats = session_lap_stats(laps) if stats is None else stats
    best = driver_best_lap(laps) if best is None else best
    j = (laps.filter(col("has_timing")).join(stats, "session_key", "left")
             .join(best, ["session_key", "driver_number"], "left"))
    return j.select(
        "session_key", "meeting_key", "season_year", "country_name", "circuit_name",
        "driver_number", "driver_name", "driver_code", "team_name", "lap_number",
        col("lap_duration").alias("lap_time_secs"),
        col("duration_sector_1").alias("sector_1_secs"),
        col("duration_sector_2").alias("sector_2_secs"),
        col("duration_sector_3").alias("sector_3_secs"),
        "i1_speed", "i2_speed", "st_speed",
        "compound", "tyre_age_at_start", "lap_in_stint", "stint_number", "is_fresh_tyre",
        "is_valid_lap", "is_pit_out_lap",
        "session_fastest_lap_secs", "median_lap_secs", "driver_fastest_lap_secs",
        (col("lap_duration") - col("session_fastest_lap_secs")).alias("gap_to_fastest_secs"),
        pct_off_pace("lap_duration", "session_fastest_lap_secs").alias("pct_off_fastest"),
        "avg_speed", "max_speed", "avg_throttle", "avg_rpm", "avg_brake", "drs_usage_pct",
        "gear_changes", "lap_started_at")


# -------------------------------------------------------------------------- race results

def fct_race_results(race_context: DataFrame, laps: DataFrame) -> DataFrame:
    valid = laps.filter(col("is_valid_lap"))
    best = valid.groupBy("session_key", "driver_number").agg(
        F.min("lap_duration").alias("fastest_lap_secs"),
        F.count(F.lit(1)).alias("valid_laps_count"))
    race_best = best.groupBy("session_key").agg(          # rolled up from the drivers' minima
        F.min("fastest_lap_secs").alias("race_fastest_lap_secs"))
    j = (race_context.join(best, ["session_key", "driver_number"], "left")
                     .join(race_best, "session_key", "left"))
    return j.select(
        "session_key", "meeting_key", "season_year", "country_name", "circuit_name",
        "race_date", "meeting_name", "driver_number", "driver_name", "driver_code",
        "team_name", "team_colour", "finish_position", "number_of_laps",
        "gap_to_leader_secs", "gap_to_leader_raw", "race_duration_secs", "is_winner",
        "is_lapped", "finished", "dnf", "dns", "dsq", "total_pit_stops",
        "fastest_stop_secs", "total_stop_time_secs", "total_pit_lane_time_secs",
        "fastest_lap_secs", "race_fastest_lap_secs",
        (col("fastest_lap_secs") == col("race_fastest_lap_secs")).alias("set_fastest_lap"),
        (col("fastest_lap_secs") - col("race_fastest_lap_secs")).alias("gap_to_fastest_lap_secs"),
        "valid_laps_count")


# ------------------------------------------------------------------------ season standings

def race_points_rows(results: DataFrame) -> DataFrame:
    """Points per classified result: base points by position (a small literal relation,
    broadcast) plus one for the fastest lap when finished in the top ten."""
    pts = F.broadcast(points_table(results.sparkSession))  # 10 rows, fixed size
    bonus = F.when(col("set_fastest_lap") & col("finished") & (col("finish_position") <= 10),
                   F.lit(1)).otherwise(F.lit(0))
    j = (results.filter(col("finished") | col("finish_position").isNotNull())
                .join(pts, results.finish_position == pts.position, "left"))
    base = F.coalesce(col("points"), F.lit(0))
    return j.select(
        "season_year", "session_key", "meeting_key", "country_name", "race_date",
        "driver_number", "driver_name", "driver_code", "team_name", "finish_position",
        "is_winner", "finished", "dnf", "set_fastest_lap",
        base.alias("base_points"), bonus.alias("fastest_lap_bonus"),
        (base + bonus).alias("race_points"))


def season_running_totals(points: DataFrame) -> DataFrame:
    """Running points / wins / podiums / DNFs and race ordinal per (season, driver)."""
    w = (Window.partitionBy("season_year", "driver_number")
               .orderBy("race_date", "session_key"))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flag = lambda c: F.when(c, F.lit(1)).otherwise(F.lit(0))
    return points.select(
        "*",
        F.sum("race_points").over(upto).cast("long").alias("cumulative_points"),
        F.sum(flag(col("is_winner"))).over(upto).cast("long").alias("cumulative_wins"),
        F.sum(flag((col("finish_position") <= 3) & col("finished"))).over(upto)
         .cast("long").alias("cumulative_podiums"),
        F.sum(flag(col("dnf"))).over(upto).cast("long").alias("cumulative_dnfs"),
        F.row_number().over(w).cast("long").alias("race_number_in_season"))


def fct_driver_season(results: DataFrame) -> DataFrame:
    running = season_running_totals(race_points_rows(results))
    standing = Window.partitionBy("season_year", "session_key").orderBy(
        F.desc("cumulative_points"))
    return running.withColumn("championship_position",
                              F.rank().over(standing).cast("long"))


# ----------------------------------------------------------------------------- pace

PACE_KEYS = ["session_key", "meeting_key", "season_year", "country_name", "circuit_name",
             "driver_number", "driver_name", "driver_code", "team_name", "team_colour"]


def driver_race_pace(laps: DataFrame) -> DataFrame:
    s1, s2, s3 = (F.min(f"duration_sector_{i}") for i in (1, 2, 3))
    return laps.filter(col("is_valid_lap")).groupBy(*PACE_KEYS).agg(
        F.count(F.lit(1)).alias("total_valid_laps"),
        F.min("lap_duration").alias("fastest_lap_secs"),
        F.avg("lap_duration").alias("avg_lap_secs"),
        F.stddev_samp("lap_duration").alias("lap_time_stddev"),
        F.median("lap_duration").alias("median_lap_secs"),
        s1.alias("best_sector_1_secs"), s2.alias("best_sector_2_secs"),
        s3.alias("best_sector_3_secs"),
        (s1 + s2 + s3).alias("theoretical_best_lap_secs"),
        F.max("st_speed").alias("top_speed_kmh"),
        F.avg("avg_throttle").alias("avg_throttle_pct"),
        F.avg("drs_usage_pct").alias("avg_drs_usage_pct"),
        F.avg("avg_brake").alias("avg_brake_pct"))


def _with_mates(pace: DataFrame) -> DataFrame:
    """``mates``: the higher-numbered drivers of the same team in the same race. A window over
    the team-race (two or three rows, pre-aggregated) gathers them, so the pace aggregate is
    made once. A NULL team has no mates."""
    team = Window.partitionBy("session_key", "team_name")
    cards = F.collect_list(F.struct(
        col("driver_number").alias("number"), col("driver_code").alias("code"),
        col("fastest_lap_secs").alias("best"), col("median_lap_secs").alias("mid"))).over(team)
    return pace.withColumn("mates", F.when(col("team_name").isNotNull(), F.filter(
        cards, lambda m: m["number"] > col("driver_number"))))


def _mate_columns() -> list:
    return [col("mate.number").alias("teammate_driver_number"), col("mate.code").alias("teammate_driver_code"),
            (col("fastest_lap_secs") - col("mate.best")).alias("gap_to_teammate_fastest_secs"),
            (col("median_lap_secs") - col("mate.mid")).alias("gap_to_teammate_median_secs"),
            (col("fastest_lap_secs") < col("mate.best")).alias("beat_teammate_on_pace")]


def teammate_pairs(pace: DataFrame) -> DataFrame:
    """Each driver against every higher-numbered driver of the same team in the same race."""
    pairs = _with_mates(pace).withColumn("mate", F.explode("mates"))
    return pairs.select("session_key", "driver_number", *_mate_columns())


def fct_driver_pace(laps: DataFrame) -> DataFrame:
    pace = driver_race_pace(laps)
    session_best = F.min("fastest_lap_secs").over(Window.partitionBy("session_key"))
    rows = (_with_mates(pace).withColumn("session_best", session_best)
                             .withColumn("mate", F.explode_outer("mates")))
    return rows.select(
        *PACE_KEYS, "total_valid_laps", "fastest_lap_secs", "avg_lap_secs", "lap_time_stddev",
        "median_lap_secs", "best_sector_1_secs", "best_sector_2_secs", "best_sector_3_secs",
        "theoretical_best_lap_secs", "top_speed_kmh", "avg_throttle_pct", "avg_drs_usage_pct",
        "avg_brake_pct",
        (col("fastest_lap_secs") - col("session_best")).alias("gap_to_session_fastest_secs"),
        *_mate_columns(),
        (col("fastest_lap_secs") - col("theoretical_best_lap_secs")).alias("execution_delta_secs"))


# --------------------------------------------------------------------------- strategy

def tyre_degradation(laps: DataFrame) -> DataFrame:
    """Valid laps with their time minus the first valid lap of the same stint."""
    w = (Window.partitionBy("session_key", "driver_number", "stint_number")
               .orderBy("lap_number")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return laps.filter(col("is_valid_lap")).select(
        "session_key", "driver_number", "stint_number", "compound", "lap_in_stint",
        "lap_number", "lap_duration",
        (col("lap_duration") - F.first("lap_duration").over(w)).alias("deg_from_stint_start_secs"))


def compound_sequence(stints: DataFrame) -> DataFrame:
    """'SOFT → MEDIUM → ...' in stint order per driver-race (NULL compounds skipped)."""
    return stints.groupBy("session_key", "driver_number").agg(
        F.expr("listagg(compound, ' → ') WITHIN GROUP (ORDER BY stint_number, compound)")
         .alias("tyre_strategy"))


def pit_stop_numbers(pit: DataFrame) -> DataFrame:
    """Ordinal of each stop per driver-race, by lap (entry time breaks ties)."""
    w = Window.partitionBy("session_key", "driver_number").orderBy(
        "lap_number", F.asc_nulls_last("pit_entry_at"), "stop_duration_secs")
    return pit.select(
        "session_key", "driver_number", col("lap_number").alias("pit_lap"),
        "stop_duration_secs", "lane_duration_secs", "is_fast_stop", "pit_entry_at",
        F.row_number().over(w).cast("long").alias("stop_number"))


STINT_COLS = ["session_key", "driver_number", "stint_number", "compound",
              "tyre_age_at_start", "lap_start", "lap_end", "stint_laps", "is_fresh_tyre"]


def stint_summary(stints: DataFrame, laps: DataFrame) -> DataFrame:
    """Stints with their mean degradation. The reference joins laps to stints and then
    groups; here the laps are aggregated per stint first and joined after — the same
    result (the stint columns are de-duplicated as the GROUP BY would), with the lap-level
    join replaced by a stint-level one."""
    deg = tyre_degradation(laps).groupBy("session_key", "driver_number", "stint_number").agg(
        F.avg("deg_from_stint_start_secs").alias("avg_deg_rate_secs_per_lap"))
    return stints.select(*STINT_COLS).distinct().join(
        deg, ["session_key", "driver_number", "stint_number"], "left")


def fct_pit_strategy(stg: dict[str, DataFrame], laps: DataFrame) -> DataFrame:
    stints = stg["stg_stints"]
    ss = stint_summary(stints, laps)
    sessions = stg["stg_sessions"].select(
        "session_key", "meeting_key", "season_year", "country_name", "circuit_name")
    drivers = stg["stg_drivers"].select(
        "driver_number", "session_key", "driver_name", "driver_code", "team_name")
    stops = pit_stop_numbers(stg["stg_pit"]).withColumnRenamed("session_key", "_p_session") \
        .withColumnRenamed("driver_number", "_p_driver")
    j = (ss.join(sessions, "session_key", "left")
           .join(drivers, ["session_key", "driver_number"], "left")
           .join(compound_sequence(stints), ["session_key", "driver_number"], "left"))
    j = j.join(stops, (j.session_key == stops._p_session) & (j.driver_number == stops._p_driver)
               & (j.lap_end == stops.pit_lap), "left")
    return j.select(
        "session_key", "driver_number", "meeting_key", "season_year", "country_name",
        "circuit_name", "driver_name", "driver_code", "team_name", "stint_number", "compound",
        "tyre_age_at_start", "lap_start", "lap_end", "stint_laps", "is_fresh_tyre",
        "avg_deg_rate_secs_per_lap", "tyre_strategy", "pit_lap", "stop_number",
        "stop_duration_secs", "lane_duration_secs", "is_fast_stop")
