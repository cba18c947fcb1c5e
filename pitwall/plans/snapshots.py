"""Driver history: the SCD-2 snapshot of drivers (team spells) and the driver dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.operators import scd
from pitwall.operators.dedup import latest_per_key

DRIVER_ATTRS = ["driver_name", "driver_code", "broadcast_name", "first_name", "last_name",
                "team_name", "team_colour", "country_code", "headshot_url",
                "latest_session_key", "_loaded_at"]
CHECK_COLS = ["team_name"]


def _snapshot_input(drivers_stg: DataFrame) -> DataFrame:
    return drivers_stg.select("driver_number", *[c for c in DRIVER_ATTRS if c != "latest_session_key"],
                              F.col("session_key").alias("latest_session_key"))


def latest_driver_rows(drivers_stg: DataFrame) -> DataFrame:
    """The snapshot's input: newest row per driver (highest session, then newest load with
    NULL loads first) — as an aggregation, so re-sent copies collapse map-side."""
    return latest_per_key(_snapshot_input(drivers_stg), ["driver_number"],
                          order=[("latest_session_key", False), ("_loaded_at", True)])


def driver_history(drivers_stg: DataFrame, sessions_stg: DataFrame) -> DataFrame:
    """One observation per driver and race; the snapshot run that saw it happened when the
    race was extracted: session end + 1 hour, or the load time where the session is unknown."""
    runs = sessions_stg.select(
        "session_key", F.timestamp_add("HOUR", F.lit(1), F.col("session_end_at")).alias("run_ts"))
    seen = _snapshot_input(drivers_stg).join(
        runs.withColumnRenamed("session_key", "latest_session_key"), "latest_session_key", "left")
    return seen.withColumn("run_ts", F.coalesce("run_ts", "_loaded_at"))


def scd_drivers_replay(stg: dict[str, DataFrame], max_session_key: int | None = None) -> DataFrame:
    hist = driver_history(stg["stg_drivers"], stg["stg_sessions"])
    if max_session_key is not None:
        hist = hist.filter(F.col("latest_session_key") < max_session_key)
    return scd.replay(hist, "driver_number", CHECK_COLS,
                      ["latest_session_key", F.col("_loaded_at").asc_nulls_first()],
                      "run_ts", DRIVER_ATTRS)


def scd_drivers_increment(snapshot: DataFrame, drivers_stg: DataFrame, run_ts) -> DataFrame:
    return scd.increment(snapshot, latest_driver_rows(drivers_stg), "driver_number",
                         CHECK_COLS, DRIVER_ATTRS, run_ts)


def dim_drivers(snapshot: DataFrame) -> DataFrame:
    """Every spell (closed ones included) with an is-current flag."""
    return snapshot.select(
        "driver_number", "driver_name", "driver_code", "broadcast_name", "first_name",
        "last_name", "team_name", "team_colour", "country_code", "headshot_url",
        "latest_session_key",
        F.col("valid_from").alias("active_since"), F.col("valid_to").alias("active_until"),
        F.col("valid_to").isNull().alias("is_current_record"))
