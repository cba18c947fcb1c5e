"""Session work-list: calendar sync and the queries a scheduler asks of it.

Only the table logic lives here (the scheduler, HTTP calls and notifications do not):
``now`` is always a parameter, so every query is reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.functions.columns import parse_iso_timestamp
from pitwall.operators.ingest import append_absent

col = F.col
RACE_SESSION_NAMES = ("Race",)  # fixed value: sessions that are extracted
MAX_RETRIES = 3                  # fixed value: failed sessions are retried below this count
OFF_SEASON_DAYS = 60             # fixed value: more days than this to the next race = idle


def _ts(x) -> Column:
    return F.lit(x).cast("timestamp_ntz") if not isinstance(x, Column) else x


def calendar_rows(calendar: DataFrame, default_year: int | None = None) -> DataFrame:
    """Race sessions of a calendar feed → new work-list rows (status 'pending').

    Sessions without a key (or key 0) or without a parsable end date are skipped; the
    extraction trigger is one hour after the end; missing fields get defaults."""
    end = parse_iso_timestamp(col("date_end")).cast("timestamp_ntz")
    year = col("year").cast("int")
    if default_year is not None:
        year = F.coalesce(F.when(year != 0, year), F.lit(default_year))
    return calendar.filter(
        col("session_name").isin(*RACE_SESSION_NAMES)
        & F.coalesce(col("session_key") != 0, F.lit(False)) & end.isNotNull()
    ).select(
        col("session_key").cast("long").alias("session_key"),
        F.coalesce(F.when(col("meeting_key") != 0, col("meeting_key")), F.lit(0)).cast("long").alias("meeting_key"),
        year.alias("year"),
        F.coalesce(col("country_name"), F.lit("")).alias("country_name"),
        col("circuit_short_name"),
        F.coalesce(col("session_name"), F.lit("")).alias("session_name"),
        F.coalesce(col("session_type"), F.lit("")).alias("session_type"),
        parse_iso_timestamp(col("date_start")).cast("timestamp_ntz").alias("date_start"),
        end.alias("date_end"),
        col("gmt_offset"),
        F.timestamp_add("HOUR", F.lit(1), end).alias("trigger_after"),
        F.lit("pending").alias("status"),
        F.lit(0).alias("retry_count"))


def sync_calendar(calendar: DataFrame, schedule: DataFrame,
                  default_year: int | None = None) -> DataFrame:
    """Schedule after a sync: existing rows untouched, new race sessions appended."""
    rows = calendar_rows(calendar, default_year)
    return append_absent(rows, schedule.select(*rows.columns), ["session_key"], ["trigger_after"])


def next_pending(schedule: DataFrame, now) -> DataFrame:
    """The next pending session strictly after ``now`` (top-1), with the whole days until
    its trigger and whether that is off-season (> 60 days)."""
    now = _ts(now)
    nxt = (schedule.filter((col("status") == "pending") & (col("trigger_after") > now))
                   .orderBy("trigger_after", "session_key").limit(1))
    secs = F.unix_seconds(col("trigger_after").cast("timestamp")) - F.unix_seconds(now.cast("timestamp"))
    days = F.floor(secs / 86400)
    return nxt.select("session_key", "country_name", "session_name", "trigger_after",
                      days.alias("days_until"), (days > OFF_SEASON_DAYS).alias("is_off_season"))


def ready_sessions(schedule: DataFrame, now) -> DataFrame:
    """Sessions to extract now: pending or failed, due, under the retry limit."""
    return (schedule.filter(col("status").isin("pending", "failed")
                            & (col("trigger_after") <= _ts(now))
                            & (col("retry_count") < MAX_RETRIES))
                    .orderBy("trigger_after", "session_key"))


def backfill_sessions(schedule: DataFrame, year: int, now) -> DataFrame:
    """Past race sessions of ``year`` not yet done or skipped (no retry limit)."""
    return (schedule.filter((col("year") == year) & (col("session_name") == "Race")
                            & (col("date_end") < _ts(now))
                            & ~col("status").isin("done", "skipped"))
                    .orderBy("date_end", "session_key"))
