"""Race-shaped raw tables derived from the star-schema test data.

The test data is a TPC-H-like star schema plus an ``events`` stream. These functions map it
onto the eight raw tables of the pipeline (and onto telemetry samples, lap boundaries and
a session calendar) with integer-only formulas, so that any SQL engine computing the same
formulas gets bit-identical inputs. The mapping (``FIXTURES.md §3``):

* one lineitem row = one lap; session = year·100 + month of ``l_shipdate``; driver =
  ``l_suppkey % 20 + 1``; lap number = order of the rows inside (session, driver);
* sector times in integer milliseconds from key arithmetic, seconds = ms / 1000;
* stints split each driver's laps into ``2 + driver % 3`` runs; one pit stop ends each
  stint but the last; results rank drivers by laps then total time;
* ``events`` supply telemetry: driver = user, sample time = ``ts``, speed = ``value``,
  and each ``signup`` event starts a lap.

Everything is lazy: each function returns a DataFrame whose work grows with the input.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitwall.functions.columns import idiv
from pitwall.plans.lazy import Lazy, once
from pitwall.session import checkpoint_dir

# Fixed values of the fixture (shared with the SQL oracle).
COMPOUND_CHOICES = (" soft", "Medium", "HARD ", "intermediate", "wet", None)
SCHEDULE_STATUSES = ("pending", "running", "done", "skipped", "failed")
TELEMETRY_EPOCH = "2024-01-01"  # telemetry session = week number since this day


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ms_to_secs(ms: Column) -> Column:
    return ms.cast("double") / 1000


def _ms_text(ms: Column) -> Column:
    """Integer milliseconds as text ``s.mmm``."""
    return F.concat(idiv(ms, 1000).cast("string"), F.lit("."),
                    F.lpad((ms % 1000).cast("string"), 3, "0"))


def _ts(year: Column, month: Column, day: int, hour: int = 0) -> Column:
    return F.make_timestamp_ntz(year, month, F.lit(day), F.lit(hour), F.lit(0), F.lit(0))


def _plus_seconds(ts: Column, secs: Column) -> Column:
    return F.timestamp_add("SECOND", secs, ts)


def numbered_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem with its session, driver and lap order ``rn``. Only given columns are
    shuffled; :func:`lap_base` derives the rest."""
    yr, mo = F.year("l_shipdate"), F.month("l_shipdate")
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_shipdate",
        (yr * 100 + mo).cast("long").alias("sk"),
        (F.col("l_suppkey") % 20 + 1).cast("int").alias("dn"))
    # Lap order inside (session, driver); the sort tuple is unique per lineitem row.
    w = Window.partitionBy("sk", "dn").orderBy(
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return li.withColumn("rn", F.row_number().over(w))


def lap_base(numbered: DataFrame) -> DataFrame:
    """The numbered laps with their year, month and lap times in ms."""
    df = numbered.select(
        "*",
        F.year("l_shipdate").alias("yr"), F.month("l_shipdate").alias("mo"),
        (25000 + (13 * F.col("l_partkey") + 7 * F.col("l_linenumber")) % 6000).alias("s1_ms"),
        (28000 + (17 * F.col("l_orderkey")) % 7000).alias("s2_ms"),
        (27000 + (29 * F.col("l_suppkey") + 3 * F.col("l_orderkey")) % 7000).alias("s3_ms"),
    )
    return df.withColumn("dur_ms", F.col("s1_ms") + F.col("s2_ms") + F.col("s3_ms"))


def _lineage(yr: Column, mo: Column, day: int) -> list[Column]:
    return [_ts(yr, mo, day).alias("_loaded_at"),
            F.concat(F.lit("fixture_"), (yr * 100 + mo).cast("string")).alias("_run_id")]


def raw_laps(base: DataFrame) -> DataFrame:
    b = F.col
    return base.select(
        b("sk").alias("session_key"),
        (b("sk") * 10).alias("meeting_key"),
        b("dn").alias("driver_number"),
        F.when(b("l_orderkey") % 1013 != 7, b("rn")).cast("int").alias("lap_number"),
        _plus_seconds(_ts(b("yr"), b("mo"), 1, 13), b("rn") * 90).alias("date_start"),
        F.when(b("l_orderkey") % 17 != 0, _ms_to_secs(b("dur_ms"))).alias("lap_duration"),
        F.when(b("l_partkey") % 53 != 0, _ms_to_secs(b("s1_ms"))).alias("duration_sector_1"),
        _ms_to_secs(b("s2_ms")).alias("duration_sector_2"),
        _ms_to_secs(b("s3_ms")).alias("duration_sector_3"),
        (200 + b("l_partkey") % 100).cast("double").alias("i1_speed"),
        (210 + b("l_orderkey") % 90).cast("double").alias("i2_speed"),
        (280 + (b("l_partkey") + b("l_orderkey")) % 60).cast("double").alias("st_speed"),
        F.when(b("l_returnflag") != "N", b("l_linenumber") == 1).alias("is_pit_out_lap"),
        *_lineage(b("yr"), b("mo"), 2),
    )


def _stint_groups(base: DataFrame) -> DataFrame:
    n = F.count(F.lit(1)).over(Window.partitionBy("sk", "dn"))
    per_lap = base.select(
        "sk", "dn", "yr", "mo", "rn",
        (idiv((F.col("rn") - 1) * (2 + F.col("dn") % 3), n) + 1).cast("int").alias("stint"))
    g = per_lap.groupBy("sk", "dn", "yr", "mo", "stint").agg(
        F.min("rn").alias("first_lap"), F.max("rn").alias("last_lap"))
    last = F.max("stint").over(Window.partitionBy("sk", "dn"))
    return g.withColumn("is_last", F.col("stint") == last)


def raw_stints(base: DataFrame) -> DataFrame:
    g = _stint_groups(base)
    b = F.col
    pick = (b("stint") + b("dn")) % 6
    compound = F.lit(None).cast("string")
    for i, name in reversed(list(enumerate(COMPOUND_CHOICES))):
        if name is not None:
            compound = F.when(pick == i, F.lit(name)).otherwise(compound)
    return g.select(
        b("sk").alias("session_key"),
        (b("sk") * 10).alias("meeting_key"),
        b("dn").alias("driver_number"),
        b("stint").alias("stint_number"),
        b("first_lap").cast("int").alias("lap_start"),
        F.when(~(b("is_last") & (b("dn") % 2 == 0)), b("last_lap")).cast("int").alias("lap_end"),
        compound.alias("compound"),
        ((b("dn") * b("stint")) % 4).cast("int").alias("tyre_age_at_start"),
        *_lineage(b("yr"), b("mo"), 2),
    )


def raw_pit(base: DataFrame) -> DataFrame:
    g = _stint_groups(base).filter(~F.col("is_last") & (F.col("dn") % 7 != 0))
    b = F.col
    pit = 20 + ((b("sk") + 3 * b("dn") + 5 * b("stint")) % 60).cast("double") / 10
    stop = 2 + ((7 * b("dn") + 3 * b("stint") + b("sk")) % 20).cast("double") / 10
    return g.select(
        b("sk").alias("session_key"),
        (b("sk") * 10).alias("meeting_key"),
        b("dn").alias("driver_number"),
        b("last_lap").cast("int").alias("lap_number"),
        _plus_seconds(_ts(b("yr"), b("mo"), 1, 13), b("last_lap") * 90 + 45).alias("date"),
        F.when(b("sk") % 2 != 0, stop).alias("stop_duration"),
        F.when(b("sk") % 3 != 0, pit).alias("lane_duration"),
        pit.alias("pit_duration"),
        *_lineage(b("yr"), b("mo"), 2),
    )


def raw_session_results(base: DataFrame) -> DataFrame:
    per = base.groupBy("sk", "dn", "yr", "mo").agg(
        F.count(F.lit(1)).alias("n"), F.sum("dur_ms").alias("total_ms"))
    w = Window.partitionBy("sk").orderBy(F.desc("n"), F.asc("total_ms"), F.asc("dn"))
    per = (per.withColumn("pos", F.row_number().over(w))
              .withColumn("lead_n", F.first("n").over(w))
              .withColumn("lead_ms", F.first("total_ms").over(w)))
    b = F.col
    out_flag = (b("sk") + b("dn")) % 23 == 0
    down = b("lead_n") - b("n")
    gap = (F.when(b("pos") == 1, F.lit("0"))
             .when(down > 5, F.concat(F.lit("+"), down.cast("string"), F.lit(" LAPS")))
             .otherwise(_ms_text(F.abs(b("total_ms") - b("lead_ms")))))
    return per.select(
        b("sk").alias("session_key"),
        (b("sk") * 10).alias("meeting_key"),
        b("dn").alias("driver_number"),
        F.when(~out_flag, b("pos")).cast("int").alias("position"),
        b("n").cast("int").alias("number_of_laps"),
        gap.alias("gap_to_leader"),
        F.when(~out_flag, _ms_text(b("total_ms"))).alias("duration"),
        F.when(out_flag, F.lit(True)).when(b("dn") % 3 == 0, F.lit(None).cast("boolean"))
         .otherwise(F.lit(False)).alias("dnf"),
        F.lit(None).cast("boolean").alias("dns"),
        ((b("sk") + 2 * b("dn")) % 37 == 0).alias("dsq"),
        *_lineage(b("yr"), b("mo"), 2),
    )


def raw_drivers(base: DataFrame) -> DataFrame:
    d = base.select("sk", "dn", "yr", "mo").distinct()
    b = F.col
    team_no = (idiv(b("dn") - 1, 2) + 1
               + F.when((b("dn") % 5 == 0) & (b("yr") >= 1999), 1).otherwise(0))
    colour_code = F.concat(F.lit("C0FFE"), (team_no % 10).cast("string"))
    dn_txt = b("dn").cast("string")

    def row(team: Column, name_prefix: str, loaded: Column) -> list[Column]:
        return [
            b("dn").alias("driver_number"), b("sk").alias("session_key"),
            (b("sk") * 10).alias("meeting_key"),
            F.concat(F.lit(name_prefix), dn_txt, F.lit(" ")).alias("full_name"),
            F.concat(F.lit("D "), dn_txt).alias("broadcast_name"),
            F.concat(F.lit("D"), F.lpad(dn_txt, 2, "0")).alias("name_acronym"),
            F.concat(F.lit("First"), dn_txt).alias("first_name"),
            F.concat(F.lit("Last"), dn_txt, F.lit(" ")).alias("last_name"),
            team.alias("team_name"),
            (F.when(team_no % 3 == 1, F.concat(F.lit("#"), colour_code))
              .when(team_no % 3 == 2, colour_code)).alias("team_colour"),
            F.concat(F.lit(" C"), (b("dn") % 7).cast("string")).alias("country_code"),
            F.concat(F.lit("headshots/"), dn_txt, F.lit(".png")).alias("headshot_url"),
            loaded.alias("_loaded_at"),
            F.concat(F.lit("fixture_"), b("sk").cast("string")).alias("_run_id"),
        ]

    team = F.when((b("sk") + b("dn")) % 13 != 0,
                  F.concat(F.lit("Team "), team_no.cast("string"), F.lit(" ")))
    current = d.select(*row(team, " Driver ", _ts(b("yr"), b("mo"), 3)))
    # Re-sent copies: an older load for every 4th driver; every 8th copy has no load time
    # (which sorts first on a descending order with NULLs first, so it wins the dedup).
    older = F.when(b("dn") % 8 != 0, _ts(b("yr"), b("mo"), 2))
    copies = d.filter(b("dn") % 4 == 0).select(*row(F.lit("Team Legacy"), " Old Driver ", older))
    # drivers of a session that the calendar does not know (yet)
    unknown = d.filter((b("dn") == 3) & (b("mo") == 1)).select(*row(team, " Driver ", _ts(b("yr"), b("mo"), 4)))
    unknown = unknown.withColumn("session_key", F.col("session_key") + 50)
    return current.unionByName(copies).unionByName(unknown)


def raw_sessions(base: DataFrame) -> DataFrame:
    s = base.select("sk", "yr", "mo").distinct()
    b = F.col
    mo_txt = b("mo").cast("string")
    return s.select(
        b("sk").alias("session_key"), (b("sk") * 10).alias("meeting_key"),
        b("yr").cast("int").alias("year"),
        F.lit("Race").alias("session_name"), F.lit("Race").alias("session_type"),
        F.concat(F.lit(" Circuit "), mo_txt, F.lit(" ")).alias("circuit_short_name"),
        F.concat(F.lit("Country "), mo_txt, F.lit(" ")).alias("country_name"),
        F.concat(F.lit(" Town "), mo_txt).alias("location"),
        _ts(b("yr"), b("mo"), 1, 13).alias("date_start"),
        _ts(b("yr"), b("mo"), 1, 15).alias("date_end"),
        F.lit("00:00:00").alias("gmt_offset"),
        *_lineage(b("yr"), b("mo"), 1),
    )


def raw_meetings(base: DataFrame) -> DataFrame:
    s = base.select("sk", "yr", "mo").distinct()
    b = F.col
    mo_txt = b("mo").cast("string")
    return s.select(
        (b("sk") * 10).alias("meeting_key"), b("yr").cast("int").alias("year"),
        F.concat(F.lit("Country "), mo_txt, F.lit(" ")).alias("country_name"),
        F.concat(F.lit("C"), mo_txt).alias("country_code"),
        F.concat(F.lit(" Circuit "), mo_txt, F.lit(" ")).alias("circuit_short_name"),
        F.concat(F.lit(" Town "), mo_txt).alias("location"),
        F.concat(F.lit("Grand Prix "), mo_txt).alias("meeting_name"),
        F.concat(F.lit(" Grand Prix "), b("yr").cast("string"), F.lit("-"), mo_txt)
         .alias("meeting_official_name"),
        _ts(b("yr"), b("mo"), 1, 0).alias("date_start"),
        _ts(b("yr"), b("mo"), 1, 18).alias("date_end"),
        F.lit("00:00:00").alias("gmt_offset"),
        *_lineage(b("yr"), b("mo"), 1),
    )


def raw_car_data_lap_agg(base: DataFrame) -> DataFrame:
    b = F.col
    return base.filter(b("l_orderkey") % 13 != 0).select(
        b("sk").alias("session_key"), (b("sk") * 10).alias("meeting_key"),
        b("dn").alias("driver_number"),
        F.when(b("l_orderkey") % 1013 != 7, b("rn")).cast("int").alias("lap_number"),
        (180 + ((7 * b("l_partkey") + b("l_orderkey")) % 600).cast("double") / 10).alias("avg_speed"),
        (300 + b("l_partkey") % 40).cast("long").alias("max_speed"),
        (70 + b("l_orderkey") % 30).cast("long").alias("min_speed"),
        (50 + ((3 * b("l_orderkey")) % 400).cast("double") / 10).alias("avg_throttle"),
        (10000 + (11 * b("l_partkey")) % 2000).cast("double").alias("avg_rpm"),
        (12000 + b("l_suppkey") % 500).cast("long").alias("max_rpm"),
        (((37 * b("l_linenumber")) % 250).cast("double") / 10).alias("avg_brake"),
        ((b("l_orderkey") % 300).cast("double") / 10).alias("drs_usage_pct"),
        (40 + b("l_partkey") % 20).cast("long").alias("gear_changes"),
        (2 * F.floor("l_quantity")).cast("long").alias("sample_count"),
        *_lineage(b("yr"), b("mo"), 2),
    )


RAW_NAMES = ("meetings", "sessions", "drivers", "laps", "stints", "pit", "session_results",
             "car_data_lap_agg")


def derived_tables(spark: SparkSession, sf_dir: str, numbered: DataFrame | None = None) -> Lazy:
    """Every fixture table as a lazy derivation from the star schema (nothing written), or from a
    stored :func:`numbered_laps`, where one query reads most of them."""
    base = once(lambda: lap_base(numbered_laps(spark, sf_dir) if numbered is None else numbered))
    raw = {
        "meetings": lambda: raw_meetings(base()),
        "sessions": lambda: raw_sessions(base()),
        "drivers": lambda: raw_drivers(base()),
        "laps": lambda: raw_laps(base()),
        "stints": lambda: raw_stints(base()),
        "pit": lambda: raw_pit(base()),
        "session_results": lambda: raw_session_results(base()),
        "car_data_lap_agg": lambda: raw_car_data_lap_agg(base()),
        "car_data": lambda: car_data_samples(spark, sf_dir),
        "lap_starts": lambda: lap_starts(spark, sf_dir),
    }
    return Lazy(raw)


def raw_tables(spark: SparkSession, sf_dir: str) -> Lazy:
    """The eight raw tables for ``sf_dir``; each built on first access."""
    derived = derived_tables(spark, sf_dir)
    return Lazy({n: (lambda n=n: derived[n]) for n in RAW_NAMES})


def json_feed(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Write a feed as JSON files, one folder per session (like per-session API dumps), to a
    new folder under the shared checkpoint folder; returns that folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/pitwall-json/{name}-{uuid.uuid4().hex}"
    derived_tables(spark, sf_dir)[name].write.partitionBy("session_key").json(path)
    return path


# --------------------------------------------------------------------------- telemetry

def _iso_text(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props")
    week = idiv(F.datediff(F.to_date("ts"), F.lit(TELEMETRY_EPOCH).cast("date")), 7) + 1
    return ev.withColumn("sk", week.cast("long"))


def car_data_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry samples as landed: loosely typed text fields (see ``CAR_DATA_TEXT``)."""
    ev = _events(spark, sf_dir)
    b = F.col
    gear_k = F.get_json_object("props", "$.k").cast("long")
    txt = lambda c: c.cast("string")
    return ev.select(
        F.when(b("event_id") % 97 != 0, _iso_text(b("ts"))).otherwise(F.lit("not-a-date")).alias("date"),
        txt(b("sk")).alias("session_key"),
        txt(b("sk") * 10).alias("meeting_key"),
        txt(b("user_id")).alias("driver_number"),
        txt(b("value")).alias("speed"),
        txt(b("event_id") % 101).alias("throttle"),
        txt(9000 + (7 * b("event_id")) % 3000).alias("rpm"),
        (F.when(b("event_type") == "error", F.lit("100"))
          .when(b("event_id") % 5 != 0, F.lit("0"))).alias("brake"),
        F.when(b("event_id") % 19 != 0, txt(b("event_id") % 16)).alias("drs"),
        (F.when(b("event_id") % 89 == 0, F.lit("n/a"))
          .when(b("event_id") % 11 != 0, txt(gear_k % 8))).alias("n_gear"),
        b("event_id").alias("sample_id"),
    )


def lap_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lap boundaries as landed: one row per ``signup`` event, numbered per user."""
    ev = _events(spark, sf_dir).filter(F.col("event_type") == "signup")
    w = Window.partitionBy("sk", "user_id").orderBy("ts", "event_id")
    b = F.col
    return ev.select(
        b("sk").cast("string").alias("session_key"),
        b("user_id").cast("string").alias("driver_number"),
        F.row_number().over(w).cast("string").alias("lap_number"),
        F.when(b("event_id") % 53 != 0, _iso_text(b("ts"))).alias("date_start"),
    )


# --------------------------------------------------------------------------- calendar

def calendar_feed(sessions: DataFrame) -> DataFrame:
    """Session calendar as the API returns it: text dates, some fields missing."""
    s = sessions
    b = F.col
    iso = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    return s.select(
        "session_key",
        F.when(b("session_key") % 11 != 0, b("meeting_key")).alias("meeting_key"),
        "year",
        F.when(b("session_key") % 7 != 0, b("country_name")).alias("country_name"),
        "circuit_short_name",
        F.when(b("session_key") % 6 == 1, F.lit("Sprint")).otherwise(b("session_name")).alias("session_name"),
        "session_type",
        iso(b("date_start")).alias("date_start"),
        F.when(b("session_key") % 13 != 0, iso(b("date_end"))).otherwise(F.lit("TBC")).alias("date_end"),
        "gmt_offset",
    )


def existing_schedule(sessions: DataFrame) -> DataFrame:
    """Work-list rows already present before a calendar sync (every third session)."""
    s = sessions.filter(F.col("session_key") % 3 == 0)
    b = F.col
    status = F.lit(None).cast("string")
    for i, name in reversed(list(enumerate(SCHEDULE_STATUSES))):
        status = F.when(b("session_key") % 5 == i, F.lit(name)).otherwise(status)
    return s.select(
        "session_key", "meeting_key", "year", "country_name", "circuit_short_name",
        "session_name", "session_type", "date_start", "date_end", "gmt_offset",
        F.timestamp_add("HOUR", F.lit(1), b("date_end")).alias("trigger_after"),
        status.alias("status"),
        (b("session_key") % 4).cast("int").alias("retry_count"),
    )
