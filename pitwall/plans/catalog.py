"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Every query reads the star-schema test tables of ``sf_dir`` (through the fixture mapping
in ``pitwall.sources.fixtures``, as lazy derivations) and runs the model or operator over all
of it. ``models(spark, sf_dir)`` is the model graph of one data folder, built anew for each
query: nothing is kept between queries.

``ROUND_COLS`` lists double columns whose last bits depend on summation order; both this
side and the SQL oracle snap them to a binary grid (multiples of 2^-20, ~1e-6) before
comparing. A binary grid, unlike a decimal one, has no rounding ties at the decimal
values that averages of millisecond times produce exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.operators import ingest, keyed, layout, spells, telemetry, versions
from pitwall.plans import enrich, marts, pipeline, reports, snapshots, views, worklist
from pitwall.plans.lazy import Lazy
from pitwall.plans.staging import build_staging
from pitwall.sources import fixtures, landing, schemas

Query = Callable[[SparkSession, str], DataFrame]

LAP_KEYS = ["session_key", "driver_number", "lap_number"]
SCD_CUTOFF_SESSION = 200001          # first snapshot round: races before 2000
SCD_RUN_TS = "2002-06-01 00:00:00"   # second round's run time
WORKLIST_NOW = "2000-06-01 16:00:00"
BACKFILL_YEAR = 2000

def models(spark: SparkSession, sf_dir: str, stored: tuple[str, ...] = (),
           observed: dict[str, dict[str, int]] | None = None) -> Lazy:
    """The model graph; models named in ``stored`` are written to the shared folder once, for
    reports that read them repeatedly (``lap_base``: the numbered laps all raw tables start from).
    Spark knows the size of a stored table when it plans a join, of a derived one only after the
    other side may have been shuffled; so small tables that are joined to all laps are stored too.
    ``observed`` gets the counts their write jobs took."""
    base = materialize(spark, fixtures.numbered_laps(spark, sf_dir), "lap_base") if "lap_base" in stored else None
    raw = fixtures.derived_tables(spark, sf_dir, base)
    stg = build_staging(raw)
    graph: dict[str, Lazy] = {}

    def b(name):  # another model of this graph
        return graph["m"][name]

    builders = {f"raw_{n}": (lambda n=n: raw[n]) for n in fixtures.RAW_NAMES}
    builders.update({n: (lambda n=n: stg[n]) for n in stg})
    builders.update({
        "stint_interval_join": lambda: enrich.laps_with_stints(b("stg_laps"), b("stg_stints")),
        "int_laps_enriched": lambda: enrich.int_laps_enriched(graph["m"]),
        "int_race_context": lambda: enrich.int_race_context(graph["m"]),
        "session_lap_stats": lambda: marts.session_lap_stats(b("int_laps_enriched")),
        "driver_best_lap": lambda: marts.driver_best_lap(b("int_laps_enriched")),
        "fct_lap_times": lambda: marts.fct_lap_times(b("int_laps_enriched"), b("session_lap_stats"), b("driver_best_lap")),
        "fct_race_results": lambda: marts.fct_race_results(b("int_race_context"),
                                                           b("int_laps_enriched")),
        "race_points_rows": lambda: marts.race_points_rows(b("fct_race_results")),
        "season_running_totals": lambda: marts.season_running_totals(b("race_points_rows")),
        "fct_driver_season": lambda: marts.fct_driver_season(b("fct_race_results")),
        "driver_race_pace": lambda: marts.driver_race_pace(b("int_laps_enriched")),
        "teammate_pairs": lambda: marts.teammate_pairs(b("driver_race_pace")),
        "fct_driver_pace": lambda: marts.fct_driver_pace(b("int_laps_enriched")),
        "tyre_degradation": lambda: marts.tyre_degradation(b("int_laps_enriched")),
        "compound_sequence": lambda: marts.compound_sequence(b("stg_stints")),
        "pit_stop_numbers": lambda: marts.pit_stop_numbers(b("stg_pit")),
        "fct_pit_strategy": lambda: marts.fct_pit_strategy(graph["m"], b("int_laps_enriched")),
        # telemetry
        "car_data": lambda: landing.typed_car_data(raw["car_data"]),
        "lap_starts": lambda: landing.typed_lap_starts(raw["lap_starts"]),
        "telemetry_assigned": lambda: telemetry.assign_laps(b("car_data"), b("lap_starts")),
        "telemetry_lap_agg": lambda: telemetry.lap_summary(b("telemetry_assigned")),
        "telemetry_from_json": lambda: telemetry.car_data_lap_agg(
            landing.typed_car_data(landing.read_landed_json(
                spark, fixtures.json_feed(spark, sf_dir, "car_data"),
                schemas.CAR_DATA_TEXT)),
            landing.typed_lap_starts(landing.read_landed_json(
                spark, fixtures.json_feed(spark, sf_dir, "lap_starts"),
                schemas.LAP_STARTS_TEXT))),
        # snapshot
        "scd_drivers_replay": lambda: snapshots.scd_drivers_replay(stg),
        "scd_drivers_increment": lambda: snapshots.scd_drivers_increment(
            snapshots.scd_drivers_replay(stg, max_session_key=SCD_CUTOFF_SESSION),
            b("stg_drivers"), SCD_RUN_TS),
        "dim_drivers": lambda: snapshots.dim_drivers(b("scd_drivers_replay")),
        # work-list
        "worklist_calendar": lambda: worklist.sync_calendar(
            fixtures.calendar_feed(raw["sessions"]), fixtures.existing_schedule(raw["sessions"])),
    })
    for name in stored:
        if name in builders:
            builders[name] = lambda build=builders[name], name=name: materialize(spark, build(), name, observed)
    graph["m"] = Lazy(builders)
    return graph["m"]


def _model(name: str) -> Query:
    return lambda spark, sf_dir: models(spark, sf_dir)[name]


def q_telemetry_asof(spark, sf_dir):
    return models(spark, sf_dir)["telemetry_assigned"].select(
        "session_key", "driver_number", "sample_id", "lap_number")


def q_gear_changes(spark, sf_dir):
    return models(spark, sf_dir)["telemetry_lap_agg"].select(*LAP_KEYS, "gear_changes")


def q_session_driver_list(spark, sf_dir):
    return ingest.session_drivers(models(spark, sf_dir)["raw_drivers"])


def q_insert_absent(spark, sf_dir):
    """Re-loading the lap feed into a table that holds the even sessions already; every
    third session is sent twice (the later copy has other times and must lose)."""
    laps = models(spark, sf_dir)["raw_laps"]
    target = laps.filter(F.col("session_key") % 2 == 0)
    resent = (laps.filter(F.col("session_key") % 3 == 0)
                  .withColumn("lap_duration", F.col("lap_duration") + 1)
                  .withColumn("_loaded_at", F.timestamp_add("DAY", F.lit(1), F.col("_loaded_at"))))
    return ingest.append_absent(laps.unionByName(resent), target, LAP_KEYS, ["_loaded_at"])


def q_schema_conform(spark, sf_dir):
    """Two partial lap feeds (one lacks two speed traps, one carries an unknown field) →
    union of their columns → the allow-listed raw.laps columns."""
    laps = models(spark, sf_dir)["raw_laps"]
    feed_a = laps.filter(F.col("session_key") % 2 == 0).drop("st_speed", "i2_speed")
    feed_b = laps.filter(F.col("session_key") % 2 == 1).withColumn(
        "segments_sector_1", F.array(F.lit(2048), F.lit(2049)))
    return landing.conform(landing.union_feeds([feed_a, feed_b]), schemas.LAPS, schemas.LAPS_ALLOWED)


def q_load_counts(spark, sf_dir):
    m = models(spark, sf_dir)
    return ingest.load_counts({n: m[f"raw_{n}"] for n in fixtures.RAW_NAMES})


def q_worklist_next(spark, sf_dir):
    return worklist.next_pending(models(spark, sf_dir)["worklist_calendar"], WORKLIST_NOW)


def q_worklist_ready(spark, sf_dir):
    return worklist.ready_sessions(models(spark, sf_dir)["worklist_calendar"], WORKLIST_NOW)


def q_worklist_backfill(spark, sf_dir):
    return worklist.backfill_sessions(models(spark, sf_dir)["worklist_calendar"],
                                      BACKFILL_YEAR, WORKLIST_NOW)


# what a query needs that joins all enriched laps to aggregates of them
LAPS_STORED = ("lap_base", "stg_stints", "stg_drivers", "stg_sessions", "int_laps_enriched", "session_lap_stats",
               "driver_best_lap")


def q_fct_lap_times(spark, sf_dir):
    return models(spark, sf_dir, stored=LAPS_STORED)["fct_lap_times"]


def q_lap_presentation(spark, sf_dir):
    m = models(spark, sf_dir, stored=LAPS_STORED)
    return reports.lap_presentation(m["int_laps_enriched"], m["session_lap_stats"])


def q_race_rounds(spark, sf_dir):
    m = models(spark, sf_dir)
    return reports.race_rounds({"stg_sessions": m["stg_sessions"],
                                "stg_session_results": m["stg_session_results"]})


def materialize(spark: SparkSession, df: DataFrame, name: str,
                observed: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back (a
    lineage cut that survives executor loss; columnar, so readers prune columns)."""
    folder = shared_folder(spark, name)
    counts = versions.stage(df, folder, "once", watch=reports.watched(name) if observed is not None else ())
    if observed is not None:
        observed[name] = counts
    return spark.read.schema(df.schema).parquet(versions.version_path(folder, "once"))


DQ_TABLES = ("stg_meetings", "stg_sessions", "stg_drivers", "stg_laps", "stg_stints", "stg_pit",
             "stg_session_results", "stg_car_data_lap_agg", "fct_race_results", "fct_lap_times",
             "fct_pit_strategy", "fct_driver_season", "fct_driver_pace", "dim_drivers",
             "raw_drivers")


DQ_STORED = (*LAPS_STORED, "fct_race_results", "fct_lap_times", "fct_pit_strategy", "fct_driver_season",
             "fct_driver_pace", "dim_drivers")


def q_dq_report(spark, sf_dir):
    """Checks over every model. The marts are written first, and their write jobs take the counts."""
    observed: dict[str, dict[str, int]] = {}
    m = models(spark, sf_dir, stored=DQ_STORED, observed=observed)
    tables = {t: m[t] for t in DQ_TABLES}
    return reports.dq_report(tables, observed)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for a query that writes tables."""
    import uuid

    from pitwall.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/pitwall-tables/{name}-{uuid.uuid4().hex}"


class Refused(ValueError):
    """A version that its check did not accept."""


def q_mart_publish(spark, sf_dir):
    """Race results published twice, first without the later seasons; a third version loses its
    winners and is refused by its check. Readers get the second."""
    results = models(spark, sf_dir, stored=("fct_race_results",))["fct_race_results"]
    table = shared_folder(spark, "fct_race_results")

    def has_winners(written):
        if written.filter("is_winner").isEmpty():
            raise Refused("no race has a winner")

    steps = [("v1", results.filter(F.col("session_key") < SCD_CUTOFF_SESSION)), ("v2", results),
             ("v3", results.withColumn("is_winner", F.lit(False)))]
    for version, rows in steps:
        try:
            versions.publish(rows, table, version, "season_year", pipeline.ORDER_OF["fct_race_results"], has_winners)
        except Refused:
            continue
    return versions.read(spark, table).select(*results.columns)


def q_insert_absent_pruned(spark, sf_dir):
    """The loads of ``insert_absent`` against a stored key index: the even sessions arrive year by
    year, then the whole feed with its re-sent copies."""
    laps = materialize(spark, models(spark, sf_dir)["raw_laps"], "raw_laps")
    table = shared_folder(spark, "laps")
    target = laps.filter(F.col("session_key") % 2 == 0)
    year = F.floor(F.col("session_key") / 100)
    for i, part in enumerate((target.filter(year < 1998), target.filter(year == 1998), target.filter(year > 1998))):
        keyed.append_absent(part, table, f"load-{i}", LAP_KEYS, ["_loaded_at"], null_keys="insert")
    resent = (laps.filter(F.col("session_key") % 3 == 0)
                  .withColumn("lap_duration", F.col("lap_duration") + 1)
                  .withColumn("_loaded_at", F.timestamp_add("DAY", F.lit(1), F.col("_loaded_at"))))
    keyed.append_absent(laps.unionByName(resent), table, "load-all", LAP_KEYS, ["_loaded_at"], null_keys="insert")
    return keyed.read(spark, table, laps.schema)


SCD_ROUNDS = (("r1", 199801, "1998-01-01 00:00:00"), ("r2", SCD_CUTOFF_SESSION, "2000-01-05 12:00:00"),
              ("r3", 999999, SCD_RUN_TS))


def q_scd_drivers_rounds(spark, sf_dir):
    """Three snapshot rounds on the stored layout, each over the sessions known by then."""
    drivers = materialize(spark, models(spark, sf_dir)["stg_drivers"], "stg_drivers")
    table = shared_folder(spark, "scd_drivers")
    for name, before, run_ts in SCD_ROUNDS:
        known = snapshots.latest_driver_rows(drivers.filter(F.col("session_key") < before))
        spells.advance(known, table, name, "driver_number", snapshots.CHECK_COLS, snapshots.DRIVER_ATTRS, run_ts)
    return spells.read(spark, table)


def text_lines(spark: SparkSession, records: DataFrame, name: str) -> DataFrame:
    """Records (``value``) written as lines of text files and read back."""
    folder = shared_folder(spark, name)
    records.select("value").write.text(folder)
    return spark.read.text(folder)


def q_landing_rejects(spark, sf_dir):
    """The lap feed as JSON lines, some cut off and some without their key → records by reason."""
    laps = models(spark, sf_dir)["raw_laps"]
    record = F.struct("session_key", "driver_number", "lap_number", "lap_duration")
    line = F.to_json(record)
    cut_off = (F.col("session_key") + F.col("driver_number")) % 17 == 3
    feed = laps.select(F.when(cut_off, F.left(line, F.length(line) - 5)).otherwise(line).alias("value"))
    schema = "session_key long, driver_number int, lap_number int, lap_duration double"
    records = landing.with_rejects(text_lines(spark, feed, "lap-lines"), spark.createDataFrame([], schema).schema, LAP_KEYS)
    return records.groupBy(F.coalesce(landing.REASON, F.lit("accepted")).alias("reason")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("lap_duration").alias("timed_rows"))


def q_schema_discover(spark, sf_dir):
    """A feed whose optional fields occur in a few records only → all of them are columns."""
    laps = models(spark, sf_dir)["raw_laps"]
    rare = F.col("session_key") % 12 == 5
    rarer = rare & (F.col("lap_number") == 2)
    record = F.struct("session_key", "driver_number", "lap_number",
                      F.when(rare, F.col("st_speed")).alias("trap_speed"),
                      F.when(rarer, F.concat(F.lit("lap "), F.col("lap_number").cast("string"))).alias("remark"))
    lines = text_lines(spark, laps.select(F.to_json(record).alias("value")), "optional-fields")
    return landing.read_discovered(lines)


def q_mart_layout(spark, sf_dir):
    """Every mart stored in its declared order, and what is found when it is read back."""
    # the lap mart is read once, by its ordered write, so it is not stored before
    m = models(spark, sf_dir, stored=tuple(n for n in DQ_STORED if n != "fct_lap_times"))
    out = None
    for name, order in pipeline.ORDER_OF.items():
        folder = shared_folder(spark, name)
        layout.write_ordered(m[name], folder, "ordered", order)
        found = layout.layout(spark.read.parquet(versions.version_path(folder, "ordered")), order)
        one = found.select(F.lit(name).alias("model"), "rows", "overlaps", "unordered")
        out = one if out is None else out.unionByName(one)
    return out


VIEW_SQL = """
SELECT s.season_year, d.team_name, count(*) AS laps, count(l.lap_duration) AS timed_laps,
       max(l.lap_number) AS last_lap
FROM stg_laps l
JOIN stg_sessions s ON s.session_key = l.session_key
LEFT JOIN stg_drivers d ON d.session_key = l.session_key AND d.driver_number = l.driver_number
GROUP BY s.season_year, d.team_name
"""


def q_view_sql(spark, sf_dir):
    """SQL text over three views of the model graph."""
    return views.query(spark, models(spark, sf_dir), ("stg_laps", "stg_sessions", "stg_drivers"), VIEW_SQL)


def q_lineage_stamp(spark, sf_dir):
    """Every lap of the feed, stamped by its run."""
    laps = models(spark, sf_dir)["raw_laps"].drop("_loaded_at", "_run_id")
    return landing.stamp_lineage(laps, SCD_RUN_TS, "run-1")


def q_nested_json(spark, sf_dir):
    """The lap feed with a record and a list column → text columns."""
    feed = models(spark, sf_dir)["raw_laps"].select(
        *LAP_KEYS, "date_start", F.struct("meeting_key", "is_pit_out_lap", "lap_number").alias("place"),
        F.array("meeting_key", "session_key").alias("keys"))
    return landing.nested_to_json(feed)


def q_gap_text(spark, sf_dir):
    """Result feed whose gaps arrive as numbers where they are numbers → text gaps."""
    results = models(spark, sf_dir)["raw_session_results"]
    feed = results.select("session_key", "driver_number",
                          F.col("gap_to_leader").try_cast("double").alias("gap_to_leader"))
    return landing.stringify(feed, "gap_to_leader")


def q_run_log(spark, sf_dir):
    return ingest.run_log_row(q_load_counts(spark, sf_dir), "run-1")


def q_dq_log(spark, sf_dir):
    return pipeline.dq_log_rows(q_dq_report(spark, sf_dir), "run-1", SCD_RUN_TS, SCD_CUTOFF_SESSION)


QUERIES: dict[str, Query] = {
    **{n: _model(n) for n in (
        "stg_meetings", "stg_sessions", "stg_drivers", "stg_laps", "stg_stints", "stg_pit",
        "stg_session_results", "stg_car_data_lap_agg", "stint_interval_join",
        "int_laps_enriched", "int_race_context", "fct_race_results",
        "season_running_totals", "fct_driver_season", "teammate_pairs", "fct_driver_pace",
        "tyre_degradation", "compound_sequence", "pit_stop_numbers", "fct_pit_strategy")},
    "fct_lap_times": q_fct_lap_times,
    "telemetry_asof": q_telemetry_asof,
    "telemetry_lap_agg": _model("telemetry_lap_agg"),
    "gear_changes": q_gear_changes,
    "telemetry_from_json": _model("telemetry_from_json"),
    "session_driver_list": q_session_driver_list,
    "scd_drivers_replay": _model("scd_drivers_replay"),
    "scd_drivers_increment": _model("scd_drivers_increment"),
    "dim_drivers": _model("dim_drivers"),
    "insert_absent": q_insert_absent,
    "schema_conform": q_schema_conform,
    "load_counts": q_load_counts,
    "worklist_calendar": _model("worklist_calendar"),
    "worklist_next": q_worklist_next,
    "worklist_ready": q_worklist_ready,
    "worklist_backfill": q_worklist_backfill,
    "lineage_stamp": q_lineage_stamp,
    "nested_json": q_nested_json,
    "gap_text": q_gap_text,
    "run_log": q_run_log,
    "dq_log": q_dq_log,
    "lap_presentation": q_lap_presentation,
    "race_rounds": q_race_rounds,
    "dq_report": q_dq_report,
    "mart_publish": q_mart_publish,
    "insert_absent_pruned": q_insert_absent_pruned,
    "scd_drivers_rounds": q_scd_drivers_rounds,
    "landing_rejects": q_landing_rejects,
    "schema_discover": q_schema_discover,
    "mart_layout": q_mart_layout,
    "view_sql": q_view_sql,
}

_PIT_SUMS = ("total_stop_time_secs", "total_pit_lane_time_secs")
_PACE = ("avg_lap_secs", "lap_time_stddev", "median_lap_secs", "gap_to_teammate_median_secs", "avg_throttle_pct", "avg_drs_usage_pct", "avg_brake_pct")

ROUND_COLS: dict[str, tuple[str, ...]] = {
    "int_race_context": _PIT_SUMS,
    "fct_race_results": _PIT_SUMS,
    "mart_publish": _PIT_SUMS,
    "fct_lap_times": ("median_lap_secs",),
    "teammate_pairs": ("gap_to_teammate_median_secs",),
    "fct_driver_pace": _PACE,
    "fct_pit_strategy": ("avg_deg_rate_secs_per_lap",),
}

GRID = 1048576  # 2^20


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    df = QUERIES[name](spark, sf_dir)
    cols = ROUND_COLS.get(name, ())
    if cols:
        df = df.select(*[(F.round(F.col(c) * GRID) / GRID).alias(c) if c in cols else F.col(c)
                         for c in df.columns])
    return df
