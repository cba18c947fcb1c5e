"""Build every layer and write it out.

Layer → folder routing: ``<root>/staging``, ``<root>/intermediate``, ``<root>/marts``,
``<root>/snapshots``. Staging models stay lazy (views); the enriched lap table is written
once and read back, because four marts read it — this cuts the lineage in a shared folder,
so a lost executor re-reads files instead of recomputing the joins. Marts are full
rebuilds, partitioned by season for pruning. Every build writes a new version of each table
beside the live one and checks them; the last step is one commit that names all new versions
(``<root>/releases``), so readers (``built``) see one build's tables or the next one's, and a
build that fails changes nothing for them.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.operators import ingest, telemetry, versions
from pitwall.plans import enrich, marts, reports, snapshots
from pitwall.plans.staging import build_staging

LAYER_OF = {
    "int_laps_enriched": "intermediate", "int_race_context": "intermediate",
    "fct_lap_times": "marts", "fct_race_results": "marts", "fct_driver_season": "marts",
    "fct_driver_pace": "marts", "fct_pit_strategy": "marts", "dim_drivers": "marts",
    "scd_drivers": "snapshots", "dq_report": "quality",
}


# Declared output order of each mart. Written tables keep rows in this order inside each
# file (no global sort: a range shuffle of the whole table buys nothing for a reader);
# ``display_order`` applies it globally for interactive display.
ORDER_OF = {
    "fct_lap_times": ("season_year", "meeting_key", "driver_number", "lap_number"),
    "fct_race_results": ("season_year", "meeting_key", "finish_position"),
    "fct_driver_season": ("season_year", "race_date", "championship_position"),
    "fct_driver_pace": ("season_year", "meeting_key", "fastest_lap_secs"),
    "fct_pit_strategy": ("season_year", "meeting_key", "driver_number", "stint_number"),
    "dim_drivers": ("driver_number",),
}


def display_order(model: str, df: DataFrame) -> DataFrame:
    """The mart in its declared order (a global sort; for display, not for writing)."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in ORDER_OF.get(model, ())])


def layer_path(root: str, model: str) -> str:
    return f"{root}/{LAYER_OF.get(model, 'staging')}/{model}"


def dq_log_rows(report: DataFrame, run_id: str, checked_at, session_key: int | None = None) -> DataFrame:
    """One run's check results as log rows; ``details`` is JSON text with the column and the
    number of failures. ``session_key`` is the session the run loaded, if it loaded one."""
    return report.select(
        "*", F.lit(run_id).alias("run_id"), F.lit(checked_at).cast("timestamp_ntz").alias("checked_at"),
        F.lit(session_key).cast("long").alias("session_key"),
        F.to_json(F.struct("column_name", "failures")).alias("details"))


def append_dq_log(report: DataFrame, path: str, run_id: str, checked_at, session_key: int | None = None) -> None:
    """Append one run's check results to the data-quality log (never rewritten)."""
    dq_log_rows(report, run_id, checked_at, session_key).write.mode("append").parquet(path)


class ChecksFailed(ValueError):
    """A build that was refused by its data checks; the report is in ``failures``."""

    def __init__(self, failures: list):
        super().__init__(", ".join(f"{r['table_name']}.{r['column_name']} {r['check_name']}: {r['failures']}" for r in failures))
        self.failures = failures


def build(spark: SparkSession, raw: dict[str, DataFrame], root: str,
          snapshot_version: str | None = None, run_id: str = "build", run_ts=None,
          required: frozenset = frozenset()) -> dict[str, str]:
    """Build all models from the raw tables; returns model → written path. ``run_ts``
    (the run's clock time, passed in) stamps the data-quality log. A failed check that is in
    ``required`` (table, column, check) stops the build before its release."""
    run_ts = run_ts or dt.datetime(2000, 1, 1)
    version = snapshot_version or f"build-{uuid.uuid4().hex}"
    stg = build_staging(raw)
    paths: dict[str, str] = {}
    observed: dict[str, dict[str, int]] = {}

    def save(name: str, df: DataFrame, partition_by: str | None = "season_year") -> DataFrame:
        table = layer_path(root, name)
        partition_by = partition_by if partition_by in df.columns else None
        order = [c for c in ORDER_OF.get(name, ()) if c in df.columns]
        observed[name] = versions.stage(df, table, version, partition_by, order, watch=reports.watched(name))
        paths[name] = versions.version_path(table, version)
        return spark.read.parquet(paths[name])

    laps = save("int_laps_enriched", enrich.int_laps_enriched(stg))
    context = save("int_race_context", enrich.int_race_context(stg))
    results = save("fct_race_results", marts.fct_race_results(context, laps))
    tables = {
        "fct_lap_times": save("fct_lap_times", marts.fct_lap_times(laps)),
        "fct_race_results": results,
        "fct_driver_season": save("fct_driver_season", marts.fct_driver_season(results)),
        "fct_driver_pace": save("fct_driver_pace", marts.fct_driver_pace(laps)),
        "fct_pit_strategy": save("fct_pit_strategy", marts.fct_pit_strategy(stg, laps)),
    }
    snap = save("scd_drivers", snapshots.scd_drivers_replay(stg), partition_by=None)
    tables["dim_drivers"] = save("dim_drivers", snapshots.dim_drivers(snap), partition_by=None)
    log = layer_path(root, "dq_report")
    append_dq_log(reports.dq_report({**stg, **tables, "raw_drivers": raw["drivers"]}, observed), log, run_id, run_ts)
    if required:
        run = spark.read.parquet(log).filter((F.col("run_id") == run_id) & ~F.col("passed"))
        failed = [r for r in run.collect() if (r["table_name"], r["column_name"], r["check_name"]) in required]
        if failed:
            raise ChecksFailed(failed)
    versions.release(spark, f"{root}/releases", version, dict(paths))
    paths["dq_report"] = log
    return paths


def built(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the last build that was released."""
    return versions.released(spark, f"{root}/releases")


def snapshot_run(spark: SparkSession, root: str, drivers_stg: DataFrame, run_ts,
                 previous_version: str | None, new_version: str) -> str:
    """One snapshot run: read the stored snapshot version ``previous_version`` (none on the
    first run), apply the check-strategy increment for ``run_ts``, and write the result as
    ``new_version`` — a new folder, never the one being read."""
    if previous_version == new_version:
        raise ValueError("a snapshot run must write a new version")
    base = layer_path(root, "scd_drivers")
    current = snapshots.latest_driver_rows(drivers_stg)
    if previous_version is None:
        ts = F.lit(run_ts).cast("timestamp_ntz")
        snap = current.select(
            "driver_number", *snapshots.DRIVER_ATTRS, ts.alias("valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("valid_to"), ts.alias("updated_at"),
            F.md5(F.concat(F.col("driver_number").cast("string"), F.lit("|"),
                           ts.cast("string"))).alias("scd_id"))
    else:
        previous = spark.read.parquet(f"{base}/{previous_version}")
        snap = snapshots.scd_drivers_increment(previous, drivers_stg, run_ts)
    path = f"{base}/{new_version}"
    snap.write.mode("errorifexists").parquet(path)
    return path


def load_telemetry_summary(samples: DataFrame, lap_starts: DataFrame, target_path: str,
                           loaded_at, run_id: str) -> dict[str, int]:
    """Extraction step for telemetry: typed samples + typed lap boundaries → per-lap
    summaries, stamped with lineage and appended to the raw ``car_data_lap_agg`` table at
    ``target_path`` with insert-absent semantics (a re-run of a session inserts nothing)."""
    from pitwall.sources.landing import stamp_lineage
    rows = stamp_lineage(telemetry.car_data_lap_agg(samples, lap_starts), loaded_at, run_id)
    return ingest.write_absent(rows, target_path, telemetry.LAP_KEYS, ["_loaded_at"])
