"""Idempotent append and load audit.

``insert_absent`` is "INSERT … ON CONFLICT DO NOTHING" as a set operation:

1. inside the batch, the first row per key wins — row number 1 in arrival order, which Spark
   also keeps per map task (window group limit), so re-sent copies collapse before the shuffle;
2. a left anti join on the key against the target drops keys already stored;
3. the survivors are appended (a new file set under the table; nothing is rewritten).

Rows with a NULL in the key never conflict (as with a SQL unique constraint) and all go
in. Single writer per table: two concurrent appenders could both pass the anti join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F


def first_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per non-NULL key: the smallest under ``order`` (then the whole row)."""
    fields = [c for c in batch.columns if c not in keys and c not in order]
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    n = "_n"
    while n in batch.columns:
        n += "_"
    arrival = Window.partitionBy(*keys).orderBy(*order, *fields)
    picked = batch.filter(has_key).withColumn(n, F.row_number().over(arrival)).filter(F.col(n) == 1)
    return picked.select(*batch.columns).unionByName(batch.filter(~has_key))


def insert_absent(batch: DataFrame, target: DataFrame, keys: Sequence[str],
                  order: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` to append to ``target`` (same columns)."""
    first = first_per_key(batch, keys, order)
    existing = target.select(*keys).filter(
        reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    return first.join(existing, list(keys), "left_anti").select(*batch.columns)


def append_absent(batch: DataFrame, target: DataFrame, keys: Sequence[str],
                  order: Sequence[str]) -> DataFrame:
    """The target as it is after the append (target ∪ new rows)."""
    return target.select(*batch.columns).unionByName(insert_absent(batch, target, keys, order))


def write_absent(batch: DataFrame, target_path: str, keys: Sequence[str], order: Sequence[str],
                 spark=None) -> dict[str, int]:
    """Append the absent rows to the Parquet table at ``target_path``. Rows with a NULL in the
    key could not be told from their replay and are rejected. Returns the numbers of rows
    sent, inserted and rejected, observed while the one write job runs. Only a table that
    does not exist counts as empty; any other read error is raised."""
    spark = spark or batch.sparkSession
    try:
        target = spark.read.schema(batch.schema).parquet(target_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        target = spark.createDataFrame([], batch.schema)
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    received, written = Observation(), Observation()
    seen = batch.observe(received, F.count(F.lit(1)).alias("sent"), F.count_if(~has_key).alias("rejected"))
    fields = [c for c in batch.columns if c not in keys]
    row = F.struct(*fields)
    first = (seen.filter(has_key).groupBy(*keys)
                 .agg(F.min_by(row, F.struct(*order, row)).alias("_r"))
                 .select(*keys, *[F.col("_r")[c].alias(c) for c in fields]).select(*batch.columns))
    absent = first.join(target.select(*keys), list(keys), "left_anti").select(*batch.columns)
    absent.observe(written, F.count(F.lit(1)).alias("inserted")).write.mode("append").parquet(target_path)
    return {**received.get, **written.get}


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table that has any, plus a grand total; total row labelled 'TOTAL'. Each table is
    counted on its own, and the total is that of the counts."""
    counts = reduce(lambda a, b: a.unionByName(b),
                    [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
                     for name, df in tables.items()]).filter("n > 0")
    return counts.rollup("table_name").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.grouping("table_name").alias("_g")).select(
        F.when(F.col("_g") == 1, F.lit("TOTAL")).otherwise(F.col("table_name")).alias("table_name"),
        "row_count")


def session_drivers(drivers: DataFrame) -> DataFrame:
    """Distinct driver numbers of each session, ascending, as text (the per-session list
    the extraction iterates over). A session has ~20 drivers: the collected set is small."""
    return drivers.filter(F.col("driver_number").isNotNull()).groupBy("session_key").agg(
        F.array_join(F.array_sort(F.collect_set("driver_number")), ",").alias("driver_numbers"),
        F.count_distinct("driver_number").alias("driver_count"))


def run_log_row(counts: DataFrame, run_id: str) -> DataFrame:
    """One audit row per run: rows loaded per table as JSON text (keys in table order)."""
    entries = F.array_sort(F.collect_list(F.struct("table_name", "row_count")))
    return counts.filter(F.col("table_name") != "TOTAL").agg(
        F.to_json(F.map_from_entries(entries)).alias("rows_loaded"),
        F.sum("row_count").alias("total_rows")).select(F.lit(run_id).alias("run_id"), "*")
