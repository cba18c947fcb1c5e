"""Structured Streaming over landed feed files.

The extraction lands one finished session at a time; these streams pick the files up as
they arrive:

* ``append_stream`` — a raw feed → its raw table with insert-absent semantics in
  ``foreachBatch``. A replayed micro-batch finds its keys already stored and appends
  nothing, so at-least-once delivery yields an exactly-once table. Rows with a NULL in the
  key cannot be told from their replay and are rejected.
* ``telemetry_stream`` — telemetry samples → per-lap summaries. Each micro-batch
  recomputes the summaries of the sessions it touched from *all* landed samples of those
  sessions and replaces those session partitions (dynamic partition overwrite), so a
  session whose files arrive over several batches still ends up whole, and a replay
  rewrites the same partitions with the same rows.

State lives in the checkpoint location and in the tables; no stateful operator is
needed because a session is complete once it has landed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pitwall.operators.ingest import write_absent
from pitwall.operators.telemetry import car_data_lap_agg
from pitwall.sources import landing
from pitwall.sources.schemas import CAR_DATA_TEXT


def append_stream(spark: SparkSession, source_dir: str, schema: T.StructType, target_path: str,
                  keys: Sequence[str], order: Sequence[str], checkpoint: str,
                  available_now: bool = True) -> StreamingQuery:
    def upsert(batch: DataFrame, epoch_id: int) -> None:
        write_absent(batch, target_path, keys, order, spark)

    stream = spark.readStream.schema(schema).json(source_dir)
    w = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def telemetry_stream(spark: SparkSession, samples_dir: str, lap_starts: DataFrame,
                     out_path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """``lap_starts``: typed lap boundaries (a batch table, e.g. the landed laps).

    Each micro-batch re-reads the landed samples of the sessions it touched. Land them
    partitioned by session (``.../session_key=<k>/``): the semi join on the batch's session
    keys then prunes the other sessions' folders (dynamic partition pruning), so a batch
    reads its own sessions only."""

    def summarise(batch: DataFrame, epoch_id: int) -> None:
        sessions = batch.select(F.col("session_key").cast("string").alias("session_key")).distinct()
        all_samples = (spark.read.schema(CAR_DATA_TEXT).json(samples_dir)
                            .join(sessions, "session_key", "left_semi"))
        starts = lap_starts.join(
            sessions.select(F.col("session_key").cast("long").alias("session_key")),
            "session_key", "left_semi")
        agg = car_data_lap_agg(landing.typed_car_data(all_samples), starts)
        (agg.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("session_key").parquet(out_path))

    stream = spark.readStream.schema(CAR_DATA_TEXT).json(samples_dir)
    w = stream.writeStream.foreachBatch(summarise).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
