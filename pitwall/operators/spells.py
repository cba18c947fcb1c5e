"""Stored type-2 history in which a round writes only what changed.

    rounds/<round>/state=closed   spells that the round closed, never rewritten
    rounds/<round>/state=open     all open spells after the round
    commits/                      the rounds that count (see ``versions``)

A round reads the open spells of the last committed round and the current rows and joins them
(``scd.increment`` without history). What it closes is added; the open spells, one per key, are
written anew beside the old ones. Its cost does not depend on how long the history is. A round that
fails before its commit is not seen: readers take the closed spells of committed rounds and the
open spells of the last one.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.operators import scd, versions


OPEN, CLOSED = "open", "closed"


def _history(spark: SparkSession, path: str) -> tuple[list, T.StructType | None]:
    """Committed rounds (their commit rows), and the schema of spells that the last one wrote."""
    found = versions.commits(spark, path)
    return found, T.StructType.fromJson(json.loads(found[-1]["facts"]["schema"])) if found else None


def _spells(spark: SparkSession, path: str, rounds: Sequence, state: str, schema: T.StructType) -> DataFrame:
    """Of one state, in the given rounds; only folders that hold some are named."""
    folders = [f"{path}/rounds/{r['version']}/state={state}" for r in rounds if int(r["facts"][state])]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All spells of the committed rounds."""
    rounds, schema = _history(spark, path)
    if not rounds:
        raise versions.NotPublished(path)
    return _spells(spark, path, rounds, CLOSED, schema).unionByName(_spells(spark, path, rounds[-1:], OPEN, schema))


def advance(current: DataFrame, path: str, name: str, key: str, check_cols: Sequence[str], attrs: Sequence[str],
            run_ts) -> int:
    """One round at ``run_ts`` over ``current`` (one row per key); the commit's number. A round of
    this name that was not committed is overwritten."""
    spark = current.sparkSession
    rounds, schema = _history(spark, path)
    if name in [r["version"] for r in rounds]:
        raise ValueError(f"round {name} is committed already")
    if rounds:
        before = _spells(spark, path, rounds[-1:], OPEN, schema)
    else:
        ts = F.lit(run_ts).cast("timestamp_ntz")
        before = current.select(
            key, *attrs, ts.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"),
            ts.alias("updated_at"), scd.scd_id(key, ts).alias("scd_id")).limit(0)
    after = scd.increment(before, current, key, check_cols, attrs, run_ts)
    is_open, counted = F.col("valid_to").isNull(), Observation()
    rows = after.observe(counted, F.count_if(is_open).alias(OPEN), F.count_if(~is_open).alias(CLOSED))
    (rows.withColumn("state", F.when(is_open, OPEN).otherwise(CLOSED))
     .write.mode("overwrite").partitionBy("state").parquet(f"{path}/rounds/{name}"))
    facts = {state: str(n) for state, n in counted.get.items()}
    return versions.commit(spark, path, name, None, {"schema": after.schema.json(), **facts})
