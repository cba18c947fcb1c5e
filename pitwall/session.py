"""Spark session settings used by tests, the bench and the entry points."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock, ANSI semantics, adaptive execution
# (runtime broadcast of sides whose measured size is small, partition coalescing and
# skew-join splitting), and no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "pitwall", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_sql_conf(spark)
    return spark


def apply_sql_conf(spark: SparkSession) -> None:
    """The one setting that results depend on (zoned text becomes a wall-clock time)."""
    spark.conf.set("spark.sql.session.timeZone", BASE_CONF["spark.sql.session.timeZone"])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this is ``spark.checkpoint.dir`` as configured for the job (a shared
    file system). Only in local mode, where driver and executors are one process, a scratch
    folder is made when it is unset; on a cluster that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="pitwall-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured
