"""Tables that are published as a whole: readers see the old version or the new one.

A table is a folder

    versions/<version>/   the rows of one version, written once and never changed
    commits/<number>/     one row per commit: number, version, rows, other facts

A version is written beside the live one, its rows are counted while they are written, checks run
on what was written, and only then the commit row is added. The commit is a single small file,
which a task's commit moves into place as a whole; a job that fails earlier leaves a folder that no
commit names. Readers resolve the highest commit, so they never list half a table, and a reader
that has begun keeps the version it resolved. One publisher per table at a time: of two commits with
the same number the resolver takes neither and raises.

A release commits several tables at once: its one row names the version of each, so a set of marts
that refer to each other changes together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

COMMIT = "number long, version string, rows long, facts map<string, string>"


class NotPublished(LookupError):
    """The table has no committed version."""


def commits(spark: SparkSession, path: str) -> list:
    """The table's commits, oldest first (a handful of rows: one per publication)."""
    try:
        return spark.read.schema(COMMIT).parquet(f"{path}/commits/*").orderBy("number").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def committed(spark: SparkSession, path: str):
    """The newest commit."""
    found = commits(spark, path)
    if not found:
        raise NotPublished(path)
    if len(found) > 1 and found[-2]["number"] == found[-1]["number"]:
        raise RuntimeError(f"two publishers committed number {found[-1]['number']} of {path}")
    return found[-1]


def version_path(path: str, version: str) -> str:
    return f"{path}/versions/{version}"


def read(spark: SparkSession, path: str) -> DataFrame:
    """The committed version."""
    return spark.read.parquet(version_path(path, committed(spark, path)["version"]))


def commit(spark: SparkSession, path: str, version: str, rows: int | None, facts: dict[str, str] | None = None) -> int:
    number = max((c["number"] for c in commits(spark, path)), default=0) + 1
    row = spark.createDataFrame([(number, version, rows, facts)], COMMIT)
    row.coalesce(1).write.mode("errorifexists").parquet(f"{path}/commits/{number:010d}")
    return number


def stage(df: DataFrame, path: str, version: str, partition_by: str | None = None, order: Sequence[str] = (),
          check: Callable[[DataFrame], None] | None = None, watch: Sequence[Column] = ()) -> dict[str, int]:
    """Writes a version without committing it. ``check`` gets what was written and raises to refuse
    it. Returns ``rows`` and the counts ``watch``, observed by the write job itself."""
    target, counted = version_path(path, version), Observation()
    rows = df.observe(counted, F.count(F.lit(1)).alias("rows"), *watch)
    if partition_by:
        rows = rows.hint("rebalance", partition_by)
    keys = list(dict.fromkeys([*([partition_by] if partition_by else []), *order]))
    if keys:
        rows = rows.sortWithinPartitions(*[F.asc_nulls_last(c) for c in keys])
    writer = rows.write.mode("errorifexists").option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(target)
    if check:
        check(df.sparkSession.read.schema(df.schema).parquet(target))
    return counted.get


def publish(df: DataFrame, path: str, version: str, partition_by: str | None = None, order: Sequence[str] = (),
            check: Callable[[DataFrame], None] | None = None) -> int:
    """Writes, checks and commits a version; the commit's number. On any error nothing is
    committed, and the table stays as it was."""
    spark = df.sparkSession
    return commit(spark, path, version, stage(df, path, version, partition_by, order, check)["rows"])


def release(spark: SparkSession, path: str, version: str, tables: dict[str, str]) -> int:
    """Commits several staged tables (name → folder written) in one row."""
    return commit(spark, path, version, None, tables)


def released(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of the newest release."""
    return {name: spark.read.parquet(p) for name, p in committed(spark, path)["facts"].items()}


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Deletes all versions but those of the newest ``keep`` commits; the deleted names. Not while
    a publisher is at work, whose version no commit names yet."""
    live = {c["version"] for c in commits(spark, path)[-keep:]}
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{path}/versions")
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    gone = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName() not in live)
    for name in gone:
        fs.delete(hadoop.Path(folder, name), True)
    return gone
