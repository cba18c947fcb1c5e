"""Idempotent append to a table with a stored key index.

A table is a folder

    data/<batch>/    the rows of one append, never rewritten
    index/<batch>/   what the files of that append can hold: per file and value of the leading key
                     column the range of the other key columns and a filter of ``BITS`` bits

An append finds the files that can hold one of its keys from the index alone: an equi-join on the
leading key column, then range and filter. Only those files are read for the anti join, so the cost
of an append follows the batch and the files it touches, not the table. A re-sent session meets the
files of that session; a new one meets none. For that the files of an append are ranges of the key: dealt
by its hash, every file would hold every session, and each row would be held against each file.

The index is also the commit: files without index rows are not part of the table, so a job that
fails between the two writes leaves nothing visible, and repeating a committed batch does nothing.
Rows with a NULL in the key cannot conflict; they go in, or are rejected. One writer per table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pitwall.operators.ingest import first_per_key

BITS = 4096
PROBES = 2


def _or_none(read, *args) -> DataFrame | None:
    try:
        return read(*args)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def index(spark: SparkSession, path: str) -> DataFrame | None:
    return _or_none(spark.read.parquet, f"{path}/index/*")


def files(spark: SparkSession, path: str) -> list[str]:
    """The table's committed files."""
    found = index(spark, path)
    return [] if found is None else sorted(r["file"] for r in found.select("file").distinct().collect())


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    names = files(spark, path)
    return spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)


def _has_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _probes(keys: Sequence[str]) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(BITS)).cast("int") for i in range(PROBES)]


def _bit(spot: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), spot % 64)


def index_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(file, lead, rows, low, high, bits) of rows as they are stored. Rows with a NULL in the key
    leave an entry for their file only."""
    lead = keys[0]
    stored = rows.select(F.col("_metadata.file_path").alias("file"), _has_key(keys).alias("has"), *keys)
    keyed = stored.withColumn("lead", F.when(F.col("has"), F.col(lead)))
    words = (keyed.select("file", "lead", F.explode(F.when(F.col("has"), F.array(*_probes(keys)))).alias("spot"))
             .groupBy("file", "lead", F.floor(F.col("spot") / 64).cast("int").alias("word"))
             .agg(F.bit_or(_bit(F.col("spot"))).alias("bits"))
             .groupBy("file", "lead").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words")))
    ranges = _ranges(keyed, keys)
    bits = F.transform(F.sequence(F.lit(0), F.lit(BITS // 64 - 1)),
                       lambda w: F.coalesce(F.try_element_at("words", w), F.lit(0).cast("long")))
    return (ranges.join(words, ["file", "lead"], "left")
            .select("file", "lead", "rows", "low", "high", F.when(F.col("words").isNotNull(), bits).alias("bits")))


def _ranges(keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(file, lead, rows, low, high). The last key column's bounds are taken first, per value of those
    between: a hash aggregate of plain columns, where bounds of whole keys would sort all rows."""
    has = F.col("has")
    between, last = list(keys[1:-1]), keys[-1]
    if len(keys) == 1:
        rest = F.struct(F.lit(0).alias("none"))
        return keyed.groupBy("file", "lead").agg(
            F.count(F.lit(1)).alias("rows"), F.any_value(F.when(has, rest), True).alias("low"),
            F.any_value(F.when(has, rest), True).alias("high"))
    inner = keyed.groupBy("file", "lead", "has", *[F.when(has, F.col(k)).alias(k) for k in between]).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(F.when(has, F.col(last))).alias("_low"),
        F.max(F.when(has, F.col(last))).alias("_high"))
    end = lambda c: F.when(has, F.struct(*between, F.col(c).alias(last)))
    return inner.groupBy("file", "lead").agg(
        F.sum("_rows").alias("rows"), F.min(end("_low")).alias("low"), F.max(end("_high")).alias("high"))


def candidate_files(batch: DataFrame, index_: DataFrame, keys: Sequence[str]) -> list[str]:
    """Files that can hold one of the batch's keys: no file that holds one is missing."""
    rest = F.struct(*keys[1:]) if len(keys) > 1 else F.struct(F.lit(0).alias("none"))
    asked = batch.filter(_has_key(keys)).select(F.col(keys[0]).alias("lead"), rest.alias("rest"),
                                                F.array(*_probes(keys)).alias("spots"))
    held = F.forall("spots", lambda s: F.get("bits", F.floor(s / 64).cast("int")).bitwiseAND(_bit(s)) != 0)
    met = asked.join(index_.filter("bits IS NOT NULL"), "lead").filter(
        (F.col("rest") >= F.col("low")) & (F.col("rest") <= F.col("high")) & held)
    return sorted(r["file"] for r in met.select("file").distinct().collect())


def append_absent(batch: DataFrame, path: str, batch_id: str, keys: Sequence[str], order: Sequence[str],
                  null_keys: str = "reject") -> dict[str, int]:
    """Appends the rows whose key the table lacks, the first per key (by ``order``). Returns the
    numbers of rows sent, inserted and rejected, and of files the table had and the append read."""
    if null_keys not in ("reject", "insert"):
        raise ValueError("null_keys is 'reject' or 'insert'")
    spark = batch.sparkSession
    known = index(spark, path)
    if _or_none(spark.read.parquet, f"{path}/index/{batch_id}") is not None:
        return {"sent": 0, "inserted": 0, "rejected": 0, "files": len(files(spark, path)), "files_read": 0}
    received = Observation()
    sums = (F.count(F.lit(1)).alias("sent"), F.count_if(~_has_key(keys)).alias("rejected"))
    seen = batch.observe(received, *sums)
    staged = f"{path}/staged/{batch_id}"
    first = first_per_key(seen, keys, order)
    (first if null_keys == "insert" else first.filter(_has_key(keys))).write.mode("overwrite").parquet(staged)
    rows = spark.read.schema(batch.schema).parquet(staged)
    staged_any = not rows.isEmpty()
    total, asked = 0, []
    if known is not None:
        total = known.select("file").distinct().count()
        asked = candidate_files(rows, known, keys)
    if asked:
        rows = rows.join(spark.read.schema(batch.schema).parquet(*asked).select(*keys), list(keys), "left_anti")
    # an attempt that failed before its index was written is overwritten
    ranged = rows.select(*batch.columns).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged.write.mode("overwrite").parquet(f"{path}/data/{batch_id}")
    index_rows(spark.read.schema(batch.schema).parquet(f"{path}/data/{batch_id}"), keys).write.mode("errorifexists").parquet(
        f"{path}/index/{batch_id}")
    # the index has all rows; a count observed in the write job would hold those sampled for the ranges twice
    inserted = spark.read.parquet(f"{path}/index/{batch_id}").agg(F.sum("rows").alias("n")).first()["n"] or 0
    # Spark drops the observation of a plan that it finds empty while it runs
    counts = {**received.get} if staged_any else batch.agg(*sums).first().asDict()
    counts["inserted"] = inserted
    if null_keys == "insert":
        counts["rejected"] = 0
    return {**counts, "files": total, "files_read": len(asked)}
