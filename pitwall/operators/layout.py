"""Tables stored in their declared order, and a check that they are.

``write_ordered`` deals rows to files by ranges of the order columns and sorts each file, so the
files are disjoint ranges: a reader that wants one range opens the files that hold it (Parquet's
minima and maxima exclude the others), and reading file after file by their lowest key is a scan in
order. ``layout`` reads back what is stored: rows, files' overlaps, and neighbours out of order.
NULLs come last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.operators import versions


def write_ordered(df: DataFrame, path: str, version: str, order: Sequence[str]) -> dict[str, int]:
    """Stages a version (see ``versions``); AQE joins neighbouring small ranges to one file."""
    keys = [F.asc_nulls_last(c) for c in order]
    return versions.stage(df.repartitionByRange(*keys).sortWithinPartitions(*keys), path, version)


def order_key(order: Sequence[str]) -> Column:
    """Compares like the order columns, NULLs last."""
    return F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))])


def layout(stored: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row: rows, overlaps (files whose lowest key is below the highest of a file before),
    unordered (rows below their predecessor in the file)."""
    path = F.col("_metadata.file_path").alias("path")
    # rows are dealt and sorted by a file's number, not by its long path; one row a file is sent
    names = sorted(r["path"] for r in stored.select(path).distinct().collect())
    numbers = stored.sparkSession.createDataFrame(list(enumerate(names)), "file int, path string")
    at = (stored.select(path, F.col("_metadata.row_index").alias("row"), order_key(order).alias("key"))
          .join(F.broadcast(numbers), "path").select("file", "row", "key"))
    before = F.lag("key").over(Window.partitionBy("file").orderBy("row"))
    files = (at.withColumn("down", (before > F.col("key")).cast("long"))
             .groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"),
                                  F.sum("down").alias("down")))
    # one row a file
    reach = F.max("high").over(Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("over", (reach > F.col("low")).cast("long")).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("over"), F.lit(0)).alias("overlaps"),
        F.coalesce(F.sum("down"), F.lit(0)).alias("unordered"))
