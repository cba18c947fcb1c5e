"""As-of join: give each timestamped row the interval (lap) in progress at its time.

Rule (backward, inclusive start): a sample at ``t`` belongs to the boundary with the
greatest start ``<= t`` within the same key; samples before the first boundary of their
key get none (inner semantics drop them); samples after the last boundary belong to it.
Of boundaries with equal starts, the one later in (start, id) order wins.

Plan: time is cut into slices of fixed width, and everything meets on (key, slice).

1. Per (key, slice) the boundaries that start there, in order: a handful.
2. A table of all slices that hold samples or boundaries, from pre-aggregated keys. A window
   per key over slices (not samples) carries the last boundary of earlier slices forward.
3. Samples join that table on (key, slice): one row each, no range condition, no pair
   blow-up. The boundary in progress is the last of the slice's (carried or own) that
   started by the sample's time.

A key with a third of all samples, and the samples after its last boundary, spread over as
many join keys as they have slices. The width only affects speed, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_SECONDS = 600


def _slice(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / (seconds * 1_000_000)).cast("long")


def asof_join(samples: DataFrame, boundaries: DataFrame, keys: Sequence[str], time_col: str,
              start: str, ident: str, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Inner as-of join: ``samples`` rows that fall in an interval, with ``ident`` (and the
    interval ``start``) attached, plus ``_bucket``, the slice (usable as a window
    sub-partition)."""
    keys = list(keys)
    sliced = (samples.filter(F.col(time_col).isNotNull())
                     .withColumn("_bucket", _slice(F.col(time_col), slice_seconds)))
    row = F.struct(F.col(start).alias("at"), F.col(ident).alias("id"))
    own = (boundaries.filter(F.col(start).isNotNull())
                     .groupBy(*keys, _slice(F.col(start), slice_seconds).alias("_bucket"))
                     .agg(F.array_sort(F.collect_set(row)).alias("_own")))
    slices = (sliced.select(*keys, "_bucket").distinct()
                    .withColumn("_own", F.lit(None).cast(own.schema["_own"].dataType))
                    .unionByName(own)
                    .groupBy(*keys, "_bucket").agg(F.max("_own").alias("_own")))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last(F.element_at("_own", -1), ignorenulls=True).over(earlier)
    table = (slices.withColumn("_carried", carried)
                   .withColumn("_known", F.concat(
                       F.when(F.col("_carried").isNotNull(), F.array("_carried"))
                        .otherwise(F.array().cast(own.schema["_own"].dataType)),
                       F.coalesce("_own", F.array().cast(own.schema["_own"].dataType))))
                   .filter(F.size("_known") > 0)
                   .select(*keys, "_bucket", "_known"))
    found = F.try_element_at(F.filter("_known", lambda x: x["at"] <= F.col(time_col)), F.lit(-1))
    out = sliced.join(table, [*keys, "_bucket"]).withColumn("_found", found)
    return (out.filter(F.col("_found").isNotNull())
               .select(*samples.columns, "_bucket", F.col("_found.id").alias(ident),
                       F.col("_found.at").alias(start)))


def asof_join_direct(samples: DataFrame, boundaries: DataFrame, keys: Sequence[str],
                     time_col: str, start: str, ident: str) -> DataFrame:
    """Plain formulation (for tests): equi-join on the key with the interval as a
    residual. Same result; every sample of a key meets every interval of that key."""
    w = Window.partitionBy(*keys).orderBy(F.col(start), F.col(ident))
    iv = (boundaries.filter(F.col(start).isNotNull()).select(*keys, ident, start)
                    .withColumn("_next", F.lead(start).over(w)))
    iv = iv.filter(F.col("_next").isNull() | (F.col("_next") > F.col(start)))
    ivr = iv.select(*[F.col(k).alias(f"_iv_{k}") for k in keys], ident, start, "_next")
    s = samples.filter(F.col(time_col).isNotNull())
    cond = F.lit(True)
    for k in keys:
        cond = cond & (s[k] == ivr[f"_iv_{k}"])
    cond = cond & (s[time_col] >= ivr[start]) & (ivr["_next"].isNull() | (s[time_col] < ivr["_next"]))
    return s.join(ivr, cond, "inner").drop(*[f"_iv_{k}" for k in keys], "_next")
