"""Telemetry → one summary row per driver-lap.

``assign_laps`` (as-of join) gives every sample its lap; ``lap_summary`` aggregates:
means rounded to 2 decimals, truncated maxima/minima, brake and DRS shares, sample count,
and the number of gear changes.

Gear changes are adjacent differences of the non-NULL gears in time order within a lap.
That count is a sum over adjacent pairs, so it splits exactly over time buckets:
``changes(A ++ B) = changes(A) + changes(B) + [last(A) != first(B)]``. So the whole
summary is one pass over the joined samples:

1. a window per (driver, bucket, lap) — about one lap's samples, and the partitioning the
   as-of join already produced when it shuffles, so no extra shuffle — marks gear changes;
2. a per-bucket aggregate keeps integer sums, counts, extremes, first/last gear;
3. a small per-lap window over its 2-3 buckets adds the changes at bucket edges, and a
   per-lap aggregate combines the buckets.

Ties in time are ordered by gear value, so the count is deterministic under re-execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.functions.columns import DRS_OPEN_VALUES
from pitwall.operators.asof import asof_join

LAP_KEYS = ["session_key", "driver_number", "lap_number"]
UNIT_DIGITS = 6  # values are summed as integers of 10^-6


def _units(x: Column) -> Column:
    return F.round(x * (10 ** UNIT_DIGITS)).cast("long")


def mean_from_units(total: Column, n: Column, digits: int = 2) -> Column:
    """Mean of values summed in integer units, rounded half-up to ``digits`` decimals.

    Exact: the result does not depend on summation order (partition layout), and ties
    round the same way on every engine. ``n = 0`` gives NULL."""
    step = 10 ** (UNIT_DIGITS - digits)
    q = F.floor((total * 2 + n * step) / (n * 2 * step))
    return F.when(n > 0, q / (10 ** digits))


def rounded_mean(x: Column, digits: int = 2) -> Column:
    """Aggregate: exact mean of ``x`` rounded half-up to ``digits`` decimals."""
    u = _units(x)
    return mean_from_units(F.sum(u), F.count(u), digits)


def assign_laps(samples: DataFrame, lap_starts: DataFrame) -> DataFrame:
    """Samples (typed) × lap boundaries (typed) → samples with ``lap_number``.

    Samples without a driver or time, before the driver's first lap start, or of a driver
    without boundaries are dropped (as the reference does)."""
    s = samples.filter(F.col("driver_number").isNotNull())
    return asof_join(s, lap_starts, ["session_key", "driver_number"], "date", "lap_start",
                     "lap_number")


_MEANS = ("speed", "throttle", "rpm", "brake_on", "drs_open")


def lap_summary(assigned: DataFrame) -> DataFrame:
    gear = F.col("n_gear")
    slice_w = (Window.partitionBy("session_key", "driver_number", "_bucket", "lap_number")
                     .orderBy("date", "n_gear")
                     .rowsBetween(Window.unboundedPreceding, -1))
    prev_gear = F.last("n_gear", ignorenulls=True).over(slice_w)
    s = assigned.select(
        *LAP_KEYS, "_bucket", "meeting_key", "date", "n_gear", "speed", "throttle", "rpm",
        F.when(F.col("brake").isNotNull(),
               F.when(F.col("brake") == 100, 100.0).otherwise(0.0)).alias("brake_on"),
        F.when(F.col("drs").isNotNull(),
               F.when(F.col("drs").isin(*DRS_OPEN_VALUES), 100.0).otherwise(0.0)).alias("drs_open"),
        F.when(gear.isNotNull() & prev_gear.isNotNull() & (prev_gear != gear), 1)
         .otherwise(0).alias("_chg"))
    order = F.when(gear.isNotNull(), F.struct("date", "n_gear"))
    sums = []
    for m in _MEANS:
        sums += [F.sum(_units(F.col(m))).alias(f"_s_{m}"), F.count(m).alias(f"_n_{m}")]
    # same key order as the window partition: the sort it made serves the aggregate too
    per_bucket = s.groupBy("session_key", "driver_number", "_bucket", "lap_number").agg(
        F.max("meeting_key").alias("meeting_key"), *sums,
        F.max("speed").alias("_max_speed"), F.min("speed").alias("_min_speed"),
        F.max("rpm").alias("_max_rpm"), F.count(F.lit(1)).alias("_rows"),
        F.sum("_chg").alias("_inner"),
        F.min_by("n_gear", order).alias("_first"), F.max_by("n_gear", order).alias("_last"))
    across = (Window.partitionBy(*LAP_KEYS).orderBy("_bucket")
                    .rowsBetween(Window.unboundedPreceding, -1))
    prev_last = F.last("_last", ignorenulls=True).over(across)
    per_bucket = per_bucket.withColumn(
        "_edge", F.when(F.col("_first").isNotNull() & prev_last.isNotNull()
                        & (prev_last != F.col("_first")), 1).otherwise(0))
    tot = []
    for m in _MEANS:
        tot += [F.sum(f"_s_{m}").alias(f"_s_{m}"), F.sum(f"_n_{m}").alias(f"_n_{m}")]
    lap = per_bucket.groupBy(*LAP_KEYS).agg(
        F.max("meeting_key").alias("meeting_key"), *tot,
        F.max("_max_speed").alias("_max_speed"), F.min("_min_speed").alias("_min_speed"),
        F.max("_max_rpm").alias("_max_rpm"), F.sum("_rows").alias("sample_count"),
        (F.sum("_inner") + F.sum("_edge")).cast("long").alias("gear_changes"))
    mean = lambda m: mean_from_units(F.col(f"_s_{m}"), F.col(f"_n_{m}"))
    return lap.select(
        "session_key", "meeting_key", "driver_number", "lap_number",
        mean("speed").alias("avg_speed"),
        F.col("_max_speed").cast("long").alias("max_speed"),
        F.col("_min_speed").cast("long").alias("min_speed"),
        mean("throttle").alias("avg_throttle"),
        mean("rpm").alias("avg_rpm"),
        F.col("_max_rpm").cast("long").alias("max_rpm"),
        mean("brake_on").alias("avg_brake"),
        mean("drs_open").alias("drs_usage_pct"),
        "gear_changes", F.col("sample_count").cast("long").alias("sample_count"))


def car_data_lap_agg(samples: DataFrame, lap_starts: DataFrame) -> DataFrame:
    """Typed samples + typed lap starts → the ``car_data_lap_agg`` raw table rows."""
    return lap_summary(assign_laps(samples, lap_starts))
