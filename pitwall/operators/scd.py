"""Slowly-changing dimension, type 2, "check" strategy.

A snapshot holds spells: one row per (key, period during which the checked columns kept
their values), with ``valid_from``, ``valid_to`` (NULL = open), ``updated_at`` and
``scd_id``. Only the checked columns open a new spell; other columns changing are
ignored (the open row keeps the values it was opened with). Keys missing from a later
input are left open (hard deletes are not applied). Comparisons are NULL-safe.

* ``increment`` — one snapshot run: (snapshot, current rows, run time) → new snapshot.
  A full outer join of the open spells with the current rows; no MERGE needed, the result
  is written as a new version of the table.
* ``replay`` — the snapshot that running ``increment`` after every observation would
  build, in one pass: ``lag`` marks changes, ``lead`` closes spells (gaps and islands).
  Window partitions are one key's observations (e.g. one driver's races).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SNAPSHOT_META = ("valid_from", "valid_to", "updated_at", "scd_id")


def scd_id(key: str, ts: Column) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit("|"), ts.cast("string")))


def _differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def replay(history: DataFrame, key: str, check_cols: Sequence[str], order_cols: Sequence[str],
           run_ts: str, attrs: Sequence[str]) -> DataFrame:
    """``history``: one row per observation of a key, ``run_ts`` = when the snapshot run
    that saw it happened. Returns the spells (snapshot rows)."""
    w = Window.partitionBy(key).orderBy(*order_cols)
    first = F.row_number().over(w) == 1
    changed = first
    for c in check_cols:
        changed = changed | _differs(F.col(c), F.lag(c).over(w))
    starts = history.withColumn("_chg", changed).filter(F.col("_chg"))
    w2 = Window.partitionBy(key).orderBy(*order_cols)
    return starts.select(
        key, *attrs,
        F.col(run_ts).alias("valid_from"),
        F.lead(run_ts).over(w2).alias("valid_to"),
        F.col(run_ts).alias("updated_at"),
        scd_id(key, F.col(run_ts)).alias("scd_id"))


def increment(snapshot: DataFrame, current: DataFrame, key: str, check_cols: Sequence[str],
              attrs: Sequence[str], run_ts) -> DataFrame:
    """One snapshot run at ``run_ts`` over ``current`` (one row per key)."""
    ts = F.lit(run_ts).cast("timestamp_ntz") if not isinstance(run_ts, Column) else run_ts
    cols = snapshot.columns
    closed = snapshot.filter(F.col("valid_to").isNotNull())
    open_ = snapshot.filter(F.col("valid_to").isNull()).select(
        F.col(key).alias("_key"), F.struct(*cols).alias("_old"))
    opened = {**{c: F.col(c) for c in (key, *attrs)}, "valid_from": ts,
              "valid_to": F.lit(None).cast("timestamp_ntz"), "updated_at": ts, "scd_id": scd_id(key, ts)}
    cur = current.select(key, *attrs)
    cur = cur.select(F.col(key).alias("_cur"), F.struct(*[opened[c].alias(c) for c in cols]).alias("_new"))
    j = open_.join(cur, open_["_key"] == cur["_cur"], "full_outer")
    changed = F.lit(False)
    for c in check_cols:
        changed = changed | _differs(F.col(f"_old.{c}"), F.col(f"_new.{c}"))
    # one or two rows per key: the old spell as it is, or closed and followed by the new one
    rows = (F.when(F.col("_old").isNull(), F.array("_new"))
             .when(F.col("_new").isNull() | ~changed, F.array("_old"))
             .otherwise(F.array(F.col("_old").withField("valid_to", ts), F.col("_new"))))
    now = j.select(F.explode(rows).alias("_row")).select(*[F.col("_row")[c].alias(c) for c in cols])
    return closed.select(*cols).unionByName(now)
