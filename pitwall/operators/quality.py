"""Data-quality checks: declared per table, evaluated in one aggregation pass per table.

Checks (with the meaning of "failures", i.e. the rows a check query would return):

* ``not_null``        — rows where the column is NULL;
* ``unique``          — distinct non-NULL values that occur more than once;
* ``accepted_values`` — distinct values outside the list (NULLs excluded by a row filter);
* ``non_empty``       — 1 when the table has no rows.

All ``not_null`` and ``accepted_values`` checks of a table and its row count share a
single ``agg`` (one scan); each ``unique`` check is a ``groupBy(column)`` with partial
aggregation. Where a table is written anyway, ``watch`` names the counts to observe while it is
written: ``not_null`` and ``non_empty`` then need no scan at all, and the two checks on distinct
values read their one column of the stored table.
The report has one row per check: table, column, check, failures, passed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableChecks:
    table: str
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: dict[str, Sequence[str]] = field(default_factory=dict)
    non_empty: bool = False


def _rows(table: str, labels: list[tuple]) -> list:
    """One aggregate row → one output row per check (a single ``explode``, no re-scan)."""
    items = [F.struct(F.lit(c).cast("string").alias("column_name"), F.lit(chk).alias("check_name"),
                      F.col(a).cast("long").alias("failures")) for c, chk, a in labels]
    return [F.lit(table).alias("table_name"), F.explode(F.array(*items)).alias("_r")]


def watch(spec: TableChecks) -> list[Column]:
    """Counts to observe while the table is written: null values of each watched column."""
    return [F.count_if(F.col(c).isNull()).alias(f"nn_{c}") for c in spec.not_null]


def _accepted(spec: TableChecks) -> list[tuple]:
    """(column, aggregate): distinct values outside the list."""
    return [(c, F.count_distinct(F.when(F.col(c).isNotNull() & ~F.col(c).isin(*values), F.col(c))))
            for c, values in spec.accepted.items()]


def table_report(df: DataFrame, spec: TableChecks, observed: dict[str, int] | None = None) -> list[DataFrame]:
    """``observed``: ``rows`` and the counts of :func:`watch`, taken while ``df`` was written."""
    aggs, labels = [], []
    if observed is None:
        counts = [*watch(spec), *([F.count(F.lit(1)).alias("rows")] if spec.non_empty else [])]
    else:
        counts = [F.lit(observed[f"nn_{c}"]).alias(f"nn_{c}") for c in spec.not_null]
        counts += [F.lit(observed["rows"]).alias("rows")] if spec.non_empty else []
    labels += [(c, "not_null", f"nn_{c}") for c in spec.not_null]
    for c, outside in _accepted(spec):
        aggs.append(outside.alias(f"av_{c}"))
        labels.append((c, "accepted_values", f"av_{c}"))
    if spec.non_empty:
        labels.append((None, "non_empty", "ne"))
    out = []
    if labels:
        if observed is None:
            one = df.agg(*counts, *aggs)
        else:                             # only columns with accepted values are read, if any
            one = (df.agg(*aggs) if aggs else df.sparkSession.range(1)).select("*", *counts)
        one = one.withColumn("ne", (F.col("rows") == 0).cast("int")) if spec.non_empty else one
        out.append(one.select(*_rows(spec.table, labels))
                      .select("table_name", "_r.column_name", "_r.check_name", "_r.failures"))
    for c in spec.unique:
        dup = (df.filter(F.col(c).isNotNull()).groupBy(c).count()
                 .filter(F.col("count") > 1).agg(F.count(F.lit(1)).alias("n")))
        out.append(dup.select(*_rows(spec.table, [(c, "unique", "n")]))
                      .select("table_name", "_r.column_name", "_r.check_name", "_r.failures"))
    return out


def report(tables: dict[str, DataFrame], specs: Sequence[TableChecks],
           observed: dict[str, dict[str, int]] | None = None) -> DataFrame:
    parts = [p for s in specs for p in table_report(tables[s.table], s, (observed or {}).get(s.table))]
    rep = reduce(lambda a, b: a.unionByName(b), parts)
    return rep.withColumn("passed", F.col("failures") == 0)
