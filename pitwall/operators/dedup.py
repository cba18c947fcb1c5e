"""Latest row per key, as an aggregation.

``row_number() = 1`` over a window puts every copy of a key into one task; a key that was
re-sent many times becomes a hot partition. Here the pick is an aggregate, ``max_by`` over
a struct ordering, so each map task collapses its copies before the shuffle (partial
aggregation) and a key's final merge sees at most one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]],
                   tie_break: Sequence[str] = ()) -> DataFrame:
    """Keep one row per ``keys``: the first under ``ORDER BY c1 DESC, c2 DESC, ...``.

    ``order`` is a list of ``(column, nulls_first)``; ``nulls_first=True`` is the Postgres
    default for DESC (a NULL load time wins). ``tie_break`` columns (descending) and then
    the whole row break remaining ties, so the pick is deterministic under retries.
    """
    fields = [c for c in df.columns if c not in keys]
    ordering = []
    for col, nulls_first in order:
        c = F.col(col)
        ordering.append((c.isNull() if nulls_first else c.isNotNull()).alias(f"{col}_null"))
        ordering.append(c.alias(f"{col}_value"))
    ordering += [F.col(c).alias(f"tb_{c}") for c in tie_break]
    row = F.struct(*[F.col(c) for c in fields])
    ordering.append(row.alias("row"))
    picked = df.groupBy(*keys).agg(F.max_by(row, F.struct(*ordering)).alias("_pick"))
    return picked.select(*keys, *[F.col("_pick")[c].alias(c) for c in fields])
