"""Independent SQL (DuckDB dialect) for every registered query — the correctness oracle."""

from oracle.sql import oracle_queries  # noqa: F401
