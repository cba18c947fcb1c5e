"""pitwall — motor-racing timing and strategy analytics on Apache Spark.

Layers (each a set of plain functions from DataFrames to DataFrames):

* ``pitwall.sources``   — raw table schemas, landed-file readers, test fixtures
* ``pitwall.functions`` — Column helpers (points, lap-time text, validity, ...)
* ``pitwall.operators`` — reusable operators (as-of join, telemetry aggregation,
  idempotent append, SCD-2, data-quality checks, latest-row dedup)
* ``pitwall.plans``     — the models: staging, enriched, marts, work-lists, build
* ``pitwall.streaming`` — the idempotent append driven by Structured Streaming
"""

__version__ = "0.1.0"
