"""Landed feeds: read with a declared schema, conform columns, type leniently.

* ``read_landed_json`` — one read over every landed file of a feed (all sessions, all
  drivers), schema given, never inferred; malformed records keep NULL fields.
* ``conform`` — keep an allow-list of columns, add missing ones as typed NULLs.
* ``union_feeds`` — the column set is the union over all partial feeds.
* ``with_rejects`` — the same read with a reason on every record that cannot be loaded, so that
  none is dropped unseen.
* ``discover`` — the columns that occur in the records themselves, also in few of them.
* ``typed_car_data`` / ``typed_lap_starts`` — lenient casts: a value that does not parse
  becomes NULL instead of failing the job.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.functions.columns import parse_iso_timestamp


def read_landed_json(spark: SparkSession, paths: str | Sequence[str],
                     schema: T.StructType) -> DataFrame:
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
                 .json(paths if isinstance(paths, str) else list(paths)))


REASON, LINE, FILE = "_reason", "_line", "_file"


def with_rejects(lines: DataFrame, schema: T.StructType, mandatory: Sequence[str]) -> DataFrame:
    """Text lines (``value``) → the fields of ``schema``, ``_reason`` (null for a record that can be
    loaded), the line and its file. Reasons: ``malformed`` (not a record of this schema) and
    ``no <field>`` for the first mandatory field that is missing. Empty lines are no records."""
    corrupt = "_corrupt"
    full = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    record = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    parsed = lines.filter(F.trim("value") != "").select(
        record.alias("_r"), F.col("value").alias(LINE), F.col("_metadata.file_path").alias(FILE))
    broken = F.col("_r").isNull() | F.col(f"_r.{corrupt}").isNotNull()
    missing = F.coalesce(*[F.when(F.col(f"_r.{c}").isNull(), F.lit(f"no {c}")) for c in mandatory]) if mandatory else F.lit(None)
    reason = F.when(broken, F.lit("malformed")).otherwise(missing)
    return parsed.select(*[F.when(~broken, F.col(f"_r.{f.name}")).alias(f.name) for f in schema.fields],
                         reason.cast("string").alias(REASON), LINE, FILE)


def accepted(records: DataFrame) -> DataFrame:
    return records.filter(F.col(REASON).isNull()).drop(REASON, LINE, FILE)


def rejects(records: DataFrame) -> DataFrame:
    """(reason, line, file): the reject table, appended beside the loaded one."""
    return records.filter(F.col(REASON).isNotNull()).select(
        F.col(REASON).alias("reason"), F.col(LINE).alias("line"), F.col(FILE).alias("file"))


def discover(lines: DataFrame) -> str:
    """The schema, as DDL, of all records of a feed of JSON lines: the union of the fields of every
    record, each with the widest of its types. One aggregate over the lines; only the schema comes
    to the driver. Decimal numbers are doubles, a field that is always null is text."""
    found = lines.select(F.schema_of_variant_agg(F.try_parse_json("value"))).first()[0]
    for pattern, kind in ((r"OBJECT<", "STRUCT<"), (r"DECIMAL\(\d+,\s*\d+\)", "DOUBLE"), (r"\bVOID\b", "STRING")):
        found = re.sub(pattern, kind, found)
    return found


def read_discovered(lines: DataFrame) -> DataFrame:
    """The records of a feed of JSON lines with the columns that occur in them."""
    ddl = discover(lines)
    if not ddl.startswith("STRUCT<"):
        raise ValueError(f"the feed's lines are no records, but {ddl}")
    return lines.select(F.from_json("value", ddl).alias("_r")).filter("_r IS NOT NULL").select("_r.*")


def union_feeds(frames: Iterable[DataFrame]) -> DataFrame:
    """Row concat of partial feeds; a column missing from one feed is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def conform(df: DataFrame, schema: T.StructType, allowed: Iterable[str] | None = None) -> DataFrame:
    """Project onto ``schema``: drop columns outside it (or outside ``allowed``), add the
    missing ones as NULL, cast the rest to the declared type (ISO text → timestamps via
    the lenient parser)."""
    keep = set(allowed) if allowed is not None else None
    cols = []
    for f in schema.fields:
        if keep is not None and f.name not in keep and not f.name.startswith("_"):
            continue
        if f.name in df.columns:
            src = F.col(f.name)
            if (isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
                    and isinstance(df.schema[f.name].dataType, T.StringType)):
                src = parse_iso_timestamp(src)            # ISO text, with or without zone
            cols.append(src.cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def stamp_lineage(df: DataFrame, loaded_at, run_id: str) -> DataFrame:
    """Add ``_loaded_at`` (passed in, never read from the clock inside a job) and ``_run_id``."""
    return df.withColumn("_loaded_at", F.lit(loaded_at).cast("timestamp_ntz")) \
             .withColumn("_run_id", F.lit(run_id))


def nested_to_json(df: DataFrame) -> DataFrame:
    """Struct / array / map columns → JSON text (for a text-typed sink)."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(*[F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, nested)
                       else F.col(f.name) for f in df.schema.fields])


def stringify(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns as text: text stays as it is, records and lists become JSON, other
    values their plain text (a gap of 12.345 s sent as a number, for a text column)."""
    def text(name):
        kind = df.schema[name].dataType
        nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
        return F.to_json(F.col(name)) if nested else F.col(name).cast("string")
    return df.withColumns({c: text(c) for c in columns})


CAR_DATA_FIELDS = ("date", "session_key", "meeting_key", "driver_number", "speed", "throttle",
                   "rpm", "brake", "drs", "n_gear")


def _whole(name: str) -> Column:
    """Whole number from loosely typed input: '12' and '12.0' are 12, anything else NULL."""
    text = F.col(name).cast("string")
    return F.coalesce(text.try_cast("long"), text.try_cast("double").try_cast("long"))


def _finite(name: str) -> Column:
    """Number from loosely typed input; text, NaN and infinities are NULL."""
    x = F.col(name).cast("string").try_cast("double")
    return F.when(F.abs(x) < float("inf"), x)


def typed_car_data(raw: DataFrame) -> DataFrame:
    """Telemetry samples with lenient types; missing fields become NULL."""
    df = raw
    for c in CAR_DATA_FIELDS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    extra = [c for c in df.columns if c not in CAR_DATA_FIELDS]
    return df.select(
        parse_iso_timestamp(F.col("date").cast("string"), require_zone=True).alias("date"),
        _whole("session_key").alias("session_key"),
        _whole("meeting_key").alias("meeting_key"),
        _whole("driver_number").alias("driver_number"),
        *[_finite(c).alias(c)
          for c in ("speed", "throttle", "rpm", "brake")],
        _whole("drs").alias("drs"),
        _whole("n_gear").alias("n_gear"),
        *extra)


def typed_lap_starts(raw: DataFrame) -> DataFrame:
    """Lap boundaries: rows without a start time, lap number or driver (or with a zero
    lap / driver number) are not boundaries."""
    df = raw.select(
        _whole("session_key").alias("session_key"),
        _whole("driver_number").alias("driver_number"),
        _whole("lap_number").alias("lap_number"),
        parse_iso_timestamp(F.col("date_start").cast("string"), require_zone=True).alias("lap_start"))
    return df.filter(F.col("lap_start").isNotNull()
                     & F.coalesce(F.col("lap_number") != 0, F.lit(False))
                     & F.coalesce(F.col("driver_number") != 0, F.lit(False)))
