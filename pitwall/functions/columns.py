"""Column-level helpers: the warehouse's reusable expressions as Column → Column functions.

All are built-in Spark expressions (code-generated, no Python at run time).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's) ------------------------------------------
# Championship points by finishing position, positions 1..10 (2010-present scoring).
POINTS_BY_POSITION = (25, 18, 15, 12, 10, 8, 6, 4, 2, 1)
# Tyre compound -> display colour; anything else -> the default colour.
COMPOUND_COLOURS = (
    ("SOFT", "#FF3333"),
    ("MEDIUM", "#FFD700"),
    ("HARD", "#EEEEEE"),
    ("INTERMEDIATE", "#39B54A"),
    ("WET", "#0067FF"),
)
DEFAULT_COMPOUND_COLOUR = "#AAAAAA"
# Accepted tyre compounds after normalisation.
COMPOUNDS = ("SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET")
# DRS states that mean "flap open".
DRS_OPEN_VALUES = (10, 12, 14)
# A stop faster than this many seconds counts as fast.
FAST_STOP_SECS = 2.5
# Telemetry samples a lap needs to count as sufficiently covered.
MIN_TELEMETRY_SAMPLES = 50
# Upper lap bound for a stint that has not ended yet.
# ------------------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def idiv(a, b) -> Column:
    """Integer division (SQL ``div``) of non-negative integer columns."""
    a, b = _c(a), (_c(b) if isinstance(b, (str, Column)) else F.lit(b))
    return ((a - a % b) / b).cast("long")


def race_points(position) -> Column:
    """Points for a finishing position; 0 outside the top ten or for NULL."""
    pos = _c(position)
    out = F.lit(0)
    for i, pts in reversed(list(enumerate(POINTS_BY_POSITION, start=1))):
        out = F.when(pos == i, F.lit(pts)).otherwise(out)
    return out


def points_table(spark):
    """The position → points relation (10 rows), for joins."""
    return spark.createDataFrame(
        list(enumerate(POINTS_BY_POSITION, start=1)), "position int, points int")


def format_lap_time(secs) -> Column:
    """Seconds → ``M:SS.mmm``. Rounds to whole milliseconds first, so 59.9996 → 1:00.000."""
    ms = F.round(_c(secs) * 1000).cast("long")
    return F.format_string("%d:%02d.%03d", idiv(ms, 60000), idiv(ms % 60000, 1000), ms % 1000)


def is_valid_lap(duration, pit_out) -> Column:
    """Timed, positive and not a pit-out lap (NULL pit-out counts as not pit-out)."""
    d = _c(duration)
    return d.isNotNull() & (d > 0) & ~F.coalesce(_c(pit_out), F.lit(False))


def compound_colour(compound) -> Column:
    up = F.upper(_c(compound))
    out = F.lit(DEFAULT_COMPOUND_COLOUR)
    for name, colour in reversed(COMPOUND_COLOURS):
        out = F.when(up == name, F.lit(colour)).otherwise(out)
    return out


def pct_off_pace(lap, reference) -> Column:
    """Percentage by which ``lap`` is slower than ``reference``, 3 decimals; NULL on /0."""
    lap, ref = _c(lap), _c(reference)
    return F.round(F.try_divide(lap - ref, ref) * 100, 3)


def normalise_colour(colour) -> Column:
    """Prefix '#' unless present; NULL stays NULL."""
    c = _c(colour)
    return F.when(F.left(c, F.lit(1)) == "#", c).otherwise(F.concat(F.lit("#"), c))


def parse_iso_timestamp(text, require_zone: bool = False) -> Column:
    """ISO-8601 text → timestamp; bad text → NULL. With ``require_zone`` the text must end
    in an offset ('Z', '+00:00', ...), as telemetry dates must; otherwise a naive time
    (read as UTC) or a space separator is accepted too, as calendar dates are."""
    t = _c(text)
    zoned = F.try_to_timestamp(t, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX"))
    if require_zone:
        return zoned
    return F.coalesce(
        zoned,
        F.try_to_timestamp(t, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]")),
        F.try_to_timestamp(t, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]")),
    )
