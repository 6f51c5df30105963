"""Time expressions.

All inputs and outputs are ``timestamp_ntz`` in UTC wall-clock time. The
helpers are plain Column expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_hours(ts: str | Column, hours: int = 1) -> Column:
    """Truncate to the hour, or to a multiple of ``hours`` within the day."""
    ts = col(ts)
    hour = F.hour(ts)
    if hours > 1:
        hour = hour - hour % F.lit(hours)
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), hour, F.lit(0), F.lit(0)
    )


def add_hours(ts: str | Column, hours: Column | int) -> Column:
    n = hours if isinstance(hours, Column) else F.lit(hours)
    return F.timestamp_add("HOUR", n, col(ts))


def parse_utc(value: str | Column, dtype: T.DataType | None = None) -> Column:
    """ISO-8601 text (``Z`` or any offset accepted) → UTC ``timestamp_ntz``.

    Junk gives NULL instead of an error (D3). A column that is already a
    timestamp is normalised to ``timestamp_ntz`` without parsing.
    """
    c = col(value)
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.TimestampType):
        return c.cast(T.TimestampNTZType())
    # An instant with its offset applied, shown on the UTC session clock.
    return F.try_to_timestamp(c).cast(T.TimestampNTZType())


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a UTC ``timestamp_ntz``."""
    return F.unix_micros(col(ts).cast(T.TimestampType()))


def lead_hours_exact(issued: str | Column, target: str | Column) -> Column:
    """Fractional hours between issue and target (gold table)."""
    return (
        F.unix_timestamp(col(target).cast(T.TimestampType()))
        - F.unix_timestamp(col(issued).cast(T.TimestampType()))
    ) / F.lit(3600.0)


def lead_hours_boundary(issued: str | Column, target: str | Column) -> Column:
    """Number of hour boundaries crossed (warehouse views, D14)."""
    return F.timestamp_diff("HOUR", floor_hours(issued), floor_hours(target))


# Bucket upper bounds (inclusive) and labels, in order. The
# labels sort correctly as text because of the zero padding.
LEAD_BUCKETS = [
    (6, "00-06h"),
    (12, "07-12h"),
    (24, "13-24h"),
    (48, "25-48h"),
    (72, "49-72h"),
]
LEAD_BUCKET_REST = "72h+"


def lead_bucket(lead: str | Column) -> Column:
    """P22. NULL lead falls through to the last label."""
    lead = col(lead)
    expr = None
    for bound, label in LEAD_BUCKETS:
        expr = (F.when if expr is None else expr.when)(lead <= bound, F.lit(label))
    return expr.otherwise(F.lit(LEAD_BUCKET_REST))


def partition_parts(ts: str | Column) -> dict[str, Column]:
    """P10: zero-padded ``year/month/day/hour`` text of a UTC timestamp."""
    ts = col(ts)

    def pad(c: Column, width: int) -> Column:
        return F.lpad(c.cast("string"), width, "0")

    return {
        "year": pad(F.year(ts), 4),
        "month": pad(F.month(ts), 2),
        "day": pad(F.dayofmonth(ts), 2),
        "hour": pad(F.hour(ts), 2),
    }
