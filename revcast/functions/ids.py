"""Content ids, record hashes and surrogate keys.

Every id is a deterministic function of row content, so any executor can
compute it without coordination: no IDENTITY counter and no global window.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timecols import col, epoch_micros

# The identity fields of each event variant (sorted by name, as
# the canonical JSON text is rendered with sorted keys).
FORECAST_IDENTITY = [
    "city",
    "event_type",
    "forecast_timestamp",
    "issued_at",
    "precipitation_probability_pct",
    "source",
    "temperature_2m_c",
    "wind_speed_10m_kmh",
]
OBSERVATION_IDENTITY = [
    "city",
    "event_type",
    "observation_timestamp",
    "precipitation_mm",
    "source",
    "temperature_2m_c",
    "wind_speed_10m_kmh",
]
IDENTITY = {"forecast": FORECAST_IDENTITY, "observation": OBSERVATION_IDENTITY}

ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss"
TIME_FIELDS = {"issued_at", "forecast_timestamp", "observation_timestamp"}


def iso_utc(ts: str | Column) -> Column:
    """UTC timestamp as ISO-8601 text with an explicit ``+00:00`` offset."""
    return F.concat(F.date_format(col(ts), ISO_UTC), F.lit("+00:00"))


def canonical_json(kind: str) -> Column:
    """Compact JSON of the identity fields, keys sorted, NULLs kept."""
    fields = []
    for name in IDENTITY[kind]:
        value = iso_utc(name) if name in TIME_FIELDS else F.col(name)
        fields.append(value.alias(name))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def event_id(kind: str) -> Column:
    """SHA-256 of the canonical identity text.

    Measured values are part of the identity, so a corrected value is a new
    id while a redelivery keeps its id.
    """
    if kind not in IDENTITY:
        return no_such_type(F.lit(kind))
    return F.sha2(canonical_json(kind), 256)


def no_such_type(kind: Column) -> Column:
    """An event of any other type fails the plan."""
    return F.raise_error(F.concat(F.lit("no identity fields for event type "), F.coalesce(kind, F.lit("NULL")))).cast(
        "string"
    )


def event_id_any(strict: bool = True) -> Column:
    """P6-P8 for a mixed frame: picks the variant by row. Other types fail
    the plan, or get NULL if not ``strict``."""
    known = F.when(F.col("event_type") == "forecast", event_id("forecast")).when(
        F.col("event_type") == "observation", event_id("observation")
    )
    return known.otherwise(no_such_type(F.col("event_type"))) if strict else known


MEASURE_DECIMAL = "decimal(18,6)"


def measure_text(c: str | Column) -> Column:
    """Canonical number text for hashing: fixed 6 decimals, NULL → ''."""
    return F.coalesce(col(c).cast(MEASURE_DECIMAL).cast("string"), F.lit(""))


def record_hash(*measures: str) -> Column:
    """P25: SHA2-256 over the measures joined by '|' (D11)."""
    return F.sha2(F.concat_ws("|", *[measure_text(m) for m in measures]), 256)


FORECAST_MEASURES = (
    "temperature_2m_c",
    "precipitation_probability_pct",
    "wind_speed_10m_kmh",
)


def surrogate_key(*parts: str | Column) -> Column:
    """A 60-bit key from the SHA-256 of the natural key text."""
    text = parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)
    text = col(text) if isinstance(text, str) else text
    return F.conv(F.substring(F.sha2(text.cast("string"), 256), 1, 15), 16, 10).cast(
        "bigint"
    )


def revision_key() -> Column:
    """Key of one SCD2 row: the natural key plus the start of its validity, as
    full SHA-256 text. There is one for each revision ever, so 60 bits would
    collide at scale; they are enough for the names of a dimension."""
    return F.sha2(
        F.concat_ws(
            "|",
            F.col("source_key").cast("string"),
            F.col("city_key").cast("string"),
            epoch_micros("issued_at").cast("string"),
            epoch_micros("forecast_timestamp").cast("string"),
            epoch_micros("effective_from").cast("string"),
        ),
        256,
    )
