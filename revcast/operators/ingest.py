"""Ingest-side operators: hourly payloads, event split, serialisation and
stream decoding (S8, P1-P5, P9, P10, F10, K7, K8, T1).

The reference does this per city in a Python loop on one machine; here each
step is a column expression over a distributed frame of payloads/records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import event_id_any
from ..functions.timecols import floor_hours, parse_utc, partition_parts

# Payload array names, in the order the provider returns them,
# and the event column each one feeds.
HOURLY_ARRAYS = [
    ("temperature_2m", "temperature_2m_c"),
    ("precipitation_probability", "precipitation_probability_pct"),
    ("precipitation", "precipitation_mm"),
    ("wind_speed_10m", "wind_speed_10m_kmh"),
]
PAYLOAD_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"


def explode_hourly(payloads: DataFrame, keep: list[str]) -> DataFrame:
    """Parallel arrays → one row per ``time`` entry.

    ``posexplode(time)`` drives the rows; every other array is read with
    ``get(array, pos)``, which gives NULL for a missing array, an empty one
    or one shorter than ``time`` (``arrays_zip`` would null the whole row
    when any array is NULL)."""
    exploded = payloads.select(
        *keep,
        F.posexplode("hourly.time").alias("pos", "time"),
        "hourly",
    )
    return exploded.select(
        *keep,
        "pos",
        parse_utc(F.col("time")).alias("event_ts"),
        *[F.get(F.col(f"hourly.{arr}"), F.col("pos")).alias(name) for arr, name in HOURLY_ARRAYS],
    )


def split_events(hourly: DataFrame, issued_at: str | Column = "issued_at") -> DataFrame:
    """An hour at or after the issue hour is a forecast, an earlier one
    an observation; each variant gets its own columns, then both are
    stacked by name (T1)."""
    issued = F.col(issued_at) if isinstance(issued_at, str) else issued_at
    is_forecast = F.coalesce(F.col("event_ts") >= issued, F.lit(False))
    # P5: the columns every event of a payload shares; coordinates as double.
    common = [F.col(c) for c in ("source", "city", "ingested_at") if c in hourly.columns]
    common += [F.col(c).cast("double").alias(c) for c in ("latitude", "longitude") if c in hourly.columns]
    forecasts = hourly.where(is_forecast).select(
        F.lit("forecast").alias("event_type"),
        *common,
        issued.alias("issued_at"),
        F.col("event_ts").alias("forecast_timestamp"),
        "temperature_2m_c",
        "precipitation_probability_pct",
        "wind_speed_10m_kmh",
    )
    observations = hourly.where(~is_forecast).select(
        F.lit("observation").alias("event_type"),
        *common,
        F.col("event_ts").alias("observation_timestamp"),
        "temperature_2m_c",
        "precipitation_mm",
        "wind_speed_10m_kmh",
    )
    return forecasts.unionByName(observations, allowMissingColumns=True)


def with_event_id(events: DataFrame, strict: bool = True) -> DataFrame:
    """P6-P8 on a mixed frame; an event of another type fails the plan, or
    gets a NULL id if not ``strict``."""
    return events.withColumn("event_id", event_id_any(strict))


def issue_hour(as_of: str | Column) -> Column:
    """The issue time is the fetch time truncated to the hour."""
    return floor_hours(F.col(as_of) if isinstance(as_of, str) else as_of)


# --- Serialisation (K7, K8) ------------------------------------------------------

JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def to_records(events: DataFrame, columns: list[str]) -> DataFrame:
    """K7: compact JSON value keyed by city (the stream's ordering key)."""
    return events.select(
        F.col("city").alias("key"),
        F.to_json(F.struct(*columns), JSON_OPTIONS).alias("value"),
    )


def to_lines(events: DataFrame, columns: list[str]) -> DataFrame:
    """K8: the same text, one event a line, for a text or console sink."""
    return to_records(events, columns).select("value")


# --- Decoding (P9, P10, F10, R2s) ---------------------------------------------------

KNOWN_TYPES = ["forecast", "observation"]


def decode_records(records: DataFrame) -> DataFrame:
    """base64 → JSON text, plus bronze partition values from
    ``ingested_at`` in UTC (D13).

    A record is good if its text parses as a JSON object, names a known type
    and has a readable ingestion time; what else it holds is kept as it came
    and judged in silver. Junk never raises: ``_error`` names the first
    failure. Rows with an error are the dead letter (F10)."""
    text = F.try_to_binary(F.col("value"), F.lit("base64")).cast("string")
    parsed = records.select(
        F.coalesce(F.col("record_id"), F.expr("uuid()")).alias("record_id"), "key", "value", text.alias("json")
    ).withColumn("_v", F.try_parse_json("json"))

    def field(name: str) -> Column:
        return F.try_variant_get("_v", f"$.{name}", "string")

    is_object = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    kind, ingested = field("event_type"), parse_utc(field("ingested_at"))
    error = (
        F.when(F.col("json").isNull(), F.lit("bad_base64"))
        .when(~is_object, F.lit("bad_json"))
        .when(~F.coalesce(kind.isin(*KNOWN_TYPES), F.lit(False)), F.lit("unsupported_event_type"))
        .when(ingested.isNull(), F.lit("bad_ingested_at"))
    )
    return parsed.select(
        "record_id", "key", "value", "json", error.alias("_error"), kind.alias("event_type"),
        *[c.alias(n) for n, c in partition_parts(ingested).items()],
    )


def bronze_rows(decoded: DataFrame) -> DataFrame:
    """Good records for the bronze sink: the JSON text as it was sent, one
    record a line (a raw line break can only stand between JSON tokens), and
    the partition columns."""
    line = F.translate("json", "\r\n", "  ")
    return decoded.where(F.col("_error").isNull()).select(
        line.alias("value"), "event_type", "year", "month", "day", "hour"
    )


def dead_letter(decoded: DataFrame) -> DataFrame:
    """R2s: the failed records, reported by id with the reason."""
    return decoded.where(F.col("_error").isNotNull()).select(
        "record_id", "key", "value", F.col("_error").alias("error")
    )
