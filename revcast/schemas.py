"""Declared schemas.

Nothing is inferred: every table is read with one of these, and what the
batch jobs write is cast to it. Engine timestamps
are ``timestamp_ntz`` holding UTC wall-clock time, so results do not depend
on the session or Python process zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
D = T.DoubleType()
TS = T.TimestampNTZType()


def _fields(*pairs):
    return [T.StructField(name, dtype, True) for name, dtype in pairs]


# --- Bronze (JSON as landed, timestamps still text) -------------------------

BRONZE_COMMON = _fields(
    ("event_id", S),
    ("event_type", S),
    ("source", S),
    ("city", S),
    ("latitude", D),
    ("longitude", D),
    ("temperature_2m_c", D),
    ("wind_speed_10m_kmh", D),
    ("ingested_at", S),
)

BRONZE_FORECAST = T.StructType(
    BRONZE_COMMON
    + _fields(
        ("issued_at", S),
        ("forecast_timestamp", S),
        ("precipitation_probability_pct", D),
    )
)

BRONZE_OBSERVATION = T.StructType(
    BRONZE_COMMON
    + _fields(
        ("observation_timestamp", S),
        ("precipitation_mm", D),
    )
)

# One JSON record that may be either variant: used by the stream decoder.
BRONZE_ANY = T.StructType(
    BRONZE_COMMON
    + _fields(
        ("issued_at", S),
        ("forecast_timestamp", S),
        ("precipitation_probability_pct", D),
        ("observation_timestamp", S),
        ("precipitation_mm", D),
    )
)

CORRUPT = "_corrupt_record"


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, S, True)])


# --- Typed events (silver input after normalisation) -------------------------

FORECAST_COLUMNS = [
    "event_id",
    "event_type",
    "source",
    "city",
    "latitude",
    "longitude",
    "issued_at",
    "forecast_timestamp",
    "temperature_2m_c",
    "precipitation_probability_pct",
    "wind_speed_10m_kmh",
    "ingested_at",
]

OBSERVATION_COLUMNS = [
    "event_id",
    "event_type",
    "source",
    "city",
    "latitude",
    "longitude",
    "observation_timestamp",
    "temperature_2m_c",
    "precipitation_mm",
    "wind_speed_10m_kmh",
    "ingested_at",
]

TIMESTAMP_COLUMNS = {
    "forecast": ["issued_at", "forecast_timestamp", "ingested_at"],
    "observation": ["observation_timestamp", "ingested_at"],
}

_TYPES = {
    "latitude": D, "longitude": D, "temperature_2m_c": D, "precipitation_probability_pct": D,
    "precipitation_mm": D, "wind_speed_10m_kmh": D, "issued_at": TS, "forecast_timestamp": TS,
    "observation_timestamp": TS, "ingested_at": TS, "forecast_date": T.DateType(), "observation_date": T.DateType(),
}


def _typed(names: list[str]) -> T.StructType:
    return T.StructType(_fields(*((n, _TYPES.get(n, S)) for n in names)))


SILVER = {
    "forecast": _typed([*FORECAST_COLUMNS, "forecast_date"]),
    "observation": _typed([*OBSERVATION_COLUMNS, "observation_date"]),
}
# Rejected rows as JSON, times as text; the names of the rules each one breaks.
QUARANTINE = {
    kind: T.StructType(
        [T.StructField(f.name, D if f.dataType == D else S) for f in schema.fields]
        + [T.StructField("failed_rules", T.ArrayType(S))]
    )
    for kind, schema in SILVER.items()
}
METRICS = T.StructType(
    _fields(
        *((n, T.LongType()) for n in ("input_count", "valid_count", "invalid_count", "deduplicated_count")),
        ("event_type", S), ("process_date", S), ("batch", S),
    )
)

# --- Stream record (M4) and hourly payload (M2) ------------------------------

STREAM_RECORD = T.StructType(_fields(("record_id", S), ("key", S), ("value", S)))

HOURLY_PAYLOAD = T.StructType(
    [
        T.StructField("city", S, True),
        T.StructField("latitude", D, True),
        T.StructField("longitude", D, True),
        T.StructField(
            "hourly",
            T.StructType(
                [
                    T.StructField("time", T.ArrayType(S), True),
                    T.StructField("temperature_2m", T.ArrayType(D), True),
                    T.StructField("precipitation_probability", T.ArrayType(D), True),
                    T.StructField("precipitation", T.ArrayType(D), True),
                    T.StructField("wind_speed_10m", T.ArrayType(D), True),
                ]
            ),
            True,
        ),
    ]
)

# --- City config (M1) ---------------------------------------------------------

CITY_CONFIG = T.StructType(
    _fields(("city", S), ("latitude", D), ("longitude", D), ("timezone", S))
)
CITY_REQUIRED = ["city", "latitude", "longitude", "timezone"]

# --- Warehouse tables (K9) ------------------------------------------------------

DIM_CITY = T.StructType(
    [
        T.StructField("city_key", T.LongType(), False),
        T.StructField("city_name", S, False),
        T.StructField("latitude", T.DecimalType(9, 6), True),
        T.StructField("longitude", T.DecimalType(9, 6), True),
        T.StructField("created_at", TS, True),
    ]
)

DIM_SOURCE = T.StructType(
    [
        T.StructField("source_key", T.LongType(), False),
        T.StructField("source_name", S, False),
        T.StructField("created_at", TS, True),
    ]
)

DIM_TIME = T.StructType(
    [
        T.StructField("time_key", T.LongType(), False),
        T.StructField("full_timestamp", TS, False),
        T.StructField("calendar_date", T.DateType(), False),
        T.StructField("year_num", T.ShortType(), True),
        T.StructField("month_num", T.ShortType(), True),
        T.StructField("day_num", T.ShortType(), True),
        T.StructField("hour_num", T.ShortType(), True),
        T.StructField("day_of_week", T.ShortType(), True),
    ]
)

STG_FORECAST_COLUMNS = [
    "event_id",
    "source",
    "city",
    "latitude",
    "longitude",
    "issued_at",
    "forecast_timestamp",
    "temperature_2m_c",
    "precipitation_probability_pct",
    "wind_speed_10m_kmh",
    "ingested_at",
]

STG_OBSERVATION_COLUMNS = [
    "event_id",
    "source",
    "city",
    "latitude",
    "longitude",
    "observation_timestamp",
    "temperature_2m_c",
    "precipitation_mm",
    "wind_speed_10m_kmh",
    "ingested_at",
]

FORECAST_KEY = ["source_key", "city_key", "issued_at", "forecast_timestamp"]
OBSERVATION_KEY = ["source_key", "city_key", "observation_timestamp"]

FACT_FORECAST_REVISION = T.StructType(
    [
        T.StructField("forecast_revision_key", S, False),
        T.StructField("source_key", T.LongType(), False),
        T.StructField("city_key", T.LongType(), False),
        T.StructField("issued_at", TS, False),
        T.StructField("forecast_timestamp", TS, False),
        T.StructField("temperature_2m_c", D, True),
        T.StructField("precipitation_probability_pct", D, True),
        T.StructField("wind_speed_10m_kmh", D, True),
        T.StructField("source_event_id", S, True),
        T.StructField("effective_from", TS, False),
        T.StructField("effective_to", TS, True),
        T.StructField("is_current", T.BooleanType(), False),
        T.StructField("record_hash", S, False),
        T.StructField("last_seen_at", TS, True),
        T.StructField("created_at", TS, True),
        T.StructField("forecast_date", T.DateType(), True),
    ]
)

# The run list behind the revisions: a row per natural key and day of sighting.
FORECAST_RUNS = T.StructType(
    _fields(
        ("source_key", T.LongType()), ("city_key", T.LongType()), ("issued_at", TS), ("forecast_timestamp", TS),
        ("slice", T.LongType()),
        ("runs", T.ArrayType(T.StructType(_fields(
            ("record_hash", S), ("temperature_2m_c", D), ("precipitation_probability_pct", D), ("wind_speed_10m_kmh", D),
            ("seen", T.ArrayType(T.StructType(_fields(("seen_at", TS), ("source_event_id", S), ("stored_at", TS))))),
        )))),
        ("forecast_date", T.DateType()),
    )
)

FACT_OBSERVATION = T.StructType(
    [
        T.StructField("source_key", T.LongType(), False),
        T.StructField("city_key", T.LongType(), False),
        T.StructField("observation_timestamp", TS, False),
        T.StructField("temperature_2m_c", D, True),
        T.StructField("precipitation_mm", D, True),
        T.StructField("wind_speed_10m_kmh", D, True),
        T.StructField("source_event_id", S, True),
        T.StructField("ingested_at", TS, True),
        T.StructField("updated_at", TS, True),
        T.StructField("observation_date", T.DateType(), True),
    ]
)

GOLD_COLUMNS = [
    "event_id",
    "source",
    "observation_source",
    "city",
    "issued_at",
    "forecast_timestamp",
    "lead_hours",
    "lead_time_bucket",
    "forecast_temperature_c",
    "observed_temperature_c",
    "temperature_error_c",
    "temperature_absolute_error_c",
    "temperature_squared_error",
    "precipitation_probability_pct",
    "precipitation_mm",
    "forecast_wind_kmh",
    "observed_wind_kmh",
    "target_date",
]

GOLD = T.StructType(
    _fields(
        *(
            (n, TS if n in ("issued_at", "forecast_timestamp") else T.DateType() if n == "target_date"
             else S if n in ("event_id", "source", "observation_source", "city", "lead_time_bucket") else D)
            for n in GOLD_COLUMNS
        )
    )
)

# What the summary needs of one day: rows and sums by city and lead bucket.
# The change feed of the gold rows: +1 came, -1 went.
GOLD_CHANGES = T.StructType([*GOLD.fields, T.StructField("change", T.IntegerType(), True)])

GOLD_PARTIALS = T.StructType(
    _fields(
        ("city", S), ("lead_time_bucket", S), ("matched_forecasts", T.LongType()),
        ("sum_absolute_error", D), ("sum_squared_error", D), ("sum_error", D), ("target_date", T.DateType()),
    )
)
