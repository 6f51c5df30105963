"""Small hand-made frames for unit tests (FIXTURES.md §4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

TS = T.TimestampNTZType()
S = T.StringType()
D = T.DoubleType()

FORECAST = T.StructType(
    [
        T.StructField("event_id", S),
        T.StructField("event_type", S),
        T.StructField("source", S),
        T.StructField("city", S),
        T.StructField("latitude", D),
        T.StructField("longitude", D),
        T.StructField("issued_at", TS),
        T.StructField("forecast_timestamp", TS),
        T.StructField("temperature_2m_c", D),
        T.StructField("precipitation_probability_pct", D),
        T.StructField("wind_speed_10m_kmh", D),
        T.StructField("ingested_at", TS),
    ]
)

OBSERVATION = T.StructType(
    [
        T.StructField("event_id", S),
        T.StructField("event_type", S),
        T.StructField("source", S),
        T.StructField("city", S),
        T.StructField("latitude", D),
        T.StructField("longitude", D),
        T.StructField("observation_timestamp", TS),
        T.StructField("temperature_2m_c", D),
        T.StructField("precipitation_mm", D),
        T.StructField("wind_speed_10m_kmh", D),
        T.StructField("ingested_at", TS),
    ]
)


def t(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def forecast(
    event_id="f1",
    source="north",
    city="Oslo",
    issued="2031-03-02 06:00",
    target="2031-03-03 09:00",
    temp=4.0,
    prob=60.0,
    wind=22.0,
    ingested="2031-03-02 06:12",
    lat=59.5,
    lon=10.5,
):
    return (
        event_id, "forecast", source, city, lat, lon,
        t(issued) if issued else None, t(target) if target else None,
        temp, prob, wind, t(ingested) if ingested else None,
    )


def observation(
    event_id="o1",
    source="north",
    city="Oslo",
    at="2031-03-03 09:00",
    temp=2.5,
    precip=0.0,
    wind=18.0,
    ingested="2031-03-03 10:20",
    lat=59.5,
    lon=10.5,
):
    return (
        event_id, "observation", source, city, lat, lon,
        t(at), temp, precip, wind, t(ingested) if ingested else None,
    )


def forecasts(spark, rows):
    return spark.createDataFrame(rows, FORECAST)


def observations(spark, rows):
    return spark.createDataFrame(rows, OBSERVATION)
