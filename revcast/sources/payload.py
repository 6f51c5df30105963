"""Hourly provider payloads as a table source.

Landed payload files are read with the declared array schema. For the test
tables, payloads are derived from forecast events: one payload per
(source, city, issue hour, target date) holding one value per hour, i.e. at
most 24 positions, so no array can grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.timecols import parse_utc
from ..operators.ingest import PAYLOAD_TIME_FORMAT, issue_hour
from ..operators.silver import latest_per_key

PAYLOAD_KEY = ["source", "city", "issued_at", "target_date"]


LANDED = T.StructType(
    [T.StructField(n, T.StringType(), True) for n in ("source", "issued_at", "ingested_at")]
    + list(schemas.HOURLY_PAYLOAD.fields)
)


def write_payloads(payloads: DataFrame, path: str) -> None:
    """Land payloads as JSON lines; NULL arrays are left out, as a provider
    leaves out a measure it doesn't have."""
    times = {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") for c in ("issued_at", "ingested_at")}
    payloads.withColumns(times).select(*LANDED.names).write.mode("overwrite").json(path)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed payload files with their declared schema; the fetch time is
    cut to its hour, which is the issue time (P4)."""
    rows = spark.read.schema(LANDED).json(path)
    return rows.withColumn("issued_at", issue_hour(parse_utc("issued_at"))).withColumn(
        "ingested_at", parse_utc("ingested_at")
    )


def _array(points: str, field: str):
    """Values of one measure in time order; a measure that is NULL at every
    hour is left out of the payload (a missing array, P2)."""
    values = F.transform(F.col(points), lambda p: p[field])
    present = F.exists(F.col(points), lambda p: p[field].isNotNull())
    return F.when(present, values)


def payloads_from_forecasts(forecasts: DataFrame) -> DataFrame:
    """Latest value per (source, city, issue, hour), grouped per target date
    into parallel arrays sorted by time."""
    hourly = latest_per_key(
        forecasts.select(
            "source",
            "city",
            "issued_at",
            "forecast_timestamp",
            "temperature_2m_c",
            "precipitation_probability_pct",
            "wind_speed_10m_kmh",
            "latitude",
            "longitude",
            "ingested_at",
            "event_id",
        ),
        ["source", "city", "issued_at", "forecast_timestamp"],
        ["ingested_at", "event_id"],
    )
    grouped = hourly.groupBy(
        "source", "city", "issued_at", F.to_date("forecast_timestamp").alias("target_date")
    ).agg(
        # Payload-level fields: where the city was fetched (first sighting)
        # and when (the latest ingestion of the group).
        F.min_by(
            F.struct("latitude", "longitude"), F.struct("ingested_at", "latitude", "longitude")
        ).alias("_at"),
        F.max("ingested_at").alias("ingested_at"),
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col("forecast_timestamp").alias("t"),
                    F.col("temperature_2m_c").alias("temperature_2m"),
                    F.col("precipitation_probability_pct").alias("precipitation_probability"),
                    F.col("wind_speed_10m_kmh").alias("wind_speed_10m"),
                )
            )
        ).alias("_pts")
    )
    return grouped.select(
        *PAYLOAD_KEY,
        F.col("_at.latitude").alias("latitude"),
        F.col("_at.longitude").alias("longitude"),
        "ingested_at",
        F.struct(
            F.transform("_pts", lambda p: F.date_format(p["t"], PAYLOAD_TIME_FORMAT)).alias("time"),
            _array("_pts", "temperature_2m").alias("temperature_2m"),
            _array("_pts", "precipitation_probability").alias("precipitation_probability"),
            F.lit(None).cast("array<double>").alias("precipitation"),
            _array("_pts", "wind_speed_10m").alias("wind_speed_10m"),
        ).alias("hourly"),
    )
