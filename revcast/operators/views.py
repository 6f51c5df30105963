"""Warehouse views.

Dimensions are joined by key. Read from storage, their file size is known
and Spark broadcasts them under ``autoBroadcastJoinThreshold``; derived in
the same plan, AQE measures them at run time and only then turns the
shuffle join into a broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import lead_bucket, lead_hours_boundary


def _names(fact: DataFrame, dim_city: DataFrame, dim_source: DataFrame) -> DataFrame:
    c = dim_city.select("city_key", "city_name")
    s = dim_source.select("source_key", "source_name")
    return fact.join(c, "city_key", "inner").join(s, "source_key", "inner")


def current_forecasts(fact: DataFrame, dim_city: DataFrame, dim_source: DataFrame) -> DataFrame:
    """``v_current_forecasts``: every issue of a target, current revision
    only, integer lead hours counted as hour boundaries (P18)."""
    current = fact.where(F.col("is_current"))  # F5
    return _names(current, dim_city, dim_source).select(
        "forecast_revision_key",
        "source_name",
        "city_name",
        "issued_at",
        "forecast_timestamp",
        lead_hours_boundary("issued_at", "forecast_timestamp").alias("lead_hours"),
        "temperature_2m_c",
        "precipitation_probability_pct",
        "wind_speed_10m_kmh",
    )


def temperature_accuracy(
    fact: DataFrame, fact_observation: DataFrame, dim_city: DataFrame, dim_source: DataFrame
) -> DataFrame:
    """``v_temperature_accuracy``: every revision (not only current) scored
    against the stored observation of its city and hour; the observing
    source is not in the key (D18)."""
    obs = fact_observation.select(
        "city_key",
        F.col("observation_timestamp").alias("forecast_timestamp"),
        F.col("temperature_2m_c").alias("observed_temperature_c"),
    )
    f = fact.select(
        "source_key",
        "city_key",
        "issued_at",
        "forecast_timestamp",
        F.col("temperature_2m_c").alias("forecast_temperature_c"),
    )
    joined = f.join(obs, ["city_key", "forecast_timestamp"], "inner")
    error = F.col("forecast_temperature_c") - F.col("observed_temperature_c")
    return _names(joined, dim_city, dim_source).select(
        "source_name",
        "city_name",
        "issued_at",
        "forecast_timestamp",
        lead_hours_boundary("issued_at", "forecast_timestamp").alias("lead_hours"),
        "forecast_temperature_c",
        "observed_temperature_c",
        error.alias("error_c"),
        F.abs(error).alias("absolute_error_c"),
    )


def accuracy_by_city_lead(accuracy: DataFrame) -> DataFrame:
    """``v_accuracy_by_city_lead`` (A2) on the integer lead."""
    return accuracy.groupBy(
        "city_name", lead_bucket("lead_hours").alias("lead_time_bucket")
    ).agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.avg("absolute_error_c").alias("mae_c"),
        F.sqrt(F.avg(F.col("error_c") * F.col("error_c"))).alias("rmse_c"),
        F.avg("error_c").alias("bias_c"),
    )
