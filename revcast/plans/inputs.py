"""Engine inputs and intermediate tables derived from the test tables.

Each function is lazy: it returns a plan over the Parquet files and runs no
job, so every query built from them scales with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import accuracy as acc
from ..operators import silver as sv
from ..operators import warehouse as wh
from ..sources import fixtures as fx


def raw(spark: SparkSession, d: str, kind: str) -> DataFrame:
    if kind == "forecast":
        return fx.forecast_events(spark, d)
    return fx.observation_events(spark, d)


def normalized(spark: SparkSession, d: str, kind: str) -> DataFrame:
    return sv.normalize(raw(spark, d, kind), kind)


def valid(spark: SparkSession, d: str, kind: str) -> DataFrame:
    good, _ = sv.split_valid(normalized(spark, d, kind), kind)
    return good


def silver(spark: SparkSession, d: str, kind: str) -> DataFrame:
    return sv.dedup(valid(spark, d, kind))


def redelivery(spark: SparkSession, d: str) -> DataFrame:
    """Valid forecasts with every tenth one delivered twice (R3s)."""
    return fx.redelivered(valid(spark, d, "forecast"))


def staged(spark: SparkSession, d: str, kind: str) -> DataFrame:
    """Staging rows: valid events before W1, so a value that returns keeps
    all its sightings (§7.4)."""
    return wh.stage(valid(spark, d, kind), kind)


def fact_forecast(spark: SparkSession, d: str) -> DataFrame:
    return wh.scd2_apply(None, wh.incoming_revisions(staged(spark, d, "forecast")))


def fact_observation(spark: SparkSession, d: str) -> DataFrame:
    return wh.upsert_observations(
        None, wh.incoming_observations(staged(spark, d, "observation"))
    )


def dims(spark: SparkSession, d: str):
    f = staged(spark, d, "forecast")
    o = staged(spark, d, "observation")
    return wh.upsert_dim_city(None, f, o), wh.upsert_dim_source(None, f, o)


def gold(spark: SparkSession, d: str) -> DataFrame:
    obs = acc.latest_observations(silver(spark, d, "observation"))
    return acc.gold_rows(silver(spark, d, "forecast"), obs)


def split_at(df: DataFrame, column: str, cut: str):
    """Two batches of one frame: rows before ``cut`` and the rest."""
    before = F.col(column) < F.lit(cut).cast("timestamp_ntz")
    return df.where(before), df.where(~before | F.col(column).isNull())
