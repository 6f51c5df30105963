"""The driver's ``events`` table as engine input (FIXTURES.md §3).

The mapping is a projection plus one join with the 5-row ``region`` table, so
it scales with ``events`` and keeps Parquet column pruning: only the six
``events`` columns it uses are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import add_hours, floor_hours

# Fixed values of the mapping.
NULL_TEMPERATURE_EVERY = 53
BACKDATED_EVERY = 47
LEAD_STEPS = 13
LEAD_STEP_HOURS = 8
ISSUE_GRID_HOURS = 6
OBSERVATION_GRID_HOURS = 2
REDELIVER_EVERY = 10
REDELIVERY_DELAY_HOURS = 1
OBSERVATION_TYPE = "view"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events_with_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    e = events.select("event_id", "ts", "user_id", "event_type", "value", "props").withColumn(
        "_rk", (F.col("user_id") % 5).cast("int")
    )
    # No hint: the planner broadcasts region from its file size (a measured
    # bound, under autoBroadcastJoinThreshold) and falls back to a shuffle
    # join above it.
    joined = e.join(region, e["_rk"] == region["r_regionkey"], "inner")
    rk = F.col("r_regionkey").cast("double")
    return joined.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_id").alias("_n"),
        F.col("event_type").alias("_kind"),
        F.col("r_name").alias("city"),
        # Coordinates: a function of the region, varied by user so that one
        # city can arrive with two positions.
        (rk * 10.0 + (F.col("user_id") % 2).cast("double") * 0.25).alias("latitude"),
        (rk * 15.0 - 30.0 + (F.col("user_id") % 3).cast("double") * 0.5).alias("longitude"),
        F.when(F.col("event_id") % NULL_TEMPERATURE_EVERY == 0, F.lit(None).cast("double"))
        .otherwise(F.col("value") / 2 - 20)
        .alias("temperature_2m_c"),
        (F.col("user_id") % 60).cast("double").alias("wind_speed_10m_kmh"),
        F.get_json_object("props", "$.k").cast("double").alias("_k"),
        F.col("ts").alias("ingested_at"),
        "ts",
    )


def _worked_out(df: DataFrame, columns: list[str], **derived: Column) -> DataFrame:
    """``columns`` of ``df`` and the derived ones, each worked out once a row:
    predicates on a generated column stay behind it, where an alias would be
    put into every rule and filter that names it. Those on the other columns
    go on to the files. (``outer``: for the plain form Spark filters by the
    size of the array first, which works it out once more.)"""
    once = F.array(F.struct(*[c.alias(n) for n, c in derived.items()]))
    return df.select(*columns, once.alias("_once")).select(*columns, F.inline_outer("_once"))


def forecast_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed forecast events (every row, valid or not)."""
    base = _events_with_city(spark, sf_dir).where(F.col("_kind") != OBSERVATION_TYPE)
    issued = floor_hours("ts", ISSUE_GRID_HOURS)
    lead = (
        F.when(F.col("_n") % BACKDATED_EVERY == 0, F.lit(-24))
        .otherwise((F.col("_n") % LEAD_STEPS) * LEAD_STEP_HOURS)
        .cast("int")
    )
    kept = ["event_id", "_kind", "city", "latitude", "longitude", "temperature_2m_c", "wind_speed_10m_kmh", "ingested_at"]
    rows = _worked_out(base, kept, k=F.col("_k"), issued_at=issued, forecast_timestamp=add_hours(issued, lead))
    return rows.select(
        "event_id",
        F.lit("forecast").alias("event_type"),
        F.col("_kind").alias("source"),
        "city",
        "latitude",
        "longitude",
        "issued_at",
        "forecast_timestamp",
        "temperature_2m_c",
        F.when(F.col("k") == 0, F.lit(None).cast("double"))
        .otherwise(F.col("k"))
        .alias("precipitation_probability_pct"),
        "wind_speed_10m_kmh",
        "ingested_at",
    )


def observation_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed observation events (every row, valid or not)."""
    base = _events_with_city(spark, sf_dir).where(F.col("_kind") == OBSERVATION_TYPE)
    kept = ["event_id", "city", "latitude", "longitude", "temperature_2m_c", "wind_speed_10m_kmh", "ingested_at"]
    rows = _worked_out(base, kept, k=F.col("_k"), observation_timestamp=floor_hours("ts", OBSERVATION_GRID_HOURS))
    return rows.select(
        "event_id",
        F.lit("observation").alias("event_type"),
        F.lit(OBSERVATION_TYPE).alias("source"),
        "city",
        "latitude",
        "longitude",
        "observation_timestamp",
        "temperature_2m_c",
        (F.col("k") / 10).alias("precipitation_mm"),
        "wind_speed_10m_kmh",
        "ingested_at",
    )


def redelivered(valid_forecasts: DataFrame) -> DataFrame:
    """Valid forecasts plus a second copy of every tenth one, landed an hour
    later (the at-least-once stream, R3s)."""
    again = valid_forecasts.where(
        F.col("event_id").cast("bigint") % REDELIVER_EVERY == 0
    ).withColumn("ingested_at", add_hours("ingested_at", REDELIVERY_DELAY_HOURS))
    return valid_forecasts.unionByName(again)


# Which mapped events are delivered damaged, or unusual but fine.
BAD_BASE64_EVERY = 101
BAD_JSON_EVERY = 103
BAD_JSON_PREFIX = 20
UNKNOWN_TYPE_EVERY = 107
BAD_TIME_EVERY = 109
LEADING_BLANK_EVERY = 5
UNDECLARED_KEY_EVERY = 7
MISTYPED_EVERY = 113


def stream_records(events: DataFrame, columns: list[str]) -> DataFrame:
    """Events as stream records (``record_id, key, value`` = base64 JSON).

    Some deliveries are damaged, one kind for each reason of the dead letter:
    not base64, cut-off JSON, an unknown type, an unreadable ingestion time.
    Others are fine but unusual: a blank before the JSON, a key that no schema
    declares, a temperature that is text."""
    from ..operators.ingest import JSON_OPTIONS

    n = F.col("event_id").cast("bigint")

    def every(k: int) -> Column:
        return F.coalesce(n % k == 0, F.lit(False))

    def step(values: Column, change: Callable[[Column], Column]) -> Column:
        # a lambda's argument is worked out once, however often it is used;
        # an expression used twice in each of a row of steps doubles with each
        return F.transform(values, change)

    def damaged(values: Column, k: int, pattern: str, by: str) -> Column:
        return step(values, lambda x: F.when(every(k), F.regexp_replace(x, pattern, by)).otherwise(x))

    text = F.array(F.to_json(F.struct(*columns), JSON_OPTIONS))
    text = damaged(text, UNKNOWN_TYPE_EVERY, '"event_type":"[a-z]+"', '"event_type":"radar"')
    text = damaged(text, BAD_TIME_EVERY, '"ingested_at":"[^"]+"', '"ingested_at":"soon"')
    text = damaged(text, MISTYPED_EVERY, '"temperature_2m_c":[^,}]+', '"temperature_2m_c":"mild"')
    text = damaged(text, UNDECLARED_KEY_EVERY, "}$", ',"sensor":"s1"}')
    text = step(text, lambda x: F.when(every(LEADING_BLANK_EVERY), F.concat(F.lit("  "), x)).otherwise(x))

    def sent(x: Column) -> Column:
        cut = F.when(every(BAD_JSON_EVERY) & ~every(BAD_BASE64_EVERY), F.substring(x, 1, BAD_JSON_PREFIX)).otherwise(x)
        return F.concat(F.when(every(BAD_BASE64_EVERY), F.lit("!")).otherwise(F.lit("")), F.base64(cut.cast("binary")))

    value = F.get(step(text, sent), F.lit(0))
    return events.select(
        F.col("event_id").alias("record_id"),
        F.col("city").alias("key"),
        value.alias("value"),
        "ingested_at",
    )


def city_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A city list from ``region``: name, position, a zone west to east."""
    rk = F.col("r_regionkey").cast("double")
    return table(spark, sf_dir, "region").select(
        F.col("r_name").alias("city"),
        (rk * 10.0).alias("latitude"),
        (rk * 15.0 - 30.0).alias("longitude"),
        F.concat(F.lit("Etc/GMT+"), F.col("r_regionkey").cast("string")).alias("timezone"),
    )
