"""Warehouse operators: staging, dimensions, SCD2 revisions, observation
upsert (S7, P26, P27, J2-J5, J9, U1-U6, D9, D12, D16, D17, D17b, D19).

``MERGE INTO`` is not available on plain Parquet, so every mutation is a pure
function ``(stored rows of the touched partitions, incoming) → new rows``,
followed by a partition-scoped write (see ``plans.storage``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.ids import FORECAST_MEASURES, record_hash, revision_key, surrogate_key
from ..functions.timecols import epoch_micros
from .silver import latest_per_key

FKEY = schemas.FORECAST_KEY
OKEY = schemas.OBSERVATION_KEY


def batch_literal(batch_ts: dt.datetime | str | None) -> Column:
    """Column defaults come from the batch parameter, never the clock."""
    if batch_ts is None:
        return F.lit(None).cast("timestamp_ntz")
    if isinstance(batch_ts, str):
        batch_ts = dt.datetime.fromisoformat(batch_ts)
    return F.lit(batch_ts.replace(tzinfo=None)).cast("timestamp_ntz")


# --- Staging (S7, D9) ---------------------------------------------------------


def stage(silver: DataFrame, kind: str) -> DataFrame:
    """Select the staging columns by name (never by position)."""
    cols = schemas.STG_FORECAST_COLUMNS if kind == "forecast" else schemas.STG_OBSERVATION_COLUMNS
    return silver.select(*cols)


def with_keys(staged: DataFrame) -> DataFrame:
    """Dimension keys of a staged row.

    Keys are a function of the name (D12), so the lookup is an expression
    instead of two joins; every staged name is inserted into its dimension
    by the same batch (U3/U4), so the inner join never dropped a row."""
    return staged.withColumn("source_key", surrogate_key("source")).withColumn(
        "city_key", surrogate_key("city")
    )


# --- Dimensions (U3-U5, P27, D16, D19) ------------------------------------------


def _staged_names(*staged: DataFrame) -> DataFrame:
    rows = None
    for s in staged:
        part = s.select("city", "source", "latitude", "longitude", "ingested_at")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def city_candidates(*staged: DataFrame) -> DataFrame:
    """One row per city name: the earliest sighting by (ingested_at, lat,
    lon) (D19). All rows meet only in a hash aggregate with a fixed-width
    buffer, combined before the shuffle; choosing among a city's few
    positions is left to its small result."""
    rows = _staged_names(*staged).where(F.col("city").isNotNull())
    positions = rows.groupBy("city", "latitude", "longitude").agg(F.min("ingested_at").alias("ingested_at"))
    first = positions.groupBy("city").agg(
        F.min_by(
            F.struct("latitude", "longitude"),
            F.struct("ingested_at", "latitude", "longitude"),
        ).alias("_c")
    )
    return first.select(
        surrogate_key("city").alias("city_key"),
        F.col("city").alias("city_name"),
        F.col("_c.latitude").cast("decimal(9,6)").alias("latitude"),
        F.col("_c.longitude").cast("decimal(9,6)").alias("longitude"),
    )


def new_cities(existing: DataFrame | None, *staged: DataFrame, batch_ts=None) -> DataFrame:
    """Rows of city names not stored yet."""
    new = city_candidates(*staged).withColumn("created_at", batch_literal(batch_ts))
    return new if existing is None else new.join(existing.select("city_name"), "city_name", "left_anti").select(*new.columns)


def upsert_dim_city(existing: DataFrame | None, *staged: DataFrame, batch_ts=None) -> DataFrame:
    """Insert names not yet present; stored attributes never change."""
    fresh = new_cities(existing, *staged, batch_ts=batch_ts)
    return fresh if existing is None else existing.unionByName(fresh)


def new_sources(existing: DataFrame | None, *staged: DataFrame, batch_ts=None) -> DataFrame:
    """Rows of source names (A9) not stored yet."""
    names = _staged_names(*staged).where(F.col("source").isNotNull()).select("source").distinct()
    new = names.select(
        surrogate_key("source").alias("source_key"),
        F.col("source").alias("source_name"),
        batch_literal(batch_ts).alias("created_at"),
    )
    return new if existing is None else new.join(existing.select("source_name"), "source_name", "left_anti").select(*new.columns)


def upsert_dim_source(existing: DataFrame | None, *staged: DataFrame, batch_ts=None) -> DataFrame:
    """U4: distinct source names inserted if absent."""
    fresh = new_sources(existing, *staged, batch_ts=batch_ts)
    return fresh if existing is None else existing.unionByName(fresh)


def dim_time(spark, *timestamps: DataFrame) -> DataFrame:
    """One row per hour between the first and last hour in the facts.

    Only the two bounds reach the driver; the hours themselves come from a
    distributed ``range``, so the calendar never sits in one task."""
    stamps = None
    for df in timestamps:
        part = df.select(F.col(df.columns[0]).alias("t"))
        stamps = part if stamps is None else stamps.unionByName(part)
    bounds = stamps.agg(
        F.min(epoch_micros("t")).alias("lo"), F.max(epoch_micros("t")).alias("hi")
    ).first()
    if bounds is None or bounds["lo"] is None:
        return spark.createDataFrame([], schemas.DIM_TIME)
    hour_us = 3_600_000_000
    lo = bounds["lo"] - bounds["lo"] % hour_us
    n = (bounds["hi"] - lo) // hour_us + 1
    ts = F.timestamp_micros(F.lit(lo) + F.col("id") * hour_us).cast("timestamp_ntz")
    hours = spark.range(0, n).select(ts.alias("full_timestamp"))
    return hours.select(
        (
            F.year("full_timestamp").cast("bigint") * 1_000_000
            + F.month("full_timestamp") * 10_000
            + F.dayofmonth("full_timestamp") * 100
            + F.hour("full_timestamp")
        ).alias("time_key"),
        "full_timestamp",
        F.to_date("full_timestamp").alias("calendar_date"),
        F.year("full_timestamp").cast("smallint").alias("year_num"),
        F.month("full_timestamp").cast("smallint").alias("month_num"),
        F.dayofmonth("full_timestamp").cast("smallint").alias("day_num"),
        F.hour("full_timestamp").cast("smallint").alias("hour_num"),
        # 0 = Sunday.
        (F.dayofweek("full_timestamp") - 1).cast("smallint").alias("day_of_week"),
    )


# --- SCD2 forecast revisions (U1, J4, J5, F6, D17) -------------------------------

REVISION_COLUMNS = list(FORECAST_MEASURES) + ["source_event_id", "record_hash"]


def incoming_revisions(staged_forecasts: DataFrame) -> DataFrame:
    """Staged forecasts as revision candidates."""
    keyed = with_keys(staged_forecasts)
    return keyed.select(
        *FKEY,
        *FORECAST_MEASURES,
        F.col("event_id").alias("source_event_id"),
        F.col("ingested_at").alias("effective_from"),
        record_hash(*FORECAST_MEASURES).alias("record_hash"),
    )


# Width of the time slices a chain is kept and ordered in: a row of the run
# list holds one key's sightings of one slice (a day: two dozen hourly runs),
# however long the key's history is.
SLICE_HOURS = 24


def _slice(seen_at: str = "seen_at") -> Column:
    return F.floor(epoch_micros(seen_at) / F.lit(SLICE_HOURS * 3_600_000_000)).cast("long")


def sightings_of(incoming: DataFrame, batch_ts=None) -> DataFrame:
    """Revision candidates as sightings; ``stored_at`` is the batch that
    brings them."""
    return incoming.select(
        *FKEY, *FORECAST_MEASURES, "source_event_id", "record_hash",
        F.col("effective_from").alias("seen_at"), batch_literal(batch_ts).alias("stored_at"),
    )


def sightings_of_runs(runs: DataFrame) -> DataFrame:
    """The run list back to one row per sighting: nothing was lost in it."""
    run = runs.select(*FKEY, F.inline("runs"))
    return run.select(*FKEY, *FORECAST_MEASURES, "record_hash", F.inline("seen"))


def sighting_runs(sightings: DataFrame) -> DataFrame:
    """The run list: one row per key and time slice with its runs, each a
    value (hash, measures) and the sightings that repeated it, in order.

    Equal-time sightings collapse to the greatest ``source_event_id`` (then
    hash); of copies the one stored first stays. Identical copies meet in the
    set aggregate before the shuffle."""
    item = F.struct(
        "seen_at", "source_event_id", "record_hash", *FORECAST_MEASURES, (-epoch_micros("stored_at")).alias("age")
    )
    slices = sightings.groupBy(*FKEY, _slice().alias("slice")).agg(F.array_sort(F.collect_set(item)).alias("_all"))
    last = F.filter("_all", lambda x, i: F.coalesce(F.get("_all", i + 1)["seen_at"] != x["seen_at"], F.lit(True)))

    def changes(i: Column) -> Column:
        before = F.get("_seen", i - 1)["record_hash"]
        return F.coalesce(before != F.get("_seen", i)["record_hash"], F.lit(True))

    def run(i: Column, j: Column) -> Column:
        first = F.get("_seen", i)
        length = F.coalesce(F.get("_at", j + 1), F.size("_seen")) - i
        stored_at = lambda x: F.timestamp_micros(-x["age"]).cast("timestamp_ntz").alias("stored_at")
        return F.struct(
            first["record_hash"].alias("record_hash"), *(first[m].alias(m) for m in FORECAST_MEASURES),
            F.transform(
                F.slice("_seen", i + 1, length), lambda x: F.struct(x["seen_at"], x["source_event_id"], stored_at(x))
            ).alias("seen"),
        )

    return (
        slices.withColumn("_seen", last)
        .withColumn("_at", F.filter(F.sequence(F.lit(0), F.size("_seen") - 1), changes))
        .select(*FKEY, "slice", F.transform("_at", run).alias("runs"), F.to_date("forecast_timestamp").alias("forecast_date"))
    )


def merge_runs(stored: DataFrame | None, incoming: DataFrame, batch_ts=None) -> DataFrame:
    """The run list with a batch's sightings in it: a late row splits the run
    it falls into, or joins it. Independent of the order batches come in."""
    new = sightings_of(incoming, batch_ts)
    return sighting_runs(new if stored is None else sightings_of_runs(stored).unionByName(new))


#: What the stitching of slices has to know of a slice's first and last run.
EDGE = ("record_hash", "effective_from", "until")


def chains(runs: DataFrame) -> DataFrame:
    """Revision chain per natural key from the run list.

    Slices are stitched in one pass over each key, last slice first: a slice
    whose first run goes on with the value before it starts no revision there,
    and a run's revision ends at the next start, wherever it lies. The pass
    sees a slice's two edges, one narrow row however many runs it has; the runs
    are joined to what it found by (key, slice), so that a key's runs never
    meet in one task."""
    first_run, last_run = F.get("_r", F.lit(0)), F.element_at("_r", -1)
    compact = runs.select(
        *FKEY, "slice",
        F.transform(
            "runs",
            lambda r: F.struct(
                r["record_hash"].alias("record_hash"), *(r[m].alias(m) for m in FORECAST_MEASURES),
                F.get(r["seen"], F.lit(0))["source_event_id"].alias("source_event_id"),
                F.get(r["seen"], F.lit(0))["seen_at"].alias("effective_from"),
                F.get(r["seen"], F.lit(0))["stored_at"].alias("created_at"),
                F.element_at(r["seen"], -1)["seen_at"].alias("until"),
            ),
        ).alias("_r"),
    )
    back = Window.partitionBy(*FKEY).orderBy(F.desc("slice"))
    opens = F.coalesce(F.col("_before.record_hash") != F.col("_first.record_hash"), F.lit(True))
    # the first start of a slice and the last sighting in front of it
    start = F.when(F.col("_opens"), F.struct(F.col("_first.effective_from").alias("at"), F.col("_before.until").alias("prior"))).when(
        F.col("_inner").isNotNull(), F.struct(F.col("_inner").alias("at"), F.col("_first.until").alias("prior"))
    )
    edges = compact.select(
        *FKEY, "slice",
        *[F.struct(*[r[c].alias(c) for c in EDGE]).alias(n) for n, r in (("_first", first_run), ("_last", last_run))],
        F.get("_r", F.lit(1))["effective_from"].alias("_inner"),
    )
    around = (
        edges.withColumn("_before", F.lead("_last").over(back))
        .withColumn("_opens", opens)
        .withColumn("_start", start)
        .withColumn("_after", F.min("_start").over(back.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_end", F.first(F.col("_last.until")).over(back.rowsBetween(Window.unboundedPreceding, 0)))
        .select(*[F.col(k).alias(f"_{k}") for k in (*FKEY, "slice")], "_opens", "_after", "_end")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in (*FKEY, "slice")]
    stitched = compact.join(around, same)

    def revision(r: Column, i: Column) -> Column:
        follows = F.get("_r", i + 1)
        return F.struct(
            *(r[c].alias(c) for c in (*REVISION_COLUMNS, "effective_from", "created_at")),
            F.coalesce(follows["effective_from"], F.col("_after.at")).alias("effective_to"),
            F.when(follows.isNotNull(), r["until"]).when(F.col("_after").isNotNull(), F.col("_after.prior"))
            .otherwise(F.col("_end")).alias("last_seen_at"),
        )

    revisions = F.transform("_r", revision)
    own = F.when(F.col("_opens"), revisions).otherwise(F.slice(revisions, F.lit(2), F.size("_r")))
    return stitched.select(*FKEY, F.inline(own)).select(
        revision_key().alias("forecast_revision_key"),
        *FKEY,
        *REVISION_COLUMNS[:-1],
        "effective_from",
        "effective_to",
        F.col("effective_to").isNull().alias("is_current"),
        "record_hash",
        "last_seen_at",
        "created_at",
        F.to_date("forecast_timestamp").alias("forecast_date"),
    )


def scd2_apply(stored_runs: DataFrame | None, incoming: DataFrame, batch_ts=None) -> DataFrame:
    """Close changed current rows, insert new or changed revisions, leave
    repeats alone. ``stored_runs`` is the run list of the partitions the batch
    touches (the key includes the target date, so that is all it needs).
    Replay-safe, and the same history whatever order batches arrive in."""
    return chains(merge_runs(stored_runs, incoming, batch_ts))


# --- Observation upsert (U2, D17b) -------------------------------------------------

OBS_MEASURES = ["temperature_2m_c", "precipitation_mm", "wind_speed_10m_kmh"]
OBS_COLUMNS = OKEY + OBS_MEASURES + ["source_event_id", "ingested_at", "updated_at"]


def incoming_observations(staged_observations: DataFrame, batch_ts=None) -> DataFrame:
    keyed = with_keys(staged_observations)
    return keyed.select(
        *OKEY,
        *OBS_MEASURES,
        F.col("event_id").alias("source_event_id"),
        "ingested_at",
        batch_literal(batch_ts).alias("updated_at"),
    )


def upsert_observations(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Matched → the newer reading replaces the stored one; not matched
    → insert. Newer = later ``ingested_at``, then greater event id, so an
    old correction arriving late cannot overwrite a newer value (D17b)."""
    rows = incoming.select(*OBS_COLUMNS)
    if existing is not None:
        rows = existing.select(*OBS_COLUMNS).unionByName(rows)
    latest = latest_per_key(rows, OKEY, ["ingested_at", "source_event_id"])
    return latest.withColumn("observation_date", F.to_date("observation_timestamp"))
