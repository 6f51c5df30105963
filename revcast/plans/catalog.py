"""Named queries: one per operator family of the inventory.

Every query takes ``(spark, sf_dir)``, reads the test tables in ``sf_dir``
and returns a DataFrame over all of their rows. Column names match the DuckDB
oracle in ``plans.oracle``. The operators round nothing; here, where results
meet another engine's, means are rounded to ``DIGITS``, as the order in which
doubles are added up moves their last bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import accuracy as acc
from ..operators import ingest
from ..operators import quality as dq
from ..operators import silver as sv
from ..operators import views
from ..operators import warehouse as wh
from ..session import configure, scratch_path
from ..sources import cities, payload
from ..sources import fixtures as fx
from ..streaming import bronze, merge
from . import inputs as I
from . import jobs
from . import storage as st

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered queries (not data).
SPLIT_AT = "2024-01-15 00:00:00"  # second batch = rows ingested from here on
COVERAGE_THRESHOLD = 0.5
DIGITS = 6
PROCESS_DAY = "2024-01-15"  # the ingestion day that the bronze scan selects
BATCH_TIMES = ("2024-01-15 00:00:00", "2024-02-01 00:00:00")


def rounded(df: DataFrame) -> DataFrame:
    """Means at ``DIGITS`` digits, order of rows kept."""
    means = {"mae_c", "rmse_c", "bias_c", "avg_lag_seconds"}
    return df.select(
        *[F.round(c, DIGITS).alias(c) if c.removeprefix("temperature_") in means else F.col(c) for c in df.columns]
    )


def query(name: str):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run

    return register


FACT_OUT = [
    "forecast_revision_key", "source_key", "city_key", "issued_at", "forecast_timestamp",
    "temperature_2m_c", "precipitation_probability_pct", "wind_speed_10m_kmh",
    "source_event_id", "effective_from", "effective_to", "is_current", "record_hash",
    "last_seen_at", "forecast_date",
]
OBS_OUT = [
    "source_key", "city_key", "observation_timestamp", "temperature_2m_c",
    "precipitation_mm", "wind_speed_10m_kmh", "source_event_id", "ingested_at",
    "observation_date",
]


# --- 1. inputs -----------------------------------------------------------------


@query("fixture_forecast")
def fixture_forecast(spark, d):
    """Forecast events mapped from ``events`` (all rows)."""
    return I.raw(spark, d, "forecast")


@query("fixture_observation")
def fixture_observation(spark, d):
    """Observation events mapped from ``events`` (all rows)."""
    return I.raw(spark, d, "observation")


# --- 2-3. silver ------------------------------------------------------------------


@query("silver_valid_forecast")
def silver_valid_forecast(spark, d):
    """F1 + D6 on normalised forecasts."""
    return I.valid(spark, d, "forecast")


@query("silver_valid_observation")
def silver_valid_observation(spark, d):
    """F2 + D6 on normalised observations."""
    return I.valid(spark, d, "observation")


@query("silver_quarantine")
def silver_quarantine(spark, d):
    """rejected rows of both types with the rules they break."""
    out = None
    for kind, target in (("forecast", "forecast_timestamp"), ("observation", "observation_timestamp")):
        _, bad = sv.split_valid(I.normalized(spark, d, kind), kind)
        part = bad.select(
            "event_id", "event_type", "source", "city",
            F.col(target).alias("target_timestamp"),
            "temperature_2m_c", "ingested_at", F.concat_ws(",", "failed_rules").alias("failed_rules"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query("silver_metrics")
def silver_metrics(spark, d):
    """Input, valid, invalid and deduplicated counts per type."""
    return sv.metrics(I.raw(spark, d, "forecast"), "forecast").unionByName(
        sv.metrics(I.raw(spark, d, "observation"), "observation")
    )


@query("silver_dedup")
def silver_dedup(spark, d):
    """W1 on the redelivered stream: one row per event id, latest copy."""
    return sv.dedup(I.redelivery(spark, d))


# --- 4. gold -------------------------------------------------------------------------


@query("gold_accuracy_rows")
def gold_accuracy_rows(spark, d):
    """J1 + P15-P24: matched (forecast, latest observation) rows."""
    return I.gold(spark, d)


@query("gold_accuracy_summary")
def gold_accuracy_summary(spark, d):
    """A1 + O1: accuracy by city and lead bucket (the flagship query)."""
    return rounded(acc.summary(I.gold(spark, d)))


# --- 5. ids, hashes, keys --------------------------------------------------------------


@query("event_id")
def event_id(spark, d):
    """Content ids of the events split out of hourly payloads."""
    return ingest.with_event_id(event_split(spark, d))


@query("record_hash")
def record_hash(spark, d):
    """P25: revision hash of every staged forecast."""
    revs = wh.incoming_revisions(I.staged(spark, d, "forecast"))
    return revs.select("source_event_id", "record_hash")


@query("surrogate_keys")
def surrogate_keys(spark, d):
    """Hash-derived keys of every city and source name."""
    city, source = I.dims(spark, d)
    return city.select(
        F.lit("city").alias("dimension"), F.col("city_name").alias("name"),
        F.col("city_key").alias("surrogate_key"),
    ).unionByName(
        source.select(
            F.lit("source").alias("dimension"), F.col("source_name").alias("name"),
            F.col("source_key").alias("surrogate_key"),
        )
    )


# --- 6. dimensions ---------------------------------------------------------------------


@query("dim_city")
def dim_city(spark, d):
    """One row per city, first-seen coordinates."""
    return I.dims(spark, d)[0].drop("created_at")


@query("dim_source")
def dim_source(spark, d):
    """U4: one row per source."""
    return I.dims(spark, d)[1].drop("created_at")


@query("dim_time")
def dim_time(spark, d):
    """Hourly calendar spanning every fact timestamp."""
    fact = I.fact_forecast(spark, d)
    obs = I.fact_observation(spark, d)
    return wh.dim_time(
        spark,
        fact.select("issued_at"),
        fact.select("forecast_timestamp"),
        obs.select("observation_timestamp"),
    )


# --- 7-8. SCD2 and upsert ---------------------------------------------------------------


@query("scd2_revisions")
def scd2_revisions(spark, d):
    """U1 on the silver forecasts in one batch."""
    return I.fact_forecast(spark, d).select(*FACT_OUT)


@query("scd2_apply_incremental")
def scd2_apply_incremental(spark, d):
    """U1 applied in two batches to the redelivered stream (no dedup):
    must equal the chain built from all rows at once. The first batch's
    result is stored and read back."""
    lay = jobs.new_layout(spark, "scd2")
    first, second = I.split_at(I.redelivery(spark, d), "ingested_at", SPLIT_AT)
    jobs.merge_forecasts(spark, lay, wh.stage(first, "forecast"), st.touched_dates(first, "forecast_date"))
    incoming = wh.incoming_revisions(wh.stage(second, "forecast"))
    return wh.scd2_apply(jobs.read_forecast_runs(spark, lay), incoming).select(*FACT_OUT)


@query("scd2_hot_key")
def scd2_hot_key(spark, d):
    """U1 with every forecast a sighting of one natural key."""
    one = {
        "source": F.lit("all"), "city": F.lit("EVERYWHERE"),
        "issued_at": F.lit(SPLIT_AT).cast("timestamp_ntz"), "forecast_timestamp": F.lit(SPLIT_AT).cast("timestamp_ntz"),
    }
    rows = I.redelivery(spark, d).withColumns(one)
    return wh.scd2_apply(None, wh.incoming_revisions(wh.stage(rows, "forecast"))).select(*FACT_OUT)


@query("observation_upsert")
def observation_upsert(spark, d):
    """U2 in two batches, the first one stored and read back: the newest
    reading per key survives."""
    lay = jobs.new_layout(spark, "upsert")
    first, second = I.split_at(I.valid(spark, d, "observation"), "ingested_at", SPLIT_AT)
    jobs.merge_observations(spark, lay, wh.stage(first, "observation"), st.touched_dates(first, "observation_date"))
    incoming = wh.incoming_observations(wh.stage(second, "observation"))
    return wh.upsert_observations(jobs.read_fact_observation(spark, lay), incoming).select(*OBS_OUT)


# --- 9. views ------------------------------------------------------------------------------


def _dims_checked(spark, d):
    """Dimensions derived in the same plan: their size is unknown before
    they run, so AQE measures them at run time and turns the join into a
    broadcast only below its threshold (a shuffle join otherwise). Stored
    dimensions are broadcast from their file size the same way."""
    return I.dims(spark, d)


@query("v_current_forecasts")
def v_current_forecasts(spark, d):
    city, source = _dims_checked(spark, d)
    return views.current_forecasts(I.fact_forecast(spark, d), city, source)


def _accuracy_view(spark, d):
    city, source = _dims_checked(spark, d)
    return views.temperature_accuracy(
        I.fact_forecast(spark, d), I.fact_observation(spark, d), city, source
    )


@query("v_temperature_accuracy")
def v_temperature_accuracy(spark, d):
    return _accuracy_view(spark, d)


@query("v_accuracy_by_city_lead")
def v_accuracy_by_city_lead(spark, d):
    return rounded(views.accuracy_by_city_lead(_accuracy_view(spark, d)))


# --- 10. other cuts ---------------------------------------------------------------------------


@query("accuracy_by_source")
def accuracy_by_source(spark, d):
    return rounded(acc.by_source(I.gold(spark, d)))


@query("accuracy_grouping_sets")
def accuracy_grouping_sets(spark, d):
    return rounded(acc.grouping_sets(I.gold(spark, d)))


# --- 11. quality ---------------------------------------------------------------------------------


@query("dq_duplicate_current")
def dq_duplicate_current(spark, d):
    """Q7 on the SCD2 table built from the redelivered stream."""
    incoming = wh.incoming_revisions(wh.stage(I.redelivery(spark, d), "forecast"))
    return dq.duplicate_current(wh.scd2_apply(None, incoming))


@query("dq_duplicate_current_unmerged")
def dq_duplicate_current_unmerged(spark, d):
    """Q7 on the same stream appended without the merge: every incoming
    row current, as if the close step were skipped."""
    incoming = wh.incoming_revisions(wh.stage(I.redelivery(spark, d), "forecast"))
    return dq.duplicate_current(incoming.withColumn("is_current", F.lit(True)))


@query("dq_invalid_intervals")
def dq_invalid_intervals(spark, d):
    incoming = wh.incoming_revisions(wh.stage(I.redelivery(spark, d), "forecast"))
    return dq.invalid_intervals(wh.scd2_apply(None, incoming)).select(*FACT_OUT)


@query("dq_target_before_issue")
def dq_target_before_issue(spark, d):
    """Q3/F8 on normalised forecasts before validation."""
    return dq.target_before_issue(I.normalized(spark, d, "forecast")).select(
        "event_id", "source", "city", "issued_at", "forecast_timestamp"
    )


@query("dq_duplicate_observations")
def dq_duplicate_observations(spark, d):
    return dq.duplicate_observations(I.fact_observation(spark, d))


@query("dq_duplicate_observations_unmerged")
def dq_duplicate_observations_unmerged(spark, d):
    """Q9 on staged observations before the upsert."""
    return dq.duplicate_observations(
        wh.incoming_observations(I.staged(spark, d, "observation"))
    )


@query("dq_missing_observations")
def dq_missing_observations(spark, d):
    """Due forecasts without an observation; ``as_of`` = the last
    observed hour (a scalar subquery, evaluated by Spark)."""
    obs = I.fact_observation(spark, d)
    as_of = obs.agg(F.max("observation_timestamp")).scalar()
    return dq.missing_observations(I.fact_forecast(spark, d), obs, as_of)


@query("dq_join_coverage")
def dq_join_coverage(spark, d):
    out = dq.join_coverage(
        I.silver(spark, d, "forecast"),
        I.silver(spark, d, "observation"),
        COVERAGE_THRESHOLD,
    )
    return out


@query("dq_ingestion_lag")
def dq_ingestion_lag(spark, d):
    return rounded(dq.ingestion_lag(I.silver(spark, d, "forecast"), I.silver(spark, d, "observation")))


@query("dq_event_id_unique")
def dq_event_id_unique(spark, d):
    """Q5 on silver after W1 (must be empty)."""
    return dq.event_id_duplicates(sv.dedup(I.redelivery(spark, d)))


@query("dq_event_id_unique_unmerged")
def dq_event_id_unique_unmerged(spark, d):
    """Q5 on the redelivered stream before W1."""
    return dq.event_id_duplicates(I.redelivery(spark, d))


@query("dq_rule_violations")
def dq_rule_violations(spark, d):
    """Q1-Q4, Q11: violation count per rule and event type."""
    return dq.rule_violations(I.normalized(spark, d, "forecast"), "forecast").unionByName(
        dq.rule_violations(I.normalized(spark, d, "observation"), "observation")
    )


# --- 12. payload explode and event split ------------------------------------------------------


def _payloads(spark, d):
    return payload.payloads_from_forecasts(I.normalized(spark, d, "forecast"))


@query("hourly_explode")
def hourly_explode(spark, d):
    """Payload arrays back to one row per hour."""
    return ingest.explode_hourly(
        _payloads(spark, d), ["source", "city", "latitude", "longitude", "issued_at", "ingested_at"]
    )


@query("event_split")
def event_split(spark, d):
    """Hours before the issue hour become observations."""
    return ingest.split_events(hourly_explode(spark, d))


@query("payload_files")
def payload_files(spark, d):
    """Payloads landed as files, read with their declared schema."""
    root = scratch_path(spark, "payloads")
    payload.write_payloads(_payloads(spark, d), root)
    return ingest.explode_hourly(
        payload.read_payloads(spark, root),
        ["source", "city", "latitude", "longitude", "issued_at", "ingested_at"],
    )


@query("unsupported_type")
def unsupported_type(spark, d):
    """P8 on a mixed frame that isn't strict: other types get no content id
    (a strict one fails, see the tests)."""
    kind = F.when(F.col("event_id").cast("bigint") % fx.UNKNOWN_TYPE_EVERY == 0, F.lit("radar")).otherwise(F.col("event_type"))
    rows = I.raw(spark, d, "forecast").select(
        F.col("event_id").alias("id"), "*", F.lit(None).cast("timestamp_ntz").alias("observation_timestamp"),
        F.lit(None).cast("double").alias("precipitation_mm"),
    ).withColumn("event_type", kind)
    return ingest.with_event_id(rows, strict=False).select(
        F.col("id").alias("event_id"), "event_type", F.col("event_id").isNotNull().alias("has_content_id")
    )


@query("serialised_records")
def serialised_records(spark, d):
    """K7/K8: compact JSON keyed by city; as text lines, then read back."""
    columns = schemas.FORECAST_COLUMNS
    events = I.raw(spark, d, "forecast")
    root = scratch_path(spark, "lines")
    ingest.to_lines(events, columns).write.text(root)
    value = F.col("value")
    return spark.read.text(root).select(
        F.get_json_object(value, "$.city").alias("key"),
        F.get_json_object(value, "$.event_id").alias("event_id"),
        F.get_json_object(value, "$.forecast_timestamp").alias("forecast_timestamp"),
        F.array_join(F.json_object_keys(value), ",").alias("fields"),
        F.contains(value, F.lit(": ")).alias("has_blanks"),
    )


@query("city_config")
def city_config(spark, d):
    """A city list written as a config and loaded with its check."""
    root = scratch_path(spark, "cities")
    cities.write_cities(fx.city_config(spark, d), root)
    return cities.load_cities(spark, root)


# --- 13. storage edges: incremental batches through real tables ----------------------------


def _two_batches(spark, d):
    """Run the batch jobs twice, split at ``SPLIT_AT`` by ingestion time,
    into a fresh folder under the shared directory; returns the layout."""
    lay = jobs.new_layout(spark, "two-batches")
    f1, f2 = I.split_at(I.raw(spark, d, "forecast"), "ingested_at", SPLIT_AT)
    o1, o2 = I.split_at(I.raw(spark, d, "observation"), "ingested_at", SPLIT_AT)
    jobs.run_batch(spark, lay, f1, o1, "batch-1", BATCH_TIMES[0])
    jobs.run_batch(spark, lay, f2, o2, "batch-2", BATCH_TIMES[1])
    return lay


@query("silver_incremental_two_days")
def silver_incremental_two_days(spark, d):
    """Silver after two process runs equals silver of all rows;
    forecasts for a date issued on the earlier day survive the later run."""
    lay = jobs.new_layout(spark, "silver-two-days")
    f1, f2 = I.split_at(I.raw(spark, d, "forecast"), "ingested_at", SPLIT_AT)
    for batch, day in ((f1, "day-1"), (f2, "day-2")):
        _, _, cached = jobs.run_silver(spark, batch, "forecast", lay, day)
        cached.unpersist()
    return jobs.read_silver(spark, lay, "forecast")


def _day_of_batches(spark, d):
    """Two batches of one day, then the first one again with clean rows."""
    lay = jobs.new_layout(spark, "day")
    f1, f2 = I.split_at(I.raw(spark, d, "forecast"), "ingested_at", SPLIT_AT)
    clean, _ = I.split_at(I.valid(spark, d, "forecast").drop("forecast_date"), "ingested_at", SPLIT_AT)
    for rows, batch in ((f1, "1"), (f2, "2"), (clean, "1")):
        _, _, cached = jobs.run_silver(spark, rows, "forecast", lay, "day", batch)
        cached.unpersist()
    return lay


@query("quarantine_stored")
def quarantine_stored(spark, d):
    """What is left in quarantine after a day of batches and reruns."""
    lay = _day_of_batches(spark, d)
    return st.read_quarantine(spark, lay.quarantine, "forecast", schemas.QUARANTINE["forecast"]).select(
        "event_id", "city", "temperature_2m_c", F.concat_ws(",", "failed_rules").alias("failed_rules"),
        "process_date", "batch",
    )


@query("metrics_stored")
def metrics_stored(spark, d):
    """One row for each batch of the day, the rerun's for the first."""
    return st.read_metrics(spark, _day_of_batches(spark, d).metrics, schemas.METRICS)


@query("warehouse_incremental")
def warehouse_incremental(spark, d):
    """U1 through stored tables: two batch runs, fact read back."""
    return jobs.read_fact_forecast(spark, _two_batches(spark, d)).select(*FACT_OUT)


def _loaded(spark, d):
    """Silver of two batches, each loaded by a step of its own; the second
    batch's dates twice."""
    lay = jobs.new_layout(spark, "staged-load")
    f, o = (I.split_at(I.raw(spark, d, kind), "ingested_at", SPLIT_AT) for kind in ("forecast", "observation"))
    for i, batch_ts in enumerate(BATCH_TIMES):
        dates = []
        for kind, rows in (("forecast", f[i]), ("observation", o[i])):
            _, touched, cached = jobs.run_silver(spark, rows, kind, lay, f"day-{i}")
            cached.unpersist()
            dates.append(touched)
        jobs.load_warehouse(spark, lay, *dates, batch_ts)
    jobs.load_warehouse(spark, lay, *dates, BATCH_TIMES[-1])
    return lay


@query("warehouse_from_silver")
def warehouse_from_silver(spark, d):
    """Revisions loaded from the stored silver of the touched dates."""
    return jobs.read_fact_forecast(spark, _loaded(spark, d)).select(*FACT_OUT)


@query("warehouse_observation_incremental")
def warehouse_observation_incremental(spark, d):
    """U2 through stored tables: two batch runs, fact read back."""
    return jobs.read_fact_observation(spark, _two_batches(spark, d)).select(*OBS_OUT)


@query("gold_incremental")
def gold_incremental(spark, d):
    """Gold after two runs, each rewriting only its touched dates,
    equals gold computed at once."""
    return jobs.read_gold(spark, _two_batches(spark, d))


@query("gold_summary_stored")
def gold_summary_stored(spark, d):
    """K6: the summary added up from the stored partial sums of each date."""
    return rounded(jobs.read_summary(spark, _two_batches(spark, d)))


def _deliveries(df: DataFrame, n: int) -> list[DataFrame]:
    """``df`` in ``n`` parts by day of ingestion; parts overlap in time."""
    part = F.coalesce(F.pmod(F.dayofyear("ingested_at"), F.lit(n)), F.lit(0))
    return [df.where(part == i) for i in range(n)]


@query("scd2_any_order")
def scd2_any_order(spark, d):
    """The redelivered stream in five deliveries that lie between each
    other in time, the last ones first, each a delta: the history is the one
    of all rows at once."""
    lay = jobs.new_layout(spark, "any-order")
    for part in reversed(_deliveries(I.redelivery(spark, d), 5)):
        part = part.persist(StorageLevel.MEMORY_AND_DISK)  # read for its dates, then merged
        try:
            dates = st.touched_dates(part, "forecast_date")
            jobs.merge_forecasts(spark, lay, wh.stage(part, "forecast"), dates, deltas=True)
        finally:
            part.unpersist()
    return jobs.read_fact_forecast(spark, lay).select(*FACT_OUT)


@query("commit_lost_writer")
def commit_lost_writer(spark, d):
    """A batch lost after it wrote all its tables, before its commit:
    every table is read as the batch before left it."""
    lay = jobs.new_layout(spark, "lost-writer")
    f1, f2 = I.split_at(I.raw(spark, d, "forecast"), "ingested_at", SPLIT_AT)
    o1, o2 = I.split_at(I.raw(spark, d, "observation"), "ingested_at", SPLIT_AT)
    jobs.run_batch(spark, lay, f1, o1, "day-1")
    lost = st.Transaction(spark, lay.root)  # never committed
    f_good, f_dates, f_kept = jobs.run_silver(spark, f2, "forecast", lay, "day-2", tx=lost)
    o_good, o_dates, o_kept = jobs.run_silver(spark, o2, "observation", lay, "day-2", tx=lost)
    jobs.run_warehouse(spark, lay, f_good, o_good, f_dates, o_dates, tx=lost)
    jobs.run_gold(spark, lay, sorted({*f_dates, *o_dates}), tx=lost)
    f_kept.unpersist(), o_kept.unpersist()
    stored = {
        "silver_forecast": jobs.read_silver(spark, lay, "forecast").select("event_id"),
        "silver_observation": jobs.read_silver(spark, lay, "observation").select("event_id"),
        "fact_forecast": jobs.read_fact_forecast(spark, lay).select(F.col("forecast_revision_key").alias("event_id")),
        "fact_observation": jobs.read_fact_observation(spark, lay).select(F.col("source_event_id").alias("event_id")),
        "gold": jobs.read_gold(spark, lay).select("event_id"),
    }
    out = None
    for name, rows in stored.items():
        part = rows.select(F.lit(name).alias("table_name"), "event_id")
        out = part if out is None else out.unionByName(part)
    return out


@query("batch_rerun")
def batch_rerun(spark, d):
    """Two runs of one day without batch names, and the second one again:
    both land, once."""
    lay = jobs.new_layout(spark, "rerun")
    f1, f2 = I.split_at(I.raw(spark, d, "forecast"), "ingested_at", SPLIT_AT)
    o1, o2 = I.split_at(I.raw(spark, d, "observation"), "ingested_at", SPLIT_AT)
    for f, o in ((f1, o1), (f2, o2), (f2, o2)):
        jobs.run_batch(spark, lay, f, o, "day")
    return jobs.read_silver(spark, lay, "forecast")


def _observation_deltas(spark, d):
    lay = jobs.new_layout(spark, "deltas")
    for part in _deliveries(I.valid(spark, d, "observation"), 4):
        dates = st.touched_dates(part, "observation_date")
        jobs.merge_observations(spark, lay, wh.stage(part, "observation"), dates, deltas=True)
    return lay


@query("observation_deltas")
def observation_deltas(spark, d):
    """R5s/K2: four deliveries, each writing the keys it touches: bases and
    deltas, resolved by key as they are read."""
    return jobs.read_fact_observation(spark, _observation_deltas(spark, d)).select(*OBS_OUT)


@query("observation_compacted")
def observation_compacted(spark, d):
    """K2: the same table after its deltas were folded and old runs removed."""
    lay = _observation_deltas(spark, d)
    table = lay.fact_observation
    st.compact(spark, lay.root, table, schemas.FACT_OBSERVATION, "observation_date", wh.OKEY, ["observation_timestamp"])
    st.vacuum(spark, lay.root, table)
    return jobs.read_fact_observation(spark, lay).select(*OBS_OUT)


def _corrected(spark, d):
    """Two batches whose second one corrects scored hours, gold kept by
    changes."""
    lay = jobs.new_layout(spark, "gold-changes")
    for f, o in zip(_deliveries(I.raw(spark, d, "forecast"), 2), _deliveries(I.raw(spark, d, "observation"), 2)):
        jobs.run_batch(spark, lay, f, o, "day", gold_by_change=True)
    return lay


@query("gold_delta")
def gold_delta(spark, d):
    """Gold kept by change feeds equals gold scored at once."""
    return jobs.read_gold(spark, _corrected(spark, d))


@query("gold_delta_summary")
def gold_delta_summary(spark, d):
    """K6: the summary added up from signed partial sums."""
    return rounded(jobs.read_summary(spark, _corrected(spark, d)))


@query("gold_changes_net")
def gold_changes_net(spark, d):
    """The stored change feed adds up to the gold rows."""
    feed = jobs.read_gold_changes(spark, _corrected(spark, d))
    return feed.groupBy(*schemas.GOLD.names).agg(F.sum("change").alias("_n")).where("_n != 0").select(*schemas.GOLD.names)


@query("dq_lag_quantiles")
def dq_lag_quantiles(spark, d):
    """Lag quantiles from stored sketches by date, merged; each held
    against the exact ranks of all rows."""
    f, o = I.silver(spark, d, "forecast"), I.silver(spark, d, "observation")
    root = scratch_path(spark, "lag-sketches")
    dq.lag_sketches(f, o).write.partitionBy("event_type").parquet(root)
    got = dq.lag_quantiles(spark.read.parquet(root))
    lags = f.select(F.lit("forecast").alias("event_type"), dq.lag_seconds(f, "issued_at").alias("lag")).unionByName(
        o.select(F.lit("observation").alias("event_type"), dq.lag_seconds(o, "observation_timestamp").alias("lag"))
    )
    ranked = lags.join(got, "event_type").groupBy("event_type", "rank", "events", "lag_seconds").agg(
        F.count(F.when(F.col("lag") < F.col("lag_seconds"), 1)).alias("_below"),
        F.count(F.when(F.col("lag") <= F.col("lag_seconds"), 1)).alias("_upto"),
    )
    slack = F.lit(dq.LAG_RANK_ERROR) * F.col("events")
    return ranked.select(
        "event_type", "rank", "events",
        ((F.col("_below") - slack <= F.col("rank") * F.col("events")) & (F.col("rank") * F.col("events") <= F.col("_upto") + slack)).alias("within_bounds"),
    )


@query("dims_two_batches")
def dims_two_batches(spark, d):
    """A second batch adds the names the first one lacked, with its
    own ``created_at``; stored names keep theirs."""
    lay = jobs.new_layout(spark, "dims")
    rows = I.staged(spark, d, "forecast").select("city", "source", "latitude", "longitude", "ingested_at")
    for batch, at in ((rows.where(F.col("city") < "B"), BATCH_TIMES[0]), (rows, BATCH_TIMES[1])):
        stored = jobs.read_dim_city(spark, lay)
        new = wh.new_cities(stored, batch, batch_ts=at)
        jobs.merge_dimension(spark, lay, lay.dim_city, schemas.DIM_CITY, stored, new)
    return jobs.read_dim_city(spark, lay)


@query("gate_report")
def gate_report(spark, d):
    """Q10: the gates on merged and on unmerged data."""
    incoming = wh.incoming_revisions(wh.stage(I.redelivery(spark, d), "forecast"))
    fact = wh.scd2_apply(None, incoming)
    observations = wh.incoming_observations(I.staged(spark, d, "observation"))
    return dq.gate_report(
        {
            "one_current_row_per_key": dq.duplicate_current(fact),
            "valid_intervals": dq.invalid_intervals(fact),
            "one_observation_per_key": dq.duplicate_observations(wh.upsert_observations(None, observations)),
            "one_current_row_per_key, unmerged": dq.duplicate_current(incoming.withColumn("is_current", F.lit(True))),
            "one_observation_per_key, unmerged": dq.duplicate_observations(observations),
        }
    )


# --- 14. streaming ------------------------------------------------------------------------------


def _land_in_two(df: DataFrame, landing: str, time_col: str, fmt: str, run, late: bool = False) -> None:
    """Land ``df`` in two deliveries split at ``SPLIT_AT`` (the later one
    first if ``late``) and run the stream after each one (``availableNow``):
    the second run restarts from the checkpoint and must only pick up the new
    files."""
    parts = I.split_at(df, time_col, SPLIT_AT)
    for part in reversed(parts) if late else parts:
        part.write.mode("append").format(fmt).save(landing)
        run()


def _bronze_flow(spark, d):
    root = scratch_path(spark, "stream-bronze")
    records = fx.stream_records(I.raw(spark, d, "forecast"), schemas.FORECAST_COLUMNS).unionByName(
        fx.stream_records(I.raw(spark, d, "observation"), schemas.OBSERVATION_COLUMNS)
    )

    def run():
        bronze.await_end(
            bronze.start_bronze(
                spark, f"{root}/landing", f"{root}/bronze", f"{root}/dead_letter", f"{root}/_checkpoints"
            )
        )

    _land_in_two(records, f"{root}/landing", "ingested_at", "json", run)
    return root


@query("stream_bronze")
def stream_bronze(spark, d):
    """R1s/K1: records decoded and landed in bronze by event type and UTC
    ingestion hour; read back with the declared schema."""
    root = _bronze_flow(spark, d)
    return bronze.read_bronze(spark, f"{root}/bronze").drop("batch", schemas.CORRUPT)


@query("bronze_roundtrip")
def bronze_roundtrip(spark, d):
    """K1: bronze holds what was sent: keys no schema declares, values of
    another type."""
    root = _bronze_flow(spark, d)
    value = F.col("value")
    word = F.get_json_object(value, "$.temperature_2m_c")
    return bronze.read_bronze_text(spark, f"{root}/bronze").select(
        F.get_json_object(value, "$.event_id").alias("event_id"),
        "event_type",
        F.get_json_object(value, "$.sensor").alias("sensor"),
        F.when(F.try_to_number(word, F.lit("S999999D999999")).isNull() & word.rlike("[a-z]{2}"), word).alias("temperature_word"),
    )


@query("bronze_scan_day")
def bronze_scan_day(spark, d):
    """One day's forecasts from bronze text, normalised; the times
    are parsed, a record that doesn't fit the schema is marked."""
    root = _bronze_flow(spark, d)
    day = bronze.read_bronze_batch(spark, f"{root}/bronze", "forecast", PROCESS_DAY)
    return sv.normalize(day, "forecast").select(
        *schemas.FORECAST_COLUMNS, "forecast_date", F.col(schemas.CORRUPT).isNotNull().alias("malformed")
    )


@query("stream_dead_letter")
def stream_dead_letter(spark, d):
    """R2s/F10: damaged records reported by id with the reason."""
    root = _bronze_flow(spark, d)
    return bronze.read_dead_letter(spark, f"{root}/dead_letter").select("record_id", "key", "error")


def _merge_flow(spark, rows, apply, lay, late=False):
    def run():
        bronze.await_end(
            merge.start(
                merge.read_silver_stream(spark, f"{lay.root}/landing", rows.schema), apply, f"{lay.root}/_checkpoints"
            )
        )

    _land_in_two(rows, f"{lay.root}/landing", "ingested_at", "parquet", run, late)


@query("stream_scd2")
def stream_scd2(spark, d):
    """R6s: the redelivered forecast stream merged batch by batch."""
    lay = jobs.new_layout(spark, "stream-scd2")
    _merge_flow(spark, I.redelivery(spark, d), merge.merge_facts(lay, "forecast"), lay)
    return jobs.read_fact_forecast(spark, lay).select(*FACT_OUT)


@query("stream_upsert")
def stream_upsert(spark, d):
    """R5s: late and corrected observations upserted batch by batch."""
    lay = jobs.new_layout(spark, "stream-upsert")
    _merge_flow(spark, I.valid(spark, d, "observation"), merge.merge_facts(lay, "observation"), lay)
    return jobs.read_fact_observation(spark, lay).select(*OBS_OUT)


@query("stream_dedup")
def stream_dedup(spark, d):
    """R4s: the redelivered stream deduplicated against stored silver."""
    lay = jobs.new_layout(spark, "stream-dedup")
    _merge_flow(spark, I.redelivery(spark, d), merge.merge_silver(lay, "forecast"), lay)
    return jobs.read_silver(spark, lay, "forecast")


@query("stream_dedup_late")
def stream_dedup_late(spark, d):
    """R4s with the second delivery older than the first: no event is lost."""
    lay = jobs.new_layout(spark, "stream-dedup-late")
    _merge_flow(spark, I.redelivery(spark, d), merge.merge_silver(lay, "forecast"), lay, late=True)
    return jobs.read_silver(spark, lay, "forecast")


def _state_flow(spark, d, late: bool):
    """The redelivered stream behind the state store, with the rows that fall
    behind its watermark merged beside it."""
    rows, lay = I.redelivery(spark, d), jobs.new_layout(spark, "stream-state")
    apply = merge.merge_silver(lay, "forecast")

    def run():
        for name, stream, sink in (
            ("state", merge.dedup_events, apply), ("late", lambda s: s, merge.late_rows(lay, "forecast", apply))
        ):
            source = merge.read_silver_stream(spark, f"{lay.root}/landing", rows.schema)
            bronze.await_end(merge.start(stream(source), sink, f"{lay.root}/_checkpoints/{name}"))

    _land_in_two(rows, f"{lay.root}/landing", "ingested_at", "parquet", run, late)
    # of copies within the watermark any may be the first; they differ in this alone
    return jobs.read_silver(spark, lay, "forecast").drop("ingested_at")


@query("stream_dedup_state")
def stream_dedup_state(spark, d):
    """R4s with Spark's state store in front of the merge."""
    return _state_flow(spark, d, late=False)


@query("stream_dedup_state_late")
def stream_dedup_state_late(spark, d):
    """The second delivery lies behind the watermark: no event is lost."""
    return _state_flow(spark, d, late=True)


# --- A10, K6/O3 -------------------------------------------------------------------------------


@query("events_per_city")
def events_per_city(spark, d):
    """A10: events produced per city and type (the producer's log line)."""
    both = I.raw(spark, d, "forecast").select("city", "event_type").unionByName(
        I.raw(spark, d, "observation").select("city", "event_type")
    )
    return both.groupBy("city", "event_type").agg(F.count(F.lit(1)).alias("events"))


@query("gold_summary_report")
def gold_summary_report(spark, d):
    """K6/O3: the printed summary, ordered, at most 200 rows."""
    return rounded(acc.summary_display(I.gold(spark, d)))
