"""Batch jobs: silver, warehouse merge, gold (§3.2-§3.4, D1, D5, D7, D10).

One run handles one landed batch (e.g. one ingestion hour or day) in one
transaction over all tables (U7):

1. silver: normalise + validate once (persisted, reused by every output),
   merge the valid rows with the stored rows of the *target dates the batch
   touches*, deduplicate (W1) and replace those dates only (D1, D10);
   rejected rows and the counts (K4) go to folders of this batch (D7).
2. warehouse: dimensions insert-if-absent, SCD2 forecast revisions and
   observation upsert for the touched dates. The SCD2 input is the batch's
   valid rows *before* W1, so a value that returns (A, B, A) is kept as three
   sightings. The run list of every key is stored beside its revisions, so the
   history is the same whatever order batches arrive in.
3. gold: score the touched target dates again and replace them (D5), and
   their partial sums (K6); the summary adds up the partials, so its cost
   doesn't grow with the gold rows.

A run lost anywhere before the commit leaves every table as it was, and running
it again ends in the same state, as every merge is replay-safe. Stream merges
use the same functions with ``deltas``: only the touched keys are written, as a
delta of their dates; a date of ``FOLD`` runs is folded by its next merge.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import rules as R
from ..operators import accuracy as acc
from ..operators import quality as dq
from ..operators import silver as sv
from ..operators import warehouse as wh
from ..session import configure, scratch_path
from . import storage as st

DATE = sv.DATE_COLUMN
TARGET = sv.TARGET_COLUMN


#: Runs of a date from which on its next merge rewrites it whole.
FOLD = 8


@dataclass(frozen=True)
class Layout:
    """A lake: its folder, and the names of its tables."""

    root: str
    dim_city: str = "warehouse/dim_city"
    dim_source: str = "warehouse/dim_weather_source"
    forecast_runs: str = "warehouse/forecast_runs"
    fact_forecast: str = "warehouse/fact_forecast_revision"
    fact_observation: str = "warehouse/fact_observation"
    gold: str = "gold/forecast_accuracy"
    gold_partials: str = "gold/forecast_accuracy_partials"
    gold_changes: str = "gold/forecast_accuracy_changes"

    def silver(self, kind: str) -> str:
        return f"silver/{kind}"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"

    @property
    def batches(self) -> str:
        return f"{self.root}/batches"


def new_layout(spark: SparkSession, name: str = "lake") -> Layout:
    return Layout(scratch_path(spark, name))


# --- stored tables, each read with its declared schema (K9) -------------------------


def _reader(spark: SparkSession, lay: Layout, tx: st.Transaction | None) -> st.Transaction:
    return tx or st.Transaction(spark, lay.root)


def read_silver(spark: SparkSession, lay: Layout, kind: str, dates: list | None = None, tx=None) -> DataFrame | None:
    return _reader(spark, lay, tx).read(lay.silver(kind), schemas.SILVER[kind], DATE[kind], dates, ["event_id"])


def read_forecast_runs(spark: SparkSession, lay: Layout, dates: list | None = None, tx=None) -> DataFrame | None:
    return _reader(spark, lay, tx).read(lay.forecast_runs, schemas.FORECAST_RUNS, "forecast_date", dates, wh.FKEY)


def read_fact_forecast(spark: SparkSession, lay: Layout, dates: list | None = None, tx=None) -> DataFrame | None:
    return _reader(spark, lay, tx).read(lay.fact_forecast, schemas.FACT_FORECAST_REVISION, "forecast_date", dates, wh.FKEY)


def read_fact_observation(spark: SparkSession, lay: Layout, dates: list | None = None, tx=None) -> DataFrame | None:
    return _reader(spark, lay, tx).read(lay.fact_observation, schemas.FACT_OBSERVATION, "observation_date", dates, wh.OKEY)


def read_gold(spark: SparkSession, lay: Layout, dates: list | None = None, tx=None) -> DataFrame | None:
    return _reader(spark, lay, tx).read(lay.gold, schemas.GOLD, "target_date", dates, ["city", "forecast_timestamp"])


def read_dim_city(spark: SparkSession, lay: Layout, tx=None) -> DataFrame | None:
    return _reader(spark, lay, tx).read(lay.dim_city, schemas.DIM_CITY)


def read_dim_source(spark: SparkSession, lay: Layout, tx=None) -> DataFrame | None:
    return _reader(spark, lay, tx).read(lay.dim_source, schemas.DIM_SOURCE)


def read_summary(spark: SparkSession, lay: Layout) -> DataFrame | None:
    """A1 from the stored partial sums of all dates."""
    partials = _reader(spark, lay, None).read(lay.gold_partials, schemas.GOLD_PARTIALS, "target_date")
    return None if partials is None else acc.summary_of_partials(partials)


def together(spark: SparkSession, *steps: Callable) -> list:
    """Results of steps that don't wait for each other, run at the same time:
    many are small jobs, which leave most of a cluster idle one by one. All
    have ended when it returns; the first error in the order of steps is raised."""
    with ThreadPoolExecutor(max(len(steps), 1)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [r.result() for r in running]


# --- merging -----------------------------------------------------------------------


def _of_keys(stored: DataFrame | None, rows: DataFrame, keys: list[str]) -> DataFrame | None:
    """Stored rows of the keys in ``rows`` (null keys too)."""
    if stored is None:
        return None
    touched = rows.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return stored.join(touched, same, "left_semi")


def _split(tx: st.Transaction, table: str, dates: list, deltas: bool) -> tuple[list, list]:
    """(dates rewritten whole, dates that get a delta)."""
    append = [d for d in dates if deltas and 0 < len(tx.runs(table).get(str(d), [])) < FOLD]
    return [d for d in dates if d not in append], append


def _publish(tx: st.Transaction, table: str, run: str, date_col: str, whole: list, append: list) -> None:
    tx.replace(table, run, date_col, whole)
    tx.append(table, run, date_col, append)


# --- silver ------------------------------------------------------------------------


def merge_silver(
    spark: SparkSession, good: DataFrame, kind: str, lay: Layout, deltas: bool = False, tx=None,
    counts: Observation | None = None,
) -> list:
    """W1 against the stored rows of the touched dates; returns the dates. An
    event's id fixes its target date, so its copies always meet there.

    ``counts`` gets the rows of ``good`` and their distinct ids from the write
    (nothing, if no date is touched)."""
    dates = st.touched_dates(good, DATE[kind])
    if not dates:
        return dates
    with st.transaction(spark, lay.root, tx) as t:
        table, schema = lay.silver(kind), schemas.SILVER[kind]
        whole, append = _split(t, table, dates, deltas)
        # each row of the batch counts one, a stored one none
        merged = good.select(*schema.names, F.lit(1).alias(sv.BATCH_ROWS))
        for part, keys in ((whole, None), (append, ["event_id"])):
            stored = read_silver(spark, lay, kind, part, t) if part else None
            stored = _of_keys(stored, good, keys) if keys else stored
            merged = merged if stored is None else stored.withColumn(sv.BATCH_ROWS, F.lit(0)).unionByName(merged)
        observed = counts and (counts, {"valid": F.sum(sv.BATCH_ROWS), "ids": F.count_if(F.col(sv.BATCH_ROWS) > 0)})
        run = t.stage(sv.dedup(merged), table, schema, DATE[kind], [TARGET[kind], "city"], observed)
        _publish(t, table, run, DATE[kind], whole, append)
    return dates


def run_silver(
    spark: SparkSession,
    events: DataFrame,
    kind: str,
    lay: Layout,
    process_date: str,
    batch: str = "0",
    temperature_range=R.TEMPERATURE_RANGE_C,
    flagged: DataFrame | None = None,
    tx=None,
) -> tuple[DataFrame, list, DataFrame]:
    """Returns the batch's valid rows (before W1), the target dates it
    touched and the persisted frame behind them (the caller unpersists).

    The counts (K4) are observed by the silver and quarantine writes."""
    configure(spark)
    if flagged is None:
        flagged = _flagged(events, kind, temperature_range)
    good = flagged.where(F.col("_valid")).drop("_valid", "failed_rules")
    if schemas.CORRUPT in good.columns:
        good = good.drop(schemas.CORRUPT)
    bad = flagged.where(~F.col("_valid")).drop("_valid")

    kept, refused = Observation(), Observation()
    dates = merge_silver(spark, good, kind, lay, tx=tx, counts=kept)
    bad = bad.observe(refused, F.count(F.lit(1)).alias("invalid"))
    st.write_quarantine(bad, lay.quarantine, kind, process_date, batch)
    found = kept.get if dates else {"valid": 0, "ids": 0}
    invalid = refused.get["invalid"]
    counts = {
        "input_count": found["valid"] + invalid,
        "valid_count": found["valid"],
        "invalid_count": invalid,
        "deduplicated_count": found["ids"],
    }
    counts = spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in counts.items()])
    st.write_metrics(counts, lay.metrics, kind, process_date, batch)
    return good, dates, flagged


def _flagged(events: DataFrame, kind: str, temperature_range=R.TEMPERATURE_RANGE_C) -> DataFrame:
    return sv.flag(sv.normalize(events, kind), kind, temperature_range).persist(StorageLevel.MEMORY_AND_DISK)


def fingerprint(*frames: DataFrame) -> str:
    """What a batch holds: rows and the sum of their hashes, for each frame.
    The order of rows doesn't matter."""

    def part(df: DataFrame) -> str:
        h = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
        n, total = df.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)"))).first()
        return f"{n}:{int(total or 0) % 2**64:016x}"

    return ",".join(together(frames[0].sparkSession, *[partial(part, df) for df in frames]) if frames else [])


# --- warehouse ------------------------------------------------------------------------


def stage_from_silver(spark: SparkSession, lay: Layout, kind: str, dates: list, tx=None) -> DataFrame | None:
    """staging = the stored silver rows of the given target dates,
    selected by name (D9); every date the batch touched, not only the
    process date (D10)."""
    rows = read_silver(spark, lay, kind, dates, tx)
    return None if rows is None else wh.stage(rows, kind)


def merge_forecasts(
    spark: SparkSession, lay: Layout, staged: DataFrame, dates: list, batch_ts=None, deltas: bool = False, tx=None
) -> None:
    """U1 for the given dates: the run list first, the revisions from it; the
    gates (Q7, Q8, Q10) see the new rows before anybody else does."""
    with st.transaction(spark, lay.root, tx) as t:
        incoming = wh.incoming_revisions(staged)
        whole, append = _split(t, lay.forecast_runs, dates, deltas)
        stored = read_forecast_runs(spark, lay, whole, t) if whole else None
        if append:
            touched = _of_keys(read_forecast_runs(spark, lay, append, t), incoming, wh.FKEY)
            stored = touched if stored is None else stored.unionByName(touched)
        order = ["forecast_timestamp", "city_key"]
        schema = schemas.FORECAST_RUNS
        runs = t.stage(wh.merge_runs(stored, incoming, batch_ts), lay.forecast_runs, schema, "forecast_date", order)
        fact = wh.chains(t.staged(lay.forecast_runs, runs, schema))
        schema = schemas.FACT_FORECAST_REVISION
        run = t.stage(fact, lay.fact_forecast, schema, "forecast_date", order)
        new = t.staged(lay.fact_forecast, run, schema)
        together(
            spark,
            lambda: dq.gate(dq.duplicate_current(new), "one_current_row_per_key"),
            lambda: dq.gate(dq.invalid_intervals(new), "valid_intervals"),
        )
        _publish(t, lay.forecast_runs, runs, "forecast_date", whole, append)
        _publish(t, lay.fact_forecast, run, "forecast_date", whole, append)


def merge_observations(
    spark: SparkSession, lay: Layout, staged: DataFrame, dates: list, batch_ts=None, deltas: bool = False, tx=None
) -> None:
    """U2 for the given dates, gated by Q9."""
    with st.transaction(spark, lay.root, tx) as t:
        incoming = wh.incoming_observations(staged, batch_ts)
        whole, append = _split(t, lay.fact_observation, dates, deltas)
        existing = read_fact_observation(spark, lay, whole, t) if whole else None
        if append:
            touched = _of_keys(read_fact_observation(spark, lay, append, t), incoming, wh.OKEY)
            existing = touched if existing is None else existing.unionByName(touched)
        schema = schemas.FACT_OBSERVATION
        upserted = wh.upsert_observations(existing, incoming)
        run = t.stage(upserted, lay.fact_observation, schema, "observation_date", ["observation_timestamp", "city_key"])
        dq.gate(dq.duplicate_observations(t.staged(lay.fact_observation, run, schema)), "one_observation_per_key")
        _publish(t, lay.fact_observation, run, "observation_date", whole, append)


def merge_dimension(
    spark: SparkSession, lay: Layout, table: str, schema, existing: DataFrame | None, new: DataFrame, tx=None
) -> None:
    """A new version only if there are new names."""
    if existing is not None and new.isEmpty():
        return
    with st.transaction(spark, lay.root, tx) as t:
        rows = new if existing is None else existing.unionByName(new)
        t.replace(table, t.stage(rows, table, schema))


def run_warehouse(
    spark: SparkSession,
    lay: Layout,
    forecasts: DataFrame,
    observations: DataFrame,
    forecast_dates: list,
    observation_dates: list,
    batch_ts=None,
    tx=None,
) -> None:
    """Dimensions, revisions and observations, in one transaction."""
    configure(spark)
    stg_f = wh.stage(forecasts, "forecast")
    stg_o = wh.stage(observations, "observation")
    with st.transaction(spark, lay.root, tx) as t:
        city, source = read_dim_city(spark, lay, t), read_dim_source(spark, lay, t)
        new = wh.new_cities(city, stg_f, stg_o, batch_ts=batch_ts)
        new_source = wh.new_sources(source, stg_f, stg_o, batch_ts=batch_ts)
        steps = [
            lambda: merge_dimension(spark, lay, lay.dim_city, schemas.DIM_CITY, city, new, t),
            lambda: merge_dimension(spark, lay, lay.dim_source, schemas.DIM_SOURCE, source, new_source, t),
        ]
        if forecast_dates:
            steps.append(lambda: merge_forecasts(spark, lay, stg_f, forecast_dates, batch_ts, tx=t))
        if observation_dates:
            steps.append(lambda: merge_observations(spark, lay, stg_o, observation_dates, batch_ts, tx=t))
        together(spark, *steps)


def load_warehouse(
    spark: SparkSession, lay: Layout, forecast_dates: list, observation_dates: list, batch_ts=None, tx=None
) -> None:
    """The load of staged dates as a step of its own, from the silver
    rows stored for them. Loading dates again changes nothing; dates without
    silver have nothing to load. Silver keeps one row for each event, so
    ``run_batch``, which has the batch at hand, merges from that instead."""
    with st.transaction(spark, lay.root, tx) as t:
        dates = {"forecast": forecast_dates, "observation": observation_dates}
        staged = {kind: stage_from_silver(spark, lay, kind, dates[kind], t) for kind in dates}
        staged = {k: spark.createDataFrame([], schemas.SILVER[k]) if rows is None else rows for k, rows in staged.items()}
        run_warehouse(spark, lay, staged["forecast"], staged["observation"], forecast_dates, observation_dates, batch_ts, t)


# --- gold --------------------------------------------------------------------------------


def run_gold(spark: SparkSession, lay: Layout, target_dates: list, tx=None) -> None:
    """Recompute the touched target dates (D10) and replace them (D5), rows
    and partial sums."""
    configure(spark)
    if not target_dates:
        return
    with st.transaction(spark, lay.root, tx) as t:
        forecasts = read_silver(spark, lay, "forecast", target_dates, t)
        observations = read_silver(spark, lay, "observation", target_dates, t)
        if forecasts is None or observations is None:
            return
        rows = acc.gold_rows(forecasts, acc.latest_observations(observations))
        run = t.stage(rows, lay.gold, schemas.GOLD, "target_date", ["city", "forecast_timestamp"])
        t.replace(lay.gold, run, "target_date", target_dates)
        sums = acc.partials(t.staged(lay.gold, run, schemas.GOLD))
        t.replace(
            lay.gold_partials, t.stage(sums, lay.gold_partials, schemas.GOLD_PARTIALS, "target_date"), "target_date", target_dates
        )


def scored_keys(forecasts: DataFrame, observations: DataFrame) -> DataFrame:
    """The (city, hour) whose score a batch can change."""
    hours = observations.select("city", F.col("observation_timestamp").alias("forecast_timestamp"))
    return forecasts.select("city", "forecast_timestamp").unionByName(hours).distinct()


def run_gold_changes(spark: SparkSession, lay: Layout, keys: DataFrame, target_dates: list, tx=None) -> None:
    """D5 by keys instead of dates: only the rows of the touched (city, hour)
    are scored again. The difference to the stored rows is the change feed
    (stored with the commit that makes it); gold gets the new rows of the hours
    that changed as a delta, the partial sums get the feed's signed sums."""
    configure(spark)
    if not target_dates:
        return
    with st.transaction(spark, lay.root, tx) as t:
        forecasts = read_silver(spark, lay, "forecast", target_dates, t)
        observations = read_silver(spark, lay, "observation", target_dates, t)
        if forecasts is None or observations is None:
            return
        key = ["city", "forecast_timestamp"]
        hours = keys.select("city", F.col("forecast_timestamp").alias("observation_timestamp"))
        seen = acc.latest_observations(_of_keys(observations, hours, ["city", "observation_timestamp"]))
        after = acc.gold_rows(_of_keys(forecasts, keys, key), seen)
        before = _of_keys(read_gold(spark, lay, target_dates, t), keys, key)
        schema = schemas.GOLD_CHANGES
        feed = t.stage(acc.changes(before, after), lay.gold_changes, schema, "target_date")
        t.append(lay.gold_changes, feed, "target_date", target_dates)
        changed = t.staged(lay.gold_changes, feed, schema)
        rows = _of_keys(after, changed, key)
        run = t.stage(rows, lay.gold, schemas.GOLD, "target_date", ["city", "forecast_timestamp"])
        t.append(lay.gold, run, "target_date", target_dates)
        sums = t.stage(acc.retractable_partials(changed), lay.gold_partials, schemas.GOLD_PARTIALS, "target_date")
        t.append(lay.gold_partials, sums, "target_date", target_dates)


def read_gold_changes(spark: SparkSession, lay: Layout, dates: list | None = None, tx=None) -> DataFrame | None:
    return _reader(spark, lay, tx).read(lay.gold_changes, schemas.GOLD_CHANGES, "target_date", dates)


def run_batch(
    spark: SparkSession,
    lay: Layout,
    forecast_events: DataFrame,
    observation_events: DataFrame,
    process_date: str,
    batch_ts=None,
    batch: str | None = None,
    min_coverage: float | None = None,
    gold_by_change: bool = False,
) -> bool:
    """Silver for both types, then warehouse, then gold for the dates the
    batch touched, committed at once. False if this batch was finished before.

    A batch without a name is known by the fingerprint of its inputs: further
    runs of a day with other rows are batches of their own, the same rows
    again change nothing. A named batch that comes back with other rows is an
    error. Before the commit the ids of the new silver rows must be unique
    (Q5) and, if ``min_coverage`` is given, that share of the touched dates'
    forecasts must have an observation (Q6). ``gold_by_change`` scores the
    touched hours only, not their whole dates."""
    configure(spark)
    flagged = {
        kind: _flagged(events, kind) for kind, events in (("forecast", forecast_events), ("observation", observation_events))
    }
    try:
        own = fingerprint(*flagged.values())
        name = batch if batch is not None else own.replace(":", "-").replace(",", "_")
        marker = f"{process_date}-{name}"
        known = st.processed(spark, lay.batches, marker)
        if known is not None:
            if known != own:
                raise ValueError(f"batch {marker} was finished with other rows ({known}, now {own})")
            return False
        with st.transaction(spark, lay.root) as tx:
            (f_good, f_dates, _), (o_good, o_dates, _) = together(
                spark,
                *[
                    partial(run_silver, spark, None, kind, lay, process_date, name, flagged=flagged[kind], tx=tx)
                    for kind in ("forecast", "observation")
                ],
            )
            touched = sorted(set(f_dates) | set(o_dates))
            # all three read silver as it is now, and no table of each other
            together(
                spark,
                lambda: gate_silver(spark, lay, touched, min_coverage, tx),
                lambda: run_warehouse(spark, lay, f_good, o_good, f_dates, o_dates, batch_ts, tx),
                lambda: run_gold_changes(spark, lay, scored_keys(f_good, o_good), touched, tx)
                if gold_by_change
                else run_gold(spark, lay, touched, tx),
            )
    finally:
        for df in flagged.values():
            df.unpersist()
    st.mark_processed(spark, lay.batches, marker, own)
    return True


def gate_silver(spark: SparkSession, lay: Layout, dates: list, min_coverage: float | None, tx=None) -> None:
    """Q5 and Q6 on the silver rows of the given dates."""
    rows = {kind: read_silver(spark, lay, kind, dates, tx) for kind in DATE} if dates else {}
    unique = [
        partial(dq.gate, dq.event_id_duplicates(df), f"unique_event_id, {kind}") for kind, df in rows.items() if df is not None
    ]
    together(spark, *unique)
    if min_coverage is not None and rows.get("forecast") is not None:
        observed = rows["observation"]
        if observed is None:
            observed = spark.createDataFrame([], schemas.SILVER["observation"])
        dq.gate(dq.join_coverage(rows["forecast"], observed, min_coverage).where("not passed"), "join_coverage")
