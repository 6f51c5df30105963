"""Stream → silver and warehouse via ``foreachBatch`` (R4s-R6s).

Each micro-batch is applied with the same functions as the batch jobs against
the stored rows of the keys it touches (W1 for silver, U1 for forecast
revisions, U2 for observations) and committed at once. What it writes is a
delta of the dates it touches: their touched keys, not the dates. All three are
replay-safe, so a micro-batch that is run again after a failure leaves the same
rows. An event is deduplicated against everything stored of its target date:
none is lost for arriving late, however late.

``dedup_events`` puts the state store in front of that: repeats within the
watermark go no further, so they touch no table.
"""

from __future__ import annotations

from collections.abc import Callable
from inspect import signature

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import warehouse as wh
from ..plans import jobs
from ..plans import storage as st


def merge_silver(lay: jobs.Layout, kind: str) -> Callable[[DataFrame], None]:
    return lambda rows: jobs.merge_silver(rows.sparkSession, rows, kind, lay, deltas=True)


def merge_facts(lay: jobs.Layout, kind: str) -> Callable[[DataFrame], None]:
    merge = jobs.merge_forecasts if kind == "forecast" else jobs.merge_observations

    def apply(rows: DataFrame) -> None:
        dates = st.touched_dates(rows, jobs.DATE[kind])
        if dates:
            merge(rows.sparkSession, lay, wh.stage(rows, kind), dates, deltas=True)

    return apply


DELAY = "6 hours"


def dedup_events(stream: DataFrame, delay: str = DELAY) -> DataFrame:
    """R4s with the state store: a copy of an event within ``delay`` of its
    first one goes no further. State is dropped as the watermark passes; rows
    behind the watermark are dropped too and come by :func:`late_rows`."""
    timed = stream.withColumn("_event_time", F.col("ingested_at").cast("timestamp")).withWatermark("_event_time", delay)
    return timed.dropDuplicatesWithinWatermark(["event_id"]).drop("_event_time")


def late_rows(lay: jobs.Layout, kind: str, apply: Callable[[DataFrame], None], delay: str = DELAY) -> Callable[[DataFrame, int], None]:
    """Applies what :func:`dedup_events` may have dropped for being late: rows
    more than ``delay`` older than the newest row up to their batch. The mark
    runs ahead of any watermark over the same files, so no row is missed; rows
    that weren't dropped are applied twice, which changes nothing. Marks are
    kept by batch, so a replayed batch finds its own."""
    root = f"{lay.root}/_late/{kind}"

    def run(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        before = [n for n in st.names(spark, root) if n.isdigit() and int(n) < batch_id]
        mark = rows.agg(F.max("ingested_at").cast("string")).first()[0] or ""
        if before:
            mark = max(mark, st.read_text(spark, f"{root}/{before[-1]}"))
        st.create_text(spark, f"{root}/{batch_id:012d}", mark)
        if mark:
            apply(rows.where(F.col("ingested_at") < F.lit(mark).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")))

    return run


def start(stream: DataFrame, apply: Callable[..., None], checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """``stream``: typed, valid rows of one event type with the date column.
    ``apply`` gets each micro-batch, and its number if it takes two."""
    numbered = len(signature(apply).parameters) > 1

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            apply(rows, batch_id) if numbered else apply(rows)
        finally:
            rows.unpersist()

    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_silver_stream(spark: SparkSession, landing: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(landing)
