"""Stream → bronze, with a dead letter (R1s-R3s, R7s, S6, K1, F10).

Records arrive as ``record_id, key, value`` (value = base64 JSON event, key =
city, the ordering key). One query reads and decodes them; each micro-batch
writes its good records, as the JSON text they were sent, and its failed ones.
Both go to folders of this stream's batch, replaced whole if the batch is
replayed, so every record is landed exactly once, and bronze keeps what
arrived: undeclared keys and mistyped values too.
"""

from __future__ import annotations

import hashlib

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.ingest import bronze_rows, dead_letter, decode_records

PARTITIONS = ["event_type", "year", "month", "day", "hour", "batch"]
DEAD_LETTER_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType(), True) for n in ("record_id", "key", "value", "error", "batch")]
)


def read_records(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.STREAM_RECORD)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)  # R18
    return reader.json(landing)


def _land(bronze_root: str, dead_letter_root: str, stream: str):
    def land(batch: DataFrame, batch_id: int) -> None:
        tag = F.lit(f"{stream}-{batch_id:06d}").alias("batch")
        decoded = decode_records(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for rows, root, by, fmt in (
                (bronze_rows(decoded), bronze_root, PARTITIONS, "text"),
                (dead_letter(decoded), dead_letter_root, ["batch"], "json"),
            ):
                # the rows of a folder meet before they are written: few files,
                # however many tasks read the batch; a large folder gets several
                (
                    rows.select("*", tag)
                    .hint("rebalance", *by)
                    .write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .partitionBy(*by)
                    .format(fmt)
                    .save(root)
                )
        finally:
            decoded.unpersist()

    return land


def start_bronze(
    spark: SparkSession,
    landing: str,
    bronze_root: str,
    dead_letter_root: str,
    checkpoint_root: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start landing the records of one folder. A stream is known by its
    checkpoint, so several can land in the same bronze."""
    stream = hashlib.sha256(checkpoint_root.encode()).hexdigest()[:12]
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return (
        read_records(spark, landing, max_files_per_trigger)
        .writeStream.foreachBatch(_land(bronze_root, dead_letter_root, stream))
        .option("checkpointLocation", f"{checkpoint_root}/bronze")
        .trigger(**trigger)
        .start()
    )


def await_end(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def _fields(schema: T.StructType) -> T.StructType:
    keys = [T.StructField(p, T.StringType(), True) for p in PARTITIONS]
    own = [f for f in schemas.with_corrupt(schema).fields if f.name not in PARTITIONS]
    return T.StructType(own + keys)


def read_bronze(spark: SparkSession, bronze_root: str, schema: T.StructType = schemas.BRONZE_ANY) -> DataFrame:
    """All landed records as the given schema; ``_corrupt_record`` holds the
    text of a record that doesn't fit it."""
    return spark.read.schema(_fields(schema)).json(bronze_root)


def read_bronze_text(spark: SparkSession, bronze_root: str) -> DataFrame:
    """All landed records as they were sent."""
    return spark.read.text(bronze_root)


def read_bronze_batch(
    spark: SparkSession, bronze_root: str, kind: str, process_date: str
) -> DataFrame:
    """One event type and ingestion day of bronze. Only that day's
    folder is listed; the phantom ``hour`` column is dropped by ``normalize``
    (D8). A day without a folder has no rows."""
    from ..plans.storage import exists

    schema = _fields(schemas.BRONZE_FORECAST if kind == "forecast" else schemas.BRONZE_OBSERVATION)
    y, m, d = process_date.split("-")
    folder = f"{bronze_root}/event_type={kind}/year={y}/month={m}/day={d}"
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", bronze_root).json(folder)


def read_dead_letter(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(DEAD_LETTER_SCHEMA).json(root)
