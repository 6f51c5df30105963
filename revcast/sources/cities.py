"""City configuration source.

A JSON array of flat objects, read with its declared schema. Every row must
carry all required fields; a row without one fails the read with the
sorted list of missing names, raised inside the plan (``raise_error``) so
no row is silently used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def missing_fields(required: list[str] = schemas.CITY_REQUIRED):
    """Sorted names of required fields that are NULL or absent in a row."""
    names = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in sorted(required)])
    return F.filter(names, lambda x: x.isNotNull())


def validated(df: DataFrame, required: list[str] = schemas.CITY_REQUIRED) -> DataFrame:
    """Rows pass through unchanged; the first incomplete row fails the job.
    The check sits in a filter so the optimizer cannot prune it away."""
    missing = missing_fields(required)
    failure = F.when(
        F.size(missing) > 0,
        F.raise_error(
            F.concat(
                F.lit("incomplete city entry, without ["),
                F.array_join(missing, ", "),
                F.lit("]: "),
                F.to_json(F.struct(*[F.col(c) for c in df.columns])),
            )
        ),
    )
    return df.where(failure.isNull())


def write_cities(cities: DataFrame, path: str) -> None:
    """A config as :func:`load_cities` reads it: one JSON array. A config is
    a list somebody keeps by hand, so it fits one row."""
    rows = F.array_sort(F.collect_list(F.struct(*schemas.CITY_REQUIRED)))
    cities.agg(F.to_json(rows).alias("value")).write.mode("overwrite").text(path)


def load_cities(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(schemas.CITY_CONFIG).option("multiLine", True).json(path)
    return validated(raw)
