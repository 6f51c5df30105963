"""Nearest neighbours with cross-polytope hashing.

A unit vector is turned by a pseudo-random rotation (three rounds of random
signs and a fast Hadamard transform) and hashed to the nearest signed axis,
the coordinate of largest magnitude with its sign. ``TABLES`` rotations give
as many tables. A query looks up its ``PROBES`` nearest signed axes in each;
what stands there is compared exactly, in double precision, on the original
vectors.

Rows of one axis are kept in blocks of about ``BLOCK`` vectors, so that a
lookup is one row and its comparisons one matrix product; an axis that a third
of all vectors share is just more blocks. Queries whose lookups return fewer
than ``k`` rows are compared with all blocks of one table.

Defined results: vectors that are null, empty, zero, or hold a null or a
non-finite component take no part; vectors of different lengths aren't
compared; rows that share an id but not a vector are separate candidates and
queries, repeated rows count once; a query row doesn't find rows of its own
id; with fewer than ``k`` candidates all are returned; ties go to the
smaller id.

Scale: the index is rebuilt from all rows, each in every table; hashing
happens where rows are read, blocks are made with salted keys, and queries
meet only blocks of their axes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import prepare, seeds, written

TABLES = 24
PROBES = 12
K = 10
#: Vectors of one block and queries that meet it at once.
BLOCK = 512
QUERIES = 128


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(
        vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0),
        F.lit(False),
    )


def rotate(x: np.ndarray, table: int) -> np.ndarray:
    """Rows of ``x`` (width a power of two), turned."""
    n = x.shape[1]
    for r in range(3):
        sign = np.where(seeds(n, 1000 * (table + 1) + r) >> np.uint64(63), 1.0, -1.0)
        x = x * sign
        h = 1
        while h < n:
            y = x.reshape(len(x), -1, 2, h)
            x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), 2).reshape(len(x), n)
            h *= 2
        x = x / np.sqrt(n)
    return x


def axes(vectors: np.ndarray, table: int, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of each vector, nearest first; axis
    ``2 i`` is coordinate i, ``2 i + 1`` its negative."""
    n = 1 << max(0, int(vectors.shape[1] - 1).bit_length())
    x = np.zeros((len(vectors), n))
    scale = np.abs(vectors).max(1, keepdims=True)
    x[:, : vectors.shape[1]] = vectors / scale
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = rotate(x, table)
    both = np.stack((x, -x), 2).reshape(len(x), 2 * n)
    return np.argsort(-both, axis=1, kind="stable")[:, :probes]


def hashed(rows: DataFrame, tables: int, probes: int) -> DataFrame:
    """(table, width, axis, id, vector) for rows (id, vector)."""
    element = rows.schema["vector"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["table", "width", "axis", "id", "vector"]
        for batch in batches:
            width = np.diff(batch.column(1).offsets.to_numpy())
            for w in np.unique(width):
                own = batch.take(pa.array(np.flatnonzero(width == w)))
                vectors = own.column(1).flatten().to_numpy().astype(np.float64).reshape(-1, w)
                for table in range(tables):
                    axis = axes(vectors, table, probes)
                    for probe in range(axis.shape[1]):
                        n = len(axis)
                        cols = [
                            pa.array(np.full(n, table, np.int32)), pa.array(np.full(n, w, np.int32)),
                            pa.array(axis[:, probe].astype(np.int32)), own.column(0), own.column(1),
                        ]
                        yield pa.RecordBatch.from_arrays(cols, names)

    return rows.mapInArrow(run, f"table int, width int, axis int, id long, vector array<{element}>")


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """One row for about ``size`` rows of (table, width, axis)."""
    key = ["table", "width", "axis"]
    # one row for each signed axis of each table: 2 * width * tables at most
    parts = rows.groupBy(*key).agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
    return (
        rows.join(F.broadcast(parts), key)
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        .groupBy(*key, "part")
        .agg(F.collect_list(F.struct("id", "vector")).alias(name))
        .drop("part")
    )


def _matrix(members: pa.StructArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(ids, vectors, second field) of a block."""
    fields = members.flatten()  # minds where the block starts in its array
    ids = fields[0].to_numpy()
    return ids, fields[-1].flatten().to_numpy().astype(np.float64).reshape(len(ids), -1), fields[1]


def _compared(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each block for each query of the other block."""
    schema = "query_id long, query_no long, vec_id long, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            out: list[tuple] = []
            left, right = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                queries, members = left[i].values, right[i].values
                ids, vectors, _ = _matrix(members)
                query, points, number = _matrix(queries)
                number = number.to_numpy()
                for q in range(len(query)):
                    apart = points[q] - vectors
                    score = np.sqrt(np.einsum("ij,ij->i", apart, apart))
                    other = np.flatnonzero(ids != query[q])
                    near = other[np.lexsort((ids[other], score[other]))[:k]]
                    out.append((np.full(len(near), query[q]), np.full(len(near), number[q]), ids[near], score[near]))
            cols = [np.concatenate([o[c] for o in out]) if out else np.zeros(0) for c in range(4)]
            types = [pa.int64()] * 3 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(t.to_pandas_dtype())) for c, t in zip(cols, types)], names)

    return pairs.select("queries", "members").mapInArrow(run, schema)


def search(
    vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding",
    k: int = K, tables: int = TABLES, probes: int = PROBES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each
    row where ``is_query`` holds."""
    spark = vectors.sparkSession
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    if not isinstance(vectors.schema[vector].dataType, T.ArrayType):
        raise TypeError(f"{vector} is not an array")
    all_rows = vectors.filter(usable(F.col(vector)) & F.col(vec_id).isNotNull())
    rows = all_rows.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vector"))
    queries = all_rows.filter(is_query).select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vector"))
    index = written(_blocks(hashed(rows, tables, 1), BLOCK, "members"), "ann-index")
    # a query's number tells apart different vectors of one id
    numbered = F.transform("queries", lambda x: F.struct(x["id"].alias("id"), F.xxhash64(x["vector"]).alias("no"), x["vector"].alias("vector")))
    asked = _blocks(hashed(queries, tables, probes), QUERIES, "queries").withColumn("queries", numbered)
    key = ["table", "width", "axis"]
    found = written(_best(_compared(asked.join(index, key), k), k), "ann-found")
    few = found.groupBy("query_id", "query_no").agg(F.count("*").alias("n")).filter(F.col("n") >= k)
    lonely = (
        queries.withColumn("no", F.xxhash64("vector"))
        .join(few, (F.col("id") == F.col("query_id")) & (F.col("no") == F.col("query_no")), "left_anti")
        .select(F.size("vector").alias("width"), F.array(F.struct("id", "no", "vector")).alias("queries"))
    )
    everything = _compared(lonely.join(index.filter("table = 0").drop("axis"), "width"), k)
    best = _best(found.select("query_id", "query_no", "vec_id", "score").unionByName(everything), k)
    return best.select("query_id", "rank", "vec_id", "score")


def _best(found: DataFrame, k: int) -> DataFrame:
    """A query has at most ``k`` rows from each block it met."""
    order = Window.partitionBy("query_id", "query_no").orderBy("score", "vec_id")
    return (
        found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "query_no", "rank", "vec_id", "score")
    )
