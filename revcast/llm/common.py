"""Helpers shared by the training-data operators.

Text work happens on UTF-8 bytes: a batch of documents is laid end to end in
one numpy array and words, hashes and windows are computed for all of them at
once. Hashes are content hashes, equal in every process and on every run.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from revcast.session import scratch_path

#: Bytes of text handled at once inside a task (one longer text is one block).
BLOCK_BYTES = 1 << 20
#: Rows of one Arrow batch; a batch of long texts stays small.
BATCH_ROWS = 512

U64 = np.uint64

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Session settings the operators need. Python workers find the package
    where the driver found it, unless they have it on their own path."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    own = spark.sparkContext.environment
    known = own.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        own["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes to the shared folder and reads back, so a lost
    executor costs the tasks it ran and nothing before them."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bits of the largest filter of ``sifting`` (4 MB).
SIFT_BITS = 1 << 25


@contextmanager
def sifting(spark: SparkSession, keys: int) -> Iterator[None]:
    """Joins in the jobs run inside filter a side before its shuffle by a Bloom
    filter of the other, filtered one, which has ``keys`` rows, whatever the
    sides' sizes; the settings are put back. The filter has 8 to 16 bits a key,
    as the driver and every task that makes or reads it hold it whole, and 4 MB
    at most: beyond some four million keys more rows get through."""
    bits = min(SIFT_BITS, max(1 << 13, 1 << (8 * keys - 1).bit_length()))
    wanted = {"enabled": "true", "applicationSideScanSizeThreshold": "1", "creationSideThreshold": "1t", "numBits": str(bits), "expectedNumItems": str(bits // 8)}
    wanted = {f"spark.sql.optimizer.runtime.bloomFilter.{k}": v for k, v in wanted.items()}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def discard(*tables: DataFrame) -> None:
    """Removes tables of ``written`` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        paths = {os.path.dirname(f) for f in df.inputFiles()}
        for path in paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


# -- text blocks ------------------------------------------------------------

#: Lower-cases A-Z, keeps 0-9, a-z and every byte of a non-ASCII character,
#: turns all else into a space: words are then what ``bytes.split`` returns.
ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
#: Lower-cases A-Z only.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def texts(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def blocks(items: list[bytes | None], limit: int = BLOCK_BYTES):
    """(first, last) slices of ``items`` of about ``limit`` bytes each."""
    first = size = 0
    for i, t in enumerate(items):
        n = len(t) if t else 0
        if i > first and size + n > limit:
            yield first, i
            first, size = i, 0
        size += n
    if items:
        yield first, len(items)


class Words:
    """The words of a block of texts: byte range, owner text and hash each.

    ``first[d]:first[d + 1]`` are the words of text ``d``.
    """

    def __init__(self, items: list[bytes | None]):
        lengths = np.fromiter((len(t) if t else 0 for t in items), np.int64, len(items))
        self.buffer = b"\n".join(t or b"" for t in items) + b"\n"
        raw = np.frombuffer(self.buffer, np.uint8)
        self.offset = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
        space = _IS_SPACE[raw]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.concatenate((np.searchsorted(self.start, self.offset), [len(self.start)]))
        self.doc = np.repeat(np.arange(len(items)), np.diff(self.first))
        self.raw = raw

    def hashes(self, seed: int) -> np.ndarray:
        """64-bit content hash of each word: a polynomial over its bytes,
        taken from prefix sums (arithmetic modulo 2^64), then mixed."""
        power, inverse = _powers(seed, len(self.raw) + 1)
        total = np.zeros(len(self.raw) + 1, U64)
        np.cumsum((self.raw.astype(U64) + U64(1)) * power[: len(self.raw)], out=total[1:])
        word = (total[self.end] - total[self.start]) * inverse[self.start]
        return mix(word + (self.end - self.start).astype(U64))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    known = _POWERS.get(seed)
    if known is None or len(known[0]) < n:
        base = (int(mix(np.array([seed], U64))[0]) * 8 + 5) % 2**64
        size = max(n, 2 * BLOCK_BYTES)
        known = tuple(
            np.concatenate((np.ones(1, U64), np.cumprod(np.full(size - 1, b, U64))))
            for b in (base, pow(base, -1, 2**64))
        )
        _POWERS[seed] = known
    return known


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the 64 output bits (splitmix finaliser)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed odd 64-bit constants."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(salt)) | U64(1)


def window_hashes(word: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words (across texts too: the caller
    keeps those within one text)."""
    if len(word) < n:
        return np.zeros(0, U64)
    out = np.zeros(len(word) - n + 1, U64)
    for i, k in enumerate(seeds(n, seed)):
        out += (word[i : len(word) - n + 1 + i] ^ (k >> U64(7))) * k
    return mix(out)
