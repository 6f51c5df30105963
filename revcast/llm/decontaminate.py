"""Benchmark decontamination with one Aho-Corasick automaton.

Test items (questions and answers) are normalised to words; every window of
``window`` consecutive words, or the whole item if it has fewer, is a pattern.
One automaton over all patterns walks each normalised text once. A match
knows its items and its length in words; word positions map back to byte and
character offsets of the original text.

Defined results: a null or wordless text has no words, no hits and is not
contaminated; null or wordless items have no window; items repeated or with
equal windows all count; rows with a null or repeated ``doc_id`` are judged
one by one; other input columns are ignored.

Scale: documents are scanned where they are read, with no shuffle. The test
items are read by the driver in bounded parts: one automaton covers at most
``AUTOMATON_BYTES`` of pattern text, and a larger set is scanned with several
automata, one pass each, so memory stays bounded for any size of test set.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, prepare, texts

WINDOW = 13
#: Share of hit words from which a text is contaminated: 1 / 20.
SHARE = 20
#: Bytes of item text in one automaton.
AUTOMATON_BYTES = 8 << 20

HITS = "n_words long, hits array<struct<first_word:long,last_word:long,first_char:long,last_char:long>>, items array<long>"


def normalised(text: bytes | None) -> bytes:
    """`` word word ... `` with one space around each word."""
    return b" " + b" ".join((text or b"").translate(ALNUM).split()) + b" "


def automaton(items: list[tuple[int, bytes]], window: int):
    """Patterns carry (number of words, items)."""
    owners: dict[bytes, tuple[int, list[int]]] = {}
    for item, text in items:
        words = text.split()
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            pattern = b" " + b" ".join(words[i : i + n]) + b" "
            owners.setdefault(pattern, (n, []))[1].append(item)
    out = ahocorasick.Automaton()
    for pattern, (n, own) in owners.items():
        out.add_word(pattern.decode("latin-1"), (n, tuple(sorted(set(own)))))
    if owners:
        out.make_automaton()
    return out if owners else None


def scan(text: bytes | None, found_by) -> tuple[int, np.ndarray | None, set[int]]:
    """(number of words, hit mask over words or None, items) of one text."""
    plain = normalised(text)
    n = 0 if plain == b"  " else plain.count(b" ") - 1
    hit, items, ends = None, set(), None
    if n and found_by is not None:
        for end, (length, own) in found_by.iter(plain.decode("latin-1")):
            if hit is None:
                hit = np.zeros(n + 1, np.int32)
                ends = np.flatnonzero(np.frombuffer(plain, np.uint8) == 32)
            last = int(np.searchsorted(ends, end))  # words before this space
            hit[last - length] += 1
            hit[last] -= 1
            items.update(own)
    return n, None if hit is None else np.cumsum(hit[:-1]) > 0, items


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return list(zip(edge[0::2].tolist(), edge[1::2].tolist()))


def spans(text: bytes, mask: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Runs of hit words as (first word, last word, first character, last
    character of the original text, exclusive)."""
    raw = np.frombuffer(text.translate(ALNUM), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([False], raw, [False])).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [(a, b - 1, int(chars[start[a]]), int(chars[end[b - 1]])) for a, b in runs(mask)]


def _parts(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[int, bytes]]]:
    part, size = [], 0
    for row in benchmark.select(F.col(item).cast("long"), F.col(text)).dropna().toLocalIterator():
        plain = normalised(row[1].encode())
        part.append((row[0], plain))
        size += len(plain)
        if size >= AUTOMATON_BYTES:
            yield part
            part, size = [], 0
    yield part


def find(
    documents: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, with_spans: bool = True,
    text: str = "text", item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``documents`` with ``n_words``, ``hits`` (runs of hit words with their
    place in the original text) and ``items`` (ids of items that occur).

    The columns of ``documents`` come first, unchanged; input columns called
    like an added one are replaced.
    """
    spark = documents.sparkSession
    prepare(spark)
    added = ("n_words", "hits", "items")
    out = documents.drop(*added)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema), HITS])
    parts = list(_parts(benchmark, item, item_text))
    parts = [spark.sparkContext.broadcast(p) for p in parts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = automaton(parts[0].value, window) if len(parts) == 1 else None
        for batch in batches:
            rows = texts(batch.column(batch.schema.get_field_index(text)))
            masks: list = [None] * len(rows)
            items: list[set] = [set() for _ in rows]
            counts = [0] * len(rows)
            for part in parts:
                found_by = one if len(parts) == 1 else automaton(part.value, window)
                for i, t in enumerate(rows):
                    counts[i], mask, own = scan(t, found_by)
                    if mask is not None:
                        masks[i] = mask if masks[i] is None else masks[i] | mask
                        items[i] |= own
            if with_spans:
                hits = [[] if m is None else spans(t, m) for t, m in zip(rows, masks)]
            else:
                hits = [[] if m is None else [(a, b - 1, None, None) for a, b in runs(m)] for m in masks]
            kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("first_word", "last_word", "first_char", "last_char")]))
            names = ("first_word", "last_word", "first_char", "last_char")
            cols = [
                pa.array(counts, pa.int64()),
                pa.array([[dict(zip(names, h)) for h in hs] for hs in hits], kind),
                pa.array([sorted(s) for s in items], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], [*batch.schema.names, *added])

    return out.mapInArrow(run, schema)


def judged(found: DataFrame, share: int = SHARE) -> DataFrame:
    """Adds ``n_hit`` and ``contaminated``."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["last_word"] - h["first_word"] + 1)
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    )


def clean(documents: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, columns unchanged."""
    # under other names, so that none is like an added one; each text goes to
    # Python and back once
    names = documents.columns
    rows = documents.toDF(*(f"c{i}" for i in range(len(names))))
    flagged = judged(find(rows, benchmark, with_spans=False, text=f"c{names.index(text)}", **options))
    return flagged.filter(~F.col("contaminated")).select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)))


def report(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: the counts, items and verdict of op1."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = judged(find(rows, benchmark, with_spans=False))
    names = F.transform("items", lambda i: i.cast("string"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(names)), 256).alias("items_sha256"),
        "contaminated",
    )
