"""Substring deduplication by recompression.

A word is removed if a window of ``window`` consecutive words covers it whose
word sequence also starts in a document with a smaller id.

Recompression shortens a word sequence in rounds. In a round every symbol is,
by a coin that depends on its name alone, a left or a right one; a right
symbol joins the left symbol before it (a pair) or its equals before it (a
run), and the joined symbols get a new name. Whether two neighbours join
depends on their names only, so equal substrings get equal interior symbols
wherever they stand; for each symbol the range of words that decided it (its
context) is kept. Names are content hashes: they are the same on every
executor and for every document, so a round needs no dictionary, and no
shuffle, and all rounds run where a document is read.

Each window is represented by one symbol whose context lies inside it: of the
highest level that has one, the symbol with the smallest hash (a window with
none represents itself). Equal windows choose equal symbols, so this loses no
repeat. Neighbouring windows share their symbol, which leaves about one row
for fifteen words:

1. rows (context hash, document, span covered by the windows, span hash);
2. contexts seen in two documents or more *reveal* repeats; most rows go;
3. of the rest, a span that a smaller document holds in full is removed;
   where one context has different spans, the windows of one document per
   span are hashed (128 bits) and compared: that *verifies* each window;
4. removed windows come back to the documents that have any.

Defined results: null and empty texts have no words, nothing removed; texts
below ``window`` words too; a row without id is never removed and removes
nothing; repeated rows of one id don't remove each other (smaller ids only);
other input columns are ignored.

Scale: only step 2 and the join after it move rows for all documents (24
bytes for some fifteen words); texts move only for documents with a repeat.
Groups are combined before the shuffle (minima and maxima), and a context
that a third of all documents share is split by adaptive skew joins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, Words, _powers, blocks, mix, prepare, seeds, texts, window_hashes, written

WINDOW = 50
#: Levels, one for each round of recompression, that may represent a window.
LEVELS = (5, 4, 3, 2)
#: Words handled at once; longer texts are taken in overlapping slices.
SLICE = 1 << 18
_FAR = 1 << 40

PARSED = (
    "doc_id long, version long, n_words long, sha256 string, "
    "anchors array<struct<context:long,span:long,first:int,last:int>>"
)


class Level:
    """Symbols of one level: first word, name and context ``[left, right)``."""

    def __init__(self, start, name, left, right, doc):
        self.start, self.name, self.left, self.right, self.doc = start, name, left, right, doc

    def next(self, round_: int) -> Level:
        name, doc = self.name, self.doc
        n = len(name)
        coin = mix(name ^ seeds(round_, 11)[-1])
        right = (coin >> U64(63)).astype(bool)
        same_doc = doc[1:] == doc[:-1]
        joined = same_doc & right[1:] & (~right[:-1] | (name[1:] == name[:-1]))
        first = np.flatnonzero(np.concatenate(([True], ~joined)))
        last = np.concatenate((first[1:], [n])) - 1
        size = (last - first + 1).astype(U64)
        k1, k2, k3 = seeds(3, 100 + round_)
        new = mix((name[first] ^ (k1 >> U64(9))) * k1 + mix(name[last] * k2) + size * k3)
        new = np.where(size == 1, name[first], new)
        # the left edge of a right symbol depends on its neighbour, the right
        # edge of any symbol too; at the end of a text there is none
        before = np.maximum(first - 1, 0)
        has_before = (first > 0) & (doc[before] == doc[first])
        after = np.minimum(last + 1, n - 1)
        has_after = (last < n - 1) & (doc[after] == doc[last])
        left = np.where(right[first], np.where(has_before, self.left[before], -_FAR), self.left[first])
        return Level(self.start[first], new, left, np.where(has_after, self.right[after], _FAR), doc[first])


def levels(word: np.ndarray, doc: np.ndarray, rounds: int) -> list[Level]:
    at = np.arange(len(word), dtype=np.int64)
    out = [Level(at, word, at, at + 1, doc)]
    for r in range(1, rounds + 1):
        out.append(out[-1].next(r))
    return out


def choose(word: np.ndarray, doc: np.ndarray, start: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the windows that start at ``start``: an id of the chosen symbol and
    its context range (the window itself if it has no symbol)."""
    left, right = start.copy(), start + window
    symbol = -1 - np.arange(len(start), dtype=np.int64)
    todo = np.arange(len(start))
    parsed = levels(word, doc, max(LEVELS))
    for level in LEVELS:
        s = parsed[level]
        inside = np.flatnonzero((s.left >= 0) & (s.right < _FAR) & (s.right - s.left <= window))
        if not len(inside) or not len(todo):
            continue
        l, r = s.left[inside], s.right[inside]
        a = np.searchsorted(l, start[todo])
        b = np.searchsorted(r, start[todo] + window, side="right")
        has = a < b
        a, b, at = a[has], b[has], todo[has]
        if len(at):
            order = (mix(s.name[inside] ^ U64(level)) >> U64(28) << U64(28)) | np.arange(len(inside), dtype=U64)
            best = (_range_min(order, a, b) & U64((1 << 28) - 1)).astype(np.int64)
            left[at], right[at] = l[best], r[best]
            symbol[at] = level * _FAR + best
        todo = todo[~has]
    return symbol, left, right


def _range_min(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of ``x[a:b]`` for each pair, from a table of doubling ranges."""
    tables, width = [x], 1
    longest = int((b - a).max())
    while 2 * width <= longest:
        t = tables[-1].copy()
        t[:-width] = np.minimum(t[:-width], tables[-1][width:])
        tables.append(t)
        width *= 2
    k = np.floor(np.log2(b - a)).astype(np.int64)
    out = np.empty(len(a), U64)
    for i, t in enumerate(tables):
        m = k == i
        out[m] = np.minimum(t[a[m]], t[b[m] - (1 << i)])
    return out


class Ranges:
    """Content hash of any range of words."""

    def __init__(self, word: np.ndarray, seed: int):
        power, self.inverse = _powers(seed, len(word) + 1)
        self.total = np.zeros(len(word) + 1, U64)
        np.cumsum(word * power[: len(word)], out=self.total[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.total[b] - self.total[a]) * self.inverse[a] + (b - a).astype(U64))


def anchors(word: np.ndarray, doc: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(text, context hash, span hash, first and last window start) of the
    symbols chosen by all windows of some texts laid end to end."""
    n = len(word)
    start = np.flatnonzero(doc[window - 1 :] == doc[: n - window + 1]) if n >= window else np.zeros(0, np.int64)
    if not len(start):
        return tuple(np.zeros(0, t) for t in (np.int64, U64, U64, np.int64, np.int64))
    symbol, left, right = choose(word, doc, start, window)
    new = (symbol[1:] != symbol[:-1]) | (doc[start[1:]] != doc[start[:-1]])
    i = np.flatnonzero(np.concatenate(([True], new)))
    j = np.concatenate((i[1:], [len(start)])) - 1
    context = Ranges(word, 21).of(left[i], right[i])
    span = Ranges(mix(word), 22).of(start[i], start[j] + window)
    return doc[start[i]], context, span, start[i], start[j]


def parse(items: list[bytes | None], window: int) -> list[tuple[int, str, list[tuple]]]:
    """(words, SHA-256 of the words joined by one space, anchors) of each text."""
    words = Words(items)
    name = words.hashes(1)
    found: list[list[np.ndarray]] = []
    for a in range(0, max(len(name), 1), SLICE):
        b = min(a + SLICE + window - 1, len(name))
        part = anchors(name[a:b], words.doc[a:b], window)
        found.append([part[0], part[1], part[2], part[3] + a, part[4] + a])
    doc, context, span, first, last = (np.concatenate(x) for x in zip(*found))
    base = words.first[doc] if len(doc) else doc
    rows = list(
        zip(context.view(np.int64).tolist(), span.view(np.int64).tolist(), (first - base).tolist(), (last - base).tolist())
    )
    cut = np.searchsorted(doc, np.arange(len(items) + 1))
    out = []
    for d, t in enumerate(items):
        sha = hashlib.sha256(b" ".join((t or b"").split())).hexdigest()
        out.append((int(words.first[d + 1] - words.first[d]), sha, rows[cut[d] : cut[d + 1]]))
    return out


def _parse_all(rows: DataFrame, window: int) -> DataFrame:
    """Every text's word count, digest and anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("context", pa.int64()), ("span", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])
        )
        names = ("context", "span", "first", "last")
        for batch in batches:
            items = texts(batch.column(2))
            for a, b in blocks(items):
                parsed = parse(items[a:b], window)
                cols = [
                    batch.column(0)[a:b],
                    batch.column(1)[a:b],
                    pa.array([p[0] for p in parsed], pa.int64()),
                    pa.array([p[1] for p in parsed]),
                    pa.array([[dict(zip(names, r)) for r in p[2]] for p in parsed], kind),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "version", "n_words", "sha256", "anchors"])

    return rows.mapInArrow(run, PARSED)


def _window_rows(touched: DataFrame, window: int) -> DataFrame:
    """Hash of each window that a document has to show for comparison."""
    schema = "doc_id long, version long, at int, h1 long, h2 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, spans = texts(batch.column(2)), batch.column(3).to_pylist()
            show = [[(s["first"], s["last"]) for s in own or [] if s["show"]] for own in spans]
            for a, b in blocks(items):
                words = Words(items[a:b])
                name = words.hashes(1)
                h1, h2 = window_hashes(name, window, 31), window_hashes(mix(name), window, 32)
                for d in range(a, b):
                    if not show[d]:
                        continue
                    at = np.unique(np.concatenate([np.arange(i, j + 1) for i, j in show[d]]))
                    pos = at + words.first[d - a]
                    n = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([batch.column(0)[d].as_py()] * n, pa.int64()),
                            pa.array([batch.column(1)[d].as_py()] * n, pa.int64()),
                            pa.array(at.astype(np.int32)),
                            pa.array(h1[pos].view(np.int64)),
                            pa.array(h2[pos].view(np.int64)),
                        ],
                        ["doc_id", "version", "at", "h1", "h2"],
                    )

    return touched.mapInArrow(run, schema)


def _removed(judged: DataFrame, window: int) -> DataFrame:
    """Texts without the words of their removed windows."""
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            spans, single = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            for d, t in enumerate(texts(batch.column(2))):
                words = (t or b"").split()
                gone = np.zeros(len(words) + 1, np.int32)
                ranges = [(s["first"], s["last"]) for s in spans[d] or [] if not s["show"]]
                ranges += [(i, i) for i in single[d] or []]
                for i, j in ranges:
                    gone[i] += 1
                    gone[j + window] -= 1
                keep = np.cumsum(gone[:-1]) == 0
                kept = b" ".join(w for w, k in zip(words, keep.tolist()) if k)
                out.append((len(words), len(words) - int(keep.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            cols = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *cols], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
            )

    return judged.mapInArrow(run, schema)


def dedup(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document row: words, removed words, digest of the kept
    words joined by one space, and, where any was removed, these words as
    ``kept`` (else null: the text stays as it is)."""
    prepare(documents.sparkSession)
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).select(
        "doc_id", F.xxhash64("text").alias("version"), "text"
    )
    parsed = written(_parse_all(rows, window), "substrings-parsed")
    anchor = (
        parsed.filter(F.col("doc_id").isNotNull())
        .select("doc_id", "version", F.explode("anchors").alias("a"))
        .select("doc_id", "version", "a.*")
    )
    repeated = (
        anchor.groupBy("context")
        .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.min("span").alias("s1"), F.max("span").alias("s2"))
        .filter(F.col("lo") < F.col("hi"))
        .select("context", "lo", (F.col("s1") != F.col("s2")).alias("differ"))
    )
    # both written, so that joins on a context that a third of all documents
    # share have plain exchanges on both sides, which can be split
    repeated = written(repeated, "substrings-repeated")
    shared = written(anchor.join(repeated, "context"), "substrings-shared")
    holder = written(shared.groupBy("context", "span").agg(F.min("doc_id").alias("holder")), "substrings-holders")
    spans = (
        shared.join(holder, ["context", "span"])
        .filter((F.col("doc_id") > F.col("holder")) | F.col("differ"))
        .groupBy("doc_id", "version")
        .agg(F.collect_set(F.struct("first", "last", (F.col("doc_id") == F.col("holder")).alias("show"))).alias("spans"))
    )
    touched = written(rows.join(spans, ["doc_id", "version"]).select("doc_id", "version", "text", "spans"), "substrings-touched")
    shown = written(_window_rows(touched.filter(F.exists("spans", lambda s: s["show"])), window), "substrings-windows")
    first = shown.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    single = (
        shown.join(first, ["h1", "h2"])
        .filter(F.col("doc_id") > F.col("lo"))
        .groupBy("doc_id", "version")
        .agg(F.collect_set("at").alias("single"))
    )
    judged = touched.join(single, ["doc_id", "version"], "left").select("doc_id", "version", "text", "spans", "single")
    untouched = parsed.join(touched.select("doc_id", "version").distinct(), ["doc_id", "version"], "left_anti").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha256").alias("kept_sha256"),
        F.lit(None).cast("string").alias("kept"),
    )
    return untouched.unionByName(_removed(judged, window))
