"""Spelling variants of a corpus vocabulary by finite-state composition.

Two words are near if they differ by one inserted, deleted or replaced code
point. The vocabulary's acceptor is composed with a one-edit transducer and
the acceptor again, one partition of initial states at a time: a partition
holds the words that agree in front of a window of positions and behind it, so
that the composition starts at the state behind the common front and edits
within the window only. Every pair has its first differing position in exactly
one window of its shorter word, so each pair comes from exactly one partition.

A word of length L takes part as the shorter word (class L) and as the longer
one of an insertion (class L - 1). A class has two windows, front and back
half; words of over ``2 * SPAN`` code points have one for every ``SPAN``.
Partitions of more than ``LIMIT`` words are halved again, down to one position,
where the alphabet bounds them; nothing is left out.

Inside a partition the middles of the words are compiled into a minimal
acceptor; what two states have in common behind an edit is enumerated once.

Defined results: null and empty texts have no words; a null id counts as an
empty one; repeated rows count again; an empty table has no words; other
columns are ignored.

Scale: words are counted per batch before the shuffle. Partitions are keyed by
hashes of front and back and carry the middles only. Their sizes are counted
first (combined before the shuffle), so no task meets a partition above
``LIMIT`` words. A task streams over its sorted partitions.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, prepare, written

#: Words of a partition that is not halved.
LIMIT = 4096
#: Positions of a window in very long words.
SPAN = 64
#: Distinct words that a task counts before it passes them on.
HELD = 200_000

#: Runs of Latin letters, as code points (A-Z are lower-cased before).
RUN = "[a-zÀ-ÿ]"


def vocabulary(
    documents: DataFrame, min_length: int = 7, min_count: int = 2,
    damage: Callable[[str], Callable[[str], str]] | None = None, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The words of at least ``min_length`` code points and ``min_count``
    occurrences: word, n. ``damage`` gets a document's id as text and gives the
    function that each of its runs goes through."""
    prepare(documents.sparkSession)
    run_of = re.compile(f"{RUN}{{{min_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"]
            )
            counts.clear()
            return rows

        for batch in batches:
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                found = run_of.findall((t or b"").translate(LOWER).decode())
                counts.update(map(damage(doc or ""), found) if damage else found)
            if len(counts) > HELD:
                yield out()
        yield out()

    rows = documents.select(F.col(doc_id).cast("string"), F.col(text)).mapInArrow(count, "word string, n long")
    total = rows.groupBy("word").agg(F.sum("n").alias("n"))
    return total.filter((F.col("n") >= min_count) & (F.char_length("word") >= min_length))


# -- partitions ---------------------------------------------------------------


def _windows(length: Column, m: Column) -> Column:
    """The windows of class ``m`` that a word of ``length`` takes part in."""
    k = F.greatest(F.lit(2), F.ceil(m / SPAN).cast("int"))
    bound = lambda i: F.floor(i * (m + 1) / k).cast("int")
    return F.transform(
        F.sequence(F.lit(0), k - 1), lambda i: F.struct(m.alias("m"), bound(i).alias("lo"), bound(i + 1).alias("hi"))
    )


def _keyed(rows: DataFrame) -> DataFrame:
    """rid, n, m, lo, hi and word → the partition's key and the word's part
    between front and back."""
    behind = F.greatest(F.lit(0), F.col("m") - F.col("hi"))
    length = F.char_length("word")
    outside = F.concat_ws(
        "\0", F.substring("word", F.lit(1), F.col("lo")), F.substring("word", length - behind + 1, behind),
        F.col("m").cast("string"), F.col("lo").cast("string"), F.col("hi").cast("string"),
    )
    return rows.select(
        F.xxhash64(outside).alias("k1"), F.xxhash64(F.lit(1), outside).alias("k2"), "rid", "n", "m", "lo", "hi",
        F.substring("word", F.col("lo") + 1, length - behind - F.col("lo")).alias("middle"),
        (length > F.col("m")).alias("longer"),
    )


def _halves() -> Column:
    """A window, cut in two."""
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    return F.array(
        F.struct("m", "lo", mid.alias("hi")), F.struct("m", mid.alias("lo"), "hi")
    )


def _partitions(words: DataFrame, limit: int) -> DataFrame:
    """The words (rid, word, n) once in each partition they belong to, sorted
    by partition inside tasks."""
    length = F.char_length("word")
    both = F.concat(
        _windows(length, length),
        F.when(length > F.lit(1), _windows(length, length - 1)).otherwise(F.array()),
    )
    rows = words.select("rid", "word", "n", F.inline(both))
    leaves = None
    while True:
        keyed = _keyed(rows)
        sizes = keyed.groupBy("k1", "k2").agg(F.count("*").alias("size"))
        large = written(
            sizes.filter((F.col("size") > limit)).select("k1", "k2"), "variants-large"
        )
        whole = large.isEmpty()
        found = keyed if whole else keyed.join(large, ["k1", "k2"], "left_anti")
        one = (F.col("hi") - F.col("lo")) == 1
        if not whole:
            again = keyed.join(large, ["k1", "k2"], "left_semi")
            found = found.unionByName(again.filter(one))  # bounded by the alphabet
            parts = written(again.filter(~one).select("rid", F.inline(_halves())), "variants-halves")
        leaves = found if leaves is None else leaves.unionByName(found)
        if whole or parts.isEmpty():
            return leaves.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "rid")
        rows = parts.join(words, "rid").select("rid", "word", "n", "m", "lo", "hi")


# -- automata -------------------------------------------------------------------


class Acceptor:
    """Minimal acceptors over one table of states: equal right languages are
    one state. State 0 accepts the empty word only or is the end of others."""

    def __init__(self) -> None:
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.known: dict[tuple, int] = {}
        self.shared: dict[tuple[int, int], list[str]] = {}

    def state(self, final: bool, arcs: dict[str, int]) -> int:
        key = (final, *arcs.items())
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return found

    def compile(self, words: list[str]) -> int:
        """The initial state of sorted distinct ``words``."""
        open_: list[tuple[dict[str, int], list[bool]]] = [({}, [False])]
        last = ""

        def close(depth: int) -> None:
            while len(open_) > depth + 1:
                arcs, final = open_.pop()
                open_[-1][0][last[len(open_) - 1]] = self.state(final[0], arcs)

        for w in words:
            same = 0
            while same < len(last) and last[same] == w[same]:
                same += 1
            close(same)
            open_.extend(({}, [False]) for _ in range(len(w) - same))
            open_[-1][1][0] = True
            last = w
        close(0)
        return self.state(open_[0][1][0], open_[0][0])

    def common(self, a: int, b: int) -> list[str]:
        """The words that lead from ``a`` and from ``b`` to an end."""
        key = (a, b) if a <= b else (b, a)
        known = self.shared.get(key)
        if known is None:
            known = [""] if self.final[a] and self.final[b] else []
            for c, t in self.arcs[a].items():
                u = self.arcs[b].get(c)
                if u is not None:
                    known += [c + z for z in self.common(t, u)]
            self.shared[key] = known
        return known


def near(short: list[str], long: list[str], span: int) -> Iterator[tuple[str, str]]:
    """Pairs that differ by one edit at a position below ``span``: two of
    ``short`` that differ in one code point, the smaller first, or one of
    ``short`` and one of ``long`` with one more. Words of one list have one
    length; lists are sorted and distinct.

    The composition's states are pairs of states: before the edit both sides
    have read the same, after it what they have in common follows."""
    acceptor = Acceptor()
    a = acceptor.compile(short) if short else None
    b = acceptor.compile(long) if long else None
    stack = [("", a, b)] if a is not None else []
    while stack:
        front, p, q = stack.pop()
        if len(front) == span:
            continue
        arcs = acceptor.arcs[p]
        letters = sorted(arcs)
        for i, x in enumerate(letters):
            for y in letters[i + 1 :]:
                for z in acceptor.common(arcs[x], arcs[y]):
                    yield front + x + z, front + y + z
        if q is not None:
            for y, t in acceptor.arcs[q].items():
                for z in acceptor.common(p, t):
                    if not z.startswith(y):  # else the first difference comes later
                        yield front + z, front + y + z
        for x in letters:
            follow = acceptor.arcs[q].get(x) if q is not None else None
            if follow is not None or acceptor.arcs[arcs[x]]:
                stack.append((front + x, arcs[x], follow))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Runs of rows with equal (k1, k2)."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:2] != key:
                if len(held) > 1:
                    yield held
                key, held = row[:2], []
            held.append(row)
    if len(held) > 1:
        yield held


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[tuple, tuple]]]:
    """The near pairs of each partition, as pairs of rows."""
    for rows in _groups(batches):
        lo, hi = rows[0][5], rows[0][6]
        short = {r[7]: r for r in rows if not r[8]}
        long = {r[7]: r for r in rows if r[8]}
        if short:
            yield [
                (short[a], short[b] if len(b) == len(a) else long[b])
                for a, b in near(sorted(short), sorted(long), hi - lo)
            ]


def pairs(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """All near pairs of ``words`` (rid, word, n), each once, as rids."""
    prepare(words.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _composed(batches):
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i][2] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"]
                )

    return _partitions(words, limit).mapInArrow(run, "a long, b long")


def _neighbours(words: DataFrame, ratio: int, limit: int) -> DataFrame:
    """For each word and partition: its near words and, where the most
    frequent of them has ``ratio`` times its occurrences, that one (all ties,
    in further rows)."""
    prepare(words.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["rid", "n_near", "form_n", "form_rid"]
            )

        for found in _composed(batches):
            count: Counter[int] = Counter()
            best: dict[int, tuple[int, list[int]]] = {}
            for a, b in found:
                for x, y in ((a, b), (b, a)):
                    count[x[2]] += 1
                    if y[3] >= ratio * x[3]:
                        n, rids = best.get(x[2], (0, []))
                        if y[3] > n:
                            best[x[2]] = (y[3], [y[2]])
                        elif y[3] == n:
                            rids.append(y[2])
            for rid, n in count.items():
                form_n, rids = best.get(rid, (None, [None]))
                out += [(rid, 0 if i else n, form_n, r) for i, r in enumerate(rids)]
            if len(out) > 5000:
                yield batch()
                out.clear()
        yield batch()

    return _partitions(words, limit).mapInArrow(run, "rid long, n_near long, form_n long, form_rid long")


def group(vocabulary: DataFrame, ratio: int = 10, limit: int = LIMIT) -> DataFrame:
    """Each word (word, n) with its form: the near word of most occurrences
    (ties: the smallest in code-point order) if they are ``ratio`` times its
    own; and its root, reached over forms of forms. ``ratio`` is 2 or more, so
    that forms can't lead back."""
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    words = written(vocabulary.select("word", "n").withColumn("rid", F.monotonically_increasing_id()), "variants-words")
    found = written(_neighbours(words, ratio, limit), "variants-near")
    counts = found.groupBy("rid").agg(F.sum("n_near").alias("n_near"))
    candidate = found.filter("form_rid is not null").select("rid", "form_n", "form_rid")
    names = words.select(F.col("rid").alias("form_rid"), F.col("word").alias("form"))
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form", "form_rid"))
    forms = written(
        candidate.join(names, "form_rid").groupBy("rid").agg(best.alias("b"))
        .select("rid", F.col("b.form").alias("form"), F.col("b.form_rid").alias("root_rid"), (-F.col("b.less")).alias("form_n")),
        "variants-forms",
    )
    top = words.agg(F.max("n")).head()[0] or 1
    # a form has ``ratio`` times the occurrences: so many steps at most, doubled each round
    steps = max(0, math.ceil(math.log(top, ratio)))
    roots = forms.select("rid", "root_rid")
    for _ in range(math.ceil(math.log2(steps + 1))):
        onward = roots.select(F.col("rid").alias("root_rid"), F.col("root_rid").alias("further"))
        roots = written(
            roots.join(onward, "root_rid", "left").select("rid", F.coalesce("further", "root_rid").alias("root_rid")),
            "variants-roots",
        )
    last = words.select(F.col("rid").alias("root_rid"), F.col("word").alias("root"))
    named = forms.drop("root_rid").join(roots, "rid").join(last, "root_rid").drop("root_rid")
    return (
        words.join(counts, "rid", "left").join(named, "rid", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")
    )
