"""Near-duplicate documents: inverted join on MinHash signature coordinates.

A document is the set of its distinct five-word shingles. Documents with the
same set form a class and go on as one. Every class is posted under each
(coordinate, value) pair of its signature; lists of one member are dropped,
and so are classes left with fewer than ``MATCHES`` posted coordinates, which
no partner can reach. Collisions are then counted in two steps:

1. *Star.* Each class is compared with the smallest member of its lists that
   it meets most often. Confirmed links give components.
2. *Prefix and skip.* Two classes with ``MATCHES`` equal coordinates share one
   of the ``COORDINATES - MATCHES + 1`` rarest of each. Only these lists are
   merged, and lists whose members are one component already are skipped.
   Members of a list meet in blocks of about ``BLOCK``; pairs of different
   components whose signatures agree often enough come out, each in one list
   only.

Every link is confirmed on the full sets: 100 * intersection >= 75 * union.
At exactly that similarity a pair has at least ``MATCHES`` of 64 equal
coordinates but for 2 in a million pairs, and passes the second signature
(768 coordinates of 4 bits) but for 4 in a million, and the 192 of them that
are looked at first but for far fewer; above it, fewer.

Defined results: null and wordless texts have an empty set and are linked
with nothing; one to four words are one shingle; rows without id are linked
with nothing (component null); of rows that share an id each is linked by its
own text; repeated rows each come back; other columns are ignored.

Scale: signatures are made where documents are read. Postings are counted
with partial sums before the shuffle; joins on them are plain equi-joins that
adaptive execution splits at hot keys. No list is gathered whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, U64, Words, blocks, discard, mix, prepare, seeds, sifting, texts, window_hashes, written

SHINGLE = 5
#: Links have PER_CENT * union <= 100 * intersection.
PER_CENT = 75
COORDINATES = 64
#: Least number of equal coordinates of a pair that is looked at: at the
#: threshold 48 are expected, with a standard deviation of 3.5.
MATCHES = 32
#: Coordinates of the second signature (4 bits each) and the least number
#: equal: at the threshold 588 are expected, with a deviation of 11.7.
FINE = 768
FINE_MATCHES = 535
#: Of these, the first are looked at before the others: 147 of 192 are
#: expected equal at the threshold, with a deviation of 5.9.
EARLY = 192
EARLY_MATCHES = 112
#: Members of a list that meet at once.
BLOCK = 256

_SIGNED = "doc_id long, version long, n_shingles long, class binary, signature array<long>"


def shingle_sets(items: list[bytes | None], n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words([t.translate(LOWER) if t else t for t in items])
    name = words.hashes(3)
    whole = window_hashes(name, n, 41)
    out = []
    for d in range(len(items)):
        a, b = words.first[d], words.first[d + 1]
        if b - a >= n:
            out.append(np.unique(whole[a : b - n + 1]))
        elif b > a:
            whole_text = np.array([b - a], U64)
            for i in range(a, b):
                whole_text = mix(whole_text * U64(0x9E3779B97F4A7C15) ^ name[i : i + 1])
            out.append(whole_text)
        else:
            out.append(np.zeros(0, U64))
    return out


def signatures(sets: list[np.ndarray], n: int, salt: int) -> np.ndarray:
    """Row per set (none empty): the smallest hash under each of ``n`` keys."""
    sizes = np.array([len(s) for s in sets])
    first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    items, out = np.concatenate(sets), np.empty((len(sets), n), U64)
    for i, k in enumerate(seeds(n, salt)):
        out[:, i] = np.minimum.reduceat((items ^ (k >> U64(5))) * k, first)
    return out


def _signed(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = texts(batch.column(2))
            for a, b in blocks(items):
                sets = shingle_sets(items[a:b])
                full = [s for s in sets if len(s)]
                signature = iter(mix(signatures(full, COORDINATES, 51)).view(np.int64).tolist() if full else [])
                cols = [
                    batch.column(0)[a:b],
                    batch.column(1)[a:b],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s, digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(signature) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "version", "n_shingles", "class", "signature"])

    return rows.mapInArrow(run, _SIGNED)


_FULL = (
    "node long, items binary, fine binary, star long, "
    "prefix array<struct<coordinate:int,value:long>>, coarse binary, mask long, values binary"
)


def _packed(values: np.ndarray) -> np.ndarray:
    """Four bits of each value, 16 values to a word."""
    bits = (values & U64(15)).reshape(len(values), -1, 16)
    return (bits << (U64(4) * np.arange(16, dtype=U64))).sum(2, dtype=U64)


def _equal_values(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of equal four-bit values of ``x`` and each row of ``y``."""
    apart = x ^ y
    apart |= apart >> U64(2)
    apart = (apart | apart >> U64(1)) & U64(0x1111111111111111)
    return 16 * y.shape[1] - np.bitwise_count(apart).sum(1, dtype=np.int64)


def _candidates(rows: DataFrame) -> DataFrame:
    """Sets and signatures of the classes that may have partners; rows are
    (node, text, posted coordinates)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in ("node", "items", "fine", "star", "prefix", "coarse", "mask", "values")]
        prefix_kind = pa.list_(pa.struct([("coordinate", pa.int32()), ("value", pa.int64())]))
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), prefix_kind, pa.binary(), pa.int64(), pa.binary()]
        for batch in batches:
            items = texts(batch.column(1))
            nodes, posted = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for a, b in blocks(items):
                sets = shingle_sets(items[a:b])
                fine = _packed(mix(signatures(sets, FINE, 52)))
                coarse = (mix(signatures(sets, COORDINATES, 51)) >> U64(56)).astype(np.uint8)
                out = []
                for i, own in enumerate(sets):
                    node, lists = nodes[a + i], posted[a + i]
                    lists.sort(key=lambda p: (p["members"], p["coordinate"], p["value"]))
                    meets: dict[int, int] = {}
                    for p in lists:
                        meets[p["center"]] = meets.get(p["center"], 0) + 1
                    meets.pop(node, None)
                    star = max(meets, key=lambda c: (meets[c], -c), default=None)
                    # coordinates posted by nobody else are the rarest
                    prefix = lists[: max(0, COORDINATES - MATCHES + 1 - (COORDINATES - len(lists)))]
                    mask = sum(1 << p["coordinate"] for p in prefix)
                    values = np.array([p["value"] for p in sorted(prefix, key=lambda p: p["coordinate"])], np.int64)
                    out.append((
                        node, own.tobytes(), fine[i].tobytes(), star,
                        [{"coordinate": p["coordinate"], "value": p["value"]} for p in prefix],
                        coarse[i].tobytes(), mask - (1 << 64) if mask >= 1 << 63 else mask, values.tobytes(),
                    ))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    return rows.mapInArrow(run, _FULL)


def _confirmed(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                p, q = np.frombuffer(x, U64), np.frombuffer(y, U64)
                if 100 * min(len(p), len(q)) < PER_CENT * max(len(p), len(q)):
                    continue
                both = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * both >= PER_CENT * (len(p) + len(q) - both):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in (0, 1)], ["a", "b"])

    left = full.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = full.select(F.col("node").alias("b"), F.col("items").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def rooted(nodes: DataFrame, star: DataFrame) -> DataFrame:
    """(node, component): the smallest partner of each node, that one's own
    partner, and so on for two jumps. Members of one component may still
    differ, never members of two."""
    up = star.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up"))
    label = written(
        nodes.join(up, "node", "left").select("node", F.least("node", F.coalesce("up", "node")).alias("component")),
        "neardup-roots",
    )
    above = label.select(F.col("node").alias("component"), F.col("component").alias("higher"))
    for _ in range(2):
        label = label.join(above, "component").select("node", F.col("higher").alias("component"))
    return written(label, "neardup-roots")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``links`` (a, b): the smallest node
    reachable.

    Each round takes the smallest component among the neighbours and then
    that component's own, so pointers double: the number of rounds grows with
    the logarithm of a component's width."""
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    label = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("component")), "components")
    while True:
        near = both.join(label.select(F.col("node").alias("b"), F.col("component").alias("near")), "b").select(
            F.col("a").alias("node"), "near"
        )
        hooked = label.select("node", F.col("component").alias("near"), F.col("component").alias("old"))
        hooked = hooked.unionByName(near.withColumn("old", F.lit(None).cast("long")))
        hooked = hooked.groupBy("node").agg(F.min("near").alias("component"), F.max("old").alias("old"))
        own = label.select(F.col("node").alias("component"), F.col("component").alias("next"))
        jumped = hooked.join(own, "component").select("node", F.least("component", "next").alias("component"), "old")
        moved = written(jumped.withColumn("moved", F.col("component") != F.col("old")), "components")
        label = moved.select("node", "component")
        if moved.filter("moved").isEmpty():
            return label


def merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` with the components that ``links`` join made one."""
    of = label.select(F.col("node").alias("a"), F.col("component").alias("x"))
    to = label.select(F.col("node").alias("b"), F.col("component").alias("y"))
    between = links.join(of, "a").join(to, "b").filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    whole = components(between).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    return label.join(whole, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))


def _open_pairs(full: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs of different components that share a list of their prefixes and
    agree in enough coordinates; each pair comes from one list only."""
    member = full.select("node", F.explode("prefix").alias("p")).select("node", "p.*").join(label, "node")
    key = ["coordinate", "value"]
    lists = member.groupBy(*key, "component").agg(F.count("*").alias("own"))
    lists = (
        lists.groupBy(*key)
        .agg(F.sum("own").alias("members"), F.count("*").alias("components"))
        .filter("components > 1")
        .select(*key, F.ceil(F.col("members") / BLOCK).cast("int").alias("parts"))
    )
    lists = written(lists, "neardup-lists")
    body = full.select("node", "coarse", "fine", "mask", "values")
    block = (
        member.join(lists, key)
        .join(body, "node")
        .withColumn("part", F.pmod(F.xxhash64("node", "coordinate"), F.col("parts")).cast("int"))
        .groupBy(*key, "parts", "part")
        .agg(F.collect_list(F.struct("node", "component", "coarse", "fine", "mask", "values")).alias("members"))
    )
    block = written(block, "neardup-blocks")
    # a block meets itself, and the others of its list, if it isn't the only one
    several = block.filter("parts > 1")
    other = several.select(*key, F.col("part").alias("part2"), F.col("members").alias("members2"))
    pairs = block.select("coordinate", "members", F.lit(None).cast(block.schema["members"].dataType).alias("members2"))
    pairs = pairs.unionByName(several.join(other, key).filter("part < part2").select("coordinate", "members", "members2"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found_a, found_b = [], []
            for k in range(batch.num_rows):
                x = _unpacked(batch.column(1)[k].as_py())
                y = _unpacked(batch.column(2)[k].as_py()) if batch.column(2)[k].is_valid else x
                a, b = _agreeing(batch.column(0)[k].as_py(), x, y)
                found_a.append(a)
                found_b.append(b)
            a = np.concatenate(found_a or [np.zeros(0, np.int64)])
            b = np.concatenate(found_b or [np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return pairs.mapInArrow(run, "a long, b long").distinct()


def _unpacked(members: list[dict]):
    mask = np.array([m["mask"] for m in members], np.int64)
    # values of the prefix at their coordinates
    values = np.zeros((len(members), COORDINATES), np.int64)
    values[np.unpackbits(mask[:, None].view(np.uint8), axis=1, bitorder="little").astype(bool)] = np.frombuffer(
        b"".join(m["values"] for m in members), np.int64
    )
    return (
        np.array([m["node"] for m in members], np.int64),
        np.array([m["component"] for m in members], np.int64),
        np.frombuffer(b"".join(m["coarse"] for m in members), np.uint8).reshape(len(members), -1),
        np.frombuffer(b"".join(m["fine"] for m in members), U64).reshape(len(members), -1),
        mask.view(U64),
        values,
    )


def _agreeing(coordinate: int, x, y) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of two blocks, smaller node first."""
    bit, found, words = U64(1) << np.arange(COORDINATES, dtype=U64), [], EARLY // 16
    early = np.ascontiguousarray(y[3][:, :words])
    for i in range(len(x[0])):
        j = np.flatnonzero((y[1] != x[1][i]) & (y[0] > x[0][i]) if x[0] is y[0] else y[1] != x[1][i])
        j = j[_equal_values(x[3][i, :words], early[j]) >= EARLY_MATCHES]
        # of the lists that both have in their prefix the first one tells
        shared = ((y[5][j] == x[5][i]) * bit).sum(1, dtype=U64) & y[4][j] & x[4][i]
        j = j[shared & (~shared + U64(1)) == bit[coordinate]]
        j = j[(y[2][j] == x[2][i]).sum(1) >= MATCHES]
        j = j[_equal_values(x[3][i], y[3][j]) >= FINE_MATCHES]
        found.append((np.full(len(j), x[0][i]), y[0][j]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = (np.concatenate(z) for z in zip(*found))
    own = a != b
    return np.minimum(a, b)[own], np.maximum(a, b)[own]


def cluster(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: its id, a hash of its text (``version``), the
    size of its set, the smallest id reachable over links, and whether the row
    is the one to keep."""
    spark = documents.sparkSession
    prepare(spark)
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).select(
        "doc_id", F.xxhash64("text").alias("version"), "text"
    )
    signed = written(_signed(rows), "neardup-signed")
    known = signed.filter(F.col("class").isNotNull() & F.col("doc_id").isNotNull())
    # a class goes on as its smallest document; one set has one signature
    classes = known.groupBy("class").agg(F.min(F.struct("doc_id", "version")).alias("first"), F.first("signature").alias("signature"))
    classes = classes.select("class", F.col("first.doc_id").alias("node"), "first.version", "signature")
    classes = written(classes, "neardup-classes")
    own = ["node", "version"]
    posted = classes.select(*own, F.posexplode("signature").alias("coordinate", "value"))
    lists = (
        posted.groupBy("coordinate", "value")
        .agg(F.count("*").alias("members"), F.min("node").alias("center"))
        .filter("members > 1")
    )
    # written, so that a list of a third of all classes can be split below
    lists = written(lists, "neardup-posted")
    reachable = (
        posted.join(lists, ["coordinate", "value"])
        .groupBy(*own)
        .agg(F.collect_list(F.struct("coordinate", "value", "members", "center")).alias("posted"))
        .withColumn("n", F.size("posted"))
        .filter(F.col("n") >= MATCHES)
    )
    reachable = written(reachable, "neardup-reachable")
    # only texts of such classes are shuffled: the other side is a filtered
    # table, from which Spark makes a Bloom filter for the documents, also if
    # that table is large
    with sifting(spark, reachable.count()):
        picked = rows.withColumnRenamed("doc_id", "node").join(reachable.filter(F.col("n") >= MATCHES), own)
        body = picked.dropDuplicates(own).select("node", "text", "posted")
        full = written(_candidates(body), "neardup-sets")
    discard(lists, reachable)
    star = _confirmed(full.filter("star is not null").select(F.col("node").alias("b"), F.col("star").alias("a")), full)
    star = written(star, "neardup-star")
    nodes = full.select("node").distinct()
    label = rooted(nodes, star)
    more = written(_confirmed(_open_pairs(full, label), full), "neardup-links")
    label = written(merged(label, star.unionByName(more)), "neardup-components")
    of_class = classes.join(label, "node", "left").select(
        "class", F.coalesce("component", "node").alias("component_id")
    )
    return (
        signed.join(of_class, "class", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
        .select(
            "doc_id", "version", "n_shingles", "component_id",
            F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )


def keep_one(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows whose document stays, one row of each such document; rows
    without id stay. Columns unchanged."""
    packed = documents.select(
        F.struct(*documents.columns).alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("version")
    )
    kept = cluster(documents, doc_id, text).filter("kept and doc_id is not null").select("doc_id", "version").distinct()
    out = packed.filter("doc_id is not null").dropDuplicates(["doc_id", "version"]).join(kept, ["doc_id", "version"], "left_semi")
    return out.select("row.*").unionByName(packed.filter("doc_id is null").select("row.*"))
