import random
import re

import numpy as np

from revcast.llm import neardup as N

from .fixtures import AWKWARD, SCHEMA, collected, frame, prose
from .test_decontaminate import lower

SPLIT = re.compile("[^\x20\x09-\x0d]+")


def shingles(t):
    w = SPLIT.findall(lower(t))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs):
    """Components over distinct (id, text); ids of equal text are one."""
    sets = [(i, shingles(t)) for i, t in docs]
    smallest = {}
    for i, s in sets:
        if i is not None and s:
            key = frozenset(s)
            smallest[key] = min(smallest.get(key, i), i)
    group = {i: i for i in smallest.values()}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    known = list(smallest.items())
    for a, (s, i) in enumerate(known):
        for t, j in known[:a]:
            both = len(s & t)
            if 100 * both >= 75 * (len(s) + len(t) - both):
                x, y = sorted((top(i), top(j)))
                group[y] = x
    out = []
    for i, s in sets:
        c = i if i is None or not s else top(smallest[frozenset(s)])
        out.append((i, len(s), c, i is None or c == i))
    return sorted(out, key=repr)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def documents():
    rng = random.Random(21)
    docs, at = list(AWKWARD), 100
    for size in (6, 20, 80, 300, 1500):
        for _ in range(3):
            base = prose(rng, size).split()
            for edits in (0, 0, 1, 1, 2, 3, size // 60, size // 40, size // 30, size // 20, size // 10, size // 5):
                docs.append((at, edited(rng, base, edits)))
                at += 1
    passage = prose(rng, 60)
    docs += [(at + i, prose(rng, 25 + i) + " " + passage) for i in range(60)]
    docs += [(at + 100, " ".join(docs[-1][1].upper().split(" "))), (5, "?!\n\n--"), (at + 200, docs[-1][1] + " x")]
    return docs


COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def test_against_brute_force(spark):
    docs = documents()
    assert collected(N.cluster(frame(spark, docs).repartition(5)), *COLUMNS) == brute(docs)


def test_lists_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 4)
    docs = documents()
    assert collected(N.cluster(frame(spark, docs).repartition(5)), *COLUMNS) == brute(docs)


def test_early_look_passes_what_the_second_signature_passes():
    rng = np.random.default_rng(3)
    for _ in range(300):
        items = rng.integers(0, 2**63, 700).astype(np.uint64)
        # 600 of 800 in common: exactly at the threshold
        a, b = np.sort(items[:700]), np.sort(np.concatenate((items[:600], rng.integers(0, 2**63, 100).astype(np.uint64))))
        fine = N._packed(N.mix(N.signatures([a, b], N.FINE, 52)))
        words = N.EARLY // 16
        assert N._equal_values(fine[0], fine[1:])[0] >= N.FINE_MATCHES
        assert N._equal_values(fine[0, :words], fine[1:, :words])[0] >= N.EARLY_MATCHES


def test_large_group_of_near_copies(spark):
    rng = random.Random(22)
    base = prose(rng, 120).split()
    docs = [(i, edited(rng, base, rng.randrange(14))) for i in range(400, 0, -1)]
    assert collected(N.cluster(frame(spark, docs)), *COLUMNS) == brute(docs)


def test_one_of_each_group_stays(spark):
    docs = documents()
    kept = N.keep_one(frame(spark, docs))
    assert kept.columns == frame(spark, docs).columns
    got = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    stays = {r[0] for r in brute(docs) if r[3]}
    want = sorted({(i, t) for i, t in docs if i is not None and i in stays}, key=repr)
    assert [i for i in got if i is not None and i != 7] == sorted((i for i, _ in want if i != 7), key=repr)
    assert got.count(None) == 2


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(60, 61), (63, 61)], "a long, b long")
    got = {r["node"]: r["component"] for r in N.components(links).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[61] == got[63] == got[60] == 60 and len(got) == 44
    nodes = spark.createDataFrame([(i,) for i in range(70)], "node long")
    label = N.rooted(nodes, links.filter("a < 60"))
    got = {r["node"]: r["component"] for r in N.merged(label, links).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[61] == got[63] == got[60] == 60 and got[65] == 65 and len(got) == 70


def test_texts_are_sifted_before_the_shuffle_however_large_the_other_side(spark, monkeypatch):
    plans, candidates = [], N._candidates

    def seen(rows):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return candidates(rows)

    monkeypatch.setattr(N, "_candidates", seen)
    changed = {"spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1b", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in changed}
    docs = documents()
    source = N.written(frame(spark, docs), "test-documents")
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        assert collected(N.cluster(source), *COLUMNS) == brute(docs)
        assert {k: spark.conf.get(k) for k in changed} == changed
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(plans) == 1 and "might_contain" in plans[0]


def test_the_filter_of_texts_is_as_large_as_its_keys(spark):
    bits, first = "spark.sql.optimizer.runtime.bloomFilter.numBits", spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.numBits")
    for keys, least, most in ((0, 1, 1 << 13), (20_000, 160_000, 320_000), (10**9, 1 << 25, 1 << 25)):
        with N.sifting(spark, keys):
            assert least <= int(spark.conf.get(bits)) <= most
    assert spark.conf.get(bits) == first


def test_empty_table(spark):
    assert N.cluster(spark.createDataFrame([], SCHEMA)).count() == 0


def test_equal_coarse_bits_of_different_values_hide_no_pair():
    def member(node, first):
        values = N.np.array([first, *range(1, 33)], N.np.int64)
        return {"node": node, "component": node, "coarse": bytes(64), "fine": bytes(8 * 48), "mask": (1 << 33) - 1, "values": values.tobytes()}

    # coordinate 0 has other values of the same 8 bits; 1 is the first shared
    x = N._unpacked([member(1, 100), member(2, 200)])
    found = {c: list(zip(*(z.tolist() for z in N._agreeing(c, x, x)))) for c in range(33)}
    assert found == {c: [(1, 2)] if c == 1 else [] for c in range(33)}
