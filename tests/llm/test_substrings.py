import hashlib
import random
import re

import numpy as np
import pytest

from revcast.llm import substrings as S

from .fixtures import AWKWARD, SCHEMA, collected, frame, prose

SPLIT = re.compile("[^\x20\x09-\x0d]+")


def brute(docs, window=50):
    words = [(i, SPLIT.findall(t or "")) for i, t in docs]
    first = {}
    for i, w in words:
        if i is not None:
            for a in range(len(w) - window + 1):
                key = tuple(w[a : a + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        if i is not None:
            for a in range(len(w) - window + 1):
                if first[tuple(w[a : a + window])] < i:
                    gone.update(range(a, a + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def documents():
    rng = random.Random(11)
    base = prose(rng, 400).split()
    docs = list(AWKWARD)
    for i in range(30):
        a = rng.randrange(300)
        n = rng.choice([48, 49, 50, 51, 60, 99])
        docs.append((100 + i, prose(rng, rng.randrange(60)) + " " + " ".join(base[a : a + n]) + "\n" + prose(rng, rng.randrange(60))))
    whole = " ".join(base)
    docs += [(50, whole), (51, whole), (51, whole), (52, whole.replace("red", "RED")), (53, " ".join(base[::-1]))]
    docs += [(60, "a " * 49), (61, "a " * 50), (62, "a " * 120), (63, "b a " * 60), (64, "a b " * 200), (65, "a b c " * 90), (66, "b c a " * 60)]
    docs += [(70, " ".join([prose(rng, 10)] * 40)), (None, whole), (49, None)]
    docs += [(71, docs[-3][1] + " tail"), (72, prose(rng, 700)), (73, prose(rng, 30) + " " + whole + " " + prose(rng, 3) + " " + whole)]
    return docs


COLUMNS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def test_against_brute_force(spark):
    docs = documents()
    assert collected(S.dedup(frame(spark, docs).repartition(4)), *COLUMNS) == brute(docs)


def test_short_windows_over_few_words(spark):
    rng = random.Random(12)
    docs = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(80)))) for i in range(40)]
    assert collected(S.dedup(frame(spark, docs), window=20), *COLUMNS) == brute(docs, 20)


def test_slices_of_long_texts_agree(spark, monkeypatch):
    rng = random.Random(13)
    base = prose(rng, 900)
    items = [base.encode(), (prose(rng, 7) + " " + base).encode()]
    want = [sorted({(c, s) for c, s, _, _ in anchors}) for _, _, anchors in S.parse(items, 50)]
    windows = {c for c, _ in want[0]}
    assert len(windows - {c for c, _ in want[1]}) <= 2  # all but the ends agree
    monkeypatch.setattr(S, "SLICE", 64)
    covered = [0, 0]
    for d, (_, _, anchors) in enumerate(S.parse(items, 50)):
        for _, _, first, last in anchors:
            covered[d] += last - first + 1
        assert {c for c, _, _, _ in anchors} == {c for c, _ in want[d]}
    assert covered == [851, 858]


def test_kept_text_and_empty_table(spark):
    docs = [(1, "x " * 60), (2, "head " + "x " * 60 + "tail")]
    rows = {r["doc_id"]: r["kept"] for r in S.dedup(frame(spark, docs)).collect()}
    assert rows == {1: None, 2: "head tail"}
    assert S.dedup(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("letters", [2, 5, 1000])
def test_equal_windows_choose_equal_symbols(letters):
    rng = np.random.default_rng(letters)
    word = rng.integers(0, letters, 3000).astype(np.uint64)
    word[2000:2600] = word[100:700]
    word = S.mix(word)
    doc = np.zeros(3000, np.int64)
    start = np.arange(2951)
    _, left, right = S.choose(word, doc, start, 50)
    assert ((left >= start) & (right <= start + 50)).all()
    assert (left[100:651] - start[100:651] == left[2000:2551] - start[2000:2551]).all()
    assert (right[100:651] - start[100:651] == right[2000:2551] - start[2000:2551]).all()
