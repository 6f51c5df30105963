"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
from collections import Counter, defaultdict

import pytest

from revcast.llm import variants
from revcast.llm.queries import op12_spelling_variants, typo

from .fixtures import AWKWARD, SCHEMA, collected, frame


def counted(docs, damage=None, shortest=7, least=2) -> dict[str, int]:
    counts: Counter[str] = Counter()
    for doc, text in docs:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lower):
            counts[damage("" if doc is None else str(doc))(run) if damage else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}


def neighbours(words) -> dict[str, set[str]]:
    found, rest = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            less = w[:i] + w[i + 1 :]
            rest[i, less].add(w)
            if less in words:
                found[w].add(less)
                found[less].add(w)
    for same in rest.values():
        for w in same:
            found[w] |= same - {w}
    return found


def expected(count: dict[str, int], ratio: int = 10) -> list[tuple]:
    near, form = neighbours(count.keys()), {}
    for w in count:
        if near[w]:
            best = min(near[w], key=lambda x: (-count[x], x))
            if count[best] >= ratio * count[w]:
                form[w] = best
    out = []
    for w, n in count.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), count[form[w]] if w in form else None))
    return sorted(out, key=repr)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def vocabulary(spark, count: dict[str, int]):
    return spark.createDataFrame(list(count.items()), "word string, n long")


@pytest.fixture(scope="module")
def dense():
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.choice((1, 2, 5, 6, 7, 8)))) for _ in range(900)}
    return {w: rng.choice((2, 2, 3, 20, 30, 200, 300, 3000)) for w in sorted(words)}


@pytest.mark.parametrize("limit", [4096, 20, 2])
def test_dense_vocabulary_whatever_the_partitions(spark, dense, limit):
    got = variants.group(vocabulary(spark, dense), limit=limit)
    assert collected(got, *COLUMNS) == expected(dense)


def test_every_pair_comes_once(spark, dense):
    words = vocabulary(spark, dense).selectExpr("*", "xxhash64(word) AS rid")
    names = {r.rid: r.word for r in words.collect()}
    got = [frozenset((names[r.a], names[r.b])) for r in variants.pairs(words, limit=50).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {frozenset((w, x)) for w, xs in neighbours(dense.keys()).items() for x in xs}


def test_composition_of_one_partition():
    got = set(variants.near(["abc", "abd", "xbc"], ["abbc", "abcd", "zabc"], 4))
    assert got == {("abc", "abd"), ("abc", "xbc"), ("abc", "abbc"), ("abc", "abcd"), ("abc", "zabc"), ("abd", "abcd")}


def test_equal_right_languages_are_one_state():
    acceptor = variants.Acceptor()
    start = acceptor.compile(sorted(f"{a}{b}" for a in "abcd" for b in "xyz"))
    assert len(acceptor.arcs) == 3 and len(set(acceptor.arcs[start].values())) == 1


def test_chains_and_ties(spark):
    count = {"letters": 2000, "lettters": 150, "letttters": 10, "better": 3, "betterx": 30, "bettery": 30, "betterz": 3}
    assert collected(variants.group(vocabulary(spark, count)), *COLUMNS) == expected(count)
    assert {r[0]: r[2] for r in expected(count)}["letttters"] == "letters"


def test_very_long_words(spark):
    base = "".join(random.Random(1).choice("abcdefgh") for _ in range(3000))
    count = {base: 500, base[:1700] + base[1701:]: 4, base[:40] + "z" + base[40:]: 30, base[:2999] + "y": 2, base + "q": 5}
    assert collected(variants.group(vocabulary(spark, count)), *COLUMNS) == expected(count)


def test_whole_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert collected(op12_spelling_variants(spark, sf), *COLUMNS) == expected(counted(docs, typo))


def test_awkward_rows(spark):
    texts = AWKWARD + [(9, "Señores señores SEÑORES, señoras señoras señores"), (None, "señores×÷ " * 3), (None, "ABCDEFGH abcdefgh")] * 2
    got = variants.vocabulary(frame(spark, texts), damage=typo)
    assert {r.word: r.n for r in got.collect()} == counted(texts, typo)


def test_empty_table(spark):
    assert variants.group(variants.vocabulary(spark.createDataFrame([], SCHEMA))).collect() == []


def test_a_ratio_that_could_lead_in_circles(spark, dense):
    with pytest.raises(ValueError):
        variants.group(vocabulary(spark, dense), ratio=1)
