import hashlib
import random
import re

from revcast.llm import decontaminate as D

from .fixtures import AWKWARD, SCHEMA, collected, frame, prose

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ITEMS = "item_id long, text string, n_words string"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(docs, items, window=13):
    out = []
    for i, t in docs:
        w, hit, own = WORD.findall(lower(t)), set(), set()
        for item, s in items:
            v = WORD.findall(lower(s))
            n = min(window, len(v))
            for a in range(len(v) - n + 1 if n else 0):
                for b in range(len(w) - n + 1):
                    if w[b : b + n] == v[a : a + n]:
                        hit.update(range(b, b + n))
                        own.add(str(item))
        digest = hashlib.sha256(",".join(sorted(own)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(own), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def cases():
    rng = random.Random(3)
    items = [(10, prose(rng, 30)), (2, prose(rng, 13)), (3, "Short ONE, here"), (4, None), (5, " ..."), (6, "x " * 20)]
    items.append((11, items[0][1]))
    passage = items[0][1].split()
    docs = AWKWARD + [
        (20, items[0][1].upper()),
        (21, prose(rng, 300) + " " + " ".join(passage[5:20]) + " " + prose(rng, 20)),
        (22, prose(rng, 40) + "... short,one;HERE ... " + prose(rng, 500)),
        (23, "x " * 50),
        (24, "xx " * 13 + "shortone here"),
        (25, (prose(rng, 2000) + " " + items[1][1] + "\n") * 5),
    ]
    return docs, items


def test_against_brute_force(spark):
    docs, items = cases()
    got = D.report(frame(spark, docs), spark.createDataFrame([(i, t, "z") for i, t in items], ITEMS))
    assert collected(got, *COLUMNS) == brute(docs, items)


def test_several_automata_give_the_same(spark, monkeypatch):
    docs, items = cases()
    monkeypatch.setattr(D, "AUTOMATON_BYTES", 40)
    got = D.report(frame(spark, docs), spark.createDataFrame([(i, t, "z") for i, t in items], ITEMS))
    assert collected(got, *COLUMNS) == brute(docs, items)


def test_spans_point_into_the_original_text(spark):
    text = "Über — the  QUICK, brown… fox; jumps"
    found = D.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(1, "quick BROWN… fox")], "item_id long, text string")).first()
    (hit,) = found["hits"]
    assert text[hit["first_char"] : hit["last_char"]] == "QUICK, brown… fox"
    assert (hit["first_word"], hit["last_word"]) == (3, 5)


def test_empty_tables_and_unchanged_columns(spark):
    docs, items = cases()
    none = spark.createDataFrame([], ITEMS)
    assert D.report(spark.createDataFrame([], SCHEMA), none).count() == 0
    own = D.clean(frame(spark, docs), none)
    assert own.columns == frame(spark, docs).columns and own.count() == len(docs)
    kept = D.clean(frame(spark, docs), spark.createDataFrame([(i, t, "z") for i, t in items], ITEMS))
    bad = sum(r[-1] for r in brute(docs, items))
    assert kept.count() == len(docs) - bad and {r["row"] for r in kept.collect()} == {"c"}


def test_clean_passes_each_text_once(spark):
    docs, items = cases()
    items = spark.createDataFrame([(i, t, "z") for i, t in items], ITEMS)
    kept = D.clean(frame(spark, docs).drop("score").withColumnRenamed("text", "body"), items, "body")
    assert kept.columns == [c if c != "text" else "body" for c in SCHEMA.replace(",", "").split()[::2][:-1]]
    kinds = dict(kept.dtypes)
    assert kinds["doc_id"] == "bigint" and kinds["body"] == "string" and kinds["n_words"] == "string"
    bad = {r[0] for r in brute(docs, items=[(r["item_id"], r["text"]) for r in items.collect()]) if r[-1]}
    got = sorted((r["body"] for r in kept.collect() if r["body"] is not None), key=repr)
    assert got == sorted((t for i, t in docs if t is not None and i not in bad), key=repr)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    # the rows' own columns go to Python, and no second copy of the text
    assert "struct" not in plan
