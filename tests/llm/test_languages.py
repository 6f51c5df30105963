import random

import numpy as np
from pyspark.sql import functions as F

from revcast.llm import languages as L
from revcast.llm.queries import held_out

from .fixtures import AWKWARD, SCHEMA, frame


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = L.learn(docs.filter(~held_out()))
    test = docs.filter(held_out())
    rows = L.identify(test, model).join(test.select("doc_id", "lang"), "doc_id").collect()
    right = sum(r["lang"] == r["lang_pred"] for r in rows)
    assert len(rows) > 150 and right >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 and abs(sum(x["share"] for x in r["languages"]) - 1) < 1e-6 for r in rows)


def test_mixture_shares(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = L.learn(docs.filter(~held_out()))
    words = {}
    for r in docs.filter(held_out()).filter(F.col("lang").isin("de", "fr")).collect():
        words.setdefault(r["lang"], []).extend(r["text"].split())
    rng = random.Random(1)
    texts = []
    for i, part in enumerate((0.0, 0.2, 0.5, 0.9)):
        n = int(400 * part)
        own = rng.sample(words["de"], n) + rng.sample(words["fr"], 400 - n)
        rng.shuffle(own)
        texts.append((i, " ".join(own)))
    got = {r["doc_id"]: {x["lang"]: x["share"] for x in r["languages"]} for r in L.identify(frame(spark, texts), model).collect()}
    for i, part in enumerate((0.0, 0.2, 0.5, 0.9)):
        assert abs(got[i].get("de", 0) - part) < 0.1, got[i]
    assert set(got[0]) == {"fr"}


def test_em_against_brute_force():
    rng = np.random.default_rng(0)
    like = np.log(rng.random((40, 2)))
    share, total = L.proportions(like)
    grid = np.linspace(0, 1, 2001)
    best = max(grid, key=lambda g: np.log(np.exp(like) @ [g, 1 - g]).sum())
    assert abs(share[0] - best) < 0.05 and np.log(np.exp(like) @ [best, 1 - best]).sum() - total < 0.05


def test_awkward_rows(spark):
    learn = spark.createDataFrame([("guten tag welt", "de"), ("bonjour le monde", "fr"), (None, "de"), ("x", None)], "text string, lang string")
    model = L.learn(learn)
    assert model[0] == ["de", "fr"]
    rows = L.identify(frame(spark, AWKWARD + [(8, "12 34"), (9, "guten tag " * 20000)]), model).collect()
    by = {r["doc_id"]: r["lang_pred"] for r in rows if r["doc_id"]}
    assert len(rows) == len(AWKWARD) + 2
    assert [by[i] for i in (1, 2, 3, 5, 8)] == ["und"] * 5 and by[4] in ("de", "fr") and by[9] == "de"
    assert L.identify(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_nothing_to_learn_from(spark):
    model = L.learn(spark.createDataFrame([], "text string, lang string"))
    assert {r["lang_pred"] for r in L.identify(frame(spark, AWKWARD), model).collect()} == {"und"}
