import collections
import math
import random

from pyspark.sql import functions as F

from revcast.llm import toxicity as T
from revcast.llm.grams import Grams
from revcast.llm.queries import held_out

from .fixtures import AWKWARD, SCHEMA, frame, prose


def grams_of(text, order):
    out = []
    for w in "".join(c if c.isalnum() else " " for c in text.lower()).split():
        s = " " + w + " "
        out += [s[max(0, i - order + 1) : i + 1] for i in range(1, len(s))]
    return out


def packed(g):
    return int.from_bytes(g.encode(), "big")


def test_grams_are_those_of_each_word():
    texts = ["Hello, big world", "", "a", None, "one  two"]
    got = Grams([t.encode() if t else t for t in texts], 4)
    for d, t in enumerate(texts):
        own = got.code[got.first[d] : got.first[d + 1]].tolist()
        assert own == [packed(g) for g in grams_of(t or "", 4)]
    assert got.words.tolist() == [0, 3, 3, 4, 4, 6]


def test_probabilities_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(" ".join("".join(rng.choice("ab") for _ in range(rng.randrange(1, 6))) for _ in range(8)), rng.randrange(2)) for _ in range(12)]
    counts = T.count(spark.createDataFrame(rows, "text string, toxic int")).cache()
    n = {c: collections.Counter(g for t, x in rows if x == c for g in grams_of(t, T.ORDER)) for c in (0, 1)}
    got = {r["gram"]: (r["toxic"], r["plain"]) for r in counts.collect()}
    assert got == {packed(g): (n[1][g], n[0][g]) for g in n[0] | n[1]}

    tops = set(n[0]) | set(n[1])
    kinds = {T.ORDER: {g for g in tops if len(g) == T.ORDER}}
    cont = {}
    for m in range(T.ORDER - 1, 0, -1):
        cont[m] = collections.Counter(g[1:] for g in kinds[m + 1])
        kinds[m] = {g for g in tops if len(g) == m} | set(cont[m])

    def shared(g):
        if not g:
            return 1 / 256
        c = cont[len(g)]
        same = {h: k for h, k in c.items() if h[:-1] == g[:-1]}
        if not same:
            return 1 / 256
        total = sum(same.values())
        return (max(c[g] - T.DISCOUNT, 0) + T.DISCOUNT * len(same) * shared(g[1:])) / total

    def p(g, c):
        same = {h: k for h, k in n[c].items() if h[:-1] == g[:-1]}
        if not same:
            return shared(g[1:])
        total = sum(same.values())
        return max(n[c][g] - T.DISCOUNT, 0) / total + T.DISCOUNT * len(same) / total * shared(g[1:])

    seen, _ = T.evidence(counts)
    for r in seen.collect():
        g = r["gram"].to_bytes(8, "big").lstrip(b"\0").decode()
        assert math.isclose(r["evidence"], math.log(p(g, 1) / p(g, 0)), rel_tol=1e-9, abs_tol=1e-9), g


def learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    return docs, labels, T.learn(docs.filter(~held_out()), labels)


def test_held_out_accuracy_and_planted_documents(spark):
    docs, labels, model = learned(spark)
    rows = T.score(docs.filter(held_out()), model).join(labels, "doc_id").select("toxicity", "toxic").collect()
    # some 5 % of the toxic labels have no expression behind them
    toxic = [r["toxicity"] >= 0.5 for r in rows if r["toxic"]]
    plain = [r["toxicity"] >= 0.5 for r in rows if not r["toxic"]]
    assert sum(toxic) >= 0.7 * len(toxic) and sum(plain) <= 0.03 * len(plain)
    clean = docs.join(labels.filter("toxic = 0"), "doc_id").filter(held_out() & (F.col("lang") == "en")).select("text").limit(40).collect()
    planted = []
    for i, r in enumerate(clean):
        words = r["text"].split(" ")
        for k in range(0, len(words), 40):
            words.insert(k, ("idiot", "worthless", "scum")[k // 40 % 3])
        planted.append((i, " ".join(words)))
    got = [r["toxicity"] for r in T.score(frame(spark, planted), model).collect()]
    assert sum(s >= 0.5 for s in got) >= 38


def test_awkward_rows(spark):
    rng = random.Random(4)
    learn = [(i, prose(rng, 30) + (" vile scum" if i % 3 == 0 else "")) for i in range(90)] + AWKWARD
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)] + [(3, 1), (None, 1), (4, None), (5, 7)], "doc_id long, toxic int")
    model = T.learn(frame(spark, learn), labels)
    rows = T.score(frame(spark, AWKWARD + [(90, "scum vile scum"), (91, prose(rng, 40) + " " + "calm " * 20000)]), model)
    assert "n_words" in rows.columns and rows.count() == len(AWKWARD) + 2
    by = {r["doc_id"]: r["toxicity"] for r in rows.collect()}
    assert all(0 <= s <= 1 for s in by.values()) and by[90] > 0.5 > by[91] and by[1] == by[2] == by[3]
    assert T.score(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert T.learn(frame(spark, AWKWARD), empty) is None
    assert {r["toxicity"] for r in T.score(frame(spark, AWKWARD), None).collect()} == {0.0}


def many_words(spark):
    """Learning rows with some 200,000 distinct grams."""
    rng = random.Random(6)
    return [(" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(400)), i % 2) for i in range(100)]


def test_every_gram_keeps_its_evidence(spark):
    counts = T.count(spark.createDataFrame(many_words(spark), "text string, toxic int")).cache()
    model, (seen, other) = T.model_of(counts), T.evidence(counts)
    for table, rows in zip(model.held, (seen, other)):
        want = {r["gram"]: r["evidence"] for r in rows.collect()}
        code = T.np.array(list(want), T.U64)
        value, known = T._look(table, code)
        assert known.all() and T.np.allclose(value, list(want.values()), atol=1e-9)
    assert len(model.held[0][0]) > 150_000


def test_joined_model_scores_alike(spark, monkeypatch):
    rng = random.Random(5)
    learn = [(i, prose(rng, 30) + (" vile scum" if i % 3 == 0 else "")) for i in range(90)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int")
    rows = frame(spark, AWKWARD + learn + [(200, "vile " * 3000), (201, "x" * 5000 + " scum")])
    out = []
    for most in (T.HELD_MODEL, 0):
        monkeypatch.setattr(T, "HELD_MODEL", most)
        model = T.learn(frame(spark, learn), labels)
        assert (model.held is None) == (most == 0)
        out.append(sorted((r["doc_id"] or -1, r["text"] or "", r["toxicity"]) for r in T.score(rows, model).collect()))
    assert [r[:2] for r in out[0]] == [r[:2] for r in out[1]] and len(out[0]) == rows.count()
    assert all(math.isclose(a[2], b[2], abs_tol=1e-6) for a, b in zip(*out))


def test_documents_of_the_curve_are_counted_too(spark):
    rng = random.Random(7)
    part = {r["id"] for r in spark.range(400).filter(F.pmod(F.xxhash64("id"), F.lit(T.FIT_PART)) == 0).collect()}
    # each part has an expression of its own
    learn = [(i, prose(rng, 30) + (" " if i % 3 else " qzjvx qzjvx" if i in part else " vile scum")) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)], "doc_id long, toxic int")
    model = T.learn(frame(spark, learn), labels)
    word = T.of(model.held, Grams([b"qzjvx"], T.ORDER))
    assert word[0] > T.STRONG
    counted = {r["gram"] for r in model.seen.select("gram").collect()}
    assert {packed(g) for _, t in learn for g in grams_of(t, T.ORDER)} == counted


def test_the_model_takes_few_tasks(spark):
    """The driver keeps each task and plan of a run: a shuffle of every length
    again in each of its plans, with 211 partitions, filled its memory."""
    counts = T.written(T.count(spark.createDataFrame(many_words(spark)[:10], "text string, toxic int")), "test-counts")
    changed = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before, status = {k: spark.conf.get(k) for k in changed}, spark.sparkContext.statusTracker()
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("few-tasks", "few-tasks")
        T.shared(counts)
        stages = {i for j in status.getJobIdsForGroup("few-tasks") for i in status.getJobInfo(j).stageIds}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    shuffled = [i for i in map(status.getStageInfo, stages) if i and i.numTasks == 16 and i.numCompletedTasks]
    assert 0 < len(shuffled) <= 16
