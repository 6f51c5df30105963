import random
import re

from pyspark.sql import functions as F

from revcast.llm import lines as L

from .fixtures import AWKWARD, SCHEMA, frame, prose


def words(line):
    return [w for w in re.split("[ \t\x0b\f\r]+", line.lower()) if w]


def near(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs):
    seen = sorted({(i, t) for i, t in docs if i is not None and t is not None})
    first = {}
    for i, t in seen:
        for p, line in enumerate(t.split("\n")):
            first.setdefault(tuple(words(line)), []).append((i, t, p))
    for places in first.values():
        places.sort(key=lambda x: (x[0], x[2]))
    place = {w: (p[0][0], p[0][2]) for w, p in first.items()}
    gone = set()
    for w, own in first.items():
        if len(w) >= L.EXACT_WORDS:
            gone.update(own[1:])
        if len(w) >= L.NEAR_WORDS and any(len(v) >= L.NEAR_WORDS and place[v] < place[w] and near(list(v), list(w)) for v in first):
            gone.update(own)
    out = []
    for i, t in docs:
        if t is None or i is None:
            out.append((i, t, 0 if t is None else t.count("\n") + 1, 0))
        else:
            own = t.split("\n")
            kept = [x for p, x in enumerate(own) if (i, t, p) not in gone]
            out.append((i, "\n".join(kept), len(own), len(own) - len(kept)))
    return sorted(out, key=repr)


def documents():
    rng = random.Random(31)
    base = [prose(rng, n) for n in (2, 3, 5, 7, 8, 9, 10, 12, 20, 40)]
    docs = [(i, t) for i, t in AWKWARD if i != 7]
    for i in range(40):
        own = []
        for _ in range(rng.randrange(1, 6)):
            w = rng.choice(base).split()
            what = rng.randrange(6)
            at = rng.randrange(len(w))
            if what == 1:
                w[at] = "changed"
            elif what == 2:
                del w[at]
            elif what == 3:
                w.insert(at, f"new{rng.randrange(3)}")
            elif what == 4:
                w[at], w[0] = f"x{rng.randrange(3)}", "y"
            elif what == 5:
                w = prose(rng, 9).split()
            own.append(rng.choice(["  ", ""]) + rng.choice([" ", "\t "]).join(w))
        docs.append((100 + i, "\n".join(own)))
    same = base[5]
    docs += [(50, f"{same}\n\n{same}\n{same.upper()}\n\n"), (51, "\n".join([same] * 3)), (51, "\n".join([same] * 3))]
    docs += [(52, "the end of it\n" * 200), (53, prose(rng, 800)), (54, "p q p q p q p q p q"), (55, "q p q p q p q p q p")]
    return docs


def test_against_brute_force(spark):
    docs = documents()
    rows = L.dedup(frame(spark, docs).repartition(4)).collect()
    got = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in rows), key=repr)
    assert got == brute(docs)


def test_other_columns_come_back_and_no_python_runs(spark):
    docs = frame(spark, documents())
    out = L.dedup(docs)
    assert out.columns == docs.columns[:5] + docs.columns[5:] or set(docs.columns) <= set(out.columns)
    assert {r["source"] for r in out.collect()} == {"s"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_within_one(spark):
    rng = random.Random(32)
    pairs = []
    for _ in range(400):
        a = [rng.choice("ab") for _ in range(rng.randrange(1, 6))]
        b = list(a)
        for _ in range(rng.randrange(3)):
            op, at = rng.randrange(3), rng.randrange(len(b))
            b = b[:at] + b[at + 1 :] if op == 0 and len(b) > 1 else b[:at] + [rng.choice("ab")] + b[at + (op == 1) :]
        pairs.append((a, b))
    rows = spark.createDataFrame(pairs, "a array<string>, b array<string>")
    for r in rows.select("a", "b", L.within_one(rows.a, rows.b).alias("ok")).collect():
        assert r["ok"] == (r["a"] == r["b"] or near(r["a"], r["b"])), r


def test_empty_table(spark):
    assert L.dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_near_copies_of_a_very_long_line(spark):
    rng = random.Random(33)
    long = prose(rng, 50_000).split()
    other = list(long)
    other[40_000] = "changed"
    docs = [(1, " ".join(long)), (2, "short one\n" + " ".join(other)), (3, " ".join(long[:100] + long[101:])), (4, prose(rng, 70) + "\nend")]
    got = {r["doc_id"]: r["n_removed"] for r in L.dedup(frame(spark, docs)).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0}


def test_variants_of_a_line_have_the_keys_of_what_is_left(spark):
    rng = random.Random(34)
    lines = [[f"w{rng.randrange(3)}" for _ in range(n)] for n in (8, 31, 32, 33, 64, 65, 100)]
    left = [(w, i, w[:i] + w[i + 1 :]) for w in lines for i in range(len(w))]
    rows = spark.createDataFrame(left, "w array<string>, i int, rest array<string>")
    rows = rows.select("i", L._left_out(rows.w).alias("v"), L._left_out(rows.rest)[0].alias("whole"))
    for r in rows.collect():
        v = {x["place"]: (x["h1"], x["h2"]) for x in r["v"]}
        assert v[r["i"]] == (r["whole"]["h1"], r["whole"]["h2"]) and r["whole"]["place"] == -1 and len(v) == len(r["v"])


def test_plain_lines_have_the_words_of_their_lines(spark):
    texts = [t for _, t in documents() if t is not None]
    texts += ["", " ", "\n", " A\tb  C \n\x0b\n d\r\n\r\fE\x0bf \n", "ΟΔΟΣ\nΟΔΟΣ x\u00a0Y  Z\u2028İ", "x" + " " * 500 + "y \t" * 50, "a b\nc d"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = rows.select("text", L.plain_lines(rows.text).alias("plain"), F.transform(F.split("text", "\n"), L.words_of).alias("words"))
    for r in rows.collect():
        assert [x.strip(" ") for x in r["plain"]] == [" ".join(w) for w in r["words"]], r["text"]


def test_short_lines_stay_whatever_their_blanks(spark):
    docs = [(1, "a b c\nd e\n\tx  y \nz"), (2, " a\t b  c \n d  e \nx y\nz")]
    got = {r["doc_id"]: r["text"] for r in L.dedup(frame(spark, docs)).collect()}
    assert got == {1: docs[0][1], 2: " d  e \nx y\nz"}
