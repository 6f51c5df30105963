"""Toxicity by class-conditional Kneser-Ney models.

Two models of byte n-grams within words (``grams``), one of toxic and one of
ordinary documents. Both back off to the same lower orders, made from the
continuation counts of both classes together, so an expression that is rare
in a class is smoothed by what is known of its ending everywhere:

    P_class(c | ctx) = max(n_class(ctx c) - D, 0) / n_class(ctx)
                       + D * kinds_class(ctx) / n_class(ctx) * P_shared(c | shorter ctx)

A document's evidence is the difference of its two log-likelihoods divided by
its number of words, once over all words and once over those with strong
evidence. A logistic curve over these turns them into a score. It is fitted on
a sample of the learning documents by the evidence of the others; the model
that scores counts them all.

Unseen grams of a known context get the same shared probability from both
classes, which cancels; so the model is one number for each gram seen and one
for each context.

Defined results: null and wordless texts have no evidence and get the score
of zero evidence; without learning rows of both classes every score is 0;
rows with null or repeated ids are judged one by one; learning rows without
text or label are left out; other columns are ignored.

Scale: counts, continuation counts and probabilities are Spark aggregates
over all learning documents, and every gram and context keeps its evidence
in a written table. A model of up to ``HELD_MODEL`` grams and contexts (16
bytes each, 64 MB) is held by every scoring task; a larger one is joined: the
grams of each distinct word of the texts scored meet the tables, words add
them up, and texts add up their words. Both ways give the same evidence. The
curve is fitted on at most ``FIT_ROWS`` documents, taken by hash.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ALNUM, U64, blocks, discard, prepare, sifting, texts, written
from .grams import Grams

ORDER = 6
#: Absolute discount.
DISCOUNT = 0.75
#: Grams and contexts of a model that scoring tasks hold; more are joined.
HELD_MODEL = 1 << 22
#: Evidence of one word counts up to this much, and is strong from STRONG.
MOST = 8.0
STRONG = 2.5
#: Largest number of documents for fitting the curve.
FIT_ROWS = 20_000
#: At most one in FIT_PART learning documents is sampled for the curve.
FIT_PART = 4
#: Distinct grams a counting task holds before it passes them on.
HELD = 1 << 21


def count(labelled: DataFrame) -> DataFrame:
    """(gram, ordered, toxic, plain): counts by class over rows (text, toxic);
    ``ordered`` is the gram's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            key = np.concatenate([k for k, _ in held])
            n = np.concatenate([v for _, v in held])
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            return key[first], np.add.reduceat(n, first)

        def out() -> pa.RecordBatch:
            key, n = held[0]
            toxic = (key & U64(1)).astype(np.int64)
            code = (key >> U64(1)) & U64((1 << 48) - 1)
            cols = [pa.array(code.view(np.int64)), pa.array((key >> U64(60)).astype(np.int32)), pa.array(n * toxic), pa.array(n * (1 - toxic))]
            return pa.RecordBatch.from_arrays(cols, ["gram", "ordered", "toxic", "plain"])

        for batch in batches:
            items, label = texts(batch.column(0)), batch.column(1).to_pylist()
            for a, b in blocks(items):
                for toxic in (0, 1):
                    grams = Grams([t for t, x in zip(items[a:b], label[a:b]) if x == toxic], ORDER)
                    if len(grams.code):
                        key = grams.code << U64(1) | U64(toxic) | grams.order.astype(U64) << U64(60)
                        held.append(np.unique(key, return_counts=True))
            if sum(len(k) for k, _ in held) > HELD:
                held = [merged()]
                if len(held[0][0]) > HELD // 2:
                    yield out()
                    held = []
        if held:
            held = [merged()]
            yield out()

    grams = labelled.mapInArrow(run, "gram long, ordered int, toxic long, plain long")
    return grams.groupBy("gram", "ordered").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))


def _context(gram) -> F.Column:
    return F.shiftright(gram, 8)


def _shorter(gram, ordered) -> F.Column:
    """Without the top byte."""
    return gram.bitwiseAND(F.pow(F.lit(256.0), ordered - 1).cast("long") - 1)


def shared(counts: DataFrame) -> list[DataFrame]:
    """(gram, p) by length, from one byte on: Kneser-Ney probability of every
    shorter gram, from the number of different bytes that stand before it. All
    lengths are counted in one job; a context has 256 grams at most."""
    longer = counts.filter("ordered > 1").select("gram", "ordered")
    # grams one longer: those counted at that length and endings of longer ones
    endings = longer.filter("ordered > 2").select("gram", F.explode(F.sequence(F.lit(2), F.col("ordered") - 1)).alias("ordered"))
    endings = endings.select(_shorter(F.col("gram"), F.col("ordered") + 1).alias("gram"), "ordered").distinct()
    longer = longer.unionByName(endings)
    grams = longer.groupBy(_shorter(F.col("gram"), F.col("ordered")).alias("gram"), (F.col("ordered") - 1).alias("ordered")).agg(F.count("*").alias("n"))
    context = Window.partitionBy("ordered", "context")
    grams = grams.withColumn("context", _context(F.col("gram"))).select(
        "gram", "ordered", "n", F.sum("n").over(context).alias("total"), F.count("*").over(context).alias("different")
    )
    counted = written(grams, "toxicity-endings")
    out, p = [], None
    for n in range(1, ORDER):
        grams = counted.filter(F.col("ordered") == n)
        if p is None:
            rest = F.lit(1 / 256)
        else:
            grams = grams.withColumn("ending", _shorter(F.col("gram"), F.lit(n))).join(
                p.select(F.col("gram").alias("ending"), F.col("p").alias("rest")), "ending", "left"
            )
            rest = F.coalesce("rest", F.lit(1 / 256))
        p = grams.select(
            "gram",
            ((F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("different") * rest) / F.col("total")).alias("p"),
        )
        p = written(p, "toxicity-shared")
        out.append(p)
    discard(counted)
    return out


def evidence(counts: DataFrame, endings: list[DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """((gram, evidence, weight), (context, evidence, weight)): difference of
    the log-probabilities of a gram seen, and of any other gram of a context.
    ``endings`` are ``shared``, where the caller has them."""
    ending = None
    for n, grams in enumerate(endings or shared(counts), 2):
        grams = grams.select(F.col("gram").alias("ending"), F.lit(n).alias("ordered"), "p")
        ending = grams if ending is None else ending.unionByName(grams)
    grams = counts.withColumn("context", _context(F.col("gram")))
    totals = {f"{name}_{c}": f(c) for c in ("toxic", "plain") for name, f in (("n", F.sum), ("kinds", lambda c: F.count_if(F.col(c) > 0)))}
    context = grams.groupBy("context", "ordered").agg(*(x.alias(name) for name, x in totals.items()))
    together = Window.partitionBy("context", "ordered")

    def weight(c):  # of the shared probability
        return F.when(F.col(f"n_{c}") > 0, DISCOUNT * F.col(f"kinds_{c}") / F.col(f"n_{c}")).otherwise(1.0)

    def own(c):
        return F.when(F.col(f"n_{c}") > 0, F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.col(f"n_{c}")).otherwise(0.0)

    rows = grams.withColumns({name: x.over(together) for name, x in totals.items()}).withColumn("ending", _shorter(F.col("gram"), F.col("ordered")))
    rows = rows.join(ending, ["ending", "ordered"], "left")
    p = F.coalesce("p", F.lit(1 / 256))
    seen = rows.select(
        "gram",
        F.log((own("toxic") + weight("toxic") * p) / (own("plain") + weight("plain") * p)).alias("evidence"),
        (F.col("toxic") + F.col("plain")).alias("n"),
    )
    other = context.select(
        F.col("context").alias("gram"),
        F.log(weight("toxic") / weight("plain")).alias("evidence"),
        (F.col("n_toxic") + F.col("n_plain")).alias("n"),
        "ordered",
    )
    return seen, other


#: Sorted codes and their evidence.
Table = tuple[np.ndarray, np.ndarray]


@dataclass
class Model:
    """(gram, evidence) of grams seen and of contexts; both as sorted arrays,
    if they are few enough; the curve."""

    seen: DataFrame
    other: DataFrame
    held: tuple[Table, Table] | None
    curve: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def score(self, n, mean, strong) -> F.Column:
        z = F.lit(float(self.curve[2][0]))
        for x, m, s, w in zip(curve_columns(n, mean, strong), *(c.tolist() for c in self.curve[:2]), self.curve[2][1:].tolist()):
            z = z + (x - F.lit(m)) / F.lit(s) * F.lit(w)
        return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))


def model_of(counts: DataFrame) -> Model:
    endings = shared(counts)
    seen, other = evidence(counts, endings)
    seen = written(seen.select("gram", "evidence"), "toxicity-seen")
    other = written(other.select("gram", "evidence"), "toxicity-contexts")
    discard(*endings)
    few = seen.unionByName(other).count() <= HELD_MODEL
    return Model(seen, other, (_sorted(seen), _sorted(other)) if few else None)


def _sorted(rows: DataFrame) -> Table:
    found = rows.toArrow()
    code, value = found["gram"].to_numpy().view(U64), found["evidence"].to_numpy()
    order = np.argsort(code)
    code, value = code[order], value[order]
    del found
    pa.default_memory_pool().release_unused()
    return code, value


def _look(table: Table, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, value = table
    at = np.minimum(np.searchsorted(keys, code), len(keys) - 1)
    known = keys[at] == code
    return np.where(known, value[at], 0.0), known


def of(held: tuple[Table, Table], grams: Grams) -> np.ndarray:
    """Evidence of every word."""
    code, at = np.unique(grams.code, return_inverse=True)
    own, known = _look(held[0], code)
    value = np.where(known, own, _look(held[1], code >> U64(8))[0])
    return np.clip(grams.sums(value[at]), -MOST, MOST)


def features(held: tuple[Table, Table], items: list[bytes | None]) -> np.ndarray:
    """(words, mean evidence, mean strong evidence) of each text."""
    grams = Grams(items, ORDER)
    out = np.zeros((len(items), 3))
    if len(grams.code):
        word = of(held, grams)
        total = np.concatenate(([0.0], np.cumsum(word)))
        strong = np.concatenate(([0.0], np.cumsum(np.where(word > STRONG, word, 0))))
        n = np.diff(grams.words)
        some = np.maximum(n, 1)
        i, j = grams.words[:-1], grams.words[1:]
        out = np.stack([n, (total[j] - total[i]) / some, (strong[j] - strong[i]) / some], 1).astype(float)
    return out


def curve_of(x: np.ndarray) -> np.ndarray:
    """What the curve sees: evidence by word, and what the strong adds up to."""
    strong = np.maximum(x[:, 2], 0)
    return np.stack([x[:, 1], np.sqrt(strong), np.log1p(strong * x[:, 0])], 1)


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton's method with a small ridge."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + 1e-2 * w
        hess = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def curve_columns(n, mean, strong) -> list[F.Column]:
    """``curve_of`` over columns."""
    strong = F.greatest(strong, F.lit(0.0))
    return [mean, F.sqrt(strong), F.log1p(strong * n)]


def featured(rows: DataFrame, model: Model) -> DataFrame:
    """(row, n, mean, strong) for rows (row, text)."""
    if model.held is None:
        return _joined(rows, model)
    shared_model = rows.sparkSession.sparkContext.broadcast(model.held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = texts(batch.column(1))
            for a, b in blocks(items):
                x = features(shared_model.value, items[a:b])
                cols = [batch.column(0).slice(a, b - a), *(pa.array(c) for c in x.T)]
                yield pa.RecordBatch.from_arrays(cols, ["row", "n", "mean", "strong"])

    schema = f"row {rows.schema['row'].dataType.simpleString()}, n double, mean double, strong double"
    return rows.mapInArrow(run, schema)


def _split(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(ALNUM).split()


def _name(word: bytes) -> bytes:
    return hashlib.blake2b(word, digest_size=16).digest()


def _joined(rows: DataFrame, model: Model) -> DataFrame:
    """``featured`` by joins; equal texts have equal features."""
    key = ["t1", "t2"]
    rows = rows.select("row", "text", F.xxhash64("text").alias("t1"), F.xxhash64("text", F.lit(7)).alias("t2"))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = texts(batch.column(2))
            for a, b in blocks(items):
                at, name, n = [], [], []
                for d in range(a, b):
                    for word, k in Counter(_split(items[d])).items():
                        at.append(d)
                        name.append(_name(word))
                        n.append(k)
                at = pa.array(at, pa.int64())
                cols = [batch.column(0).take(at), batch.column(1).take(at), pa.array(name, pa.binary()), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["t1", "t2", "word", "n"])

    def vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = texts(batch.column(0))
            for a, b in blocks(items):
                own = list({w for t in items[a:b] for w in _split(t)})
                cols = [pa.array([_name(w) for w in own], pa.binary()), pa.array(own, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["word", "bytes"])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column(1).to_pylist()
            for a, b in blocks(items):
                grams = Grams(items[a:b], ORDER)
                at = pa.array(np.repeat(np.arange(a, b), np.diff(grams.first)))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(grams.code.view(np.int64))], ["word", "gram"])

    posted = rows.select(*key, "text").mapInArrow(post, "t1 long, t2 long, word binary, n long")
    posted = written(posted.dropDuplicates([*key, "word"]), "toxicity-posted")
    words = written(rows.select("text").mapInArrow(vocabulary, "word binary, bytes binary").dropDuplicates(["word"]), "toxicity-vocabulary")
    grams = written(words.mapInArrow(spell, "word binary, gram long"), "toxicity-spelled")
    seen = model.seen.withColumnRenamed("evidence", "own")
    other = model.other.select(F.col("gram").alias("context"), F.col("evidence").alias("rest"))
    grams = written(grams.join(seen, "gram", "left").select("word", _context(F.col("gram")).alias("context"), "own"), "toxicity-own")
    value = grams.join(other, "context", "left").groupBy("word").agg(F.sum(F.coalesce("own", "rest", F.lit(0.0))).alias("e"))
    value = written(value.select("word", F.greatest(F.least("e", F.lit(MOST)), F.lit(-MOST)).alias("e")), "toxicity-words")
    strong = F.when(F.col("e") > STRONG, F.col("e")).otherwise(0.0)
    x = posted.join(value, "word").groupBy(*key).agg(
        F.sum("n").cast("double").alias("n"), F.sum(F.col("n") * F.col("e")).alias("mean"), F.sum(F.col("n") * strong).alias("strong")
    )
    x = written(x.select(*key, "n", *((F.col(c) / F.col("n")).alias(c) for c in ("mean", "strong"))), "toxicity-features")
    out = rows.select("row", *key).join(x, key, "left")
    return out.select("row", *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("n", "mean", "strong")))


def learn(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> Model | None:
    """A model from the labelled documents; None if a class is missing."""
    spark = documents.sparkSession
    prepare(spark)
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("toxic"))
    known = known.filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).dropna()
    part = F.pmod(F.xxhash64("doc_id"), F.lit(FIT_PART))
    kept = known.filter(part == 0).orderBy(F.xxhash64("doc_id", F.lit("curve")), "doc_id").limit(FIT_ROWS)
    kept = written(kept, "toxicity-kept")
    rest = written(known.join(F.broadcast(kept.select("doc_id")), "doc_id", "left_anti"), "toxicity-rest")
    # documents without a label are sifted out before they are shuffled
    with sifting(spark, rest.count()):
        counted = rows.join(rest.filter(F.col("toxic").isin(0, 1)), "doc_id").select("text", "toxic")
        counts = written(count(counted), "toxicity-counts")
    discard(rest)
    sample = rows.filter(part == 0).join(F.broadcast(kept), "doc_id").select("text", "toxic")
    own = written(count(sample), "toxicity-counts")
    totals = counts.agg(F.sum("toxic"), F.sum("plain")).first()
    if not totals[0] or not totals[1]:
        return None
    # the curve is fitted by the evidence of the other documents
    others = model_of(counts)
    found = featured(sample.select(F.struct("toxic").alias("row"), "text"), others)
    found = found.select("row.toxic", "n", "mean", "strong").toArrow()
    discard(others.seen, others.other)
    del others
    y = found["toxic"].to_numpy()
    if not len(y) or not 0 < y.mean() < 1:
        return None
    whole = counts.unionByName(own).groupBy("gram", "ordered").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))
    whole = written(whole, "toxicity-counts")
    discard(counts, own)
    model = model_of(whole)
    discard(whole)
    model.curve = fit(curve_of(np.column_stack([found[c].to_numpy() for c in ("n", "mean", "strong")])), y)
    return model


def score(documents: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``documents`` with ``toxicity`` (0 to 1); a column of that name is replaced."""
    prepare(documents.sparkSession)
    rows = documents.drop("toxicity")
    if model is None:
        return rows.withColumn("toxicity", F.lit(0.0))
    packed = rows.select(F.struct(*rows.columns).alias("row"), F.col(text).alias("text"))
    scored = featured(packed, model)
    return scored.select("row.*", model.score(F.col("n"), F.col("mean"), F.col("strong")).alias("toxicity"))
