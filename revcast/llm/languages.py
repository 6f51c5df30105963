"""Language proportions of a document by expectation-maximisation.

Each language has a model of byte n-grams within words (``grams``): counts
over all learning documents, smoothed. A document is a mixture: every word
was drawn from one of the languages, with the document's proportions as
prior. Expectation-maximisation estimates the proportions from the words'
likelihoods. The set of languages is chosen by penalised likelihood: from
all languages, the one with the smallest share goes as long as that doesn't
raise ``-2 * log-likelihood + PENALTY * log(words) * languages``.

Defined results: a null text, one without a letter, or an empty learning
table gives ``und`` with score 0 and no proportions; learning rows without
text or language are left out; rows with null or repeated ids are judged one
by one; ties go to the language first by name; other columns are ignored.

Scale: both passes run where documents are read. Counting gathers one table
per input partition and adds them up by key; the model has ``2 ** BITS``
places for each language, whatever the input, and only it passes the driver
(4 bytes a place: 0.25 MB a language).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, prepare, texts
from .grams import Grams, slots

ORDER = 4
BITS = 16
#: Share of the likelihood that rests on a gram's own count; the rest is even.
SMOOTHING = 0.5
#: Weight of the penalty for each language of a document.
PENALTY = 3.0
STEPS = 30
CLOSE = 1e-4

UNKNOWN = "und"


def count(labelled: DataFrame) -> DataFrame:
    """(lang, place, n): grams of all rows (text, lang) by table place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            items, langs = texts(batch.column(0)), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                own = [t for t, x in zip(items, langs) if x == lang]
                table = tables.setdefault(lang, np.zeros(1 << BITS, np.int64))
                for a, b in blocks(own):
                    table += np.bincount(slots(Grams(own[a:b], ORDER).code, BITS), minlength=1 << BITS)
        for lang, table in tables.items():
            at = np.flatnonzero(table)
            cols = [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(table[at])]
            yield pa.RecordBatch.from_arrays(cols, ["lang", "place", "n"])

    grams = labelled.mapInArrow(run, "lang string, place int, n long")
    return grams.groupBy("lang", "place").agg(F.sum("n").alias("n"))


def learn(documents: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, log-likelihood of each place under each language)."""
    prepare(documents.sparkSession)
    rows = documents.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    found = count(rows).toArrow()
    langs = sorted(set(found["lang"].to_pylist()))
    table = np.zeros((len(langs), 1 << BITS))
    number = {x: i for i, x in enumerate(langs)}
    who = np.array([number[x] for x in found["lang"].to_pylist()], np.int64)
    table[who, found["place"].to_numpy()] = found["n"].to_numpy()
    table += SMOOTHING
    return langs, np.log(table / table.sum(1, keepdims=True)).T.astype(np.float32) if len(langs) else table.T


def proportions(likelihood: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares of the columns and the log-likelihood, for rows of words."""
    n, k = likelihood.shape
    top = likelihood.max(1, keepdims=True)
    p = np.exp(likelihood - top)
    share = np.full(k, 1 / k)
    total = last = -np.inf
    for _ in range(STEPS if k > 1 else 1):
        joint = p @ share
        total = float(np.log(joint).sum())
        if total - last < CLOSE * n:
            break
        last = total
        share = share * ((1 / joint) @ p) / n
    return share, total + float(top.sum())


def mixture(likelihood: np.ndarray) -> tuple[list[int], np.ndarray]:
    """The chosen columns and their shares."""
    chosen = list(range(likelihood.shape[1]))
    penalty = PENALTY * np.log(max(len(likelihood), 2))
    share, total = proportions(likelihood)
    cost = -2 * total + penalty * len(chosen)
    while len(chosen) > 1:
        out = int(np.argmin(share[::-1]))  # of equal shares the last by name goes
        fewer = [c for i, c in enumerate(chosen) if i != len(chosen) - 1 - out]
        next_share, next_total = proportions(likelihood[:, fewer])
        next_cost = -2 * next_total + penalty * len(fewer)
        if next_cost > cost:
            break
        chosen, share, cost = fewer, next_share, next_cost
    return chosen, share


def identify(documents: DataFrame, model: tuple[list[str], np.ndarray], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: the language with the largest share of the
    words, that share, and the shares of all languages chosen."""
    spark = documents.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)
    schema = "doc_id long, lang_pred string, score double, languages array<struct<lang:string,share:double>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table = shared.value
        kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        for batch in batches:
            items, out = texts(batch.column(1)), []
            for a, b in blocks(items):
                grams = Grams(items[a:b], ORDER)
                words = grams.sums(table[slots(grams.code, BITS)].astype(np.float64)) if langs else None
                for d in range(b - a):
                    i, j = grams.words[d], grams.words[d + 1]
                    if i == j or not langs or not any(map(str.isalpha, items[a + d].decode(errors="replace"))):
                        out.append((UNKNOWN, 0.0, []))
                        continue
                    chosen, share = mixture(words[i:j])
                    best = int(np.argmax(share))
                    names = [{"lang": langs[c], "share": float(s)} for c, s in zip(chosen, share)]
                    out.append((langs[chosen[best]], min(1.0, float(share[best])), names))
            kinds = [pa.string(), pa.float64(), kind]
            cols = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc_id", "lang_pred", "score", "languages"])

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, schema)
