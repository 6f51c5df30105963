"""The registered queries of the training-data operators and, where SQL can
express them, their DuckDB statements."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann, conversations, decontaminate, languages, licenses, lines, neardup, packing, pseudonyms, substrings, tokencount,
    toxicity, variants,
)
from .common import table

#: Vocabulary file of the packing query.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Key of the pseudonym query; a real run passes its own.
KEY = "registered query"


def held_out() -> Column:
    """One in five documents is kept from learning."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), KEY)
    n = F.aggregate("finds", F.lit(0).cast("long"), lambda n, f: n + f["n"])
    return found.select("doc_id", "text", n.alias("n_found"), F.to_json("finds").alias("finds"))


def op3_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = languages.learn(docs.filter(~held_out()))
    return languages.identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "languages")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(table(spark, sf_dir, "documents")).drop("kept")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.search(table(spark, sf_dir, "documents"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.cluster(table(spark, sf_dir, "documents")).drop("version")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.encode("text", "utf-8"), 256).alias("kept_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs.filter(~held_out()), table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


#: Model of the token count query.
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count(table(spark, sf_dir, "documents"), PIECES)


def typo(doc_id: str) -> Callable[[str], str]:
    """The query's damage: one run in 31 loses a code point."""
    front = zlib.crc32(f"{doc_id}:".encode())

    def of(run: str) -> str:
        h = zlib.crc32(run.encode(), front)
        if h % 31:
            return run
        at = h % len(run)
        return run[:at] + run[at + 1 :]

    return of


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(variants.vocabulary(table(spark, sf_dir, "documents"), damage=typo))


def damaged(given: DataFrame) -> DataFrame:
    """The query's damage: by hash of conversation and turn, one row in 20
    each is dropped, emptied, cut short of its stops, repeated or made the
    user's."""
    plain = given.select(
        "conv_id", "turn", *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")),
        (F.crc32(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))) % 20).alias("h"),
    )
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return plain.filter("h != 0").select(
        "conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(times).alias("copy"),
    ).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    return conversations.digests(given.select("conv_id"), conversations.repair(damaged(given)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_pseudonyms, op3_languages, op4_substring_dedup, op5_licenses, op6_neighbours,
        op7_near_duplicates, op8_line_dedup, op9_packing, op10_toxicity, op11_token_counts, op12_spelling_variants,
        op13_conversation_repair,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALNUM_WORDS = (
    f"coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
)
#: Words between white space, of the text put in.
_WORDS = r"coalesce(regexp_extract_all({}, '[^\x20\x09-\x0D]+'), [])"

ORACLE: dict[str, str] = {
    "op1_decontaminate": f"""
WITH d AS (SELECT doc_id, {_ALNUM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_ALNUM_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, list_slice(w, p, p + least(13, len(w)) - 1) AS words
  FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS r(p) WHERE len(w) > 0),
place AS (
  SELECT doc_id, p, n, list_slice(w, p, p + n - 1) AS words
  FROM d, (SELECT DISTINCT n FROM win), unnest(range(1, len(w) - n + 2)) AS r(p) WHERE len(w) >= n),
hit AS (SELECT place.doc_id, p, place.n, item_id FROM place JOIN win USING (n, words)),
word AS (SELECT DISTINCT doc_id, q FROM hit, unnest(range(p, p + n)) AS r(q)),
n_hit AS (SELECT doc_id, count(*) AS n_hit FROM word GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n_hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op4_substring_dedup": rf"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
win AS (
  SELECT doc_id, p, array_to_string(list_slice(w, p, p + 49), ' ') AS words
  FROM d, unnest(range(1, len(w) - 48)) AS r(p) WHERE len(w) >= 50),
first AS (SELECT words, min(doc_id) AS lo FROM win GROUP BY words),
gone AS (
  SELECT DISTINCT doc_id, q FROM win JOIN first USING (words), unnest(range(p, p + 50)) AS r(q) WHERE doc_id > lo),
word AS (SELECT doc_id, q, w[q] AS v FROM d, unnest(range(1, len(w) + 1)) AS r(q)),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(v, ' ' ORDER BY q) AS t
  FROM word ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op7_near_duplicates": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(f"translate(text, '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + 4), ' ') AS g
  FROM d, unnest(range(1, greatest(len(w) - 3, 2))) AS r(p) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM both_ JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * i >= 75 * (na.n + nb.n - i)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(reach.b) AS component_id, min(reach.b) = d.doc_id AS kept
FROM d JOIN reach ON reach.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""",
}
