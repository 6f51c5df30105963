"""Corpus pipeline over ``documents``: each stage's rows are written as
Parquet to the shared folder and reread as the next stage's documents.

Stages get (spark, docs, sf_dir). All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revcast.llm import decontaminate, lines, neardup, packing, toxicity
from revcast.llm.common import table, written
from revcast.llm.queries import TOKENIZER, held_out


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model rejects go."""
    model = toxicity.learn(docs.filter(~held_out()), table(spark, sf_dir, "labels"))
    packed = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return toxicity.score(packed, model).filter("toxicity < 0.5").select("row.*")


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in an earlier document, or nearly so, go from the
    text; a document stays unless all its lines went."""
    packed = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")
    left = lines.dedup(packed).filter("n_removed = 0 or n_removed < n_lines")
    return left.select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return neardup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of what is left."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("toxicity", toxic_documents),
    ("line_dedup", repeated_lines),
    ("near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack),
]

#: The first stage scores with a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
