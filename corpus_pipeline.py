"""The corpus pipeline: five stages from raw documents to packed training sequences.

Every stage takes and returns a table with the columns of documents; the last returns packed pieces.
``run`` writes each stage's result to the shared folder and reads it again, so that a stage never repeats
the work before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import jaccard, lines, mixing, packing, toxicity
from ledgerloom.llm.common import prepare
from ledgerloom.llm.queries import TOKENIZER, table
from ledgerloom.session import materialise

NEAR_PERCENT, NEAR_WORDS = 80, 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; the model learns from the labelled rows of ``sf_dir``."""
    prepare(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents share stay in the one with the largest id."""
    prepare(spark)
    return lines.drop_lines(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 in five-word shingles the one with the smallest id stays."""
    prepare(spark)
    return jaccard.one_per_group(docs, NEAR_PERCENT, NEAR_WORDS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and in the order, that the sources' weights ask for."""
    prepare(spark)
    return mixing.training_order(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("jaccard_join", one_of_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# packing needs the tokenizer and toxicity a trained model, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
