"""Registered queries: every operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import alignment, contamination, fim, fingerprints, jaccard, lines, mixing, packing, pages, pii, suffixes, toxicity, vectors
from .common import partitions, prepare

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(prepare(spark), folder)

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    QUERIES[function.__name__] = run
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to weights 1, 2, 3, repeating, in training order."""
    mixed = mixing.mix(table(spark, folder, "documents"), keep=["doc_id"])
    # the id settles ties and spreads the documents without a position
    order = [F.col("position").asc_nulls_last(), F.col("row.doc_id").asc_nulls_last()]
    ordered = mixed.repartitionByRange(partitions(mixed), *order).sortWithinPartitions(*order)
    return ordered.select("row.doc_id", "size", "source_size", "target", "taken", "position")


@query
def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    return pii.span_report(table(spark, folder, "documents"))


@query
def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.edit_report(table(spark, folder, "documents"))


@query
def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return pages.extract(table(spark, folder, "pages"))


@query
def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents with equal three-word shingles to 90 of 100."""
    return jaccard.join_documents(table(spark, folder, "documents"))


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """A toxicity score for every document."""
    return toxicity.toxicity_report(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated lines dropped from every document but the one with the largest id."""
    return lines.line_report(table(spark, folder, "documents"))


@query
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(table(spark, folder, "documents"), TOKENIZER)


@query
def op9_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate vectors, their links and groups."""
    return vectors.link_vectors(table(spark, folder, "embeddings"))


@query
def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes covered by strings of 200 bytes that start elsewhere too, removed from every document."""
    return suffixes.repeat_report(table(spark, folder, "documents"))


@query
def op11_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold ten-word windows of benchmark items."""
    return contamination.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document cut at token places and put into its fill-in-middle form."""
    return fim.report(table(spark, folder, "documents"))


@query
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of tokens of two tokenizers over the same bytes of every document, and how usual their links are."""
    return alignment.report(table(spark, folder, "documents"), BYTE_LEVEL, PIECES)
