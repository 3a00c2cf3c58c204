"""A training corpus from raw documents: each stage works on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import jaccard_join, language_id, line_dedup, mixing, packing
from landfall.llm.common import held_out, shielded, stored
from landfall.plans.bindings import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with enough confidence; a missing lang is filled in.

    A null text and one without a letter are rejected. Rows with a null id may be learned from;
    repeated rows are judged one by one and stay repeated. Without any labelled text nothing is
    known and all rows go; an empty table gives an empty one. Other columns are kept, also those
    whose names an operator uses.
    """
    model = language_id.fit(docs.where(~held_out(F.col("doc_id"), 4, 2)))
    rows, restored = shielded(docs, "doc_id", "text", "lang")
    kept = language_id.identify(rows, model, tuple(rows.columns)).where("not rejected")
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*restored)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document with a smaller id holds.

    No row goes: a null text stays null, one whose lines all go becomes empty. A null id counts as
    the largest; rows that repeat an id are one document's, as ``drop_lines`` states. n_chars is
    counted anew. An empty table gives an empty one; other columns are kept.
    """
    kept = line_dedup.drop_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8.

    The smallest id stays, a null id counting as the largest; of repeated rows one stays, by the
    order that ``keep_one_each`` states. Rows without words are in no group and all stay. An empty
    table gives an empty one; other columns are kept.
    """
    return jaccard_join.keep_one_each(docs, jaccard_join.Join(words=5, percent=80))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Rows without words (null and empty texts too) leave, as the mix counts words. A null source
    is a source, the last; null ids and repeated rows take part row by row. An empty table gives
    an empty one; other columns are kept.
    """
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences.

    A null or empty text is the end token alone; null ids stay null, and each repeated row is
    packed on its own. An empty table gives an empty one; other columns are left out.
    """
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_languages),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_duplicates),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: SQL cannot train the language model or draw the seeded mix; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
