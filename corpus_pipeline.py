"""The corpus pipeline: documents in, pieces of clean, distinct, uncontaminated documents out.

In all stages null texts count as empty, texts of any length are read whole, an empty table gives an empty one, and further columns
are handed on as they are, whatever their names; only the last stage has columns of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.llm.common import save, small_batches
from textloom.llm.decontaminate import drop_contaminated
from textloom.llm.exact_dedup import keep_first_copies
from textloom.llm.sentencepiece_codec import encode
from textloom.llm.simhash import keep_one_of_each
from textloom.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model doesn't reject; it learns from the labels of sf_dir that are among docs.

    Empty texts stay, as do all documents where the labels aren't of both kinds. Rows that repeat, or that share an id or have none, are
    judged by their own text.
    """
    small_batches(spark)
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (but for blanks): the one of most code points, then of the smallest id.

    Empty and null texts are one group. Of rows that tie in all this one stays; a row without an id stays only if none has one.
    """
    small_batches(spark)
    return keep_first_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near duplicates.

    Texts without words are near duplicates of each other. An id that several rows carry stays with all of them if it is the smallest of
    one of their groups; rows without an id stay.
    """
    small_batches(spark)
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark of sf_dir doesn't contaminate.

    Texts without words stay. Where an id is null or several rows share it, each row is judged by its own text.
    """
    small_batches(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_pieces, decoded, round_trip of every document, rows that repeat included; empty texts have no pieces."""
    small_batches(spark)
    return encode(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontaminate),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again. An empty table gives the last stage's columns alone."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


#: The stages are a trained model, fingerprints and pieces: SQL can't express them. tests/llm holds them against brute force.
ORACLE_SQL = None
