"""The pipeline from raw documents to token ids, a stage an operator.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
the columns they came with; the last returns their ids.  ``run`` writes every
stage's documents to the shared folder and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkmeter.llm import exact, importance, mixture, near, sentence
from inkmeter.llm.queries import piece_file
from inkmeter.llm.staging import stage, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps; the rest are rejected."""
    return importance.Importance(docs, table(spark, sf_dir, "labels")).kept()


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document of the largest id."""
    return exact.keep_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document of the smallest id."""
    return near.keep_near(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return mixture.take_mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_ids, ids and whether they decode to the text."""
    coded = sentence.with_ids(docs, piece_file(), check=True)
    return coded.select("doc_id", "source", "n_ids", "ids", "round_trip")


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mixing),
    ("SentencePiece encoding and decoding", encoding),
]

# Signatures, a fitted model and a knapsack are beyond SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
