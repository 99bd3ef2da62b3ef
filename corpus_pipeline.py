"""From raw documents to encoded training data, stage by stage.

Each stage works on all rows that the one before kept and is written before the next begins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, quality_knn, sentence_pieces, simhash_dedup, substring_dedup
from tidemark.session import bounded_batches, stored
from tidemark.sources.tables import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neighbour votes reject go.

    A row goes if its own text is rejected, so rows that repeat an id are told apart by
    text; rows without id are kept or dropped by their text alone. Nulls in other columns
    and extra columns stay as they are.
    """
    bounded_batches(spark)
    model = quality_knn.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_knn.keep(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id."""
    bounded_batches(spark)
    return simhash_dedup.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document of smaller id holds too are cut out."""
    bounded_batches(spark)
    return substring_dedup.remove(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    bounded_batches(spark)
    return decontamination.remove(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the best segmentation, and the next best ones."""
    bounded_batches(spark)
    return sentence_pieces.encode(docs)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark),
    ("SentencePiece encoding and decoding", pieces),
]
# Votes, fingerprint links and lattices are not SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
