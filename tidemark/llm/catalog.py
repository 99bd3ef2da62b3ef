"""One query per training-data operator, with its SQL oracle where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontamination, language_id, length_histogram, maxent_lm, neighbours, quality_knn, ranked_search, sentence_pieces,
    simhash_dedup, substring_dedup, toxicity, vector_codes, web_archive,
)
from tidemark.sources.tables import table


def repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, folder, "documents"))


def benchmark_hits(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, folder, "documents"))


def page_languages(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(table(spark, folder, "pages"), table(spark, folder, "documents"))


def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return neighbours.nearest(vectors.where(F.col("vec_id") % 20 == 0), vectors)


def model_scores(spark: SparkSession, folder: str) -> DataFrame:
    return maxent_lm.fit_and_score(table(spark, folder, "documents"))


def best_segmentations(spark: SparkSession, folder: str) -> DataFrame:
    return sentence_pieces.encode(table(spark, folder, "documents"))


def token_lengths(spark: SparkSession, folder: str) -> DataFrame:
    return length_histogram.length_table(table(spark, folder, "documents"))


def quality_votes(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality_knn.fit(docs, table(spark, folder, "labels"))
    return quality_knn.score(docs, model)


def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def vector_code_table(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.encode(table(spark, folder, "embeddings"))


def ranked_documents(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def archived_pages(spark: SparkSession, folder: str) -> DataFrame:
    return web_archive.round_trip(table(spark, folder, "pages"))


QUERIES = {
    "op1_model_scores": model_scores,
    "op2_best_segmentations": best_segmentations,
    "op3_token_lengths": token_lengths,
    "op4_toxicity_scores": toxicity_scores,
    "op5_repeated_passages": repeated_passages,
    "op6_benchmark_hits": benchmark_hits,
    "op7_simhash_components": simhash_components,
    "op8_page_languages": page_languages,
    "op9_nearest_vectors": nearest_vectors,
    "op10_quality_votes": quality_votes,
    "op11_vector_codes": vector_code_table,
    "op12_ranked_documents": ranked_documents,
    "op13_archived_pages": archived_pages,
}
ORACLES = {
    "op6_benchmark_hits": decontamination.ORACLE,
    "op9_nearest_vectors": neighbours.ORACLE,
    "op11_vector_codes": vector_codes.ORACLE,
    "op12_ranked_documents": ranked_search.ORACLE,
    "op13_archived_pages": web_archive.ORACLE,
}
