"""Readers: S1, S2, S5, S9, S10."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import strip

READ_BATCH = 10_000  # fixed value: rows per round trip to a database


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table; columns and filters are pruned at the scan."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def seed_urls(spark: SparkSession, urls: Sequence[str] | DataFrame = (),
              file: str | None = None) -> DataFrame:
    """Configured URLs and those of a text file, trimmed, blank lines dropped, distinct."""
    given = urls if isinstance(urls, DataFrame) else spark.createDataFrame(
        [(u,) for u in urls], "url string")
    every = given.select("url")
    if file is not None:
        every = every.union(spark.read.text(file).select(F.col("value").alias("url")))
    return every.select(strip(F.col("url")).alias("url")).filter("url <> ''").distinct()


def versions_from_database(spark: SparkSession, url: str, query: str, *,
                           partition_column: str, lower: int, upper: int,
                           partitions: int, **options) -> DataFrame:
    """A version table held in a database, read by many tasks over a numeric column.

    Untested: no database may be started here.
    """
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=f"({query}) AS versions", fetchsize=READ_BATCH,
                 partitionColumn=partition_column, lowerBound=lower, upperBound=upper,
                 numPartitions=partitions, **options)
        .load()
    )


def query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """SQL text over data frames, each usable in the text as ``{name}``."""
    return spark.sql(sql, **frames)
