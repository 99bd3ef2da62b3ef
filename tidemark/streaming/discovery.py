"""Link discovery over listing pages that arrive as files: L3, L4 and L7 as streams.

Two queries, one behind the other, each with its own checkpoint below the root:

    pages -> log      every page parsed once; a row per page with its cards and resolved links
    log   -> firsts   per URL its first occurrence and the number of occurrences, in Spark's
                      keyed streaming state; every batch writes the URLs that it changed

A first occurrence only ever gets smaller and a number of occurrences only larger, so the
batches' rows merge by minimum and maximum in any order: repeated batches, pages that arrive
out of order and a stopped stream leave the tables that the batch operators give over the
whole input. Occurrences are combined in each task before they are shuffled, so a URL that
stands on every page is one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.html import Rule
from tidemark.operators import links
from tidemark.session import folder_names

_LOG = T.StructType([
    T.StructField("page_no", T.LongType()), T.StructField("page_url", T.StringType()),
    T.StructField("cards", T.LongType()), T.StructField("targets", T.ArrayType(T.StructType([
        T.StructField("pos", T.IntegerType()), T.StructField("href", T.StringType())]))),
])
_FIRSTS = "url string, first struct<page_no: bigint, pos: int, page_url: string>, occurrences long"


class Discovery:
    """The stored state of link discovery below ``root``; files per batch bound a batch."""

    def __init__(self, spark: SparkSession, root: str, rules: Sequence[Rule] = links.LISTING_RULES,
                 files_per_batch: int = 50):
        self.spark, self.root, self.rules, self.files = spark, root.rstrip("/"), rules, files_per_batch

    def read(self, pages: DataFrame) -> StreamingQuery:
        """pages -> log: all pages that have arrived, exactly once."""
        found = links.listing_pieces(pages, self.rules).select(
            F.col("page_no").cast("long").alias("page_no"), "page_url", F.size("card").cast("long").alias("cards"),
            F.transform("href.value", lambda href, pos: F.struct(pos.alias("pos"), href.alias("href"))).alias("targets"))
        return (found.writeStream.format("parquet").option("path", f"{self.root}/log")
                .option("checkpointLocation", f"{self.root}/checkpoint-log").trigger(availableNow=True).start())

    @staticmethod
    def _links(log: DataFrame) -> DataFrame:
        """A row per target; resolved to the normal form, those that give no URL left out."""
        rows = log.select("page_no", "page_url", F.inline("targets"))
        return links.resolved_links(rows).drop("href")

    def merge(self) -> StreamingQuery:
        """log -> firsts: the keyed state, and what every batch changed of it."""
        log = self.spark.readStream.schema(_LOG).option("maxFilesPerTrigger", self.files).parquet(f"{self.root}/log")
        changed = self._links(log).groupBy("url").agg(
            F.min(F.struct("page_no", "pos", "page_url")).alias("first"), F.count(F.lit(1)).alias("occurrences"))

        def write(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{self.root}/firsts/batch={number}")

        return (changed.writeStream.outputMode("update").foreachBatch(write)
                .option("checkpointLocation", f"{self.root}/checkpoint-firsts").trigger(availableNow=True).start())

    def run(self, pages: DataFrame) -> None:
        """Everything that has arrived, through both queries."""
        self.read(pages).awaitTermination()
        self.merge().awaitTermination()

    # --- the tables so far --------------------------------------------------------------------

    def log(self) -> DataFrame:
        if "log" not in folder_names(self.spark, self.root):
            return self.spark.createDataFrame([], _LOG)
        return self.spark.read.schema(_LOG).parquet(f"{self.root}/log")

    def resolved(self) -> DataFrame:
        return self._links(self.log())

    def unresolved(self) -> DataFrame:
        """L2: the logged links that give no absolute URL."""
        return links.unresolved_links(self.log().select("page_no", "page_url", F.inline("targets")))

    def first_seen(self) -> DataFrame:
        """L3 so far, from the state's rows alone: no page and no link is read again."""
        if not folder_names(self.spark, f"{self.root}/firsts"):
            found = self.spark.createDataFrame([], _FIRSTS)
        else:
            found = self.spark.read.schema(_FIRSTS).parquet(f"{self.root}/firsts/batch=*")
        return found.groupBy("url").agg(F.min("first").alias("first"), F.max("occurrences").alias("occurrences")).select(
            "url", "first.page_no", "first.pos", "first.page_url", "occurrences")

    def duplicate_links(self) -> DataFrame:
        """L4 so far: the logged links against the first occurrences of the state."""
        return links.duplicates_of(self.resolved(), self.first_seen())

    def discovery_totals(self) -> DataFrame:
        """L7 so far: a page's new URLs are the first occurrences that the state has on it."""
        return links.totals_of(self.log().select("page_no", "cards"), self.first_seen())
