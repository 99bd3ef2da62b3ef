"""Pages that arrive as files, merged batch by batch: T1.

A batch is bounded by its number of files (``files_per_batch``), which loses nothing; there is
no cap on records.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.merge import PARTIAL
from tidemark.plans.run import load_run
from tidemark.sources.history_store import HistoryStore

PAGE_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])


def page_stream(spark: SparkSession, folder: str, files_per_batch: int = 50,
                pattern: str = "*.parquet", schema: T.StructType = PAGE_SCHEMA) -> DataFrame:
    """New page files of a folder, a bounded number per micro-batch."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .option("pathGlobFilter", pattern).parquet(folder))


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query when it made the checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first().id


def ingest(stream: DataFrame, store: HistoryStore, checkpoint: str,
           run_at: Callable[[int], datetime], **layout) -> StreamingQuery:
    """Every micro-batch is one partial run of the store.

    A micro-batch never shows the whole site, so the merge is always the partial one. The
    store hands out the run number and commits it with the id of the checkpoint and the batch
    number: a batch replayed after a failure finds its commit and changes nothing. Another
    stream, or the same one after its checkpoint was lost, has another id, so all of its
    batches are merged; pages seen before make no new version. The state of the store is read
    once per batch, and the store is compacted when that is due, so a batch late in a long
    stream reads no more folders than an early one.
    """
    def merge(batch: DataFrame, number: int) -> None:
        source, state = _query_id(store.spark, checkpoint), store.state()
        if store.find(source, number, state) is None:
            if store.compaction_due(state):
                store.compact()
                state = store.state()
            load_run(batch, store, state.last + 1, run_at(number), mode=PARTIAL,
                     source=source, batch=number, state=state, **layout)

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
