"""What the training-data operators share: folds, text batches, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import stored

BATCH_BYTES = 4 << 20


def fold(id_col: str, parts: int = 5) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id has fold -1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts, F.lit(-1)).cast("int")


def lower_ascii(text: str | Column) -> Column:
    """A-Z only, as all word rules here ask; null becomes the empty text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes per row, null as the empty text."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def in_slices(batches: Iterator[pa.RecordBatch], column: str,
              limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches where their texts exceed ``limit`` bytes; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        # Lengths come from the offsets; a text is copied only when its slice is read.
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        bins = (np.cumsum(sizes) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(bins)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(start, end - start)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node with an edge to another; root is the smallest reachable node.

    Alternates large-star and small-star rounds (joins and minimum aggregates on narrow
    rows); each round is written to the shared folder, so lineage stays short and a lost
    executor repeats one round at most. The number of rounds grows with the logarithm of
    the largest component. Loops, repeated edges and both directions of one are allowed.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    current = stored(pairs.where("u != v").distinct(), "edges")
    before = None
    while True:
        both = current.union(current.select("v", "u"))
        lowest = both.groupBy("u").agg(F.min("v").alias("m"))
        lowest = lowest.select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        large = stored(large, "large-star")
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(root, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(root.select("u", "m")).where("u != v").distinct())
        current = stored(small, "small-star")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = current.select("v").distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
