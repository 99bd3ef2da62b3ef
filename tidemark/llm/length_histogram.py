"""Exact token counts: a histogram of encoded lengths that answers every context limit.

Documents are encoded once and aggregated by length. All later questions (totals, quantiles,
tokens kept under a context limit) are sums over the histogram, which has one row per
distinct length and group, not one per document.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published split pattern of the 50k byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoder(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded_lengths(docs: DataFrame, text_col: str = "text", by: Sequence[str] = (),
                    path: str = RANKS) -> DataFrame:
    """(*by, n_tokens): the encoded length of every whole text; null and empty have 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_ordinary
        for part in in_slices(batches, "text"):
            lengths = [len(encode(t)) if t else 0 for t in part.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(lengths, dtype=np.int64)), *part.columns[1:]],
                names=["n_tokens", *part.schema.names[1:]])

    keys = [F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]
    rows = docs.select(F.col(text_col).alias("text"), *keys)
    kinds = ", ".join(["n_tokens long", *[f"_by{i} {t}" for i, (_, t) in enumerate(rows.dtypes[1:])]])
    counted = rows.mapInArrow(run, kinds)
    return counted.select(*[F.col(f"_by{i}").alias(c) for i, c in enumerate(by)], "n_tokens")


def histogram(lengths: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(*by, n_tokens, docs); hot groups shrink to one row per length before the shuffle."""
    return lengths.groupBy(*by, "n_tokens").agg(F.count("*").alias("docs"))


def limits(hist: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What each occurring length means as a context limit.

    Per length L: docs and tokens of that length, docs_longer (suffix sum of documents),
    tokens_longer (suffix sum of their tokens), kept_tokens (total when every text is cut to
    L tokens), cut_tokens (what is lost), share_at_most (share of documents not cut). The
    window runs over distinct lengths of a group, not over documents.
    """
    tokens = hist.withColumn("tokens", F.col("n_tokens") * F.col("docs"))
    group = Window.partitionBy(*by)
    later = group.orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    sums = tokens.withColumns({
        "docs_longer": F.coalesce(F.sum("docs").over(later), F.lit(0)),
        "tokens_longer": F.coalesce(F.sum("tokens").over(later), F.lit(0)),
        "_docs": F.sum("docs").over(group), "_tokens": F.sum("tokens").over(group)})
    kept = F.col("_tokens") - F.col("tokens_longer") + F.col("n_tokens") * F.col("docs_longer")
    return sums.select(
        *by, "n_tokens", "docs", "tokens", "docs_longer", "tokens_longer", kept.alias("kept_tokens"),
        (F.col("_tokens") - kept).alias("cut_tokens"),
        (1 - F.col("docs_longer") / F.col("_docs")).alias("share_at_most"))


def truncated_totals(hist: DataFrame, contexts: Sequence[int]) -> DataFrame:
    """(context, total_tokens, docs_cut) for any limits, occurring or not."""
    limit = hist.sparkSession.createDataFrame([(int(c),) for c in contexts], "context long")
    per_limit = hist.select("n_tokens", "docs", F.explode(F.array(*[F.lit(int(c)).cast("long") for c in contexts])).alias("context"))
    found = per_limit.groupBy("context").agg(
        F.sum(F.least("n_tokens", "context") * F.col("docs")).alias("total_tokens"),
        F.sum(F.when(F.col("n_tokens") > F.col("context"), F.col("docs")).otherwise(0)).alias("docs_cut"))
    return limit.join(found, "context", "left").na.fill(0)


def quantiles(hist: DataFrame, shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(*by, share, n_tokens): smallest length that at least this share of documents do not exceed."""
    ranked = limits(hist, by)
    return ranked.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares]))).where(
        F.col("share_at_most") >= F.col("share")).groupBy(*by, "share").agg(
        F.min("n_tokens").alias("n_tokens"))


def length_table(docs: DataFrame, text_col: str = "text", by: Sequence[str] = (),
                 path: str = RANKS) -> DataFrame:
    """Encodes, aggregates and gives one row per length with its limits.

    Null and empty texts count as documents of length 0, ties are added up, repeated rows
    count as often as they occur, an empty table gives an empty result, other columns are
    ignored.
    """
    return limits(histogram(encoded_lengths(docs, text_col, by, path), by), by)
