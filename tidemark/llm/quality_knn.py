"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

Texts become counts of byte-class pairs and of repeated words; a truncated singular value
decomposition of the labelled sample gives the latent space. The labelled vectors are
broadcast: at most ``MAX_LABELLED`` rows of ``RANK`` numbers, 2 MB. Every document is
compared with all of them in blocked cosine products, exactly, and the labels of the
nearest ones are weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, in_slices, texts_of

MAX_LABELLED = 3000
RANK = 48
NEIGHBOURS = 15
CLASSES = 64
EXTRA = 4
TERMS = CLASSES * CLASSES + EXTRA


def _byte_classes() -> np.ndarray:
    """Letters by themselves (capitals as one class), digits, white space, signs, other bytes."""
    table = np.zeros(256, dtype=np.int64)
    number = 1
    for byte in range(33, 127):
        c = chr(byte)
        if not c.isalnum():
            table[byte] = number
            number += 1
    for c in "abcdefghijklmnopqrstuvwxyz":
        table[ord(c)] = number if number < CLASSES - 5 else CLASSES - 6
        number += 1
    table[ord("A"):ord("Z") + 1] = CLASSES - 5
    table[ord("0"):ord("9") + 1] = CLASSES - 4
    table[[32, 9, 11, 12]] = CLASSES - 3
    table[[10, 13]] = CLASSES - 2
    table[128:] = CLASSES - 1
    return table


BYTE_CLASSES = _byte_classes()


def term_counts(text: bytes) -> np.ndarray:
    """Weights of all terms of a whole text, of length one; zeros for an empty text."""
    out = np.zeros(TERMS, dtype=np.float32)
    if not text:
        return out
    codes = BYTE_CLASSES[np.frombuffer(text, dtype=np.uint8)]
    pairs = np.bincount(codes[:-1] * CLASSES + codes[1:], minlength=CLASSES * CLASSES)
    out[:-EXTRA] = np.sqrt(pairs)
    words = text.split()
    n = len(words)
    if n:
        kinds = len(set(words))
        again = sum(map(bytes.__eq__, words[1:], words[:-1]))
        scale = np.sqrt(len(text))
        out[-EXTRA:] = (scale * again / n, scale * (1 - kinds / n) ** 2,
                        scale * (max(map(len, words)) > 40), scale * (n < 5))
    return out / np.sqrt((out * out).sum())


def _vectors(texts: list[bytes]) -> np.ndarray:
    return np.stack([term_counts(t) for t in texts]) if texts else np.zeros((0, TERMS), np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(length > 0, length, 1)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out_fold: int | None = 0,
                    bound: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, text, y): at most ``bound`` labelled rows, those with the smallest id hashes.

    Rows of the held-out fold, without id or without a label of 0 or 1 are not used; a
    repeated label row counts once.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("y"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
    if held_out_fold is not None:
        known = known.where(fold("doc_id") != held_out_fold)
    known = known.groupBy("doc_id").agg(F.max("y").cast("int").alias("y"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(known), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", held_out_fold: int | None = 0,
        bound: int = MAX_LABELLED, rank: int = RANK, seed: int = 7) -> dict[str, np.ndarray]:
    """Projection, labelled vectors and their labels, fitted on the bounded sample."""
    sample = labelled_sample(docs, labels, label, held_out_fold, bound)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, "text"):
            data = [term_counts(t).astype(np.float16).tobytes() for t in texts_of(part.column(1))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(data, pa.binary())], names=["doc_id", "y", "x"])

    rows = sample.select("doc_id", "text", "y").mapInArrow(run, "doc_id long, y int, x binary").collect()
    if not rows:
        return {"basis": np.zeros((TERMS, 1), np.float32), "known": np.zeros((0, 1), np.float32),
                "y": np.zeros(0, np.float32)}
    rows.sort(key=lambda r: (r.doc_id, r.x))
    x = np.stack([np.frombuffer(r.x, dtype=np.float16) for r in rows]).astype(np.float32)
    # Subspace iteration for the leading right singular vectors.
    k = min(rank, len(x))
    q = np.random.default_rng(seed).standard_normal((TERMS, min(k + 8, TERMS))).astype(np.float32)
    for _ in range(6):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    basis = (q @ vt.T)[:, :k]
    # The leading direction is what all texts have in common; halving it spreads the rest.
    basis = basis * np.where(np.arange(k) == 0, 0.5, 1).astype(np.float32)
    return {"basis": basis.astype(np.float32), "known": _unit(x @ basis).astype(np.float32),
            "y": np.array([r.y for r in rows], dtype=np.float32)}


def vote(model: dict[str, np.ndarray], texts: list[bytes], neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Similarity-weighted mean label of the nearest labelled vectors, 0.5 without any."""
    known, y = model["known"], model["y"]
    if not len(y):
        return np.full(len(texts), 0.5)
    out = np.empty(len(texts))
    k = min(neighbours, len(y))
    for at in range(0, len(texts), 256):
        near = _unit(_vectors(texts[at:at + 256]) @ model["basis"]) @ known.T
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, best, axis=1), 0).astype(np.float64) ** 4 + 1e-9
        out[at:at + 256] = (weight * y[best]).sum(axis=1) / weight.sum(axis=1)
    return np.clip(out, 0, 1)


def score(docs: DataFrame, model: dict[str, np.ndarray], id_col: str = "doc_id",
          text_col: str = "text", neighbours: int = NEIGHBOURS, threshold: float = 0.3,
          held_out_fold: int = 0) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Null and empty texts are scored alike, from the zero vector, whose neighbours all have
    the same weight. Repeated rows come out as often as they came in; an empty table gives
    an empty result; without labelled rows every score is 0.5. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, "text"):
            values = vote(shared.value, texts_of(part.column(1)), neighbours)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values)], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (fold("doc_id") == held_out_fold).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep(docs: DataFrame, model: dict[str, np.ndarray], text_col: str = "text",
         neighbours: int = NEIGHBOURS, threshold: float = 0.3) -> DataFrame:
    """The rows whose text reaches the threshold, with all their columns as they are.

    Rows with null or empty text hold nothing to train on and go. Rows are judged one by
    one, so repeated rows stay or go together.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def votes(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts))
        raw = [(t or "").encode("utf-8", "surrogateescape") for t in texts]
        for at in range(0, len(raw), 256):
            out[at:at + 256] = vote(shared.value, raw[at:at + 256], neighbours)
        return pd.Series(out)

    text = F.col(text_col)
    return docs.where(text.isNotNull() & (text != "") & (votes(text) >= threshold))
