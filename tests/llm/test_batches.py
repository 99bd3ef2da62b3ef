"""How much text a Python worker holds at once, and what is made of it."""

import numpy as np
import pyarrow as pa

import corpus_pipeline
from helpers import frame
from tidemark.llm import common, maxent_lm
from tidemark.session import BATCH_BYTES


def test_pipeline_bounds_batches_by_bytes(spark):
    """Finding on the pipeline: long texts come to the workers in batches of four megabytes, whatever their number."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    spark.conf.unset(BATCH_BYTES)
    try:
        corpus_pipeline.near_duplicates(spark, frame(spark, {1: "a b c"}), "")
        texts = spark.range(0, 600, 1, 1).selectExpr("repeat(concat('w', id, ' '), 5000) AS text")
        sizes = [r.n for r in texts.mapInArrow(run, "n long").collect()]
        assert sum(sizes) > 12_000_000 and max(sizes) < 4_500_000
        spark.conf.set(BATCH_BYTES, "1m")
        corpus_pipeline.pieces(spark, frame(spark, {1: "a b c"}), "")
        assert spark.conf.get(BATCH_BYTES) == "1m"
    finally:
        spark.conf.unset(BATCH_BYTES)


def test_slices_are_measured_without_reading_texts(monkeypatch):
    """Findings on the pipeline and op1: a batch is not copied as a whole to be cut."""
    texts = ["ä" * 10, None, "", "x" * 30, "y", "z" * 5]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"]).slice(0)
    monkeypatch.setattr(common, "texts_of", None)
    parts = list(common.in_slices([batch, batch.slice(3), batch.slice(6)], "text", 20))
    assert [p.column(0).to_pylist() for p in parts] == [
        texts[:1], texts[1:4], texts[4:], texts[3:4], texts[4:]]


def test_log_of_one_target_is_that_of_the_softmax():
    """Finding on op1: scoring divides the probability it asks for, and gets it to the last bit."""
    for width in (3, 48, 64):
        logits = (np.random.default_rng(width).normal(size=(500, width)) * 20).astype(np.float32)
        target = np.arange(500) % width
        want = maxent_lm._softmax(logits.copy())[np.arange(500), target]
        got = maxent_lm._log_target(logits.copy(), target)
        assert (got == np.log(want.astype(np.float64) + 1e-30)).all()
