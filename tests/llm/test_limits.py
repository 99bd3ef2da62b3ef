"""Work that must be shared or left out for the operators to stay within their limits."""

import random

import numpy as np
import pytest

from tidemark.llm import maxent_lm, sentence_pieces, simhash_dedup, substring_dedup


# --- op1 ---------------------------------------------------------------------------------

@pytest.mark.parametrize("sizes", [[1, 2, 3, 40, 1, 17, 16, 300], [1] * 50, [500], [maxent_lm.LEVELS, maxent_lm.LEVELS + 1]])
def test_sums_of_groups_are_those_of_their_rows(sizes):
    draw = np.random.default_rng(5)
    rows = draw.permutation(np.repeat(np.arange(len(sizes)), sizes))
    values = draw.normal(size=(len(rows), 7)).astype(np.float32)
    order = np.argsort(rows, kind="stable")
    first = np.flatnonzero(np.diff(rows[order], prepend=-1))
    got = maxent_lm._sum_groups(values, order, first, np.diff(first, append=len(order)))
    for k in range(len(sizes)):
        assert got[k] == pytest.approx(values[rows == k].astype(np.float64).sum(axis=0), abs=1e-3)


def test_gradient_steps_make_no_sum_per_weight_row_and_column(monkeypatch):
    """A reduction of the short groups one by one was most of op1's time."""
    draw, groups = np.random.default_rng(2), []

    class Add:
        def reduceat(self, values, first, *rest, **named):
            groups.append(len(first))
            return np.add.reduceat(values, first, *rest, **named)

    class Numpy:
        add = Add()

        def __getattr__(self, name):
            return getattr(np, name)

    table = draw.normal(size=(maxent_lm.ROWS + 1, 64)).astype(np.float32)
    rows = draw.integers(0, maxent_lm.ROWS, size=(4_000, maxent_lm.FEATURES))
    target = draw.integers(0, 64, size=4_000)
    speed, touched = np.zeros(len(table), dtype=np.float32), np.zeros(len(table), dtype=np.int64)
    monkeypatch.setattr(maxent_lm, "np", Numpy())
    maxent_lm._update(table, speed, touched, maxent_lm.ROWS, rows, target, 0.5)
    assert touched.sum() == rows.size and sum(groups) < 100


def test_softmax_of_any_width():
    for width in (1, 2, 3, 5, 48, 64, 67):
        logits = np.random.default_rng(width).normal(size=(20, width)) * 50
        want = np.exp(logits - logits.max(axis=1, keepdims=True))
        assert maxent_lm._softmax(logits.copy()) == pytest.approx(want / want.sum(axis=1, keepdims=True))


# --- op2 ---------------------------------------------------------------------------------

def _odd_texts():
    draw = random.Random(7)
    letters = "abcdefghij éß漢字▁😀\n\t\x00.,!1"
    texts = ["".join(draw.choices(letters, k=k)) for k in range(200)]
    return [*texts, "", " ", "\n", "▁", "a" * 3_000, "漢字かな" * 200, "x" + "=-" * 100]


def test_new_segments_are_searched_together(monkeypatch):
    """Not one by one: that was most of op2's time."""
    draw, calls, one = random.Random(3), [], sentence_pieces.viterbi
    monkeypatch.setattr(sentence_pieces, "viterbi", lambda v, s: calls.append(s) or one(v, s))
    text = " ".join("".join(draw.choices("abcdefghijklmnop", k=9)) for _ in range(2_000))
    ids, _, _ = sentence_pieces.Encoder(sentence_pieces.MODEL).encode(text.encode())
    assert sentence_pieces.decode_ids(ids).decode() == text
    assert len(calls) < 20


def test_segments_searched_together_equal_those_searched_alone():
    v = sentence_pieces.vocabulary(sentence_pieces.MODEL)
    segments = sorted({s for t in _odd_texts() for s in v.segments.findall("▁" + t.replace(" ", "▁"))})
    ids, sizes, scores, losses = sentence_pieces.viterbi_all(v, segments)
    at = 0
    for segment, size, score, loss in zip(segments, sizes.tolist(), scores.tolist(), losses.tolist()):
        best, whole, second = sentence_pieces.viterbi(v, segment)
        assert score == pytest.approx(whole, rel=1e-12)
        assert loss == pytest.approx(second, abs=1e-6)
        spelled = [b"".join(v.spelled[i] for i in piece) for piece in (best, ids[at:at + size].tolist())]
        assert spelled[0] == spelled[1]
        at += size
    assert at == len(ids)


@pytest.mark.parametrize("memo", [5, 500_000])
def test_slices_and_a_full_memo_change_nothing(monkeypatch, memo):
    texts = [t.encode() for t in _odd_texts()] + [b"\xff\xfe a \xc3"]
    alone = [sentence_pieces.Encoder(sentence_pieces.MODEL).encode(t) for t in texts[::10]]
    monkeypatch.setattr(sentence_pieces, "MEMO", memo)
    encoder = sentence_pieces.Encoder(sentence_pieces.MODEL)
    together = [found for at in range(0, len(texts), 7) for found in encoder.encode_all(texts[at:at + 7])][::10]
    assert [(i.tolist(), s, o) for i, s, o in alone] == [(i.tolist(), s, o) for i, s, o in together]


# --- pipeline ------------------------------------------------------------------------------

def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_near_duplicates_deal_texts_by_id_once(spark, no_broadcast):
    draw = random.Random(4)
    rows = [(i, " ".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=60))) for i in range(40)]
    rows += [(100 + i, text) for i, text in rows[:10]] + [(None, "no id")]
    got = simhash_dedup.keep_first(spark.createDataFrame(rows, "doc_id long, text string"))
    # One exchange of the texts and one of the ids.
    assert _plan(got).count("Exchange hashpartitioning") == 2 and "Window" not in _plan(got)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([*rows[:40], (None, "no id")], key=str)


def test_near_duplicates_of_repeated_ids_keep_the_smallest_text(spark):
    draw = random.Random(5)
    one, two, three = (" ".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=60)) for _ in range(3))
    rows = [(1, one), (1, two), (1, one), (2, one), (3, three), (3, three)]
    got = simhash_dedup.keep_first(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == [(1, min(one, two)), (3, three)]


def test_repeated_passages_are_cut_without_dealing_texts(spark, no_broadcast):
    draw = random.Random(6)
    own = [" ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(80)) for _ in range(4)]
    rows = [(1, own[0]), (2, own[1] + "  " + own[0]), (3, own[2]), (4, own[2]), (None, own[3]), (5, None)]
    got = substring_dedup.remove(spark.createDataFrame(rows, "doc_id long, text string"))
    assert "Exchange hashpartitioning" not in _plan(got)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, own[0]), (2, own[1] + "  "), (3, own[2]), (None, own[3]), (5, None)], key=str)
