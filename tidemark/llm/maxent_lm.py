"""Hashed maximum-entropy language model with a class-factored softmax.

A token is predicted as its class, then as a word of that class, from hashed features of the
three tokens before it (the last, the one before it skipping the last, both, and the last with
the third). Frequent words have classes of ``WORDS_PER_CLASS``; the rest share classes by their last two bytes and
are told apart by smoothed counts, so every token has a probability. Training runs in rounds over
disjoint shares of all training documents: each task makes gradient updates to its copy of
the weights, and Spark averages the changes per weight row. Counts cover all training tokens;
the most frequent ``LOOKUP`` are broadcast, the others are joined.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, in_slices, texts_of
from tidemark.session import stored

END = b"\n"  # white space, so no word is equal to it
LOOKUP = 100_000
CLASSES, WORDS_PER_CLASS, RARE = 32, 64, 16
VOCABULARY = CLASSES * WORDS_PER_CLASS
OUT = CLASSES + RARE
START = VOCABULARY + RARE
ROWS = 1 << 14
FEATURES = 4
STEP_TOKENS = 8192
ROUNDS = 3
RATE = 0.5
FLUSH = 300_000
# Up to this size groups of gradients are summed together, larger ones each by itself.
LEVELS = 8


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased words and the end of the text."""
    return [*text.lower().split(), END]


def rare_class(token: bytes) -> int:
    return zlib.crc32(token[-2:]) % RARE


# --- counts ---------------------------------------------------------------------------

def token_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, c) over all whole texts; tasks count first and hand on partial counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed(counts):
            return pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["token", "c"])

        counts: Counter = Counter()
        for part in in_slices(batches, "text"):
            for text in texts_of(part.column(0)):
                counts.update(tokens(text))
            if len(counts) > FLUSH:
                yield handed(counts)
                counts = Counter()
        yield handed(counts)

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "token binary, c long")
    return rows.groupBy("token").agg(F.sum("c").alias("c"))


def vocabulary(counts: DataFrame, lookup: int = LOOKUP) -> dict:
    """The broadcast part of the counts, at most ``lookup`` tokens, and the totals.

    The least count that comes along follows from how many tokens have which count, so no
    task sends more to the driver than is kept.
    """
    total, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    least, held = math.inf, 0
    for r in counts.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).collect():
        if held + r.n > lookup:
            break
        least, held = r.c, held + r.n
    top = counts.where(F.col("c") >= least).collect() if held else []
    top.sort(key=lambda r: (-r.c, bytes(r.token)))
    words = [bytes(r.token) for r in top]
    number = np.array([r.c for r in top], dtype=np.float64)
    inside = counts.sparkSession.createDataFrame([(w,) for w in words[:VOCABULARY]], "token binary")
    suffix = F.pmod(F.crc32(F.expr("substring(token, -2, 2)")), F.lit(RARE))
    rare = counts.join(F.broadcast(inside), "token", "left_anti").groupBy(suffix.alias("r")).agg(
        F.sum(F.col("c") + 0.5).alias("mass"))
    mass = np.full(RARE, 0.5)  # the unseen token of each class
    for r in rare.collect():
        mass[int(r.r)] += r.mass
    return {"words": words, "counts": number, "mass": mass, "tokens": int(total), "kinds": int(kinds)}


class Reader:
    """Texts to arrays of output ids (words below VOCABULARY, rare classes above)."""

    def __init__(self, vocab: dict):
        self.index = {w: i for i, w in enumerate(vocab["words"])}
        self.out = np.array([i if i < VOCABULARY else VOCABULARY + rare_class(w)
                             for i, w in enumerate(vocab["words"])] + [0], dtype=np.int64)
        self.counts = np.append(vocab["counts"], 0.0)

    def read(self, texts: list[bytes]):
        """(ids, place in text, text number, lookup index, rows of rare tokens, rare tokens)"""
        words = [tokens(t) for t in texts]
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        flat = list(chain.from_iterable(words))
        index = np.fromiter(map(self.index.get, flat, repeat(-1)), dtype=np.int64, count=len(flat))
        ids = self.out[index]
        missing = np.flatnonzero(index < 0)
        rare = [flat[i] for i in missing.tolist()]
        ids[missing] = [VOCABULARY + rare_class(t) for t in rare]
        starts = np.cumsum(sizes) - sizes
        place = np.arange(len(flat)) - np.repeat(starts, sizes)
        return ids, place, np.repeat(np.arange(len(texts)), sizes), index, missing, rare


# --- the model ----------------------------------------------------------------------

def new_weights(vocab: dict) -> dict[str, np.ndarray]:
    """Bias rows that make the untrained model the smoothed unigram distribution."""
    classes = np.zeros((ROWS + 1, OUT), dtype=np.float32)
    words = np.zeros((ROWS + CLASSES, WORDS_PER_CLASS), dtype=np.float32)
    count = np.zeros(VOCABULARY)
    known = vocab["counts"][:VOCABULARY]
    count[:len(known)] = known + 0.5
    by_class = count.reshape(CLASSES, WORDS_PER_CLASS)
    mass = np.concatenate([by_class.sum(axis=1), vocab["mass"]])
    with np.errstate(divide="ignore"):
        classes[ROWS] = np.maximum(np.log(mass), -30)
        words[ROWS:] = np.maximum(np.log(by_class), -30)
    return {"classes": classes, "words": words}


def _mix(a: np.ndarray, salt: int) -> np.ndarray:
    h = (a.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(32))) & np.uint64(ROWS - 1)).astype(np.int64)


def context_features(ids: np.ndarray, place: np.ndarray) -> np.ndarray:
    """(tokens, FEATURES) feature values: last token, skipping it the one before, both, last and third last."""
    before = []
    for k in (1, 2, 3):
        shifted = np.concatenate((np.full(k, START), ids))[:len(ids)]
        before.append(np.where(place >= k, shifted, START))
    one, two, three = before
    size = START + 1
    return np.stack([one, size + two, 2 * size + one * size + two, (2 + size) * size + one * size + three], axis=1)


def _numerators(logits: np.ndarray) -> np.ndarray:
    """Of the softmax, in place."""
    # The maximum by halves of the columns: a reduction of many short rows is slow.
    most, width = logits, logits.shape[1]
    while width > 3:
        half = width // 2
        most, width = np.maximum(most[:, :width - half], most[:, half:width]), width - half
    logits -= most[:, :width].max(axis=1, keepdims=True)
    return np.exp(logits, out=logits)


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits = _numerators(logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _log_target(logits: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log of the softmax at one target per row; the others are not divided."""
    top = _numerators(logits)
    chosen = top[np.arange(len(target)), target] / top.sum(axis=1)
    return np.log(chosen.astype(np.float64) + 1e-30)


def _sum_rows(table: np.ndarray, bias: np.ndarray | int, rows: np.ndarray) -> np.ndarray:
    out = table.take(rows[:, 0], axis=0)
    out += table[bias] if isinstance(bias, int) else table.take(bias, axis=0)
    for k in range(1, rows.shape[1]):
        out += table.take(rows[:, k], axis=0)
    return out


def _sum_groups(values: np.ndarray, order: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``np.add.reduceat(values[order], first)`` for groups that begin at ``first``, to the last bit.

    It adds the sum of the others to the first member, and others below eight one by one. Most groups
    are that small: all of them take their third member together, those of four or more their
    fourth, and so on; only the few large ones go through the reduction, column by column.
    """
    by_size = np.argsort(-sizes, kind="stable")
    starts, negative = first[by_size], -sizes[by_size]
    large, *at_least = np.searchsorted(negative, -np.array([LEVELS + 1, *range(2, LEVELS + 1)]), side="right").tolist()
    out = np.empty((len(first), values.shape[1]), dtype=values.dtype)
    out[by_size] = values.take(order[starts], axis=0)
    if at_least[0] > large:
        rest = values.take(order[starts[large:at_least[0]] + 1], axis=0)
        for level, n in enumerate(at_least[1:], 2):
            if n <= large:
                break
            rest[:n - large] += values.take(order[starts[large:n] + level], axis=0)
        out[by_size[large:at_least[0]]] += rest
    if large:
        counts = -negative[:large]
        begins = np.cumsum(counts) - counts
        members = np.repeat(starts[:large] - begins, counts) + np.arange(counts.sum())
        out[by_size[:large]] = np.add.reduceat(values.take(order[members], axis=0), begins, axis=0)
    return out


def _steps(ids: np.ndarray, place: np.ndarray):
    """Slices of a sequence: (slice, class, class rows, positions of words, word in class, word rows)."""
    features = context_features(ids, place)
    classes = np.where(ids < VOCABULARY, ids // WORDS_PER_CLASS, ids - VOCABULARY + CLASSES)
    rows = np.stack([_mix(features[:, k], 17 * k) for k in range(FEATURES)], axis=1)
    for s in range(0, len(ids), STEP_TOKENS):
        part = slice(s, s + STEP_TOKENS)
        inside = np.flatnonzero(ids[part] < VOCABULARY)
        c = classes[part][inside]
        f = features[part][inside]
        word_rows = np.stack([_mix(f[:, k] * CLASSES + c, 17 * k + 5) for k in range(FEATURES)], axis=1)
        yield part, classes[part], rows[part], inside, ids[part][inside] % WORDS_PER_CLASS, ROWS + c, word_rows


def log_probabilities(weights: dict, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Natural log of each token's class, and of frequent words in their class."""
    out = np.empty(len(ids))
    for part, classes, rows, inside, word, bias, word_rows in _steps(ids, place):
        value = _log_target(_sum_rows(weights["classes"], ROWS, rows), classes)
        if len(inside):
            value[inside] += _log_target(_sum_rows(weights["words"], bias, word_rows), word)
        out[part] = value
    return out


def _update(table: np.ndarray, speed: np.ndarray, touched: np.ndarray, bias, rows: np.ndarray,
            target: np.ndarray, rate: float) -> None:
    """One gradient step on all features; a row's step shrinks with the gradients it has seen."""
    error = _softmax(_sum_rows(table, bias, rows))
    error[np.arange(len(target)), target] -= 1
    for k in range(rows.shape[1]):
        order = np.argsort(rows[:, k].astype(np.int16), kind="stable")  # ROWS fit; a radix sort
        sorted_rows = rows[order, k]
        first = np.flatnonzero(np.diff(sorted_rows, prepend=-1))
        at = sorted_rows[first]
        sizes = np.diff(first, append=len(order))
        slope = _sum_groups(error, order, first, sizes)
        speed[at] += (slope * slope).sum(axis=1)
        slope *= (rate / np.sqrt(speed[at] + 1))[:, None]
        table[at] = table.take(at, axis=0) - slope
        touched[at] += sizes


def train_tables(weights: dict, shares: Iterator[tuple[np.ndarray, np.ndarray]], rate: float):
    """Gradient updates over one share; yields (table, rows, weights, changes) of the rows each table met."""
    start = weights
    own = {k: v.copy() for k, v in start.items()}
    speed = {k: np.zeros(len(v), dtype=np.float32) for k, v in own.items()}
    touched = {k: np.zeros(len(v), dtype=np.int64) for k, v in own.items()}
    for ids, place in shares:
        for _, classes, rows, inside, word, bias, word_rows in _steps(ids, place):
            _update(own["classes"], speed["classes"], touched["classes"], ROWS, rows, classes, rate)
            if len(inside):
                _update(own["words"], speed["words"], touched["words"], bias, word_rows, word, rate)
    for number, name in enumerate(("classes", "words")):
        met = np.flatnonzero(touched[name])
        yield number, met, touched[name][met].astype(np.float64), own[name][met] - start[name][met]


def train_share(weights: dict, shares: Iterator[tuple[np.ndarray, np.ndarray]], rate: float):
    """``train_tables`` row by row: (table, row, weight, change)."""
    for number, rows, times, changes in train_tables(weights, shares, rate):
        for row, weight, change in zip(rows.tolist(), times.tolist(), changes):
            yield number, row, weight, change


def _packed(rows: np.ndarray) -> pa.Array:
    """One binary value per row of a matrix."""
    width = rows.itemsize * rows.shape[1]
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def _averaged(changes: DataFrame) -> DataFrame:
    """Mean change per weight row, weighted by how often tasks met it; bounded by the model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = [np.zeros(ROWS + 1), np.zeros(ROWS + CLASSES)]
        sums = [np.zeros((len(w), n), dtype=np.float32) for w, n in zip(weights, (OUT, WORDS_PER_CLASS))]
        for batch in batches:
            t, row, weight = (batch.column(k).to_numpy() for k in range(3))
            for number, (held, total) in enumerate(zip(weights, sums)):
                here = np.flatnonzero(t == number)
                if not len(here):
                    continue
                data = b"".join(batch.column(3).take(pa.array(here)).to_pylist())
                change = np.frombuffer(data, dtype=np.float16).reshape(len(here), -1).astype(np.float32)
                change *= weight[here, None].astype(np.float32)
                # A row has one change from each task: all first ones are added together, then all second ones.
                order = np.argsort(row[here], kind="stable")
                first = np.flatnonzero(np.diff(row[here][order], prepend=-1))
                sizes = np.diff(first, append=len(order))
                for level in range(sizes.max()):
                    member = order[first[sizes > level] + level]
                    held[row[here[member]]] += weight[here[member]]
                    total[row[here[member]]] += change[member]
        for number, (held, total) in enumerate(zip(weights, sums)):
            met = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(met), number, dtype=np.int32)), pa.array(met.astype(np.int32)),
                _packed((total[met] / held[met, None]).astype(np.float32))], names=["t", "row", "data"])

    return changes.repartition("t", "row").mapInArrow(run, "t int, row int, data binary")


def train(docs: DataFrame, vocab, rounds: int = ROUNDS, rate: float = RATE, id_col: str = "doc_id",
          text_col: str = "text") -> dict[str, np.ndarray]:
    """Weights after ``rounds`` rounds, each over another share of the documents."""
    sc = docs.sparkSession.sparkContext
    weights = new_weights(vocab.value)
    share = F.pmod(F.xxhash64(id_col), F.lit(rounds))
    for number in range(rounds):
        shared = sc.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            reader = Reader(vocab.value)

            def read():
                for part in in_slices(batches, "text", 1 << 20):
                    ids, place, *_ = reader.read(texts_of(part.column(0)))
                    yield ids, place

            for t, rows, weight, change in train_tables(shared.value, read(), rate):
                for s in range(0, len(rows), 4096):
                    here = slice(s, s + 4096)
                    met = rows[here].astype(np.int32)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(met), t, dtype=np.int32)), pa.array(met), pa.array(weight[here]),
                        _packed(change[here].astype(np.float16))], names=["t", "row", "weight", "data"])

        part = docs.where(share == number).select(F.col(text_col).alias("text"))
        changes = part.mapInArrow(run, "t int, row int, weight double, data binary")
        weights = {k: v.copy() for k, v in weights.items()}
        for r in _averaged(changes).collect():
            name = ("classes", "words")[r.t]
            weights[name][r.row] += np.frombuffer(r.data, dtype=np.float32)
        shared.unpersist()
    return weights


# --- scoring ------------------------------------------------------------------------------

def score(docs: DataFrame, counts: DataFrame, vocab, weights: dict, id_col: str = "doc_id",
          text_col: str = "text", held_out_fold: int = 1) -> DataFrame:
    """One row per input row with base and model score of its whole text.

    Null and empty texts consist of their end alone. Repeated rows come out as often as they
    came in; an empty table gives an empty result, and without training documents every
    token is unknown. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    ten = np.log(10)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, mass = Reader(vocab.value), vocab.value["mass"]
        row = TaskContext.get().partitionId() << 40
        for part in in_slices(batches, "text", 1 << 20):
            texts = texts_of(part.column(1))
            ids, place, number, index, missing, rare = reader.read(texts)
            log_c = np.where(index >= 0, np.log10(reader.counts[index] + 0.5), 0.0)
            model = log_probabilities(shared.value, ids, place) / ten
            outside = np.flatnonzero(ids >= VOCABULARY)
            model[outside] += log_c[outside] - np.log10(mass[ids[outside] - VOCABULARY])
            n = len(texts)
            per_text = np.bincount(number[missing], minlength=n)
            offsets = np.concatenate(([0], np.cumsum(per_text))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row, row + n)), part.column(0),
                pa.array(np.bincount(number, minlength=n)), pa.array(np.bincount(number, index >= 0, n).astype(np.int64)),
                pa.array(np.bincount(number, log_c, n)), pa.array(np.bincount(number, model, n)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(rare, pa.binary()))],
                names=["row", "doc_id", "n_tokens", "n_known", "base", "model", "rare"])
            row += n

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    kinds = ("row long, doc_id long, n_tokens long, n_known long, base double, model double, "
             "rare array<binary>")
    scored = stored(rows.mapInArrow(run, kinds), "scored")
    # The frequent tokens are not among these, so no key of the join is hot.
    asked = scored.select("row", F.explode("rare").alias("token"))
    found = asked.join(counts, "token").groupBy("row").agg(
        F.count("*").alias("more_known"), F.sum(F.log10(F.col("c") + 0.5) - F.log10(F.lit(0.5))).alias("more"))
    n_rare = F.size("rare") * F.log10(F.lit(0.5))
    extra = n_rare + F.coalesce("more", F.lit(0.0))
    held = vocab.value
    base = np.log10(held["tokens"] + 0.5 * (held["kinds"] + 1))
    return scored.join(found, "row", "left").select(
        "doc_id", (fold("doc_id") == held_out_fold).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(held["tokens"]).cast("long").alias("train_tokens"),
        (F.col("base") + extra - F.col("n_tokens") * F.lit(float(base))).alias("base_score"),
        (F.col("model") + extra).alias("score"))


def fit_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  held_out_fold: int = 1, rounds: int = ROUNDS, lookup: int = LOOKUP) -> DataFrame:
    """Learns from all documents outside the held-out fold and scores all documents."""
    training = docs.where(fold(id_col) != held_out_fold)
    counts = stored(token_counts(training, text_col), "token-counts")
    vocab = docs.sparkSession.sparkContext.broadcast(vocabulary(counts, lookup))
    weights = train(training, vocab, rounds, id_col=id_col, text_col=text_col)
    return score(docs, counts, vocab, weights, id_col, text_col, held_out_fold)
