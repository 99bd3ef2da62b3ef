"""Toxicity by noisy-channel deobfuscation.

Spans where letters may be disguised (signs or digits inside words, letters repeated three
times or more, single letters with gaps) become character lattices. Viterbi decoding under a
character trigram model of the whole corpus picks the likeliest writing. Elsewhere the
lattice has one path, the text itself. The restored text is scored by the evidence of its
words and word beginnings, learned from labelled training rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, in_slices
from tidemark.llm.quality_knn import labelled_sample

# The letters of the model, and what stands for a letter in disguised words.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâäãåæçèéêëìíîïñòóôöõøùúûüýÿßœ"
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
SIZE = len(LETTERS) + 1
POINTS = 0x2100
MAX_LABELLED = 20_000
MEMO = 200_000
WORDS = re.compile(r"[^\W\d_]+")


def _tables() -> tuple[np.ndarray, np.ndarray]:
    letters, signs = np.zeros(POINTS, dtype=np.int32), np.zeros(POINTS, dtype=bool)
    for number, c in enumerate(LETTERS, 1):
        letters[ord(c)] = number
        if len(c.upper()) == 1 and ord(c.upper()) < POINTS:
            letters[ord(c.upper())] = number
    for c in LEET:
        signs[ord(c)] = True
    return letters, signs


LETTER_CODE, IS_SIGN = _tables()
CODE = {chr(p): int(LETTER_CODE[p]) for p in np.flatnonzero(LETTER_CODE).tolist()}


def points(text: str) -> np.ndarray:
    """Code points, those the tables do not hold as 0."""
    found = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    return np.where(found < POINTS, found, 0)


# --- character model ----------------------------------------------------------

def trigram_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(id, n): counts of letter trigrams over all whole texts, word boundaries included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE ** 3, dtype=np.int64)
        for part in in_slices(batches, "text"):
            joined = "\n\n".join(t for t in part.column(0).to_pylist() if t)
            c = np.concatenate(([0, 0], LETTER_CODE[points(joined)], [0, 0]))
            ids = (c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:]
            total += np.bincount(ids[(c[1:-1] > 0) | (c[2:] > 0)], minlength=len(total))
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "id long, n long")
    return rows.groupBy("id").agg(F.sum("n").alias("n"))


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """log p(letter | two before), interpolated with shorter contexts; at most SIZE**3 counts."""
    counts = np.zeros(SIZE ** 3)
    for r in trigram_counts(docs, text_col).collect():
        counts[r.id] = r.n
    three = counts.reshape(SIZE, SIZE, SIZE)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    uni = (one + 1) / (one.sum() + SIZE)
    bi = (two + 20 * uni) / (two.sum(axis=1, keepdims=True) + 20)
    tri = (three + 20 * bi[None]) / (three.sum(axis=2, keepdims=True) + 20)
    return np.log(tri)


# --- decoding ---------------------------------------------------------------------

def decode(span: str, model: np.ndarray, keep: float = 3.0, swap: float = 1.5,
           drop: float = 0.5) -> str:
    """The likeliest plain writing of one span under channel and character model.

    A sign is kept as a boundary at cost ``keep`` (``drop`` where no letter follows it) or
    read as a letter at cost ``swap``; a letter that repeats the one before can be dropped at
    cost ``drop``, and a gap between single letters is kept at cost ``swap``.
    """
    gaps = _gaps(span)
    best: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for i, c in enumerate(span):
        if c in CODE:
            options = [(c, CODE[c], 0.0)]
            if i and span[i - 1].lower() == c.lower():
                options.append(("", -1, drop))
        elif c in LEET:
            inner = i + 1 < len(span) and (span[i + 1] in CODE or span[i + 1] in LEET or i + 1 in gaps)
            options = [(c, 0, keep if inner else drop)] + [(x, CODE[x], swap) for x in LEET[c]]
            if i and span[i - 1] == c:
                options.append(("", -1, drop))
        elif i in gaps:
            options = [(c, 0, swap), ("", -1, 0.0)]
        else:
            options = [(c, 0, 0.0)]
        following: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, out) in best.items():
            for text, code, price in options:
                state, total = (a, b), cost + price
                if code >= 0 and (code or b):
                    total -= model[a, b, code]
                    state = (b, code)
                if state not in following or total < following[state][0]:
                    following[state] = (total, out + text)
        best = following
    return min((cost - (model[a, b, 0] if b else 0.0), out) for (a, b), (cost, out) in best.items())[1]


def _gaps(span: str) -> set[int]:
    """Positions of signs between two single letters."""
    def single(i: int) -> bool:
        return (0 <= i < len(span) and (span[i] in CODE or span[i] in LEET)
                and (i == 0 or span[i - 1] not in CODE) and (i + 1 == len(span) or span[i + 1] not in CODE))
    return {i for i, c in enumerate(span) if c not in CODE and c not in LEET and single(i - 1) and single(i + 1)}


def spans(text: str) -> list[tuple[int, int]]:
    """Where the lattice has more than one path, as whole tokens, in order, without overlap."""
    p = points(text)
    n = len(p)
    if n < 3:
        return []
    code = LETTER_CODE[p]
    letter, sign = code > 0, IS_SIGN[p]
    hits = [np.flatnonzero(sign[:-1] & letter[1:])]
    hits.append(np.flatnonzero(letter[2:] & (code[2:] == code[1:-1]) & (code[1:-1] == code[:-2])) + 1)
    gap = p == 32
    gap |= (p == ord(".")) | (p == ord("-")) | (p == ord("_")) | (p == ord("*"))
    framed = np.concatenate(([True], ~(letter | sign), [True]))
    alone = (letter | sign) & framed[:-2] & framed[2:]
    spaced = alone.copy()
    if n >= 5:
        three = alone[:-4] & gap[1:-3] & alone[2:-2] & gap[3:-1] & alone[4:]
        spaced[:] = False
        starts = np.flatnonzero(three)
        for k in (0, 2, 4):
            spaced[starts + k] = True
        hits.append(starts)
    else:
        spaced[:] = False
    found: list[tuple[int, int]] = []
    for at in np.unique(np.concatenate(hits)).tolist():
        if found and at < found[-1][1]:
            continue
        start = end = at
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        while end < n and (not text[end].isspace() or (spaced[end - 1] and end + 1 < n and spaced[end + 1])):
            end += 1
        found.append((max(start, found[-1][1] if found else 0), end))
    return found


def restore(text: str, model: np.ndarray, memo: dict[str, str]) -> str:
    """The text with every disguised span replaced by its likeliest writing."""
    out, at = [], 0
    for start, end in spans(text):
        span = text[start:end]
        plain = memo.get(span)
        if plain is None:
            if len(memo) >= MEMO:
                memo.clear()
            plain = memo[span] = decode(span, model)
        out += [text[at:start], plain]
        at = end
    return "".join([*out, text[at:]]) if out else text


# --- evidence -----------------------------------------------------------------------

def word_features(word: str) -> list[int]:
    """The word and its beginnings of three to six letters, as 32-bit hashes."""
    return [zlib.crc32(f"={word}".encode())] + [
        zlib.crc32(word[:k].encode()) for k in range(3, min(len(word), 6) + 1)]


def document_evidence(text: str, table: dict[int, float], memo: dict[str, float]) -> tuple[float, ...]:
    """The three strongest words' evidence, and the share of words with any."""
    words = WORDS.findall(text.lower())
    found = []
    for word, n in Counter(words).items():
        value = memo.get(word)
        if value is None:
            if len(memo) >= MEMO:
                memo.clear()
            value = memo[word] = max([table.get(f, 0.0) for f in word_features(word)])
        if value:
            found.append((value, n))
    found.sort(reverse=True)
    best = [v for v, n in found[:3] for _ in range(min(n, 3))][:3] + [0.0] * 3
    share = sum(n for v, n in found if v > 3) / max(len(words), 1)
    return (*best[:3], 10 * math.sqrt(share))


def _features_of(rows: DataFrame, model, table) -> DataFrame:
    """rows (doc_id, text, y) to (doc_id, y, e0..e3)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled: dict[str, str] = {}
        known: dict[str, float] = {}
        for part in in_slices(batches, "text"):
            found = [document_evidence(restore(t or "", model.value, spelled), table.value, known)
                     for t in part.column(1).to_pylist()]
            columns = [pa.array(c, pa.float64()) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), *columns], names=["doc_id", "y", "e0", "e1", "e2", "e3"])

    kinds = "doc_id long, y int, e0 double, e1 double, e2 double, e3 double"
    return rows.select("doc_id", "text", "y").mapInArrow(run, kinds)


def evidence_table(rows: DataFrame, model, strength: float = 5.0, least: float = 1.5) -> dict[int, float]:
    """Smoothed log odds per feature from document counts; only those that speak for label 1.

    ``rows`` is part of the bounded labelled sample, so the table is bounded too.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled: dict[str, str] = {}
        for part in in_slices(batches, "text"):
            counts: dict[tuple[int, int], int] = Counter()
            for text, y in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = set(WORDS.findall(restore(text or "", model.value, spelled).lower()))
                counts.update((f, y) for f in {f for w in words for f in word_features(w)})
                counts[-1, y] += 1
            yield pa.RecordBatch.from_pydict({
                "f": pa.array([f for f, _ in counts], pa.int64()),
                "n1": pa.array([n * y for (_, y), n in counts.items()], pa.int64()),
                "n0": pa.array([n * (1 - y) for (_, y), n in counts.items()], pa.int64())})

    counted = rows.select("text", "y").mapInArrow(run, "f long, n1 long, n0 long")
    summed = counted.groupBy("f").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    summed = summed.where("f = -1 OR (n1 >= 3 AND n1 > n0)")
    found = {r.f: (r.n1, r.n0) for r in summed.collect()}
    ones, zeros = found.pop(-1, (0, 0))
    if not ones or not zeros:
        return {}
    base = ones / (ones + zeros)
    odds = {f: math.log((a + strength * base) / (b + strength * (1 - base))) - math.log(base / (1 - base))
            for f, (a, b) in found.items()}
    return {f: v for f, v in odds.items() if v >= least}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(curve, slope)
    return w


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", held_out_fold: int | None = 0,
        bound: int = MAX_LABELLED) -> dict:
    """Character model of all documents; evidence and weights from at most ``bound`` labelled rows."""
    sc = docs.sparkSession.sparkContext
    model = sc.broadcast(character_model(docs))
    sample = labelled_sample(docs, labels, label, held_out_fold, bound)
    third = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3))
    table = evidence_table(sample.where(third != 0), model)
    rows = _features_of(sample.where(third == 0), model, sc.broadcast(table)).collect()
    rows.sort()
    if not rows:
        return {"model": model, "table": {}, "weights": np.zeros(5)}
    x = np.array([tuple(r)[2:] for r in rows])
    return {"model": model, "table": table, "weights": _logistic(x, np.array([r.y for r in rows]))}


def score(docs: DataFrame, fitted: dict, id_col: str = "doc_id", text_col: str = "text",
          held_out_fold: int = 0) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Null and empty texts have no evidence and get the score of that. Repeated rows come out
    as often as they came in; an empty table gives an empty result; without labelled rows of
    both kinds every score is the same. Other columns are ignored.
    """
    table = docs.sparkSession.sparkContext.broadcast(fitted["table"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.lit(0).alias("y"))
    e = _features_of(rows, fitted["model"], table)
    *slopes, rest = (float(w) for w in fitted["weights"])
    z = sum((F.col(f"e{i}") * w for i, w in enumerate(slopes)), F.lit(rest))
    chance = 1 / (1 + F.exp(-z))
    return e.select("doc_id", (fold("doc_id") == held_out_fold).alias("held_out"), chance.alias("score"),
                    (chance >= 0.5).cast("int").alias("predicted"))
