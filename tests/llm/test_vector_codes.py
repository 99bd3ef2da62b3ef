"""Product codes against plain Python, and rows that must not break them."""

import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * np.float32(x).item()) for x in v], label) for i, v, label in rows]
    kept.sort(key=lambda r: (r[0], r[1]))
    width = len(kept[0][1]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[cut[e][p] for e in range(min(entries, len(kept)))] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            taken = {}
            for x in cut:
                taken.setdefault(nearest(x[p], books[p])[1], []).append(x[p])
            for e, own in taken.items():
                books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, total = [], {}
    for (i, _, label), x in zip(kept, cut):
        best = [nearest(x[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in best)
        total[label] = total.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for _, e in best), error, label))
    return sorted((i, c, e, total[label], digest) for i, c, e, label in out)


@pytest.mark.parametrize("seed", range(2))
def test_codes_equal_a_plain_search(spark, seed):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(16)] for _ in range(5)]
    rows = [(i, [m + rng.gauss(0, 0.05) for m in rng.choice(middles)], rng.choice([None, 1, 2])) for i in range(150)]
    rows += [(150 + i, rows[3][1], 1) for i in range(60)]  # a group of copies, ties included
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted(map(tuple, vector_codes.encode(frame).collect())) == plain(rows)


def test_any_start_gives_the_nearest_entry():
    rng = np.random.default_rng(5)
    centres = rng.integers(-40, 40, (16, 3))
    centres[7] = centres[2]
    points = rng.integers(-50, 50, (3000, 3))
    wanted = vector_codes.nearest_of_all(points, centres)
    for start in (wanted, rng.integers(0, 16, 3000), np.zeros(3000, dtype=np.int64)):
        best, least = vector_codes.assign(points, start, centres)
        assert (best == wanted).all() and (least == vector_codes.distances(points, centres[wanted])).all()


def test_awkward_vectors(spark):
    whole = [0.5] * 8
    rows = [(1, whole, None), (1, whole, 3), (2, None, 1), (3, [float("nan")] + whole[1:], 1), (4, [None] + whole[1:], 1),
            (5, [float("inf")] + whole[1:], 1), (6, whole * 2, 1), (7, [], 1), (8, [0.1] * 7, 1), (None, [-0.5] * 8, None), (9, [0.0] * 8, 3)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS code", "1 AS q", "2 AS v", "3 AS near", "4 AS error", "5 AS _label")
    got = sorted(map(tuple, vector_codes.encode(frame).select("vec_id", "code", "error", "label_error").collect()), key=repr)
    # Copies of one row take two entries, the lower of which gets both; every vector is met exactly.
    assert got == [(1, "00" * 8, 0, 0), (1, "00" * 8, 0, 0), (9, "02" * 8, 0, 0), (None, "03" * 8, 0, 0)]
    assert vector_codes.encode(frame.where("false")).collect() == []
    with pytest.raises(Exception, match="too large|OVERFLOW"):
        vector_codes.encode(spark.createDataFrame([(1, [1e5] * 64, 1)], SCHEMA)).collect()
