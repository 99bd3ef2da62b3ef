"""Ranked search against a full scan in plain Python."""

import math
import random
import re
from collections import Counter

import pytest
from helpers import awkward, frame, nothing, words

from tidemark.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    total = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counted:
            n, score = sum(c.values()), 0
            m = 25 + (75 * n * len(counted)) // total
            for t in terms(text):
                if tf := c.get(t):
                    w = math.floor(1000 * math.log((2 * len(counted) + 2) / (2 * df[t] + 1)))
                    score += w * ((10 ** 9 * tf) // (1000 * tf + 8 * m))
            if score > 0 and i is not None:
                found.append((-score, i))
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def test_terms_are_those_of_the_pattern():
    text = "Él Ño7_x-ÀB c d\x85e f ABC\x1f9[Z]^`{~\x7f"
    assert [t.decode() for t in ranked_search.terms_of(text.encode())] == terms(text)


@pytest.mark.parametrize("limits", [{}, {"postings": 9, "item_bytes": 150}])
def test_equals_a_full_scan(spark, limits):
    rng = random.Random(7)
    words_ = [f"t{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(rng.choices(words_, weights, k=rng.choice([1, 3, 9, 9, 9, 40, 200])))) for i in range(300)]
    docs += [(300 + i, docs[5][1]) for i in range(50)] + [(5, docs[5][1])]  # copies, one of them under the same id
    items = [(i, " ".join(rng.choices(words_, k=rng.choice([1, 4, 12]))) + " T1 unheard") for i in range(25)]
    items += [(3, items[3][1]), (90, "unheard"), (91, "")]
    got = ranked_search.rank(spark.createDataFrame(docs, "doc_id long, text string").repartition(6),
                             spark.createDataFrame(items, ITEMS), **limits)
    assert sorted(map(tuple, got.collect())) == plain(docs, items)


def test_ties_go_to_the_smaller_id_and_a_term_of_all_documents_weighs_nothing(spark):
    docs = frame(spark, {i: "same" + " words" * (i < 41) for i in range(700, 10, -1)})
    items = spark.createDataFrame([(1, "words"), (2, "same")], ITEMS)
    got = sorted(map(tuple, ranked_search.rank(docs, items).select("item_id", "rank", "doc_id").collect()))
    assert got == [(1, r, 10 + r) for r in range(1, 11)]


def test_bounds_are_never_below_a_score():
    rng = random.Random(1)
    vocabulary = {f"{i}".encode(): i for i in range(6)}
    counts = [Counter({f"{i}".encode(): rng.randint(1, 3) for i in rng.sample(range(6), 3)}) for _ in range(5)]
    items = ranked_search.Items(list(range(5)), counts, vocabulary, {i: rng.randint(0, 900) for i in range(6)})
    import numpy as np
    for m in (25, 300):
        docs = [{i: rng.randint(1, 50) for i in rng.sample(range(6), 4)} for _ in range(20)]
        top = np.array([max(d.get(i, 0) for d in docs) for i in range(6)])
        bound = items.bounds(m, np.arange(6), top)
        for d in docs:
            assert (items.bounds(m, np.array(sorted(d)), np.array([d[i] for i in sorted(d)])) <= bound).all()


def test_awkward_rows(spark):
    docs = awkward(spark)
    items = spark.createDataFrame([(1, "TWICE a"), (2, ""), (3, None), (None, "id here"), (5, words(1, 5000)), (6, "w1x" + "9" * 90_000)], ITEMS)
    extra = items.selectExpr("*", "1 AS item_no", "2 AS score", "3 AS doc_id", "4 AS m")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = ranked_search.rank(docs, extra).collect()
    wanted = [tuple(-1 if v is None else v for v in r) for r in plain(texts, [(-1 if r.item_id is None else r.item_id, r.text) for r in items.collect()])]
    assert sorted(tuple(-1 if v is None else v for v in r) for r in got) == wanted
    assert ranked_search.rank(nothing(spark), items).collect() == []
    assert ranked_search.rank(docs, items.where("false")).collect() == []
