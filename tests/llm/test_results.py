"""Results against brute force, round trips and held-out labels."""

import itertools
import math
import random
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from conftest import SMALL
from helpers import frame, words
from pyspark.sql import functions as F

from tidemark.llm import (
    catalog, common, decontamination, length_histogram, maxent_lm, neighbours, quality_knn, sentence_pieces, simhash_dedup,
    substring_dedup, toxicity,
)


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())


# --- op1 ---------------------------------------------------------------------------------

def test_language_model_base_and_gain(spark, texts):
    got = catalog.QUERIES["op1_model_scores"](spark, SMALL).collect()
    split = {i: t.encode().lower().split() + [b"\n"] for i, t in texts.items()}
    counts = Counter(w for i, ws in split.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    for r in got:
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in split[r.doc_id])
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (
            len(split[r.doc_id]), sum(w in counts for w in split[r.doc_id]), total)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_untrained_model_is_a_distribution():
    vocab = {"words": [f"w{i}".encode() for i in range(3000)], "counts": np.arange(3000, 0, -1.0),
             "mass": np.full(maxent_lm.RARE, 400.0), "tokens": 1, "kinds": 1}
    weights = maxent_lm.new_weights(vocab)
    place = np.zeros(maxent_lm.START, dtype=np.int64)
    ids = np.arange(maxent_lm.START)
    p = np.exp(maxent_lm.log_probabilities(weights, ids, place))
    assert p.sum() == pytest.approx(1, abs=1e-4)


def test_every_step_trains_every_feature():
    """Also a share of a single slice; the last token with the third last is one of the features."""
    rng = random.Random(4)
    vocab = {"words": [f"w{i}".encode() for i in range(100)], "counts": np.full(100, 50.0),
             "mass": np.full(maxent_lm.RARE, 1.0), "tokens": 5000, "kinds": 100}
    weights = maxent_lm.new_weights(vocab)
    ids = np.array([rng.randrange(100) for _ in range(500)])
    place = np.arange(500)
    met = {(t, row) for t, row, *_ in maxent_lm.train_share(weights, iter([(ids, place)]), 0.5)}
    features = maxent_lm.context_features(ids, place)
    assert features.shape[1] == 4 and len(set(features[3:, 3].tolist())) > 400
    for k in range(4):
        assert {(0, row) for row in maxent_lm._mix(features[:, k], 17 * k).tolist()} <= met


# --- op2 ---------------------------------------------------------------------------------

def test_pieces_decode_to_the_text(spark, texts):
    odd = {-1: " a  b ", -2: "▁ in the text", -3: "日本 🙂", -4: "tab\tline\nend "}
    docs = frame(spark, texts | odd)
    encoded = sentence_pieces.encode(docs)
    back = {r.doc_id: r.text for r in sentence_pieces.decode(encoded).collect()}
    assert back == texts | odd
    for r in encoded.limit(40).collect():
        scores = [r.score, *[o.score for o in r.others]]
        assert scores == sorted(scores, reverse=True)
        for other in r.others:
            ids = sentence_pieces.alternative(list(r.ids), [c.asDict() for c in other.changes])
            assert ids != list(r.ids) and sentence_pieces.decode_ids(ids).decode() == (texts | odd)[r.doc_id]


@pytest.mark.parametrize("text", ["the cat sat", "hello", "a  b", "ünder"])
def test_n_best_is_exact(text):
    v = sentence_pieces.vocabulary(sentence_pieces.MODEL)
    lattice = "▁" + text.replace(" ", "▁")

    def paths(at):
        if at == len(lattice):
            yield 0.0, ()
            return
        for end, ids, gain in v.edges(lattice, at):
            for score, rest in paths(end):
                yield gain + score, ids + rest

    every = sorted((s for s, _ in paths(0)), reverse=True)[:8]
    _, score, others = sentence_pieces.Encoder(sentence_pieces.MODEL).encode(text.encode(), 8)
    assert [score, *[o["score"] for o in others]] == pytest.approx(every)


@pytest.mark.parametrize("text", ["=" * 10_000, "a" * 10_000, "ab" * 5_000, "x" + "=-" * 3_000 + " " + "a" * 2_000])
def test_n_best_of_long_runs_equals_a_dynamic_program(text):
    """All orders of the same pieces score alike there; the search must not walk through them."""
    v = sentence_pieces.vocabulary(sentence_pieces.MODEL)
    lattice = "▁" + text.replace(" ", "▁")
    best = [[0.0]] + [[] for _ in lattice]
    for at in range(len(lattice)):
        best[at] = sorted(best[at], reverse=True)[:4]
        for end, _, gain in v.edges(lattice, at):
            best[end] += [s + gain for s in best[at]]
    started = time.process_time()
    ids, score, others = sentence_pieces.Encoder(sentence_pieces.MODEL).encode(text.encode(), 4)
    assert time.process_time() - started < 30
    assert [score, *[o["score"] for o in others]] == pytest.approx(sorted(best[-1], reverse=True)[:4], rel=1e-12)
    spelled = [sentence_pieces.alternative(ids.tolist(), o["changes"]) for o in others]
    assert len({tuple(s) for s in [ids.tolist(), *spelled]}) == 4
    assert all(sentence_pieces.decode_ids(s).decode() == text for s in [ids.tolist(), *spelled])


# --- op3 ---------------------------------------------------------------------------------

def test_length_table_answers_every_limit(spark, texts):
    encode = length_histogram.encoder(length_histogram.RANKS).encode_ordinary
    lengths = [len(encode(t)) for t in texts.values()]
    docs = frame(spark, texts)
    hist = length_histogram.histogram(length_histogram.encoded_lengths(docs)).cache()
    for r in length_histogram.limits(hist).collect():
        assert r.docs == lengths.count(r.n_tokens)
        assert r.docs_longer == sum(n > r.n_tokens for n in lengths)
        assert r.tokens_longer == sum(n for n in lengths if n > r.n_tokens)
        assert r.kept_tokens == sum(min(n, r.n_tokens) for n in lengths)
    limits = [1, 100, 10 ** 6]
    got = {r.context: (r.total_tokens, r.docs_cut) for r in length_histogram.truncated_totals(hist, limits).collect()}
    assert got == {c: (sum(min(n, c) for n in lengths), sum(n > c for n in lengths)) for c in limits}
    half = length_histogram.quantiles(hist, [0.5]).first().n_tokens
    assert half == sorted(lengths)[math.ceil(len(lengths) / 2) - 1]


# --- op4, op10 -----------------------------------------------------------------------------

def test_disguised_words_are_restored(spark, texts):
    model = toxicity.character_model(frame(spark, texts | {9000 + i: "idiot stupid moron scum loser" for i in range(300)}))
    for shown, plain in {"s t u p i d": "stupid", "stuuupid.": "stupid.", "$cum": "scum", "m0r0n": "moron",
                         "i.d.i.o.t": "idiot", "the end": "the end"}.items():
        assert toxicity.restore(shown, model, {}) == plain


@pytest.mark.parametrize("name,label,least", [("op4_toxicity_scores", "toxic", 0.85), ("op10_quality_votes", "quality", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    marks = {r.doc_id: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = [r for r in catalog.QUERIES[name](spark, folder).collect() if r.held_out and r.doc_id in marks]
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.predicted == marks[r.doc_id] for r in got) >= least * len(got)


# --- op5 ---------------------------------------------------------------------------------

def test_every_repeated_passage_is_found(spark, texts):
    got = {r.doc_id for r in catalog.QUERIES["op5_repeated_passages"](spark, SMALL).collect()}
    holders = defaultdict(set)
    for i, t in texts.items():
        w = t.encode().lower().split()
        for k in range(len(w) - substring_dedup.MIN_WORDS + 1):
            holders[tuple(w[k:k + substring_dedup.MIN_WORDS])].add(i)
    assert set().union(*[h for h in holders.values() if len(h) > 1]) <= got


def test_passages_are_cut_and_clean_documents_stay(spark):
    shared, nearly = words(1, 60), words(2, 80).split()
    changed = list(nearly)
    changed[40] = "other"
    docs = frame(spark, {
        1: f"{words(10, 70)} {shared} {words(11, 70)}", 2: f"{words(12, 90)}\n{shared}\n{words(13, 30)}",
        3: " ".join(nearly), 4: f"{words(14, 20)} {' '.join(changed)}", 5: words(15, 300), 6: shared,
        7: f"{words(16, 60)} {' '.join(shared.split()[:30])} {words(17, 60)}"})
    found = {r.doc_id: r for r in substring_dedup.repeated_passages(docs).collect()}
    assert set(found) == {1, 2, 3, 4, 6}
    assert (found[2].class_id, found[6].class_id, found[4].class_id) == (1, 1, 3)
    assert [(p.start, p.end) for p in found[2].passages] == [(90, 150)]
    left = {r.doc_id: r.text for r in substring_dedup.remove(docs).collect()}
    assert set(left) == {1, 2, 3, 4, 5, 7}
    assert left[2].split() == (words(12, 90) + " " + words(13, 30)).split() and left[4].split() == words(14, 20).split()
    assert left[5] == words(15, 300)


@pytest.mark.parametrize("seed", range(3))
def test_compact_windows_are_nodes_of_the_cartesian_tree(seed):
    """Every subsequence that is long enough lies in exactly one window, whose centre is its minimum."""
    rng, width = random.Random(seed), 7
    texts = [[rng.getrandbits(64) for _ in range(n)] for n in (30, 3, 0, 7, 25)]
    texts[4][10:16] = [texts[4][0]] * 6
    # Texts end in four words that begin no shingle.
    flat = np.array([h for t in texts for h in [*t, 1, 2, 3, 4]], dtype=np.uint64)
    sizes = np.array([len(t) + 4 for t in texts])
    text = np.repeat(np.arange(len(texts)), sizes)
    starts = (np.cumsum(sizes) - sizes)[text]
    ends = starts + sizes[text] - 4
    key, c, left, right = (x.tolist() for x in substring_dedup.compact_windows(flat, starts, ends, width, 2))
    values = substring_dedup.packed_order(substring_dedup._mix(flat ^ np.uint64(3 * 0xD6E8FEB86659FD93 & (1 << 64) - 1))).tolist()
    at = 0
    for t in texts:
        for i in range(len(t)):
            for j in range(i + width - 1, len(t)):
                least = min(range(at + i, at + j + 1), key=values.__getitem__)
                assert [m for x, m, y in zip(left, c, right) if x <= at + i and m == least and at + j <= y] == [least]
        at += len(t) + 4
    assert all(any(s <= x and y < e for s, e in zip(starts.tolist(), ends.tolist())) and y - x + 1 >= width for x, y in zip(left, right))
    again = substring_dedup.compact_windows(flat, starts, ends, width, 2, spans=False)
    assert again[0].tolist() == key and again[1].tolist() == c


def test_passages_with_an_inserted_or_deleted_word_are_found(spark):
    texts, rng = {}, random.Random(5)
    for n in (55, 60, 70, 80, 90, 100):
        for what in range(10):
            passage = [f"p{rng.getrandbits(40)}" for _ in range(n)]
            other, at = list(passage), rng.randrange(n // 3, n - n // 3)
            other[at:at + what % 2] = [] if what % 2 else ["new"]
            for p in (passage, other):
                sides = [" ".join(f"f{rng.getrandbits(40)}" for _ in range(k)) for k in (80, 60)]
                texts[len(texts)] = f"{sides[0]} {' '.join(p)} {sides[1]}"
    found = {r.doc_id: r for r in substring_dedup.repeated_passages(frame(spark, texts)).collect()}
    pairs = [i for i in range(0, len(texts), 2) if i + 1 in found and found[i + 1].class_id == i]
    assert len(pairs) >= 0.95 * len(texts) / 2
    assert {p.start for i in pairs for p in found[i + 1].passages} == {80}


def test_nearly_every_similar_stretch_agrees_under_two_functions():
    rng, met = random.Random(8), 0
    for _ in range(400):
        x = [rng.getrandbits(64) for _ in range(50)]
        y = list(x)
        y[25] = 0
        keys = []
        for t in (x, y):
            shingles = substring_dedup.shingle_hashes(np.array(t, dtype=np.uint64))
            place = np.zeros(len(shingles), dtype=np.int64)
            keys.append({k for f in range(substring_dedup.FUNCTIONS) for k in substring_dedup.compact_windows(
                shingles, place, place + len(shingles), 46, f)[0].tolist()})
        met += len(keys[0] & keys[1]) >= substring_dedup.AGREE
    assert met >= 0.98 * 400


def test_exact_repeats_meet_in_groups_of_foreign_windows(spark, monkeypatch):
    """One key for every place and equal words beside each centre: only whole windows tell them apart."""
    def rows(docs, width, spans):
        every = docs.select(F.lit(8).cast("long").alias("key"), "u", F.explode(
            F.sequence(F.lit(0), F.size(F.split("text", " ")) - 50)).alias("c")).withColumns({"l": F.lit(0), "r": F.lit(45)})
        return every if spans else every.select("key", "u")

    monkeypatch.setattr(substring_dedup, "window_rows", rows)
    monkeypatch.setattr(substring_dedup, "_beside", lambda docs, windows: windows.select("key", "u", "c", "l", "r"))
    shared, other = words(1, 60), words(2, 55)
    docs = frame(spark, {1: f"{words(10, 70)} {other} {words(18, 9)}", 2: f"{words(11, 70)} {shared} {words(12, 50)}",
                         3: f"{words(13, 90)} {shared} {words(14, 20)}", 4: f"{words(15, 30)} {other} {words(16, 40)}"})
    found = {r.doc_id: r for r in substring_dedup.repeated_passages(docs).collect()}
    assert {i: r.class_id for i, r in found.items()} == {1: 1, 2: 2, 3: 2, 4: 1}
    assert [tuple(p) for p in found[3].passages] == [(90, 150, 2, 70)]
    assert [tuple(p) for p in found[4].passages] == [(30, 85, 1, 70)]


def test_copies_and_different_texts_under_one_id(spark):
    long, other = words(1, 80), words(2, 70)
    rows = [(1, long), (2, long), (2, long), (3, long.upper()), (4, other), (4, f"{words(3, 60)} {long}"), (5, f"{other} {words(4, 60)}"),
            (6, words(5, 20)), (7, words(5, 20)), (None, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in substring_dedup.repeated_passages(docs).collect()}
    assert {i: r.class_id for i, r in found.items()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1}
    assert found[2].n_words == 80 and found[5].n_words == 70 and [p.other for p in found[5].passages] == [4]
    left = sorted((r.doc_id or 0, r.text.strip()) for r in substring_dedup.remove(docs).collect())
    # The texts of id 4 come first among those that share a passage; what has nothing left goes.
    assert left == sorted([(0, long), (4, other), (4, f"{words(3, 60)} {long}"), (5, words(4, 60)), (6, words(5, 20)), (7, words(5, 20))])


def test_periodic_texts_are_compared_in_reasonable_time():
    x = [b"%d" % (i % 12) for i in range(3200)]
    started = time.process_time()
    assert substring_dedup.similar_parts(x, x[6:], 46, 0.8, [0, 6, -6])
    assert time.process_time() - started < 20


def test_similar_parts_of_moved_and_foreign_words():
    rng = random.Random(6)
    some = lambda n: [b"%d" % rng.getrandbits(40) for _ in range(n)]
    for n in (50, 75, 100, 400):
        for at in (5, n // 2, n - 5):
            p = some(n)
            left, right = some(40) + p + some(33), some(20) + p[:at] + [b"new"] + p[at:] + some(60)
            assert [r[:4] for r in substring_dedup.similar_parts(left, right, 46, 0.8)] == [(40, 40 + n, 20, 21 + n)]
    p = some(40)
    assert substring_dedup.similar_parts(some(40) + p + some(33), some(20) + p + some(60), 46, 0.8) == []


# --- op6 ---------------------------------------------------------------------------------

def test_short_items_and_span_removal(spark):
    docs = frame(spark, {1: "Start, one two THREE end!", 2: "nothing here", 3: "x " + words(3, 12) + " y"})
    items = spark.createDataFrame([(7, "One-Two three"), (8, words(3, 12)), (9, "")], "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.contamination(docs, items).collect()}
    assert [(got[i].n_words, got[i].n_hit, got[i].n_items) for i in (1, 2, 3)] == [(5, 3, 1), (2, 0, 0), (14, 12, 1)]
    cut = {r.doc_id: r.text for r in decontamination.remove(docs, items, what="spans").collect()}
    assert cut == {1: "Start, end!", 2: "nothing here", 3: "x y"}
    assert [r.doc_id for r in decontamination.remove(docs, items).collect()] == [2]


# --- op7 ---------------------------------------------------------------------------------

def test_simhash_against_brute_force(spark, texts):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in catalog.QUERIES["op7_simhash_components"](spark, SMALL).collect()}
    prints = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        shingles = [b" ".join(w[k:k + 3]) for k in range(max(len(w) - 2, 1))] if w else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {i: (f"{p:016x}", find(i)) for i, p in prints.items()}


@pytest.mark.parametrize("group", [3, 65_536])
def test_links_of_dense_groups_survive_splitting(spark, group):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    prints = sorted({centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))) for _ in range(150)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame_ = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = simhash_dedup.fingerprint_links(frame_, 3, group)
    placed = {r.node: r.root for r in common.components(found).collect()}

    def classes(of):
        out = defaultdict(set)
        for p in signed:
            out[of(p)].add(p)
        return sorted(map(sorted, out.values()))

    root = {p: p for p in signed}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in itertools.combinations(signed, 2):
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3:
            root[find(a)] = find(b)
    assert classes(lambda p: placed.get(p, p)) == classes(find)


# --- op9 ---------------------------------------------------------------------------------

def test_neighbours_over_many_tiles(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((300, 8)).astype(np.float32)
    base[100:120] = base[5]
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.nearest(v.where("vec_id % 20 = 0"), v, k=7, block=16).collect()
    exact = base.astype(np.float64)
    for q in range(0, 300, 20):
        score = (exact[q] * exact).sum(axis=1)
        best = sorted((i for i in range(300) if i != q), key=lambda i: (-score[i], i))[:7]
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == best


# --- shared ----------------------------------------------------------------------------------

def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 199), (199, 200)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {199: 199, 200: 199}


def test_pruned_chains_are_those_of_a_plain_search():
    """Dense stretches, prospects and skipped starts leave out nothing that all starts and steps would find."""
    rng, width, found = random.Random(3), 8, 0

    def plain(runs):
        for n, (first, end, shift) in enumerate(runs):
            held = {n: end - first}
            for k in range(n, len(runs)):
                i, j, d = runs[k]
                if k > n:
                    best = 0
                    for m, v in held.items():
                        mi, mj, md = runs[m]
                        over = max(0, mj - i, (mj - md) - (i - d))
                        if mi < i and mi - md < i - d and over < j - i:
                            best = max(best, v + j - i - over)
                    if not best:
                        continue
                    held[k] = best
                nx, ny = j - first, (j - d) - (first - shift)
                if held[k] * 1.8 >= 0.8 * (max(nx, width) + max(ny, width)) - 1e-9:
                    return True
        return False

    for t in range(600):
        base = [rng.randrange(9) for _ in range(rng.randrange(5, 40))]
        other = list(base)
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(other))
            other[at:at + 1] = rng.choice([[99 + t], [50, other[at]], []]) if len(other) > 3 else [other[at]]
        x = np.array([rng.randrange(100, 110) for _ in range(rng.randrange(6))] + base)
        y = np.array(other + [rng.randrange(200, 210) for _ in range(rng.randrange(6))])
        every = np.ones(len(x), dtype=bool), np.ones(len(y), dtype=bool)
        dense = tuple(substring_dedup._dense(np.isin(a, b), width, 0.8) for a, b in ((x, y), (y, x)))
        shifts = set(range(-12, 13))
        wanted = plain(substring_dedup._runs_on(x, y, shifts, every))
        assert bool(substring_dedup._chains(substring_dedup._runs_on(x, y, shifts, dense), width, 0.8)) == wanted
        found += wanted
    assert 100 < found < 600
