"""Ranked lexical search over a length-stratified index.

All documents of one length normaliser m form a stratum: there a term's impact depends on its
frequency tf alone, so impacts are computed once per tf. A stratum's postings lie term by
term in order of falling tf. The first posting of each of an item's terms bounds the scores
of the whole stratum without reading another one.

The index holds the postings of the terms that items ask for. Large strata are split into
pieces of a stated number of postings, each with bounds of its own. A search reads the bounds
first and visits the most promising pieces of every item; the scores found there are the
floors below which no other piece is opened. Bounds are never below a score and ties are
opened, so the result is that of a full scan. Items are the query set, taken in blocks.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tidemark.llm.common import empty, in_slices, texts_of, union_all
from tidemark.session import stored

K = 10
# Pieces that are visited first for every item, postings of a piece, bytes of item text in a block.
FIRST, POSTINGS, ITEM_BYTES = 3, 1 << 13, 4 << 20
# Terms are runs of ASCII letters and digits and of bytes beyond ASCII.
_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEPT else 0x20 for c in range(256))
_INDEX = "m long, piece int, docs binary, term binary, top binary, start binary, doc binary, tf binary"
_FOUND = "item_no long, doc_id long, score long"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def impacts(tf: np.ndarray, m: int) -> np.ndarray:
    """The part of a score that one occurrence list gives at weight 1, computed once per tf."""
    kinds, at = np.unique(tf.astype(np.int64), return_inverse=True)
    return ((1_000_000_000 * kinds) // (1000 * kinds + 8 * m))[at]


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Per document with terms: doc_id, n (all its terms), and number and tf of those asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text"):
            ids, sizes, numbers, tfs = [], [], [], []
            for i, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))):
                terms = terms_of(text)
                if terms:
                    asked = [(vocabulary[t], tf) for t, tf in Counter(terms).items() if t in vocabulary]
                    ids.append(i)
                    sizes.append(len(terms))
                    numbers.append([t for t, _ in asked])
                    tfs.append([tf for _, tf in asked])
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids, pa.int64()), "n": pa.array(sizes, pa.int64()),
                "terms": pa.array(numbers, pa.list_(pa.int32())), "tfs": pa.array(tfs, pa.list_(pa.int32()))})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stored(rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>"), "term-counts")


def build_index(counts: DataFrame, n_docs: int, n_terms: int, n_postings: int, postings: int = POSTINGS) -> DataFrame:
    """One row per stratum piece: documents by id, terms with their greatest tf, postings by term and falling tf.

    A stratum with more postings than ``postings`` is dealt to several pieces by document, so no
    task gathers a whole hot stratum. A single document is never divided.
    """
    m = F.expr(f"100 - 75 + ((75 * n * {n_docs}L) div {n_terms}L)")
    rows = counts.where("doc_id IS NOT NULL AND size(terms) > 0").withColumn("m", m)
    sizes = rows.groupBy("m").agg(F.ceil(F.sum(F.size("terms")) / postings).alias("pieces"))
    split = stored(sizes.where("pieces > 1"), "large-strata")
    piece = F.pmod(F.xxhash64("doc_id"), F.coalesce("pieces", F.lit(1))).cast("int")
    dealt = rows.join(split, "m", "left").select("m", piece.alias("piece"), "doc_id", "terms", "tfs")

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        terms = table.column("terms").combine_chunks()
        doc = np.repeat(np.arange(len(terms)), terms.value_lengths().to_numpy())
        term, tf = terms.flatten().to_numpy(), table.column("tfs").combine_chunks().flatten().to_numpy()
        order = np.lexsort((doc, -tf, term))
        term, tf, doc = term[order], tf[order], doc[order]
        kinds, start = np.unique(term, return_index=True)
        packed = {"docs": table.column("doc_id").to_numpy().astype(np.int64), "term": kinds.astype(np.int32),
                  "top": tf[start].astype(np.int32), "start": np.append(start, len(term)).astype(np.int32),
                  "doc": doc.astype(np.int32), "tf": tf.astype(np.int32)}
        return pa.table({"m": pa.array([key[0].as_py()], pa.int64()), "piece": pa.array([key[1].as_py()], pa.int32()),
                         **{name: pa.array([x.tobytes()], pa.binary()) for name, x in packed.items()}})

    # By number: pieces are small, yet each is much work to search, so they must not end in few files.
    tasks = max(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_postings // (64 * postings))
    return stored(dealt.repartition(tasks, "m", "piece").groupBy("m", "piece").applyInArrow(pack, _INDEX), "index")


class Items:
    """A block of items as arrays: per item a run of (term number, weight times its repeats)."""

    def __init__(self, numbers: list[int], counts: list[Counter], vocabulary: dict[bytes, int], weight: dict[int, int]):
        self.numbers = np.array(numbers, dtype=np.int64)
        runs = [[(vocabulary[t], n * weight[vocabulary[t]]) for t, n in c.items() if weight.get(vocabulary[t])]
                for c in counts]
        self.start = np.cumsum([0, *map(len, runs)])
        self.term = np.array([t for r in runs for t, _ in r], dtype=np.int64)
        self.weight = np.array([w for r in runs for _, w in r], dtype=np.int64)
        self.kinds = len(vocabulary)

    def places(self, kinds: np.ndarray) -> np.ndarray:
        """Where each wanted term stands in a piece, -1 if nowhere."""
        place = np.full(self.kinds, -1, dtype=np.int64)
        place[kinds] = np.arange(len(kinds))
        return place[self.term]

    def bounds(self, m: int, kinds: np.ndarray, top: np.ndarray) -> np.ndarray:
        """Per item the score of a document that had the greatest tf of each of its terms."""
        at = self.places(kinds)
        gains = np.where(at >= 0, self.weight * impacts(top, m)[at], 0)
        sums = np.concatenate([[0], np.cumsum(gains)])
        return sums[self.start[1:]] - sums[self.start[:-1]]


def _ints(value: bytes, kind=np.int32) -> np.ndarray:
    return np.frombuffer(value, dtype=kind)


def first_visits(index: DataFrame, items: Items, first: int = FIRST) -> list[Row]:
    """(item, m, piece): for every item the pieces of highest bound; no posting is read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((len(items.numbers), first), dtype=np.int64)
        whose = np.zeros((len(items.numbers), first, 2), dtype=np.int64)
        for batch in batches:
            for m, piece, term, top in zip(*(batch.column(c).to_pylist() for c in ("m", "piece", "term", "top"))):
                bound = items.bounds(m, _ints(term), _ints(top))
                lowest = best.argmin(axis=1)
                better = np.flatnonzero(bound > best[np.arange(len(best)), lowest])
                best[better, lowest[better]] = bound[better]
                whose[better, lowest[better]] = m, piece
        i, j = np.nonzero(best)
        yield pa.RecordBatch.from_pydict({
            "item": pa.array(i, pa.int32()), "bound": pa.array(best[i, j], pa.int64()),
            "m": pa.array(whose[i, j, 0], pa.int64()), "piece": pa.array(whose[i, j, 1], pa.int32())})

    local = index.select("m", "piece", "term", "top").mapInArrow(run, "item int, bound long, m long, piece int")
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "m", "piece")
    return local.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= first).select(
        "item", "m", "piece").collect()  # at most ``first`` rows for each item of the block


def visit(index: DataFrame, items: Items, k: int, floors: np.ndarray,
          only: dict[tuple[int, int], list[int]] | None = None) -> DataFrame:
    """The best documents of each task's pieces; a piece is opened for items whose bound reaches their floor.

    Within a batch pieces of the greatest bounds come first and raise the floors for the rest.
    With ``only``, pieces are opened for the named items alone.
    """
    def scores(item: int, at: np.ndarray, gain: np.ndarray, start: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        total = np.zeros(n, dtype=np.int64)
        for x in range(items.start[item], items.start[item + 1]):
            if at[x] >= 0:
                s, e = start[at[x]], start[at[x] + 1]
                total[doc[s:e]] += items.weight[x] * gain[s:e]
        return total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = np.maximum(floors, 1)
        heaps: dict[int, list[tuple[int, int]]] = {}
        for batch in batches:
            bounds = [items.bounds(m, _ints(term), _ints(top)) for m, term, top in
                      zip(*(batch.column(c).to_pylist() for c in ("m", "term", "top")))]
            for row in sorted(range(batch.num_rows), key=lambda r: -int(bounds[r].max(initial=0))):
                one = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                wanted = np.flatnonzero(bounds[row] >= floor)
                if only is not None:
                    wanted = np.intersect1d(wanted, only.get((one["m"], one["piece"]), []))
                if not len(wanted):
                    continue
                docs, start, doc = _ints(one["docs"], np.int64), _ints(one["start"]), _ints(one["doc"])
                at, gain = items.places(_ints(one["term"])), impacts(_ints(one["tf"]), one["m"])
                for item in wanted.tolist():
                    total = scores(item, at, gain, start, doc, len(docs))
                    good = np.flatnonzero(total >= floor[item])
                    # Documents lie by id, so a stable order leaves ties to the smaller one.
                    good = good[np.argsort(-total[good], kind="stable")[:k]]
                    heap = heaps.get(item, []) + list(zip((-total[good]).tolist(), docs[good].tolist()))
                    heaps[item] = heap = sorted(heap)[:k]
                    if len(heap) == k:
                        floor[item] = max(floor[item], -heap[-1][0])
        out = [(items.numbers[i], d, -s) for i, heap in heaps.items() for s, d in heap]
        yield pa.RecordBatch.from_pydict({
            name: pa.array([o[c] for o in out], pa.int64()) for c, name in enumerate(("item_no", "doc_id", "score"))})

    return index.mapInArrow(run, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_no").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: DataFrame, items: Items, k: int = K) -> DataFrame:
    """(item_no, doc_id, score, rank): the ``k`` best of every item of a block."""
    where: dict[tuple[int, int], list[int]] = {}
    for row in first_visits(index, items):
        where.setdefault((row.m, row.piece), []).append(row.item)
    floors = np.zeros(len(items.numbers), dtype=np.int64)
    if where:
        spark = index.sparkSession
        wanted = F.broadcast(spark.createDataFrame(list(where), "m long, piece int"))  # FIRST rows an item at most
        seen = _best(visit(index.join(wanted, ["m", "piece"], "left_semi").select(*index.columns), items, k, floors, where), k)
        at = {number: i for i, number in enumerate(items.numbers.tolist())}
        for row in seen.where(F.col("rank") == k).collect():
            floors[at[row.item_no]] = row.score
    return _best(visit(index, items, k, floors), k)


def rank(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES,
         postings: int = POSTINGS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0 for each item.

    Equal scores go by doc_id. Null and empty texts have no terms: such documents are not
    counted, such items have no rows. Every input row is a document or an item of its own, also
    if it repeats another; documents without id are counted but cannot be named, so they are no
    results. Long texts count whole. Empty tables give an empty result; other columns are
    ignored. Blocks of more than ``item_bytes`` of item text read the documents once each.
    """
    spark = docs.sparkSession
    listed = stored(items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text"))
                    .withColumn("item_no", F.monotonically_increasing_id()), "items")
    blocks = max(1, math.ceil((listed.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / item_bytes))
    found = [empty(spark, _FOUND + ", rank int")]
    for block in range(blocks):
        rows = listed.where(F.pmod(F.xxhash64("item_no"), F.lit(blocks)) == block).select("item_no", "text").collect()
        counts = [Counter(terms_of((r.text or "").encode())) for r in rows]
        vocabulary = {t: i for i, t in enumerate(sorted({t for c in counts for t in c}))}
        if not vocabulary:
            continue
        per_doc = term_counts(docs, vocabulary, id_col, text_col)
        total = per_doc.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        if not total.docs:
            break
        df = per_doc.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # asked terms at most
        weight = {r.term: math.floor(1000 * math.log((2 * total.docs + 2) / (2 * r["count"] + 1))) for r in df}
        index = build_index(per_doc, total.docs, total.terms, sum(r["count"] for r in df), postings)
        found.append(search(index, Items([r.item_no for r in rows], counts, vocabulary, weight), k))
    return union_all(found).join(listed.select("item_no", "item_id"), "item_no").select(
        "item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, row_number() OVER () AS i, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT count(*) AS docs, sum(len(w)) AS terms FROM d WHERE len(w) > 0),
q AS (SELECT i, item_id, term, count(*) AS reps FROM (SELECT i, item_id, unnest(w) AS term FROM b) GROUP BY ALL),
f AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
g AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS weight
  FROM (SELECT term, count(*) AS df FROM f GROUP BY term), s),
n AS (SELECT doc_id, r, (25 + (75 * len(w) * docs) // terms)::BIGINT AS m FROM d, s WHERE len(w) > 0),
x AS (
  SELECT i, item_id, r, doc_id, sum(reps * weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN g USING (term) JOIN f USING (term) JOIN n USING (r) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0)
WHERE rank <= 10
"""
