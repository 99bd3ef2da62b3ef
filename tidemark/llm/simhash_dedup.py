"""SimHash near duplicates over a Gray-ordered hierarchical index.

Fingerprints are made from word shingles. Distinct fingerprints are dealt by the bits of
three of six blocks: two that differ in at most three bits agree on at least three blocks,
so every pair meets in one of the twenty deals. Inside a deal they are sorted by Gray rank,
which puts fingerprints with few differing bits next to each other; runs become leaves,
leaves become upper nodes that keep the bits all their members share. Two nodes are compared
by those shared bits: the differences counted so far are a lower bound for all their
members, so whole groups are pruned at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import components, in_slices, texts_of
from tidemark.session import stored

SEED = 42
BITS = 64
LEAF, FAN = 32, 8
# A group above this is dealt anew by sub-blocks of the bits not yet fixed.
GROUP = 65_536


def _blocks(bits: list[int], parts: int) -> list[list[int]]:
    return [part.tolist() for part in np.array_split(np.array(bits), parts)]


def _mask(bits) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def text_fingerprint(text: bytes, width: int = 3) -> int:
    """The SimHash of one text: a bit is 1 if set in more than half of its shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    last = (ends[width - 1:] - 1).tolist() if len(words) >= width else [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, last)], dtype=np.uint64)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 8192):
        octets = hashes[at:at + 8192].astype(">u8").view(np.uint8)
        counts += np.unpackbits(octets).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = 3) -> DataFrame:
    """(doc_id, fp) for every row, whole texts; fp is the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, "text"):
            fps = [text_fingerprint(t, width) for t in texts_of(part.column(1))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))],
                names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def gray_rank(value: Column) -> Column:
    """Position of a bit pattern in the reflected Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        value = value.bitwiseXOR(F.shiftrightunsigned(value, shift))
    return value


def _deal(fps: DataFrame) -> DataFrame:
    """(path, fixed, fp): each fingerprint under each of its three-block patterns."""
    blocks = _blocks(list(range(BITS)), 6)
    deals = []
    for number, chosen in enumerate(combinations(range(6), 3)):
        mask = _mask(b for c in chosen for b in blocks[c])
        deals.append(F.struct(F.lit(number).alias("path"), F.lit(mask).alias("mask")))
    dealt = fps.select("fp", F.explode(F.array(*deals)).alias("d"))
    return dealt.select(F.col("d.path").alias("path"), F.col("d.mask").alias("mask"),
                        F.col("fp").bitwiseAND(F.col("d.mask")).alias("fixed"), "fp")


def _split_large(dealt: DataFrame, group: int) -> DataFrame:
    """Deals groups above ``group`` anew by a quarter of their free bits, twice at most.

    Of four sub-blocks one agrees when three bits differ, so no pair is lost. After two
    rounds at most 18 bits are free, which bounds a group by 2**18 fingerprints.
    """
    masks = {}
    blocks = _blocks(list(range(BITS)), 6)
    for number, chosen in enumerate(combinations(range(6), 3)):
        masks[number] = sorted({b for c in chosen for b in blocks[c]})
    for _ in range(2):
        sizes = dealt.groupBy("path", "fixed").count().where(F.col("count") > group)
        sizes = stored(sizes.select("path", "fixed"), "large-groups")
        if sizes.isEmpty():
            return dealt
        sub = [(path, path * 4 + k + 64, _mask(part), bits + part)
               for path, bits in masks.items()
               for k, part in enumerate(_blocks(sorted(set(range(BITS)) - set(bits)), 4))]
        plan = dealt.sparkSession.createDataFrame(
            [(p, n, m) for p, n, m, _ in sub], "path int, next int, more long")
        large = dealt.join(sizes, ["path", "fixed"], "left_semi").join(F.broadcast(plan), "path")
        large = large.select(
            F.col("next").alias("path"), F.col("mask").bitwiseOR(F.col("more")).alias("mask"),
            F.col("fp").bitwiseAND(F.col("mask").bitwiseOR(F.col("more"))).alias("fixed"), "fp")
        dealt = stored(dealt.join(sizes, ["path", "fixed"], "left_anti").unionByName(large), "dealt")
        masks |= {n: bits for _, n, _, bits in sub}
    return dealt


def group_links(fps: np.ndarray, distance: int = 3) -> list[tuple[int, int]]:
    """Links that connect everything within ``distance`` in one Gray-sorted group.

    Nodes hold the bits shared by all members; a pair of nodes is skipped when those bits
    already differ too often or when all members are connected. The links form a forest, so
    there are fewer of them than fingerprints.
    """
    n = len(fps)
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links: list[tuple[int, int]] = []

    def link(i: int, j: int) -> None:
        ri, rj = find(i), find(j)
        if ri != rj:
            parent[max(ri, rj)] = min(ri, rj)
            links.append((i, j))

    near = np.flatnonzero(np.bitwise_count(fps[1:] ^ fps[:-1]) <= distance)
    for i in near.tolist():
        link(i, i + 1)
    if n == 2:
        return links
    bounds = [np.arange(0, n, LEAF)]
    ones, zeros = [np.bitwise_and.reduceat(fps, bounds[0])], [~np.bitwise_or.reduceat(fps, bounds[0])]
    while len(bounds[-1]) > 1:
        step = np.arange(0, len(bounds[-1]), FAN)
        ones.append(np.bitwise_and.reduceat(ones[-1], step))
        zeros.append(np.bitwise_and.reduceat(zeros[-1], step))
        bounds.append(bounds[-1][step])

    def one_component(lo: int, hi: int, lo2: int, hi2: int) -> bool:
        root = find(lo)
        return all(find(i) == root for i in range(lo, hi)) and all(
            find(i) == root for i in range(lo2, hi2))

    todo = [(len(bounds) - 1, 0, 0)]
    while todo:
        level, x, y = todo.pop()
        differ = np.bitwise_count((ones[level][x] & zeros[level][y]) | (zeros[level][x] & ones[level][y]))
        if x != y and differ > distance:
            continue
        if level:
            xs = range(x * FAN, min((x + 1) * FAN, len(bounds[level - 1])))
            ys = range(y * FAN, min((y + 1) * FAN, len(bounds[level - 1])))
            todo += [(level - 1, p, q) for p in xs for q in ys if p <= q]
            continue
        lo, hi, lo2, hi2 = x * LEAF, min((x + 1) * LEAF, n), y * LEAF, min((y + 1) * LEAF, n)
        if one_component(lo, hi, lo2, hi2):
            continue
        close = np.bitwise_count(fps[lo:hi, None] ^ fps[None, lo2:hi2]) <= distance
        for i, j in zip(*(k.tolist() for k in np.nonzero(close))):
            if lo + i < lo2 + j:
                link(lo + i, lo2 + j)
    return links


def fingerprint_links(fps: DataFrame, distance: int = 3, group: int = GROUP) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all within ``distance``."""
    dealt = _split_large(_deal(fps), group)
    ordered = (
        dealt.select("path", "fixed", "fp").repartition("path", "fixed")
        .withColumn("rank", gray_rank(F.col("fp"))).sortWithinPartitions("path", "fixed", "rank")
        .select("path", "fixed", "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None

        def found(path, fixed, fp):
            new = np.flatnonzero((path[1:] != path[:-1]) | (fixed[1:] != fixed[:-1])) + 1
            starts, ends = np.append(0, new), np.append(new, len(fp))
            out = [(s, i, j) for s, e in zip(starts.tolist(), ends.tolist()) if e - s > 1
                   for i, j in group_links(fp[s:e], distance)]
            a = np.array([fp[s + i] for s, i, _ in out], dtype=np.uint64).view(np.int64)
            b = np.array([fp[s + j] for s, _, j in out], dtype=np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            columns[2] = columns[2].astype(np.int64).view(np.uint64)
            if kept is not None:
                columns = [np.concatenate(pair) for pair in zip(kept, columns)]
            path, fixed, fp = columns
            last = np.flatnonzero((path != path[-1]) | (fixed != fixed[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield found(path[:cut], fixed[:cut], fp[:cut])
            kept = [c[cut:] for c in columns]
        if kept is not None:
            yield found(*kept)

    return ordered.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = 3, distance: int = 3, group: int = GROUP) -> DataFrame:
    """One row per input row: doc_id, fingerprint, component_id.

    Fingerprints link at ``distance`` or fewer differing bits; component_id is the smallest
    doc_id reachable. Copies share a fingerprint and are linked through it, never pairwise.
    Null and empty texts have fingerprint zero and link like others. Repeated rows come out
    as often as they came in. A component of rows without id has a null component_id. An
    empty table gives an empty result; other input columns are ignored.
    """
    marked = stored(fingerprints(docs, id_col, text_col, width), "fingerprints")
    first = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fp")
    roots = components(fingerprint_links(first.select("fp"), distance, group))
    placed = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    placed = stored(placed, "placed")
    lowest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = placed.join(lowest, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               width: int = 3, distance: int = 3) -> DataFrame:
    """The row of the smallest id of each component, with all its columns as they are.

    Of rows that repeat that id the one with the smallest text stays; a component of rows
    without id keeps them, since they cannot be told apart.
    """
    found = near_duplicates(docs, id_col, text_col, width, distance)
    stays = F.max(F.expr("component_id = doc_id OR component_id IS NULL"))
    ids = found.groupBy("doc_id").agg(stays.alias("stays"), F.count("*").alias("n")).where("stays")
    ids = stored(ids.select("doc_id", (F.col("n") > 1).alias("again")), "kept-ids")
    packed = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("_id"),
                         F.col(text_col).alias("_text"))

    def held(which: str) -> DataFrame:
        return packed.join(ids.where(which), F.col("_id").eqNullSafe(F.col("doc_id")), "left_semi")

    # Texts are dealt by id once at most; only rows that repeat an id are compared by text after that.
    if ids.where("again AND doc_id IS NOT NULL").isEmpty():
        return held("true").select("_row.*")
    again = Window.partitionBy("_id").orderBy("_text")
    numbered = held("again AND doc_id IS NOT NULL").withColumn("_n", F.row_number().over(again)).where("_n = 1")
    return numbered.select("_row.*").unionByName(held("NOT again OR doc_id IS NULL").select("_row.*"))
