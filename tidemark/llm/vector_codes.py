"""Product codes for vectors, their codebooks learnt by ball k-means.

Components become integers and a vector is cut into equal parts; every part position has a
codebook of its own. All distances, sums and comparisons are exact in integers, so the result
does not depend on how rows are dealt to tasks.

A row keeps the entry that was nearest to each of its parts at the start. In a pass the parts
that share such an entry form its ball: the radius is the largest distance to the entry as it
stands now. Another entry can only be as near to a member if it lies within twice the radius,
which names the ball's neighbours. By the triangle inequality a part at distance d has to be
compared with the neighbours within 2d only: those below half the way to the nearest neighbour
are the stable core and need no comparison; the others form rings, and the members of a ring
meet the neighbours up to it. The bound holds for any starting entry, so rows are written
once and only read in every round; what a round returns is one sum per entry and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.skew import attach_per_key
from tidemark.llm.common import empty
from tidemark.session import stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
SCHEMA = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


def finite(vector: str) -> Column:
    """Not null, without null or non-finite components."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good, F.lit(False))


def distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    apart = points - centre
    return (apart * apart).sum(axis=-1)


def assign(points: np.ndarray, near: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each point (ties to the lower index) and its squared distance.

    ``near`` is any entry per point; the nearer it is, the fewer comparisons are made.
    """
    own = distances(points, centres[near])
    between = distances(centres[:, None], centres[None])
    best, least = near.copy(), own.copy()
    for ball in range(len(centres)):
        members = np.flatnonzero(near == ball)
        if not len(members):
            continue
        # Squared distances: within 2d is within 4d^2.
        members = members[np.argsort(-own[members], kind="stable")]
        reach = 4 * own[members]
        neighbours = np.flatnonzero(between[ball] <= reach[0])
        for other in neighbours[np.argsort(between[ball, neighbours], kind="stable")]:
            if other == ball:
                continue
            # Far members first, so those this neighbour can reach are a prefix.
            ring = members[:np.searchsorted(-reach, -between[ball, other], side="right")]
            away = distances(points[ring], centres[other])
            nearer = (away < least[ring]) | ((away == least[ring]) & (other < best[ring]))
            best[ring[nearer]], least[ring[nearer]] = other, away[nearer]
    return best, least


def nearest_of_all(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Plain search, for the first assignment."""
    return np.stack([distances(points, c) for c in centres], axis=1).argmin(axis=1)


def _cut(column: pa.ChunkedArray | pa.Array, parts: int, dim: int) -> np.ndarray:
    """Components as rows x parts x components of a part."""
    whole = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(whole) and 16 * dim * int(np.abs(whole).max()) ** 2 >= 1 << 62:
        raise ValueError("components too large for exact distances in 64 bits")
    return whole.reshape(-1, parts, dim // parts)


def _near(column: pa.Array, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, parts).astype(np.int64)


def start_rows(rows: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """Rows with their integers ``q`` and the nearest first entry per part as bytes ``near``."""
    parts, _, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _cut(batch.column("q"), parts, parts * width)
            near = np.stack([nearest_of_all(points[:, p], codebooks[p]) for p in range(parts)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([r.tobytes() for r in near.astype(np.uint8)], pa.binary())],
                names=[*batch.schema.names, "near"])

    return stored(rows.mapInArrow(run, "vec_id long, label string, q array<int>, near binary"), "vectors")


def next_codebooks(rows: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Entries replaced by the mean of their parts, rounded down; unused entries stay.

    Returns to the driver one count and one sum per entry and component, whatever the rows.
    """
    parts, entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), dtype=np.int64)
        total = np.zeros((parts, entries, width), dtype=np.int64)
        for batch in batches:
            points, near = _cut(batch.column("q"), parts, parts * width), _near(batch.column("near"), parts)
            for p in range(parts):
                best, _ = assign(points[:, p], near[:, p], codebooks[p])
                count[p] += np.bincount(best, minlength=entries)
                for entry in np.unique(best):
                    total[p, entry] += points[best == entry, p].sum(axis=0)
        used = np.argwhere(count > 0)
        if len(used):
            p, e = used[:, 0], used[:, 1]
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(p, pa.int32()), "entry": pa.array(e, pa.int32()),
                "n": pa.array(count[p, e], pa.int64()),
                "sums": pa.array(total[p, e].tolist(), pa.list_(pa.int64()))})

    sums = rows.select("q", "near").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "total")]
    found = (sums.select("part", "entry", "n", F.posexplode("sums").alias("at", "total"))
             .groupBy("part", "entry", "at").agg(*exact).collect())
    after = codebooks.copy()
    for row in found:
        after[row.part, row.entry, row.at] = int(row.total) // int(row.n)
    return after


def encode_rows(rows: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) under given codebooks."""
    parts, _, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, near = _cut(batch.column("q"), parts, parts * width), _near(batch.column("near"), parts)
            codes, error = np.empty(near.shape, dtype=np.uint8), np.zeros(len(near), dtype=np.int64)
            for p in range(parts):
                codes[:, p], least = assign(points[:, p], near[:, p], codebooks[p])
                error += least
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id"), "label": batch.column("label"),
                "code": [r.tobytes().hex() for r in codes], "error": pa.array(error, pa.int64())})

    return rows.mapInArrow(run, "vec_id long, label string, code string, error long")


def codebooks_digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
        label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES,
        rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray] | None:
    """The stored rows that take part and their codebooks (parts x entries x components).

    None if no row takes part. Learns from all rows; entries must not exceed 256.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
        v.alias("v")).where(finite("v") & (F.size("v") > 0) & (F.size("v") % parts == 0))
    order = F.col("vec_id").asc_nulls_last(), "v"
    first = rows.orderBy(*order).limit(1).collect()
    if not first:
        return None
    dim = len(first[0].v)
    rows = rows.where(F.size("v") == dim).withColumn(
        "q", F.transform("v", lambda x: F.floor(x * SCALE).cast("int")))
    seeds = [r.q for r in rows.orderBy(*order).limit(entries).collect()]
    codebooks = np.array(seeds, dtype=np.int64).reshape(len(seeds), parts, dim // parts).transpose(1, 0, 2)
    codebooks = np.ascontiguousarray(codebooks)
    rows = start_rows(rows.select("vec_id", "label", "q"), codebooks)
    for _ in range(rounds):
        codebooks = next_codebooks(rows, codebooks)
    return rows, codebooks


def encode(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES,
           rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), one row per vector that takes part.

    Vectors null or with null or non-finite components take no part, nor do those that cannot
    be cut into equal parts or are of another length than that of the smallest vec_id. The
    first entries are the parts of the smallest ids, a null id last, rows that repeat an id
    by their components; fewer rows than ``entries`` make fewer entries. Repeated rows each
    count. Null labels are one label. Components so large that distances leave 64 bits fail
    the job. Empty tables give an empty result; other columns are ignored.
    """
    found = fit(vectors, id_col, vector_col, label_col, parts, entries, rounds)
    if found is None:
        return empty(vectors.sparkSession, SCHEMA)
    rows, codebooks = found
    # A null label must meet its like, which a join on equality does not do.
    key = F.coalesce(F.concat(F.lit("="), "label"), F.lit("null")).alias("_label")
    coded = stored(encode_rows(rows, codebooks).select("vec_id", key, "code", "error"), "codes")
    per_label = coded.groupBy("_label").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    return attach_per_key(coded, per_label, ["_label"], "_rows", salt="vec_id").select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256"))


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The rounds as a chain of common table expressions over single components."""
    steps = [f"""
v AS MATERIALIZED (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT vec_id, (nth - 1) // width AS part, (nth - 1) % width AS pos, floor({SCALE} * x)::BIGINT AS x
  FROM (SELECT vec_id, len(e) // {parts} AS width, unnest(e) AS x, generate_subscripts(e, 1) AS nth FROM v)),
c0 AS MATERIALIZED (
  SELECT part, entry, pos, x AS c
  FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v) USING (vec_id)
  WHERE entry < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, part, entry, d FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) AS nth FROM (
      SELECT vec_id, part, entry, sum((x - c) * (x - c))::BIGINT AS d
      FROM p JOIN c{r} USING (part, pos) GROUP BY ALL)) WHERE nth = 1)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (
  SELECT part, entry, pos, sum(x) AS s, count(*) AS n FROM p JOIN a{r} USING (vec_id, part) GROUP BY ALL),
c{r + 1} AS MATERIALIZED (
  SELECT part, entry, pos, CASE WHEN n IS NULL THEN c
    ELSE ((s - ((s % n) + n) % n) // n)::BIGINT END AS c
  FROM c{r} LEFT JOIN m{r} USING (part, entry, pos))""")
    return "WITH" + ",".join(steps) + f"""
, o AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, pos)) FROM c{rounds}) AS codebooks_sha256
FROM o JOIN v USING (vec_id)
"""


ORACLE = _oracle()
