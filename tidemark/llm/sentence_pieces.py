"""N-best segmentation into pieces of a public vocabulary, and exact decoding.

Texts are cut where no piece can cross (before a run of word marks, between characters that
no piece holds next to each other). In each segment, forward Viterbi scores are exact
heuristics for a backward A-star search over the piece lattice, which then delivers
segmentations in order of score. The best of a whole text joins the best of its segments;
of its N best only the N-1 segments with the smallest loss to their second best can differ,
so a second A-star search over those gives them exactly.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, texts_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# A word mark that is part of the text itself, spelled with byte pieces to survive the trip.
LITERAL_MARK = "\ud800"
UNKNOWN_PENALTY = 10.0
MEMO = 500_000
# Parts of segments up to this many characters are searched together, longer ones one by one.
TOGETHER = 32
BEST = 4
SCHEMA = ("doc_id long, n_pieces int, ids array<int>, score double, "
          "others array<struct<score: double, changes: array<struct<at: int, n: int, ids: array<int>>>>>")


class Vocabulary:
    """Pieces with log probabilities, as a table of all their beginnings.

    A vocabulary whose scores are merge ranks gets Zipf's law over the ranks (probability in
    proportion to 1 / (rank + 1)); one with log probabilities keeps them.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        raw = {i: model.get_score(i) for i in plain}
        if all(v == int(v) for v in raw.values()):
            total = math.log(sum(1 / (r + 1) for r in range(len(plain))))
            raw = {i: -math.log(1 - v) - total for i, v in raw.items()}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = min(raw.values()) - UNKNOWN_PENALTY
        pieces = {model.id_to_piece(i): i for i in plain}
        # A tree of characters: for each the characters that follow it, and id and log probability
        # of the piece that ends there, or -1.
        self.tree: dict = {}
        self.joined: set[tuple[str, str]] = set()
        for piece, i in pieces.items():
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {piece!r} crosses a word boundary")
            following = self.tree
            for c in piece:
                node = following.setdefault(c, [{}, -1, 0.0])
                following = node[0]
            node[1:] = i, raw[i]
            self.joined.update(zip(piece, piece[1:]))
        self.longest = max(map(len, pieces))
        self._number_nodes()
        inside = set("".join(p for p in pieces if len(p) > 1))
        alone = "".join(c for c in "\n\t\r\v\f" + LITERAL_MARK if c not in inside)
        self.segments = re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+|[{alone}]")
        self.spelled = {i: p.replace(MARK, " ").encode() for p, i in pieces.items()}
        self.spelled |= {i: bytes([b]) for b, i in enumerate(self.bytes)}

    def _number_nodes(self) -> None:
        """The tree as arrays: nodes by number (0 where there is none, 1 the root), letters by code (0: in no piece)."""
        letters = {c: k for k, c in enumerate(sorted(set("".join(c for pair in self.joined for c in pair)) | set(self.tree)), 1)}
        self.letters, self.code_of = len(letters) + 1, np.zeros(0x110000, dtype=np.int32)
        for c, k in letters.items():
            self.code_of[ord(c)] = k
        keys, children, ended, gains, todo = [], [], [-1, -1], [0.0, 0.0], [(1, self.tree)]
        for number, following in todo:
            for c, (rest, piece, gain) in following.items():
                keys.append(number * self.letters + letters[c])
                children.append(len(ended))
                todo.append((len(ended), rest))
                ended.append(piece)
                gains.append(gain)
        order = np.argsort(np.array(keys, dtype=np.int64))
        # One more key than any that is asked for, so that every search ends at one.
        self.step_keys = np.append(np.array(keys, dtype=np.int64)[order], np.iinfo(np.int64).max)
        self.step_to = np.append(np.array(children, dtype=np.int64)[order], 0)
        self.ended, self.gains = np.array(ended, dtype=np.int32), np.array(gains)
        self.roots = self.following(np.ones(self.letters, dtype=np.int64), np.arange(self.letters))
        self.pairs = np.sort(np.array([letters[a] * self.letters + letters[b] for a, b in self.joined] + [np.iinfo(np.int64).max]))
        first, last = np.divmod(self.pairs[:-1], self.letters)
        self.pair_to = np.append(np.where(self.roots[first] > 0, self.following(self.roots[first], last), 0), 0)

    def following(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The nodes reached from ``nodes`` by letters, 0 where there is none."""
        asked = nodes * self.letters + codes
        at = np.searchsorted(self.step_keys, asked)
        return np.where(self.step_keys[at] == asked, self.step_to[at], 0)

    def codes(self, text: str) -> np.ndarray:
        return self.code_of[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)].astype(np.int64)

    def edges(self, segment: str, start: int) -> list[tuple[int, tuple[int, ...], float]]:
        """(end, ids, score) of the pieces that begin at ``start``; bytes where there is none."""
        found, following = [], self.tree
        for end in range(start, len(segment)):
            node = following.get(segment[end])
            if node is None:
                break
            following, piece, gain = node
            if piece >= 0:
                found.append((end + 1, (piece,), gain))
        if not found or found[0][0] != start + 1:
            found.append((start + 1, self.bytes_of(segment[start]), self.unknown))
        return found

    def bytes_of(self, c: str) -> tuple[int, ...]:
        raw = MARK.encode() if c == LITERAL_MARK else c.encode("utf-8", "surrogateescape")
        return tuple(self.bytes[b] for b in raw)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def viterbi(v: Vocabulary, segment: str) -> tuple[tuple[int, ...], float, float]:
    """Best ids, their score, and the loss of the second best."""
    n, tree, longest = len(segment), v.tree, v.longest
    first, second = [-math.inf] * (n + 1), [-math.inf] * (n + 1)
    first[0] = 0.0
    came: list[int] = [0] * (n + 1)
    by: list[int] = [0] * (n + 1)
    for start in range(n):
        one, two = first[start], second[start]
        following, single, end = tree, False, start
        for c in segment[start:start + longest]:
            node = following.get(c)
            if node is None:
                break
            following, piece, gain = node
            end += 1
            if piece >= 0:
                if end == start + 1:
                    single = True
                total, other = one + gain, two + gain
                best = first[end]
                if total > best:
                    second[end] = best if best > other else other
                    first[end], came[end], by[end] = total, start, piece
                else:
                    if other > total:
                        total = other
                    if total > second[end]:
                        second[end] = total
        if not single:
            end, total, other = start + 1, one + v.unknown, two + v.unknown
            if total > first[end]:
                second[end] = max(first[end], other)
                first[end], came[end], by[end] = total, start, -1
            else:
                second[end] = max(second[end], total, other)
    ids: list[int] = []
    at = n
    while at:
        start = came[at]
        if by[at] >= 0:
            ids.append(by[at])
        else:
            ids += reversed(v.bytes_of(segment[start]))
        at = start
    ids.reverse()
    return tuple(ids), first[n], first[n] - second[n]


def viterbi_all(v: Vocabulary, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of many segments one after another, their numbers, scores and losses.

    Segments are cut between neighbours that no piece joins; all walks through the tree take their steps
    together; then all edges that leave the first position of a part are followed, all that leave
    the second, and so on. Scores are the same sums in the same order, and ties go to the leftmost
    start, as in ``viterbi``, which finds the parts that are long or spelled with bytes.
    """
    text = "".join(segments)
    codes, last = v.codes(text), np.cumsum(np.fromiter(map(len, segments), dtype=np.int64, count=len(segments)))
    asked = codes[:-1] * v.letters + codes[1:]
    pair = np.searchsorted(v.pairs, asked)
    apart = np.ones(len(codes) + 1, dtype=bool)
    apart[1:-1] = v.pairs[pair] != asked
    apart[last] = True
    cuts = np.flatnonzero(apart)
    begin, stop = cuts[:-1], cuts[1:]
    number = np.repeat(np.arange(len(begin)), stop - begin)
    # Walks of one step, of two by the pairs, and on; those in long parts end after the first.
    short = stop - begin <= TOGETHER
    at, nodes, single = np.arange(len(codes)), v.roots[codes], np.zeros(len(codes), dtype=bool)
    ends = stop[number]
    found: list[tuple] = []
    for size in range(1, v.longest + 1):
        alive = nodes > 0
        at, nodes = at[alive], nodes[alive]
        whole = v.ended[nodes] >= 0
        found.append((at[whole], size, nodes[whole]))
        if size == 1:
            single[at[whole]] = True
            at = np.flatnonzero(~apart[1:] & short[number])
            nodes = v.pair_to[pair[at]]
            continue
        going = at + size < ends[at]
        at, nodes = at[going], nodes[going]
        if not len(at):
            break
        nodes = v.following(nodes, codes[at + size])
    alone = np.flatnonzero(~single)
    start = np.concatenate([f[0] for f in found] + [alone])
    end = np.concatenate([f[0] + f[1] for f in found] + [alone + 1])
    piece = np.concatenate([v.ended[f[2]] for f in found] + [np.full(len(alone), -1, dtype=np.int32)])
    gain = np.concatenate([v.gains[f[2]] for f in found] + [np.full(len(alone), v.unknown)])
    place = np.minimum(start - begin[number[start]], TOGETHER).astype(np.int8)
    order = np.argsort(place, kind="stable")
    bounds = np.cumsum(np.bincount(place))[:TOGETHER].tolist()
    # A part has one position more than characters.
    start, end, piece, gain = (x[order] for x in (start + number[start], end + number[start], piece, gain))
    first = np.full(len(codes) + len(begin), -np.inf)
    second, came = first.copy(), np.zeros(len(first), dtype=np.int64)
    begins, finals = begin + np.arange(len(begin)), stop + np.arange(len(begin))
    first[begins] = 0.0
    for a, b in zip([0, *bounds], bounds):
        # Edges that leave the same position of a part have different ends.
        s, e, g = start[a:b], end[a:b], gain[a:b]
        total, other, best = first[s] + g, second[s] + g, first[e]
        better = total > best
        second[e] = np.where(better, np.maximum(best, other), np.maximum(second[e], total))
        first[e] = np.maximum(best, total)
        came[e[better]] = np.flatnonzero(better) + a
    taken = np.zeros(len(first), dtype=np.int64)  # the edge on the best path that ends at a position, and one
    at, floor = finals[short], begins[short]
    while len(at):
        edge = came[at]
        taken[at] = edge + 1
        at = start[edge]
        going = at > floor
        at, floor = at[going], floor[going]
    places = np.flatnonzero(taken)
    ids, of = piece[taken[places] - 1], np.repeat(np.arange(len(begin)), stop - begin + 1)[places]
    counts, scores = np.bincount(of, minlength=len(begin)), first[finals]
    with np.errstate(invalid="ignore"):
        losses = scores - second[finals]
    alone = ~short
    alone[of[ids < 0]] = True
    if alone.any():
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for k in np.flatnonzero(alone).tolist():
            best, scores[k], losses[k] = viterbi(v, text[begin[k]:stop[k]])
            parts[k] = np.array(best, dtype=np.int32)
            counts[k] = len(best)
        ids = np.concatenate(parts)
    until = np.searchsorted(cuts, last)
    head = np.append(0, until[:-1])
    total = scores[head]
    for k in np.flatnonzero(until - head > 1).tolist():
        total[k] = sum(scores[head[k]:until[k]].tolist())
    return ids, np.add.reduceat(counts, head), total, np.minimum.reduceat(losses, head)


def forward_scores(v: Vocabulary, segment: str) -> tuple[list[float], list[list]]:
    """Best score up to every position, and the edges that end there."""
    n = len(segment)
    forward = [0.0] + [-math.inf] * n
    incoming: list[list] = [[] for _ in range(n + 1)]
    for start in range(n):
        for end, ids, gain in v.edges(segment, start):
            incoming[end].append((start, ids, gain))
            forward[end] = max(forward[end], forward[start] + gain)
    return forward, incoming


def segment_best(v: Vocabulary, segment: str, n: int = BEST) -> Iterator[tuple[float, tuple[int, ...]]]:
    """The ``n`` best segmentations in order of score: backward A-star, exact forward scores as heuristics.

    A position is left at most ``n`` times: whatever comes later there has ``n`` rests of no
    smaller score before it. Equal scores go on at the position nearest the start, so ties are
    finished one by one and runs of one sign take time in proportion to their length.
    """
    best, score, _ = viterbi(v, segment)
    forward, incoming = forward_scores(v, segment)
    yield score, best  # the search finds it as well, among its equals in some order
    left, given, count = [n] * (len(segment) + 1), 1, 0
    queue: list[tuple] = [(-score, len(segment), 0, 0.0, None)]
    while queue and given < n:
        total, at, _, behind, rest = heapq.heappop(queue)
        if at == 0:
            ids: list[int] = []
            while rest:
                piece, rest = rest
                ids += piece
            if tuple(ids) != best:
                given += 1
                yield -total, tuple(ids)
            continue
        if not left[at]:
            continue
        left[at] -= 1
        for start, piece, gain in incoming[at]:
            if left[start]:
                count += 1
                heapq.heappush(queue, (-(forward[start] + gain + behind), start, count, gain + behind, (piece, rest)))


def _others(v: Vocabulary, segments: list[str], loss: np.ndarray, starts: np.ndarray, total: float, n: int,
            memo: dict[tuple[str, int], list]) -> list:
    """The second to ``n``-th best of a text, each as changes against the best."""
    k = min(n - 1, int(np.isfinite(loss).sum()))
    if k <= 0:
        return []
    chosen = np.sort(np.argsort(loss, kind="stable")[:k]).tolist()
    lists = []
    for i in chosen:
        known = memo.get((segments[i], n))
        if known is None:
            if len(memo) >= MEMO // 8:
                memo.clear()
            known = memo[segments[i], n] = list(segment_best(v, segments[i], n))
        lists.append(known)
    queue, seen, out = [(0.0, (0,) * k)], {(0,) * k}, []
    while queue and len(out) < n:
        lost, picks = heapq.heappop(queue)
        changes = [{"at": int(starts[i]), "n": len(alternatives[0][1]), "ids": list(alternatives[p][1])}
                   for i, alternatives, p in zip(chosen, lists, picks) if p]
        out.append({"score": total - lost, "changes": changes})
        for j in range(k):
            p = picks[j] + 1
            following = (*picks[:j], p, *picks[j + 1:])
            if p < len(lists[j]) and following not in seen:
                seen.add(following)
                more = sum(alt[0][0] - alt[q][0] for alt, q in zip(lists, following))
                heapq.heappush(queue, (more, following))
    return out[1:]


class Encoder:
    """Encodes texts; numbers the segments it met and keeps what was found for each."""

    def __init__(self, path: str):
        self.v = vocabulary(path)
        self.lists: dict[tuple[str, int], list] = {}
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.used = 0
        self.ids = np.zeros(0, dtype=np.int32)
        # First id, number of ids, score and loss of every segment.
        self.begins, self.sizes, self.scores, self.losses = (np.zeros(0, dtype=t) for t in (int, int, float, float))

    def _learn(self, segments: list[str]) -> None:
        ids, sizes, scores, losses = viterbi_all(self.v, segments)
        n, used = len(self.numbers), self.used
        self.ids = _put(self.ids, used, ids)
        self.begins = _put(self.begins, n, used + np.cumsum(sizes) - sizes)
        self.sizes, self.scores, self.losses = (
            _put(a, n, b) for a, b in ((self.sizes, sizes), (self.scores, scores), (self.losses, losses)))
        self.numbers.update(zip(segments, range(n, n + len(segments))))
        self.used += len(ids)

    def encode(self, text: bytes, n: int = BEST) -> tuple[np.ndarray, float, list]:
        """Ids of the best segmentation, its score, and the next ``n - 1`` as changes."""
        return self.encode_all([text], n)[0]

    def encode_all(self, texts: list[bytes], n: int = BEST) -> list[tuple[np.ndarray, float, list]]:
        """``encode`` of many texts; the segments that are new in any of them are searched together."""
        listed = []
        for text in texts:
            written = text.decode("utf-8", "surrogateescape").replace(MARK, LITERAL_MARK)
            listed.append(self.v.segments.findall(MARK + written.replace(" ", MARK)) if text else [])
        met = set().union(*listed)
        new = met.difference(self.numbers)
        if len(self.numbers) + len(new) > MEMO and self.numbers:
            self._forget()
            new = met
        if new:
            self._learn(list(new))
        counts = [len(segments) for segments in listed]
        k = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(listed)), dtype=np.int64, count=sum(counts))
        sizes, scores, losses = self.sizes[k], self.scores[k], self.losses[k]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        ids = self.ids[np.repeat(self.begins[k] - starts, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        out, at = [], 0
        for segments, count in zip(listed, counts):
            if not count:
                out.append((np.zeros(0, dtype=np.int32), 0.0, []))
                continue
            here = slice(at, at + count)
            total, first = math.fsum(scores[here].tolist()), starts[at]
            at += count
            out.append((ids[first:ends[at - 1]], total,
                        _others(self.v, segments, losses[here], starts[here] - first, total, n, self.lists)))
        return out


def _put(held: np.ndarray, n: int, more: np.ndarray) -> np.ndarray:
    """``held`` with ``more`` from place ``n`` on; grows by half at least, so growing takes time in proportion."""
    if n + len(more) > len(held):
        held = np.concatenate((held[:n], np.empty(max(len(more), n // 2 + 1), dtype=held.dtype)))
    held[n:n + len(more)] = more
    return held


def decode_ids(ids: list[int] | np.ndarray, path: str = MODEL) -> bytes:
    """The text of a list of ids, without the mark that encoding puts in front."""
    spelled = vocabulary(path).spelled
    return b"".join(map(spelled.__getitem__, ids))[1:]


def alternative(ids: list[int], changes: list) -> list[int]:
    """The ids of another segmentation from those of the best and its changes."""
    out, at = [], 0
    for change in sorted(changes, key=lambda c: c["at"]):
        out += [*ids[at:change["at"]], *change["ids"]]
        at = change["at"] + change["n"]
    return [*out, *ids[at:]]


def encode(docs: DataFrame, n: int = BEST, id_col: str = "doc_id", text_col: str = "text",
           path: str = MODEL) -> DataFrame:
    """One row per input row: doc_id, n_pieces, ids, score, others.

    ``others`` holds the second to n-th best segmentation with score and changes (position
    in ``ids``, number of ids replaced, new ids); fewer where the lattice has fewer paths.
    Equal losses are broken by position. Null and empty texts have no pieces and score 0;
    repeated rows come out as often as they came in; an empty table gives an empty result;
    other columns are ignored. Bytes that are not UTF-8 and word marks survive the trip.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        kinds = pa.schema([
            ("doc_id", pa.int64()), ("n_pieces", pa.int32()), ("ids", pa.list_(pa.int32())),
            ("score", pa.float64()), ("others", pa.list_(pa.struct([
                ("score", pa.float64()), ("changes", pa.list_(pa.struct([
                    ("at", pa.int32()), ("n", pa.int32()), ("ids", pa.list_(pa.int32()))])))])))])
        for part in in_slices(batches, "text", 1 << 18):
            found = encoder.encode_all(texts_of(part.column(1)), n)
            sizes = np.array([len(ids) for ids, _, _ in found], dtype=np.int32)
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            flat = np.concatenate([ids for ids, _, _ in found])
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                pa.array([s for _, s, _ in found], pa.float64()),
                pa.array([o for _, _, o in found], kinds.field("others").type)], schema=kinds)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str = MODEL) -> DataFrame:
    """(doc_id, text): the texts of lists of ids; a null list gives null, an empty one the empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if ids is None else decode_ids(ids, path) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["doc_id", "text"])

    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text binary").withColumn("text", F.col("text").cast("string"))
