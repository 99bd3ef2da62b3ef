"""One pass over a page that lifts out the elements named by a list of rules.

Rules are data. The Python side only finds elements and hands back their raw text,
markup or attribute; everything that gives those values a meaning is a Spark
expression in ``operators.extraction`` and ``operators.links``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

@dataclass(frozen=True)
class Step:
    """One level of a path; what is not given may be anything."""

    tag: str
    cls: str | None = None         # the exact class attribute
    tokens: tuple[str, ...] = ()   # classes that must be among those given
    title: str | None = None
    nth: int | None = None         # position among the same tags below one parent

    def fits(self, tag: str, number: int, cls: str, title: str) -> bool:
        return (self.tag == tag and self.nth in (None, number) and self.cls in (None, cls)
                and self.title in (None, title) and set(self.tokens) <= set(cls.split()))


Path = tuple[Step | None, ...]


def step(tag: str, cls: str | None = None, tokens: Sequence[str] = (),
         title: str | None = None, nth: int | None = None) -> Path:
    """A path of one level; paths are joined with ``+``."""
    return (Step(tag, cls, tuple(tokens), title, nth),)


ANYWHERE: Path = (None,)  # any number of levels


@dataclass(frozen=True)
class Rule:
    """Where to look (``path``, tag last) and what to take.

    take: "text" own text nodes, "all_text" also those of descendants, "html" the
    element as written in the page (null inside another one of the rule), "mark" just its
    place, "@name" an attribute.
    scope: rule whose innermost open element's number is noted with each value.
    """

    name: str
    tag: str
    path: Path
    take: str = "text"
    scope: str | None = None


PIECES = T.ArrayType(T.StructType([
    T.StructField("nth", T.IntegerType()),     # number of the element within its rule
    T.StructField("scope", T.IntegerType()),   # number of the enclosing scope element
    T.StructField("pos", T.IntegerType()),     # order within the page
    T.StructField("value", T.StringType()),
]))
_ARROW_TYPES = {"nth": pa.int32(), "scope": pa.int32(), "pos": pa.int32(), "value": pa.string()}

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = {t: re.compile(rf"(?=</{t}[\s>])|\Z", re.I) for t in ("script", "style")}
_BLOCK = frozenset(
    "address article aside blockquote dd div dl dt fieldset figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr li main nav ol p pre section table ul".split()
)
# An opening tag ends an open element of the first set, unless one of the second is nearer.
_ENDS = {tag: (("p",), frozenset({"td", "th", "button"})) for tag in _BLOCK}
_ENDS["li"] = (("li", "p"), frozenset({"ul", "ol"}))
_ENDS["dt"] = _ENDS["dd"] = (("dt", "dd"), frozenset({"dl"}))

# A tag ends at ">" or, unclosed, before the next "<" outside quotes, so that no two tokens
# look through the same text and the time for a page follows its length.
_ATTRIBUTE = r"""([^\s/>=<]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s><]++)?)?"""
_ATTRIBUTES = re.compile(_ATTRIBUTE)
_INSIDE = _ATTRIBUTE.replace("([^", "(?:[^").replace('("[', '(?:"[')
_TOKEN = re.compile(
    rf"(<!--.*?(?:-->|\Z))|<[!?][^>]*+>|</([a-zA-Z][^\s/>]*+)[^>]*+>"
    rf"|<([a-zA-Z][^\s/><]*+)((?:[\s/]++|{_INSIDE}|=)*+)>", re.S)
_NONE: dict[str, str] = {}
_UNASKED: tuple[set[int], bool, bool] = (set(), False, False)
_TEXTS = ("text", "all_text")
_SELF_CLOSED = re.compile(r"""(?:^|[\s"'])/$""")


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for name, value in _ATTRIBUTES.findall(text):
        if value[:1] in ('"', "'") and len(value) > 1 and value[-1] == value[0]:
            value = value[1:-1]
        found.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return found


class _Element:
    __slots__ = ("tag", "state", "counts", "hits")

    def __init__(self, tag, state):
        self.tag, self.state = tag, state
        self.counts = None   # children seen, per tag
        self.hits = ()    # (rule, number, index of the value to fill at the end, start)


class _Reader:
    """Walks the tags of a page with a stack of open elements; broken markup is no error.

    How far each rule's path has come is a small state that a child takes over from its
    parent, so an open element costs the same at any depth.
    """

    def __init__(self, rules: Sequence[Rule]):
        self.rules = tuple(rules)
        self.names = [rule.name for rule in rules]
        self.scopes = {rule.scope for rule in rules if rule.scope}
        # What steps ask of a tag, so that other attributes do not make new kinds of element.
        self.asked: dict[str, tuple[set[int], bool, bool]] = {}
        for wanted in {s for rule in rules for s in rule.path if s}:
            nth, cls, title = self.asked.get(wanted.tag, (set(), False, False))
            self.asked[wanted.tag] = (nth | {wanted.nth} - {None}, cls or wanted.cls is not None
                                      or bool(wanted.tokens), title or wanted.title is not None)
        # Tags whose number below their parent a step asks for; others are not counted.
        self.numbered = {tag for tag, (nth, _, _) in self.asked.items() if nth}
        self.kinds: dict[tuple, tuple[int, tuple[Rule, ...], dict[str, str], bool]] = {}
        self.states: dict[frozenset, int] = {}
        self.places: list[frozenset] = []
        self.moves: dict[tuple, tuple[int, tuple[Rule, ...]]] = {}
        self.outside = self._state({(r, 0) for r in range(len(self.rules))})

    def _state(self, places: set[tuple[int, int]]) -> int:
        """Number of a set of (rule, next step); a step that may be skipped brings the next one."""
        every = set(places)
        for rule, at in places:
            path = self.rules[rule].path
            while at < len(path) and path[at] is None:
                at += 1
                every.add((rule, at))
        found = frozenset(every)
        if found not in self.states:
            self.states[found] = len(self.places)
            self.places.append(found)
        return self.states[found]

    def _move(self, state: int, tag: str, number: int, cls: str, title: str) -> tuple[int, tuple[Rule, ...]]:
        """The state inside a child element, and the rules that end at it."""
        nth, by_cls, by_title = self.asked.get(tag, _UNASKED)
        kind = (state, tag if tag in self.asked else "", number if number in nth else 0,
                cls if by_cls else "", title if by_title else "")
        known = self.moves.get(kind)
        if known is None:
            if len(self.moves) > 10_000:
                self.moves.clear()  # a memo only
            inside, ended = set(), []
            for rule, at in sorted(self.places[state]):
                path = self.rules[rule].path
                if at == len(path):
                    continue
                if path[at] is None:
                    inside.add((rule, at))
                elif path[at].fits(tag, number, cls, title):
                    if at + 1 == len(path):
                        ended.append(self.rules[rule])
                    else:
                        inside.add((rule, at + 1))
            known = self.moves[kind] = (self._state(inside), tuple(dict.fromkeys(ended)))
        return known

    def _kind(self, state: int, tag: str, number: int, attributes: str) -> tuple[int, tuple[Rule, ...], dict[str, str], bool]:
        """What an opening tag as written comes to: state inside, rules that end, attributes, whether it is empty."""
        kind = (state, tag, number, attributes)
        known = self.kinds.get(kind)
        if known is None:
            given = _attributes(attributes) if len(attributes) > 1 else _NONE
            inside, ended = self._move(state, tag, number, given.get("class", ""), given.get("title", ""))
            empty = tag in _VOID or attributes[-1:] == "/" and bool(_SELF_CLOSED.search(attributes))
            known = (inside, ended, given, empty)
            if len(attributes) < 200:   # a memo only: of bounded rows, each of bounded length
                if len(self.kinds) > 10_000:
                    self.kinds.clear()
                self.kinds[kind] = known
        return known

    def read_batch(self, pages: Iterable[str | None]) -> list[pa.Array]:
        """One list array per rule, one list per page; pieces are gathered column by column."""
        self.found = {name: ([], [], [], []) for name in self.names}
        ends = {name: [0] for name in self.names}
        for page in pages:
            self._read(page or "")
            for name, columns in self.found.items():
                ends[name].append(len(columns[0]))
        arrays = []
        for name, columns in self.found.items():
            parts = [pa.array(c, t) for c, t in zip(columns, _ARROW_TYPES.values())]
            arrays.append(pa.ListArray.from_arrays(
                pa.array(ends[name], pa.int32()),
                pa.StructArray.from_arrays(parts, list(_ARROW_TYPES))))
        return arrays

    def _read(self, html: str) -> None:
        self.html = html
        self.open = [_Element("", self.outside)]
        self.taking: dict[Rule, list[int]] = {}   # open elements of the rules that take all text
        self.writing: dict[str, int] = {}   # open elements of the rules that take a place or markup
        self.inner: dict[str, list[int]] = {name: [] for name in self.scopes}
        self.where: dict[str, list[int]] = {}   # places in the stack per tag
        self.seen = dict.fromkeys(self.names, 0)
        self.pos = at = 0
        self.texts = 0   # open elements that take text
        limit = html.rfind(">") + 1   # no token ends beyond
        search = _TOKEN.search
        while token := search(html, at, limit):
            start, end = token.span()
            if self.texts and start > at:
                self._text(html[at:start])
            comment, ended, started, attributes = token.groups()
            at = end
            if started:
                tag = started.lower()
                self._start(tag, attributes, start, at)
                if tag in _RAW:
                    at = _RAW[tag].search(html, at).start()
            elif ended:
                self._end(ended.lower(), start, at)
            elif comment and not comment.endswith("-->"):
                at = len(html)
        if self.texts and at < len(html):
            self._text(html[at:])
        self._close_to(1, len(html))

    def _add(self, rule: Rule, number: int, value: str | None) -> int:
        around = self.inner[rule.scope] if rule.scope else None
        scope = around[-1] if around else None
        for column, item in zip(self.found[rule.name], (number, scope, self.pos, value)):
            column.append(item)
        self.pos += 1
        return len(self.found[rule.name][0]) - 1

    def _text(self, text: str) -> None:
        """Once per rule, as a text is one node of the page however its elements are nested."""
        if "&" in text:
            text = unescape(text)
        for rule, numbers in self.taking.items():
            if numbers:
                self._add(rule, numbers[-1], text)
        for rule, number, _, _ in self.open[-1].hits:
            if rule.take == "text":
                self._add(rule, number, text)

    def _close_to(self, depth: int, end: int) -> None:
        while len(self.open) > depth:
            element = self.open.pop()
            self.where[element.tag].pop()
            for rule, _, slot, start in element.hits:
                if rule.take in _TEXTS:
                    self.texts -= 1
                if rule.take == "all_text":
                    self.taking[rule].pop()
                elif rule.name in self.writing:
                    self.writing[rule.name] -= 1
                if rule.name in self.inner:
                    self.inner[rule.name].pop()
                if slot is not None:
                    self.found[rule.name][3][slot] = self.html[start:end]

    def _start(self, tag: str, attributes: str, start: int, end: int) -> None:
        if tag in _ENDS:
            self._end_implied(tag, start)
        parent, number = self.open[-1], 0
        if tag in self.numbered:
            counts = parent.counts
            if counts is None:
                counts = parent.counts = {}
            number = counts[tag] = counts.get(tag, 0) + 1
        state, ended, given, empty = self._kind(parent.state, tag, number, attributes)
        element = _Element(tag, state)
        places = self.where.get(tag)
        if places is None:
            places = self.where[tag] = []
        places.append(len(self.open))
        self.open.append(element)
        for rule in ended:
            self._hit(element, rule, given, start)
        if empty:
            self._close_to(len(self.open) - 1, end)

    def _end_implied(self, tag: str, start: int) -> None:
        ends, barrier = _ENDS[tag]
        where, nearest = self.where, 0
        for t in ends:
            if (places := where.get(t)) and places[-1] > nearest:
                nearest = places[-1]
        if nearest:
            for t in barrier:
                if (places := where.get(t)) and places[-1] > nearest:
                    return
            self._close_to(nearest, start)

    def _hit(self, element: _Element, rule: Rule, given: dict[str, str], start: int) -> None:
        number = self.seen[rule.name]
        self.seen[rule.name] += 1
        slot = None
        if rule.take in ("mark", "html"):
            slot = self._add(rule, number, None)
            # What stands inside another element of the rule is in that one's markup already.
            nested = self.writing.get(rule.name, 0)
            self.writing[rule.name] = nested + 1
            slot = None if nested else slot
        elif rule.take[0] == "@":
            value = given.get(rule.take[1:])
            if value is not None:
                self._add(rule, number, value)
        else:
            self.texts += 1
            if rule.take == "all_text":
                self.taking.setdefault(rule, []).append(number)
        element.hits += ((rule, number, slot if rule.take == "html" else None, start),)
        if rule.name in self.inner:
            self.inner[rule.name].append(number)

    def _end(self, tag: str, start: int, end: int) -> None:
        if places := self.where.get(tag):
            depth = places[-1]
            if len(self.open) > depth + 1:
                self._close_to(depth + 1, start)
            self._close_to(depth, end)


# Markup that is taken out of a batch at once: what a worker holds beside Spark's own batch
# follows from this and from the longest page, not from the rows that a task has.
TEXT_AT_ONCE = 1 << 20


def _runs(texts: pa.Array, at_once: int) -> Iterator[tuple[int, int]]:
    """(start, rows) of neighbouring rows with at most ``at_once`` bytes together, or of one row."""
    start = total = 0
    for row, size in enumerate(pc.binary_length(texts).to_pylist()):
        size = size or 0
        if row > start and total + size > at_once:
            yield start, row - start
            start, total = row, 0
        total += size
    if start < len(texts):
        yield start, len(texts) - start


def read_batches(batches: Iterable[pa.RecordBatch], rules: Sequence[Rule], keep: Sequence[str],
                 html: str = "html", at_once: int = TEXT_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Batches of pages to batches of ``keep`` and pieces, each of a bounded share of the markup."""
    reader, names = _Reader(rules), [*keep, *[r.name for r in rules]]
    for batch in batches:
        for start, rows in _runs(batch.column(html), at_once):
            part = batch.slice(start, rows)
            columns = [part.column(c) for c in keep]
            columns += reader.read_batch(part.column(html).to_pylist())
            yield pa.RecordBatch.from_arrays(columns, names)


def read_pieces(pages: DataFrame, rules: Sequence[Rule], keep: Sequence[str],
                html: str = "html") -> DataFrame:
    """Columns ``keep`` plus one list column of pieces per rule; one parse per page.

    The markup itself ends here: it is never carried into a shuffle.
    """
    rules, keep = tuple(rules), list(keep)
    schema = T.StructType(
        [pages.schema[c] for c in keep] + [T.StructField(r.name, PIECES) for r in rules]
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return read_batches(batches, rules, keep, html)

    return pages.select(*dict.fromkeys([*keep, html])).mapInArrow(parse, schema)
