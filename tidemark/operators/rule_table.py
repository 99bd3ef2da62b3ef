"""Extraction under rules and labels that are tables: U2, X5.

The reader only finds elements; it hands back one row per piece, (page, rule, nth, scope, pos,
value). What a piece means is data: the rule table says which layout a rule belongs to and
which field it fills, the label table which field the entry behind a label fills. Both are
small and meet the rows by broadcast joins; an aggregate turns the rows of a page into its
record. A new layout, field or label is a row, not code.

Rule table, one row per rule (``RULES``): layout, rank (layouts are tried in this order), rule,
field (null for rules that only mark or scope), marks (a page that shows the rule has the
layout), take and scope as in ``functions.html``, how ("first", "join" or "list"), and path,
a list of steps of which a null tag stands for any number of levels.

Label table (``LABELS``): layout, label, field, how, and part: the rule, scoped by the entry's
rule, whose pieces inside the labelled entry are the value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.html import Rule, Step, read_pieces
from tidemark.functions.text import blank_to_null, strip
from tidemark.session import stored

_STEP = "struct<tag: string, cls: string, tokens: array<string>, title: string, nth: int>"
RULES = ("layout string, rank int, rule string, field string, marks boolean, take string, scope string, how string, "
         f"path array<{_STEP}>")
LABELS = "layout string, label string, field string, how string, part string"


def reader_rules(table: DataFrame) -> list[Rule]:
    """The rules of all layouts for the one pass over a page; a few rows, collected.

    Rules of equal name must be equal, whatever their layouts; a page is read once for all.
    """
    found: dict[str, Rule] = {}
    for row in table.collect():
        path = tuple(None if s.tag is None else Step(s.tag, s.cls, tuple(s.tokens or ()), s.title, s.nth) for s in row.path)
        rule = Rule(row.rule, next((s.tag for s in reversed(path) if s), ""), path, row.take, row.scope)
        if found.setdefault(row.rule, rule) != rule:
            raise ValueError(f"rule {row.rule} is given in two ways")
    return sorted(found.values(), key=lambda r: r.name)


def piece_rows(pages: DataFrame, table: DataFrame, page: str = "page_id", html: str = "html") -> DataFrame:
    """(page, rule, nth, scope, pos, value): every piece of every rule as a row; markup ends here."""
    rules = reader_rules(table)
    pieces = read_pieces(pages, rules, [page], html)

    def named(name: str) -> Column:
        return F.transform(name, lambda p: F.struct(
            F.lit(name).alias("rule"), p.nth.alias("nth"), p.scope.alias("scope"), p.pos.alias("pos"), p.value.alias("value")))

    return pieces.select(page, F.inline(F.concat(*[named(r.name) for r in rules])))


def page_layouts(rows: DataFrame, table: DataFrame, page: str = "page_id") -> DataFrame:
    """(page, layout): of the layouts a page is marked as, the one of lowest rank."""
    marks = F.broadcast(table.where("marks").select("rule", "rank", "layout"))
    return rows.select(page, "rule").join(marks, "rule").groupBy(page).agg(
        F.min(F.struct("rank", "layout")).alias("least")).select(page, F.col("least.layout").alias("layout"))


def _value(how: Column, pieces: Column) -> Column:
    """The value of a field from its pieces in page order; blank is null."""
    texts = F.transform(F.array_sort(pieces), lambda p: p.value)
    first = F.get(F.filter(F.transform(texts, lambda t: blank_to_null(t)), lambda t: t.isNotNull()), F.lit(0))
    return F.when(how == "join", blank_to_null(F.array_join(texts, ""))).when(
        how == "list", F.array_join(F.filter(F.transform(texts, strip), lambda t: t != ""), ", ")).otherwise(first)


def extract_by_table(pages: DataFrame, rules: DataFrame, labels: DataFrame | None = None,
                     page: str = "page_id", html: str = "html", label_rule: str = "label",
                     entry_rule: str = "entry") -> DataFrame:
    """One row per page that has a layout: page, layout, and a text column per field of the tables.

    Every piece row of a page meets its layout and then the rule and label tables. A labelled
    entry is the ``entry_rule`` element (taken as "mark") of the same number as the
    ``label_rule`` element whose text is the label, white space and colons apart; the last of
    equal labels that has an entry counts. Labels nobody asked for and pages without layout are
    left out. Values are text; lists are joined
    by ", ". Columns are those of the tables, in order of name.
    """
    rows = stored(piece_rows(pages, rules, page, html), "pieces")
    rows = rows.join(page_layouts(rows, rules, page), page)
    piece = F.struct("pos", "value").alias("piece")
    asked = F.broadcast(rules.where("field IS NOT NULL").select("layout", "rule", "field", "how"))
    found = rows.join(asked, ["layout", "rule"]).select(page, "layout", "field", "how", piece)
    names = {r.field for r in rules.where("field IS NOT NULL").select("field").distinct().collect()}
    if labels is not None:
        text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda p: p.value), "")
        label = F.replace(strip(text), F.lit(":"), F.lit(""))
        shown = rows.where(F.col("rule") == label_rule).groupBy(page, "layout", "nth").agg(label.alias("label"))
        entries = rows.where(F.col("rule") == entry_rule).select(page, "nth")
        meant = shown.join(F.broadcast(labels), ["layout", "label"]).join(entries, [page, "nth"])
        last = meant.groupBy(page, "layout", "field").agg(F.max(F.struct("nth", "how", "part")).alias("at"))
        inside = rows.where("scope IS NOT NULL").select(page, F.col("rule").alias("part"), piece, F.col("scope").alias("nth"))
        found = found.unionByName(last.select(page, "layout", "field", "at.*").join(inside, [page, "part", "nth"]).select(
            page, "layout", "field", "how", "piece"))
        names |= {r.field for r in labels.select("field").distinct().collect()}
    values = found.groupBy(page, "layout", "field", "how").agg(F.collect_list("piece").alias("pieces")).select(
        page, "field", _value(F.col("how"), F.col("pieces")).alias("value"))
    record = values.groupBy(page).pivot("field", sorted(names)).agg(F.first("value", ignorenulls=True))
    return page_layouts(rows.drop("layout"), rules, page).join(record, page, "left")


def rule(layout: str, rank: int, name: str, path: Sequence[Step | None], take: str = "text", field: str | None = None,
         how: str = "first", marks: bool = False, scope: str | None = None) -> tuple:
    """A row of the rule table from the path builders of ``functions.html``."""
    steps = [(None,) * 5 if s is None else (s.tag, s.cls, list(s.tokens), s.title, s.nth) for s in path]
    return layout, rank, name, field, marks, take, scope, how, steps
