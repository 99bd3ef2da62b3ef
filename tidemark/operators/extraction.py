"""Field extraction over detail pages: X1 to X15.

One parse per page hands back raw pieces (``functions.html``); every meaning is given
here by Spark expressions. Rules are data, so another layout is another rule list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.html import ANYWHERE, PIECES, Path, Rule, read_pieces, step
from tidemark.functions.text import blank_to_null, first_group, split_list, strip
from tidemark.schema import MARKDOWN_FIELDS

# --- fixed values of the detail-page layout ---------------------------------
LABELS = {
    "Kurzzusammenfassung": "description",
    "Zusatzinfos": "more_info",
    "Rechtsgrundlage": "legal_basis",
    "Ansprechpunkt": "contact_info",
    "Weiterführende Links": "further_links",
    "Förderart": "funding_type",
    "Förderbereich": "funding_area",
    "Fördergebiet": "funding_location",
    "Förderberechtigte": "eligible_applicants",
    "Fördergeber": "funding_body",
}
SITE = "https://www.foerderdatenbank.de/"
DETAIL_LINK_TITLE = "Öffnet die Einzelsicht"
# (?U): white space of any script, no-break spaces included.
FAX, PHONE, EMAIL = r"(?U)Fax:\s*(.*)", r"(?U)Tel:\s*(.*)", r"mailto:(.*)"
# ----------------------------------------------------------------------------

_MAIN = step("html") + step("body") + step("main")
_DD = ANYWHERE + step("dd")
_TAB = _MAIN + step("div", nth=2) + step("div") + step("div", nth=1) + step("h2") + step("span")
_CARD_LABEL = step("a", title=DETAIL_LINK_TITLE) + step("span", cls="link--label")


def _in_dd(name: str, tag: str, *steps: Path, take: str = "text") -> Rule:
    return Rule(name, tag, sum(steps, _DD + ANYWHERE), take, scope="dd")


DETAIL_RULES = (
    Rule("title", "h1", ANYWHERE + step("h1", cls="title"), "all_text"),
    Rule("tab", "span", _TAB, "all_text"),
    Rule("article", "article", ANYWHERE + step("div", cls="content") + ANYWHERE + step("article"),
         "html"),
    Rule("jumbotron", "div", ANYWHERE + step("main") + step("div", cls="jumbotron"), "mark"),
    Rule("block", "div", ANYWHERE + step("main") + step("div") + step("div", cls="content"),
         "html", "jumbotron"),
    Rule("dt", "dt", ANYWHERE + step("dt"), "mark"),
    Rule("dt_text", "dt", ANYWHERE + step("dt"), "text"),
    Rule("dd", "dd", _DD, "mark"),
    Rule("dd_text", "dd", _DD, "text"),
    Rule("body", "span", _DD + step("p", cls="card--title") + _CARD_LABEL, "text", "dd"),
    _in_dd("link", "a", step("a"), take="@href"),
    _in_dd("institution", "span", _CARD_LABEL, take="all_text"),
    _in_dd("street", "p", step("p", cls="adr")),
    _in_dd("city", "p", step("p", cls="locality")),
    _in_dd("fax", "p", step("p", cls="fax")),
    _in_dd("phone", "p", step("p", cls="tel")),
    _in_dd("email", "a", step("p", cls="email"), step("a"), take="@href"),
    _in_dd("website", "a", step("p", cls="website"), step("a"), take="@href"),
)

_ENTRIES = {"dt", "dt_text", "dd", "dd_text"}
_ARTICLES = _ENTRIES | {"tab", "article", "jumbotron", "block"}
_NEEDED = {
    "title": {"title"}, "funding_body": _ENTRIES | {"body"}, "further_links": _ENTRIES | {"link"},
    **dict.fromkeys(MARKDOWN_FIELDS, _ARTICLES),
}


def rules_for(fields: Sequence[str], rules: Sequence[Rule] = DETAIL_RULES) -> list[Rule]:
    """The rules that some fields are made of, so that no other text leaves the reader.

    The other fields, and the issues of a page, mean nothing under them.
    """
    wanted: set[str] = set()
    for field in fields:
        part = field.removeprefix("contact_info_")
        wanted |= _NEEDED.get(field, _ENTRIES if part == field else _ENTRIES | {part})
    return [r for r in rules if r.name in wanted]


# Plain article pages: a heading and one article, no tabs and no labelled list.
ARTICLE_RULES = (
    Rule("title", "h1", ANYWHERE + step("article") + step("h1"), "all_text"),
    Rule("jumbotron", "body", step("html") + step("body"), "mark"),
    Rule("block", "article", step("html") + step("body") + step("article"), "html"),
)


def detail_pieces(pages: DataFrame, rules: Sequence[Rule] = DETAIL_RULES,
                  keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """Raw pieces per page; rules a layout does not have give empty lists."""
    found = read_pieces(pages, rules, keep)
    absent = {r.name for r in DETAIL_RULES} - {r.name for r in rules}
    return found.withColumns({name: F.array().cast(PIECES) for name in sorted(absent)})


def _named(label: Column) -> Column:
    """Label as on the page to column name; null for labels nobody asked for."""
    table = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    return F.element_at(table, F.replace(strip(label), F.lit(":"), F.lit("")))


def _first(pieces: Column) -> Column:
    return F.get(pieces, F.lit(0)).value


def label_structure(pieces: DataFrame) -> DataFrame:
    """Adds what each tab and each list entry is, by position.

    ``tab_fields`` and ``entry_fields`` name the column of the i-th article and the i-th
    dt/dd pair. The shorter of the two lists decides how many pairs there are.
    """
    def entry(dt: Column) -> Column:
        return _named(_first(F.filter("dt_text", lambda t: t.nth == dt.nth)))

    pairs = F.least(F.size("dt"), F.size("dd"))
    return pieces.withColumns({
        "tab_fields": F.slice(F.transform("tab.value", _named), 1,
                              F.greatest(F.size("article"), F.lit(0))),
        "entry_fields": F.slice(F.transform("dt", entry), 1, pairs),
    })


def _last_position(fields: str, name: str) -> Column:
    """Where ``name`` stands last, counted from 0; null if nowhere."""
    back = F.array_position(F.reverse(fields), name)
    return F.when(back > 0, (F.size(fields) - back).cast("int"))


def map_fields(pieces: DataFrame) -> DataFrame:
    """All record fields of a page, from its pieces; narrow, no shuffle.

    Adds ``issues``: what is odd about the page (X2, X15 and dropped tabs).
    """
    known = label_structure(pieces)
    # Positions first, so that each is computed once per row.
    positions = {f"_at_{c}": _last_position("entry_fields", c) for c in LABELS.values()}
    positions |= {f"_tab_{c}": _last_position("tab_fields", c) for c in MARKDOWN_FIELDS}
    placed = known.withColumns(positions)

    def inside(name: str, field: str) -> Column:
        """Pieces of a rule that belong to the list entry of ``field``."""
        return F.filter(name, lambda piece: piece.scope == F.col(f"_at_{field}"))

    def own_text(field: str) -> Column:
        return _first(F.filter("dd_text", lambda t: t.nth == F.col(f"_at_{field}")))

    def matching(name: str, pattern: str) -> Column:
        """First capture among the pieces of a contact rule."""
        hits = F.transform(inside(name, "contact_info"),
                           lambda piece: first_group(piece.value, pattern))
        return F.get(F.array_compact(hits), F.lit(0))

    def absolute(href: Column) -> Column:
        return F.when(F.startswith(href, F.lit("http")), href).otherwise(
            F.concat(F.lit(SITE), F.regexp_replace(href, "^/", "")))

    first_jumbotron = F.get("jumbotron", F.lit(0)).pos
    # A block after the first jumbotron and beside it, never one inside a jumbotron.
    fallback = _first(F.filter(
        "block", lambda b: (b.pos > first_jumbotron) & b.scope.isNull()))
    no_tabs = F.size("tab") == 0

    fields: dict[str, Column] = {
        "title": blank_to_null(F.array_join("title.value", "")),
    }
    for name in MARKDOWN_FIELDS:
        article = F.get("article", F.col(f"_tab_{name}")).value
        from_page = F.when(no_tabs, fallback).otherwise(article) if name == "description" \
            else article
        fields[name] = F.when(
            F.col(f"_at_{name}").isNotNull(), blank_to_null(own_text(name))
        ).otherwise(from_page)
    for name in ("funding_type", "funding_area", "funding_location", "eligible_applicants"):
        fields[name] = split_list(own_text(name))
    hrefs = F.transform(inside("link", "further_links"), lambda piece: absolute(piece.value))
    fields["funding_body"] = strip(_first(inside("body", "funding_body")))
    fields["further_links"] = F.when(F.size(hrefs) > 0, hrefs)
    contact = {
        "institution": blank_to_null(F.array_join(
            F.transform(inside("institution", "contact_info"), lambda p: p.value), " ")),
        "street": blank_to_null(_first(inside("street", "contact_info"))),
        "city": blank_to_null(_first(inside("city", "contact_info"))),
        "fax": matching("fax", FAX),
        "phone": matching("phone", PHONE),
        "email": matching("email", EMAIL),
        "website": F.nullif(_first(inside("website", "contact_info")), F.lit("")),
    }
    fields |= {f"contact_info_{part}": value for part, value in contact.items()}

    keep = [c for c in pieces.columns if c not in {r.name for r in DETAIL_RULES}]
    about_page = {
        "_no_tabs": no_tabs,
        "_no_content": no_tabs & fallback.isNull(),
        "_no_list": (F.size("dt") == 0) & (F.size("dd") == 0),
        "_odd_tab": F.exists("tab_fields", lambda f: f.isNull() | ~f.isin(*MARKDOWN_FIELDS)),
        "_uneven_tabs": F.size("tab") != F.size("article"),
    }
    values = fields | about_page
    mapped = placed.select(*keep, *[value.alias(name) for name, value in values.items()])
    # Through a generator, so that later filters use the values and do not repeat the work.
    mapped = mapped.select(*keep, F.inline(F.array(F.struct(*values))))
    issues = {
        "no title": F.col("title").isNull(),
        "no content": F.col("_no_content"),
        "no data": F.col("title").isNotNull() & F.col("_no_tabs") & F.col("_no_list")
        & F.col("description").isNull(),
        "unknown tab": F.col("_odd_tab"),
        "tabs and articles differ": F.col("_uneven_tabs") & ~F.col("_no_tabs"),
    }
    return mapped.withColumn(
        "issues", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in issues.items()]))
    ).drop(*about_page)


def extract(pages: DataFrame, rules: Sequence[Rule] = DETAIL_RULES,
            keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """Pages to records under a rule list, one row per page."""
    return map_fields(detail_pieces(pages, rules, keep))


def records(extracted: DataFrame) -> DataFrame:
    """Pages with a title."""
    return extracted.filter(F.col("title").isNotNull()).drop("issues")


def page_issues(extracted: DataFrame, by: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """One row per page and reason."""
    return extracted.select(*by, F.explode("issues").alias("reason"))
