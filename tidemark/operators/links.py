"""Link discovery over listing pages: L1 to L8."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.html import ANYWHERE, Rule, read_pieces, step
from tidemark.functions.skew import attach_per_key, running_totals
from tidemark.functions.urls import canonical_url
from tidemark.session import stored

# fixed values: class names of the listing layout, and its page size
CARD = ANYWHERE + step("div", tokens=["card--fundingprogram"])
CARD_LINK = CARD + step("p", tokens=["card--title"]) + step("a")
NEXT_LINK = ANYWHERE + step("a", tokens=["forward", "button"])
CARDS_PER_PAGE = 10

LISTING_RULES = (
    Rule("card", "div", CARD, "mark"),
    Rule("href", "a", CARD_LINK, "@href", scope="card"),
    Rule("label", "a", CARD_LINK, "text", scope="card"),
    Rule("next", "a", NEXT_LINK, "@href"),
)

# Pages whose navigation block lists the targets; each link counts as its own card.
_NAV = ANYWHERE + step("nav") + ANYWHERE + step("a")
NAVIGATION_RULES = (
    Rule("card", "a", _NAV, "mark"),
    Rule("href", "a", _NAV, "@href", scope="card"),
    Rule("label", "a", _NAV, "text", scope="card"),
    Rule("next", "a", NEXT_LINK, "@href"),
)


def listing_pieces(pages: DataFrame, rules: Sequence[Rule] = LISTING_RULES,
                   page: str = "page_id", url: str = "url") -> DataFrame:
    """One parse per listing page; all operators below start from this."""
    return read_pieces(pages, rules, [page, url]).select(
        F.col(page).alias("page_no"), F.col(url).alias("page_url"), *[r.name for r in rules]
    )


def links(pieces: DataFrame) -> DataFrame:
    """L1: every link target of every card, in page order."""
    return pieces.select(
        "page_no", "page_url", F.posexplode("href.value").alias("pos", "href")
    )


def resolved_links(found: DataFrame) -> DataFrame:
    """L2: absolute URL in normal form. Pages and targets repeat; each row stands alone."""
    return found.withColumn("url", canonical_url("page_url", "href")).filter("url IS NOT NULL")


def unresolved_links(found: DataFrame) -> DataFrame:
    """L2: the links that give no absolute URL, as a report."""
    return found.withColumn("url", canonical_url("page_url", "href")).filter("url IS NULL").drop("url")


# Matches that one read of the pages looks up; they are narrow and broadcast.
MATCHES_PER_READ = 250_000
# Every read is a scan and a broadcast table, which takes a megabyte on the driver however few
# rows it has; so their number ends here, unless reads then hold more than MATCHES_PER_READ.
READS = 16


def page_matches(firsts: DataFrame, pages: DataFrame, page: str = "page_id", url: str = "url") -> DataFrame:
    """L3 to S2 on narrow columns: discovered URLs with the id of the stored page behind each."""
    known = pages.select(F.col(page), canonical_url(url, url).alias("_url"))
    return firsts.join(known, F.col("url") == F.col("_url")).drop("_url")


def stored_pages(firsts: DataFrame, pages: DataFrame, page: str = "page_id", url: str = "url",
                 per_read: int = MATCHES_PER_READ) -> DataFrame:
    """The stored page of every discovered URL, with where it was first seen.

    URLs meet on narrow columns and the matches are stored. The pages, with their text, are
    then read for ranges of page ids of at most about ``per_read`` matches, each broadcast to
    the tasks that read: page text is never shuffled, and where page files are laid out by
    id, a range reads its own part of them only. Where that would be more than ``READS``
    reads, they take more matches each. Both sides are in normal form.
    """
    matches = stored(page_matches(firsts, pages, page, url), "page-matches")
    columns = [c for c in pages.columns if c not in (page, url)]
    count = matches.count()
    reads = min(-(-count // per_read), max(READS, -(-count // MATCHES_PER_READ)))
    inner = [] if reads < 2 else matches.approxQuantile(page, [i / reads for i in range(1, reads)], 0.1 / reads)
    edges = [None, *sorted(set(inner)), None]
    found = None
    for low, high in zip(edges, edges[1:]):
        within = F.lit(True)
        within = within if low is None else within & (F.col(page) > low)
        within = within if high is None else within & (F.col(page) <= high)
        text = pages.where(within).select(page, *columns)
        part = text.join(F.broadcast(matches.where(within)), page).select(*matches.columns, *columns)
        found = part if found is None else found.unionByName(part)
    return found


def links_without_page(firsts: DataFrame, pages: DataFrame, url: str = "url") -> DataFrame:
    """Discovered URLs that no stored page answers; reads the URLs of pages only."""
    known = pages.select(canonical_url(url, url).alias("url"))
    return firsts.join(known, "url", "left_anti")


def first_seen(resolved: DataFrame) -> DataFrame:
    """L3: one row per URL, its first occurrence. An aggregate, so hot URLs combine early."""
    return (
        resolved.groupBy("url")
        .agg(F.min(F.struct("page_no", "pos", "page_url")).alias("first"),
             F.count(F.lit(1)).alias("occurrences"))
        .select("url", F.col("first.page_no").alias("page_no"), F.col("first.pos").alias("pos"),
                F.col("first.page_url").alias("page_url"), "occurrences")
    )


def duplicate_links(resolved: DataFrame) -> DataFrame:
    """L4: each later occurrence, where it was found and where the original stands."""
    return duplicates_of(resolved, first_seen(resolved))


def duplicates_of(resolved: DataFrame, firsts: DataFrame) -> DataFrame:
    """L4 where the first occurrences (L3) are known already."""
    firsts = firsts.filter("occurrences > 1").select(
        "url", F.col("page_no").alias("original_page_no"), F.col("pos").alias("original_pos"),
        F.col("page_url").alias("original_page_url"), "occurrences",
    )
    joined = attach_per_key(resolved, firsts, ["url"], "occurrences", salt="page_no")
    return joined.filter(
        (F.col("page_no") != F.col("original_page_no")) | (F.col("pos") != F.col("original_pos"))
    ).select("url", "page_no", "page_url", "pos", "original_page_no", "original_page_url")


def listing_quality(pieces: DataFrame, expected: int = CARDS_PER_PAGE) -> DataFrame:
    """Cards per page, and whether the page looks right. No shuffle."""
    n = F.size("card")
    return pieces.select(
        "page_no", "page_url", n.alias("cards"),
        F.when(n == 0, "none").when(n != expected, "unexpected").otherwise("ok").alias("status"),
    )


def _first_in_card(name: str):
    return lambda card: F.get(
        F.filter(name, lambda piece: piece.scope == card.nth), F.lit(0)
    ).value


def incomplete_cards(pieces: DataFrame) -> DataFrame:
    """Cards without a link target or without a title text."""
    href, label = _first_in_card("href"), _first_in_card("label")
    cards = pieces.select(
        "page_no", "page_url",
        F.inline(F.transform("card", lambda c: F.struct(
            (c.nth + 1).alias("card_no"), href(c).alias("href"), label(c).alias("label")))),
    )
    missing_link = F.coalesce(F.col("href"), F.lit("")) == ""
    missing_text = F.coalesce(F.col("label"), F.lit("")) == ""
    return cards.select(
        "page_no", "page_url", "card_no",
        missing_link.alias("missing_link"), missing_text.alias("missing_text"),
    ).filter("missing_link OR missing_text")


def discovery_totals(pieces: DataFrame, resolved: DataFrame) -> DataFrame:
    """Running totals of cards and of first-seen URLs, page by page."""
    return totals_of(pieces.select("page_no", F.size("card").cast("long").alias("cards")), first_seen(resolved))


def totals_of(cards: DataFrame, firsts: DataFrame) -> DataFrame:
    """L7 from the cards per page and the first occurrences (L3)."""
    new_urls = firsts.groupBy("page_no").agg(F.count(F.lit(1)).alias("new_urls"))
    per_page = cards.join(new_urls, "page_no", "left").fillna(0, ["new_urls"])
    return running_totals(
        per_page, "page_no", {"total_cards": "cards", "total_urls": "new_urls"}
    )


def next_pages(pieces: DataFrame) -> DataFrame:
    """Target of the next-page link; null or empty means the end of the list."""
    return pieces.select(
        "page_no", "page_url",
        F.nullif(F.get("next.value", F.lit(0)), F.lit("")).alias("next_href"),
    )
