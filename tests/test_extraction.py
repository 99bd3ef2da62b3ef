"""Golden rows of hand-written pages in the layouts the rules describe."""

import time
from datetime import datetime

import pages as P
import pytest
from conftest import rows

from tidemark.functions import html
from tidemark.functions.text import split_list, url_slug
from tidemark.functions.urls import canonical
from tidemark.operators import extraction, identity, links
from tidemark.plans.run import read_records, split


def page_frame(spark, *htmls):
    return spark.createDataFrame(
        [(i, f"https://x.example/FDB/Foerderprogramm/Bund/P{i}.html", h)
         for i, h in enumerate(htmls)], "page_id long, url string, html string")


@pytest.fixture(scope="module")
def found(spark):
    frame = page_frame(spark, P.TABBED, P.FALLBACK, P.UNTITLED, P.EMPTY, P.BROKEN, None, "")
    return {r.page_id: r for r in extraction.extract(frame).collect()}


def test_tabbed_page(found):
    record = found[0]
    assert record.title == "Titel A & B"
    assert record.description == (
        '<article class="content--tab-text"><p>Kurz &amp; gut</p></article>')
    assert "Noch mehr" in record.more_info and "<h3>Recht</h3>" in record.legal_basis
    # The last of a repeated label wins, blank text is null, an unknown label is skipped.
    assert record.funding_type == ["Darlehen", "Zuschuss"]
    assert record.funding_area == ["Beratung", "Bau & Wohnen", "Energie"]
    assert record.funding_location is None and record.eligible_applicants is None
    assert record.funding_body == "Ministerium für Wasser (MfW)"
    assert record.further_links == [
        "https://eins.example/a?b=1&c=2", "https://www.foerderdatenbank.de/zwei/seite.html",
        "https://www.foerderdatenbank.de/drei.html"]
    assert record.issues == ["unknown tab"]


def test_contact(found):
    record = found[0]
    assert record.contact_info_institution.split() == ["Projekt\xadhaus", "Nord"]
    assert record.contact_info_street == "Lange Gasse 1"
    assert record.contact_info_city == "12345 Ort"
    assert record.contact_info_phone.strip() == "030 1234"
    assert record.contact_info_fax.strip() == "030 9999"
    assert record.contact_info_email == "info@haus.example"
    assert record.contact_info_website == "https://haus.example/"


def test_page_without_tabs(found):
    assert found[1].title == "Titel C"
    assert found[1].description == (
        '<div class="content"> <div class="rich--text"> <p> Nur <div>Text</div></div> </div>')
    assert found[1].issues == []


def test_rejected_and_broken_pages(found):
    assert found[2].title is None and found[2].issues == ["no title"]
    assert found[3].issues == ["no content", "no data"]
    assert found[4].title == "Abgebrochen mitten"
    assert found[5].issues == found[6].issues == ["no title", "no content"]


def test_snapshot_reports(spark):
    frame = page_frame(spark, P.TABBED, P.UNTITLED, P.EMPTY)
    parts = split(read_records(frame, datetime(2025, 6, 19)))
    assert [r.id_url for r in parts.records.collect()] == ["bund-p0"]
    assert rows(parts.rejected.select("page_id", "problems")) == [(2, ["description: missing"])]
    assert rows(parts.issues.select("page_id", "reason"), "page_id", "reason") == [
        (0, "unknown tab"), (1, "no title"), (2, "no content"), (2, "no data")]


def test_one_record_per_key_both_ways(spark):
    frame = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z")], "id_hash string, page_id int, title string")
    repeated = identity.repeated_keys(frame)
    plain = identity.one_per_key(frame, ["page_id"])
    helped = identity.one_per_key(frame, ["page_id"], repeated=repeated)
    expected = [("a", 1, "y"), ("b", 3, "z")]
    assert rows(plain, "id_hash") == rows(helped, "id_hash") == expected


def test_unique_gate(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("b",)], "id_hash string")
    assert identity.require_unique(frame.distinct()).count() == 2
    with pytest.raises(Exception, match="id_hash repeats: a"):
        identity.require_unique(frame).collect()


def test_wrong_types_are_reported(spark):
    frame = spark.createDataFrame(
        [("k", "u", "t", "not a list", [1, 2])],
        "id_hash string, id_url string, title string, funding_area string, funding_type array<int>")
    row = identity.validate(frame).first()
    assert "funding_area: wrong type" in row.problems and "url: missing" in row.problems
    assert row.funding_area is None and row.funding_type == ["1", "2"]


@pytest.mark.parametrize("url, slug", [
    ("https://x/FDB/DE/Foerderprogramm/Bund/BMWi/a-B.html", "bund-bmwi-a-b"),
    ("https://x/FDB/DE/Archiv/c.html", "c"),
    ("https://x/Archiv/Foerderprogramm/d.html", "d"),
    ("https://x/other/e.html", ""),
])
def test_slug(spark, url, slug):
    frame = spark.createDataFrame([(url,)], "u string")
    assert frame.select(url_slug(frame.u)).first()[0] == slug


@pytest.mark.parametrize("text, parts", [
    ("  a, b,c ", ["a", "b,c"]), (" \n ", None), (None, None), (" x ", ["x"])])
def test_split_list(spark, text, parts):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(split_list(frame.t)).first()[0] == parts


@pytest.mark.parametrize("base, href, url", [
    ("https://X.Example/a/b.html", "c.html", "https://x.example/a/c.html"),
    ("https://x.example/a/b.html", "/d?b=2&a=1&a=0#top", "https://x.example/d?a=0&a=1&b=2"),
    ("https://x.example/a", "?q=", "https://x.example/a?q="),
    ("https://x.example", "HTTP://Y.example", "http://y.example/"),
    ("https://x.example/", "für,.", "https://x.example/f%C3%BCr,."),
    ("https://x.example/", "a%2fb%20c d", "https://x.example/a%2Fb%20c%20d"),
    ("https://x.example/", "?x=a b&y=%C3%BC", "https://x.example/?x=a+b&y=%C3%BC"),
    ("https://x.example/", None, None),
    ("https://x.example/", "http://[broken", None),
])
def test_canonical_url(base, href, url):
    assert canonical(base, href) == url


def test_listing_pages(spark):
    frame = spark.createDataFrame(
        [(1, "https://x.example/liste.html", P.LISTING),
         (2, "https://x.example/liste2.html", P.LAST_LISTING), (3, "https://x.example/l3", "")],
        "page_id long, url string, html string")
    pieces = links.listing_pieces(frame)
    resolved = links.resolved_links(links.links(pieces))
    shared = "https://x.example/FDB/b.html"
    assert rows(links.first_seen(resolved).select("url", "page_no", "occurrences"), "url") == [
        ("https://x.example/FDB/Content/DE/Foerderprogramm/Bund/a.html?a=1&b=2", 1, 1),
        (shared, 1, 2)]
    assert rows(links.duplicate_links(resolved)) == [
        (shared, 2, "https://x.example/liste2.html", 0, 1, "https://x.example/liste.html")]
    assert rows(links.listing_quality(pieces, 3).select("cards", "status"), "page_no") == [
        (3, "ok"), (1, "unexpected"), (0, "none")]
    assert rows(links.incomplete_cards(pieces).drop("page_url"), "card_no") == [
        (1, 2, False, True), (1, 3, True, False)]
    assert rows(links.discovery_totals(pieces, resolved).select(
        "page_no", "total_cards", "total_urls"), "page_no") == [(1, 3, 2), (2, 4, 2), (3, 4, 2)]
    assert rows(links.next_pages(pieces).select("next_href"), "page_no") == [
        ("?page=2",), (None,), (None,)]


def test_deep_markup_costs_by_its_length():
    """Unclosed elements keep a state, not their path: 50,000 levels, one row, all pieces."""
    import tracemalloc

    from tidemark.functions import html

    reader = html._Reader(extraction.DETAIL_RULES)
    reader.read_batch(["<main>" + "<div>x" * 1000])
    peaks = []
    for depth in (25_000, 50_000):
        tracemalloc.start()
        found = reader.read_batch(["<html><body><main>" + "<div>x" * depth + '<h1 class="title">T</h1>'])
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert found[0].to_pylist()[0][0]["value"] == "T"
    assert peaks[1] < 2.6 * peaks[0] < 10**8


def test_block_beside_the_jumbotron_not_inside(spark):
    page = ('<html><body><main><div class="jumbotron"><div class="content">HERO</div></div>'
            '<div><div class="content">BODY</div></div><h1 class="title">T</h1></main></body></html>')
    got = extraction.extract(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string"))
    assert "BODY" in got.first().description and "HERO" not in got.first().description


def test_no_break_space_after_phone_label(spark):
    page = ('<html><body><main><h1 class="title">T</h1><dl><dt>Ansprechpunkt:</dt>'
            '<dd><p class="tel">Tel:&nbsp;030 1</p></dd></dl></main></body></html>')
    got = extraction.extract(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string"))
    assert got.first().contact_info_phone == "030 1"


# Signs and tags that nothing closes, and elements nested as deep as the page is long.
SHAPES = ("<a ", "</a", "<!x", "<!--", '<a b="', "<a b='>' ", "<a href=x", "<a<a ", '<a "x', "<", "<?", "<script>", "<p>",
          "<p><td><div>", '<h1 class="title">x', "<dd>x<b>", "<dl><dt>a", '<div class="content"><article>', "<ul><li>")


@pytest.mark.parametrize("shape", SHAPES)
def test_a_megabyte_of_any_shape_is_one_row_in_linear_time(shape):
    def seconds(n, end):
        page, reader = shape * (n // len(shape)) + end, html._Reader(extraction.DETAIL_RULES)
        started = time.process_time()
        assert all(len(column) == 1 for column in reader.read_batch([page]))
        return time.process_time() - started

    for end in ("", ">", "-->"):
        # Sixteen times the page may take some more than sixteen times as long, never 256 times.
        assert seconds(1 << 20, end) < 60 * max(seconds(1 << 16, end), 0.01)


def test_unclosed_tags_are_text(spark):
    page = ('<main><h1 class="title">A <b <i>B</i> &lt; <a href="x</h1>" <p>C</h1>'
            '<h1 class="title">D<!-- never closed <h1 class="title">E</h1></main>')
    frame = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    assert [p.value for p in html.read_pieces(frame, extraction.DETAIL_RULES, ["page_id"]).first().title] == [
        "A <b ", "B", ' < <a href="x', "D"]


def test_the_rules_of_a_field_give_what_all_rules_give(spark):
    frame = page_frame(spark, P.TABBED, P.FALLBACK)
    every = {r.page_id: r for r in extraction.extract(frame).collect()}
    for field in ("title", "description", "more_info", "legal_basis", "funding_type", "funding_body", "further_links",
                  "contact_info_institution", "contact_info_city", "contact_info_phone", "contact_info_email"):
        few = extraction.rules_for([field])
        assert len(few) < len(extraction.DETAIL_RULES)
        for r in extraction.extract(frame, few).collect():
            assert r[field] == every[r.page_id][field], field
