"""Rules and labels as tables, and raw page files."""

import codecs
import os

import pytest
from conftest import rows

from tidemark.functions.html import ANYWHERE, step
from tidemark.operators import rule_table as T
from tidemark.sources import page_files


def rules(spark, *more):
    return spark.createDataFrame([
        T.rule("shop", 1, "shop", ANYWHERE + step("body", cls="shop"), "mark", marks=True),
        T.rule("shop", 1, "name", ANYWHERE + step("h1"), "all_text", "title", "join"),
        T.rule("shop", 1, "label", ANYWHERE + step("dt")), T.rule("shop", 1, "entry", ANYWHERE + step("dd"), "mark"),
        T.rule("shop", 1, "entry_text", ANYWHERE + step("dd"), scope="entry"),
        T.rule("shop", 1, "tag", ANYWHERE + step("dd") + ANYWHERE + step("i"), scope="entry"),
        T.rule("news", 2, "body", ANYWHERE + step("body"), "mark", marks=True),
        T.rule("news", 2, "head", ANYWHERE + step("h2"), "all_text", "title", "join"), *more], T.RULES)


def pages(spark, *htmls):
    return spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "page_id long, html string")


LABELS = [("shop", "Price", "price", "first", "entry_text"), ("shop", "Tags", "tags", "list", "tag")]


def test_layouts_are_told_apart_and_labels_met(spark):
    shop = ('<body class="shop"><h1>A <b>b</b></h1><h2>no</h2><dl><dt>Price:<dd> 5 <i>x</i><dt>Odd<dd>1<dt> Tags'
            "<dd><i>p</i> <i> q</i><i> </i><dt>Price</dt><dd>7</dd><dt>Price</dl>")
    news = "<body><h1>no</h1><h2>N</h2><dl><dt>Price<dd>9</dl>"
    labels = spark.createDataFrame(LABELS, T.LABELS)
    got = T.extract_by_table(pages(spark, shop, news, "<p>neither", None, '<body class="shop">'), rules(spark), labels)
    assert got.columns == ["page_id", "layout", "price", "tags", "title"]
    assert rows(got, "page_id") == [
        (0, "shop", "7", "p, q", "A b"), (1, "news", None, None, "N"), (4, "shop", None, None, None)]


def test_a_new_field_and_a_new_layout_are_rows(spark):
    page = '<body class="shop"><h1>A</h1><p class="note">n1</p><p class="note">n2</p>'
    more = (T.rule("shop", 1, "note", ANYWHERE + step("p", cls="note"), field="notes", how="list"),
            T.rule("first", 0, "note", ANYWHERE + step("p", cls="note"), field="first_note", marks=True))
    got = T.extract_by_table(pages(spark, page), rules(spark, more[0]))
    assert rows(got) == [(0, "shop", "n1, n2", "A")]
    got = T.extract_by_table(pages(spark, page), rules(spark, *more))
    assert [r.asDict() for r in got.collect()] == [
        {"page_id": 0, "layout": "first", "first_note": "n1", "notes": None, "title": None}]


def test_one_name_for_two_rules_fails(spark):
    with pytest.raises(ValueError, match="two ways"):
        T.reader_rules(rules(spark, T.rule("x", 3, "name", ANYWHERE + step("h3"))))


def test_no_pages(spark):
    assert T.extract_by_table(pages(spark, "").where("false"), rules(spark)).collect() == []


@pytest.mark.parametrize("content, html, charset, problem", [
    ("<p>ü".encode(), "<p>ü", "utf-8", None),
    (codecs.BOM_UTF8 + "ü".encode(), "ü", "utf-8", None),
    ("﻿ü".encode("utf-16-le"), "ü", "utf-16-le", None),
    (b"<meta charset=latin-1>\xfc\x80", "<meta charset=latin-1>ü€", "cp1252", None),
    (b'<META http-equiv=x content="text/html; charset=utf-8">\xfc', None, "utf-8", "byte 54"),
    (b"<meta charset='no-such'>", None, "no-such", "unknown character set"),
    (b"<meta charset=hex>zz", None, "hex", "unknown character set"),
    (b"x" * 2000 + b"<meta charset=latin-1>\xfc", None, "utf-8", "byte 2022"),
    (b"", "", "utf-8", None), (None, None, None, "no content"),
])
def test_pages_are_decoded_as_they_state(content, html, charset, problem):
    got = page_files.decode_page(content)
    assert got[:2] == (html, charset) and (got[2] is None) == (problem is None) and (problem or "") in (got[2] or "")


def test_files_become_pages_and_rejects(spark, folder):
    os.makedirs(f"{folder}/site/deep")
    for name, content in {"a.html": "ä".encode(), "deep/b.html": b"\xff\xfe\x00", "c.html": b"\xe4", "notes.txt": b"x"}.items():
        with open(f"{folder}/site/{name}", "wb") as file:
            file.write(content)
    files = page_files.page_files(spark, f"{folder}/site/*", "*.html").union(
        page_files.page_files(spark, f"{folder}/site/deep", "*.html"))
    found = page_files.decoded_files(files.distinct())
    assert rows(page_files.pages_of(found).select("html", "charset")) == [("ä", "utf-8")]
    rejected = {r.path.rpartition("/")[2]: r.problem for r in page_files.rejected_files(found).collect()}
    assert set(rejected) == {"b.html", "c.html"} and "byte 0" in rejected["c.html"]
