"""One test or more per finding of the third round, on rows of their own."""

import hashlib
import os
import random

import compare
import duckdb
import pyarrow as pa
from conftest import rows

from tidemark.functions import html
from tidemark.operators import links
from tidemark.plans import catalog, oracles


def test_links_without_page_meet_every_stored_page(spark, folder):
    """pages with odd ids answer their links too; only what no page answers is left."""
    spark.createDataFrame(
        [(1, "red car", "Brand#1", "STANDARD"), (2, "blue car", "Brand#1", "STANDARD"), (3, "old car", "Brand#3", "STANDARD"),
         (4, "red car", "Brand#3", "STANDARD"), (5, "no link", "Brand#1", "ECONOMY")],
        "p_partkey long, p_name string, p_brand string, p_type string").coalesce(1).write.parquet(f"{folder}/part.parquet")
    got = catalog.QUERIES["l9_links_without_page"](spark, folder)
    site = "https://www.example.org/FDB/Content/DE/Foerderprogramm/"
    assert rows(got.select("url", "page_no")) == [(site + "old-car.html", 0)]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{folder}/part.parquet/*.parquet'")
    assert compare.oracle_rows(con, oracles.ORACLES["l9_links_without_page"]) == compare.spark_rows(got)


def test_a_batch_is_read_in_shares_of_bounded_text():
    """A worker holds the pieces of about a megabyte of markup, not of a whole batch."""
    htmls = [f'<h1 class="title">{i}</h1><p>{"ä" * 5000}</p>' for i in range(600)]
    htmls[7], htmls[8] = None, f"<h1 class='title'>{'x' * 3_000_000}</h1>"
    batch = pa.RecordBatch.from_pydict({"page_id": range(600), "html": htmls})
    rules = (html.Rule("title", "h1", html.ANYWHERE + html.step("h1"), "all_text"),)
    found = list(html.read_batches([batch, batch.slice(0, 0)], rules, ["page_id"]))
    sizes = [sum(len((htmls[i] or "").encode()) for i in part["page_id"].to_pylist()) for part in found]
    assert all(size <= html.TEXT_AT_ONCE or part.num_rows == 1 for size, part in zip(sizes, found)) and len(found) > 6
    assert [i for part in found for i in part["page_id"].to_pylist()] == list(range(600))
    titles = [[p["value"] for p in row] for part in found for row in part["title"].to_pylist()]
    assert titles == [[] if h is None else ["x" * 3_000_000] if i == 8 else [str(i)] for i, h in enumerate(htmls)]


def test_reads_of_page_text_end_at_a_number(spark):
    """every read costs the driver a broadcast table, so small reads are joined once there are many."""
    pages = spark.range(300).selectExpr("id AS page_id", "'https://x.example/' || id AS url", "'t' || id AS html")
    firsts = pages.selectExpr("url", "page_id AS page_no")
    found = links.stored_pages(firsts, pages, per_read=1)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert 8 < text.count("BroadcastExchange") <= 2 * links.READS
    assert rows(found.select("page_no", "page_id", "html"), "page_no") == [(i, i, f"t{i}") for i in range(300)]


def test_a_tag_as_written_is_taken_apart_once(monkeypatch):
    """pages of one layout repeat their tags, so their attributes and rules are found once per worker."""
    taken = []
    read = html._attributes
    monkeypatch.setattr(html, "_attributes", lambda text: taken.append(text) or read(text))
    page = '<main class="a"><div class="b" title="t"><p class="c">x<p class="c">y</div><img class="c"/><br class="c">z</main>'
    rules = [html.Rule("all", "p", html.ANYWHERE + html.step("p", cls="c", nth=2), "text"),
             html.Rule("main", "main", html.step("main", cls="a"), "all_text")]
    found = html._Reader(rules).read_batch([page] * 50)
    assert [[p["value"] for p in row] for row in found[0].to_pylist()] == [["y"]] * 50
    assert [[p["value"] for p in row] for row in found[1].to_pylist()] == [["x", "y", "z"]] * 50
    assert len(taken) <= 6


def test_page_files_are_written_by_several_tasks(spark, folder, monkeypatch):
    """also where the pages come in one piece."""
    texts = ["".join(random.Random(i).choices("abcdefghijklmnopqrstuvwxyz", k=1_500_000)) for i in range(9)]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "page_id long, html string").coalesce(1).write.parquet(
        f"{folder}/pages.parquet")
    monkeypatch.setattr(catalog, "shared_folder", lambda spark, purpose: f"{folder}/{purpose}")
    got = catalog.QUERIES["s2_page_files"](spark, folder)
    wanted = [(i, "utf-8" if i % 3 == 0 else "cp1252", hashlib.sha1(
        (t if i % 3 == 0 else f'<meta charset="ISO-8859-1">ü{t}').encode()).hexdigest()) for i, t in enumerate(texts) if i % 3 < 2]
    assert [r for r in rows(got, "page_id") if r[0] % 3 < 2] == wanted
    files = [name for _, _, names in os.walk(f"{folder}/page-files") for name in names if name.endswith(".txt")]
    assert len(files) == 9 and len({name[:10] for name in files}) > 1
