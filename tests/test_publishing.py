from datetime import datetime

import pytest
from conftest import rows
from pages import FALLBACK, TABBED

from tidemark.functions.markdown import _Writer
from tidemark.operators import publishing
from tidemark.plans import run
from tidemark.plans.run import load_run, publish_history, run_counts
from tidemark.schema import LICENSE_TEXT, MIN_FIELDS, RECORD_FIELDS
from tidemark.sources import published, tables
from tidemark.sources.history_store import HistoryStore


@pytest.mark.parametrize("html, markdown", [
    ("<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr></table>",
     "| A | B |\n| --- | --- |\n| 1 | 2 |"),
    ("<table><tbody><tr><td>A<td>B<tr><td>1<td>2</table>",
     "|  |  |\n| --- | --- |\n| A | B |\n| 1 | 2 |"),
    ("<p>x</p><pre>a\n  b <b>c</b></pre>y", "x\n\n```\na\n  b **c**\n```\n\ny"),
    ("<pre><code>a_b\n</code></pre>", "```\na_b\n```"),
    ("<del>old</del> and <s>older</s>", "~~old~~ and ~~older~~"),
    ("<p>a</p><p>b</p>", "a\n\nb"),
    ("<p>a<p>b", "a\n\nb"),
    ("<h1>T</h1>x", "T\n=\n\nx"),
    ("<h2>Ab</h2>", "Ab\n--"),
    ('<div class="rich--text"> <h5 class=""> Grund</h5> <p> Text<strong><br> </strong>'
     "<span>vom 1.</span></p> </div>", "##### Grund\n\nText vom 1."),
    ("<ul> <li>eins</li><li>zwei<ul><li>drei</li></ul></li></ul>",
     "* eins\n* zwei\n  + drei"),
    ("<ol><li>a</li><li>b</li></ol>", "1. a\n2. b"),
    ('<p>x <a href="https://e/" title="T">Link</a>.</p>', 'x [Link](https://e/ "T").'),
    ('<a href="https://e/">https://e/</a>', "<https://e/>"),
    ("a<br>b", "a  \nb"),
    ("<b>fett</b> und <i>schief</i>", "**fett** und *schief*"),
    ("1 &lt; 2 &amp; 3_4", "1 < 2 & 3\\_4"),
    ("<script>x</script>y", "y"),
    ("", ""),
])
def test_markdown(html, markdown):
    assert _Writer(convert_charrefs=True).to_markdown(html) == markdown


def test_markdown_keeps_nulls(spark):
    frame = spark.createDataFrame([("<p>a</p>",), (None,)], "d string")
    assert rows(publishing.with_markdown(frame, ["d"])) == [("a",), (None,)]


def test_csv_round_trip(spark, folder):
    frame = spark.createDataFrame(
        [("a", 'say "x", then\ny', ["p", "q, r"]), ("b", None, None), ("c", " s ", [])],
        "id_hash string, description string, funding_area array<string>")
    published.write_csv(frame, folder + "/csv")
    back = published.read_csv(spark, folder + "/csv", frame)
    assert rows(back, "id_hash") == [
        ("a", 'say "x", then\ny', "p, q, r"), ("b", None, None), ("c", " s ", "")]


def test_seed_urls(spark, folder):
    path = folder + "/seeds.txt"
    with open(path, "w", encoding="utf-8") as file:
        file.write("https://a\n\n  https://b \nhttps://a\n")
    got = tables.seed_urls(spark, ["https://a", "https://c"], path)
    assert rows(got, "url") == [("https://a",), ("https://b",), ("https://c",)]
    assert rows(tables.seed_urls(spark, [" x "])) == [("x",)]


def test_runs_end_to_end(spark, folder):
    """Three scheduled runs, then every published file."""
    def frame(*pages):
        return spark.createDataFrame(
            [(n, f"https://x.example/FDB/Foerderprogramm/Bund/P{n}.html", h) for n, h in pages],
            "page_id long, url string, html string")

    store = HistoryStore(spark, folder + "/store")
    first = frame((0, TABBED), (1, FALLBACK))
    assert load_run(first, store, 1, datetime(2025, 6, 19), mode="complete")
    # The same pages scraped later make no new version, although the licence date differs.
    assert load_run(first, store, 2, datetime(2025, 6, 21), mode="complete")
    assert store.versions().count() == 2
    changed = frame((0, TABBED.replace("Energie", "Wasser")))
    assert load_run(changed, store, 3, datetime(2025, 6, 23), mode="complete")
    assert not load_run(changed, store, 3, datetime(2025, 6, 23), mode="complete")

    full = {r.id_url: r for r in publish_history(store, folder + "/out").collect()}
    assert full["bund-p0"].last_updated == datetime(2025, 6, 23)
    assert not full["bund-p0"].deleted and full["bund-p1"].deleted
    assert full["bund-p0"].funding_area[-1] == "Wasser"
    assert set(RECORD_FIELDS) <= set(full["bund-p0"].asDict())
    minimal = published.read_published(spark, folder + "/out", "min_data_format.parquet")
    assert minimal.columns == list(MIN_FIELDS)
    assert dict(minimal.dtypes)["funding_area"] == "array<string>"
    newest = published.Publication.newest(spark, folder + "/out")
    back = published.read_csv(spark, newest.path("min_data_format.csv"), minimal)
    assert rows(back, "id_hash") == rows(publishing.flat_lists(minimal), "id_hash")
    text = "\n".join(r.value for r in spark.read.text(newest.path("LICENSE-DATA")).collect())
    assert text.strip() == LICENSE_TEXT.strip()

    # A failure on the way, or a repeated key, leaves the last publication as it was.
    before = sorted(map(str, published.read_published(spark, folder + "/out").collect()))
    again = changed.union(frame((5, TABBED)))
    assert load_run(again, store, 4, datetime(2025, 6, 25), mode="complete")
    for failing in ("require_unique", "publish_min"):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(run, failing, lambda *_: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                publish_history(store, folder + "/out")
        assert sorted(map(str, published.read_published(spark, folder + "/out").collect())) == before
    publish_history(store, folder + "/out")
    assert published.read_published(spark, folder + "/out").where("id_url = 'bund-p5'").count() == 1
    assert published.Publication.newest(spark, folder + "/out").name == "run=4-2"
    assert [(r.run, r.pages, r.untitled, r.rejected, r.repeated, r.opened, r.closed)
            for r in run_counts(store).orderBy("run").collect()] == [
        (1, 2, 0, 0, 0, 2, 0), (2, 2, 0, 0, 0, 0, 0), (3, 1, 0, 0, 0, 1, 2), (4, 2, 0, 0, 0, 1, 0)]


def test_nothing_published_is_an_error(spark, folder):
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, folder)
