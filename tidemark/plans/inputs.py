"""Operator inputs derived from the benchmark tables, as Spark jobs that grow with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import content_checksum
from tidemark.operators.extraction import DETAIL_LINK_TITLE

VERSION_FIELDS = (
    "description", "eligible_applicants", "funding_area", "funding_body", "funding_location",
    "funding_type", "legal_basis", "more_info", "title",
)
DETAIL_SITE = "https://www.example.org/FDB/Content/DE/"


def _texts(*values: str) -> Column:
    return F.array(*map(F.lit, values))


def order_versions(orders: DataFrame, suppliers: DataFrame) -> DataFrame:
    """A version table: customers change with every order, suppliers never do.

    A customer's version ends with the next order; the last one ends nine days later if
    its order is closed ("F"), else it stays active. The next order is found per day
    first, so a customer with very many orders is not sorted in one task.
    """
    day = ["o_custkey", "o_orderdate"]
    days = orders.groupBy(*day).agg(F.max("o_orderkey").alias("_last"))
    by_customer = Window.partitionBy("o_custkey").orderBy("o_orderdate")
    days = days.withColumn("_next", F.lead("o_orderdate").over(by_customer))
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    priority = F.col("o_orderpriority")
    closed = F.when(status == "F", F.col("o_orderdate") + F.expr("INTERVAL 9 DAYS"))
    changing = orders.join(days, day).select(
        F.concat(F.lit("c"), "o_custkey").alias("id_hash"),
        priority.alias("title"),
        F.concat(F.lit("<h3>"), priority, F.lit("</h3><p>Status <strong>"), status,
                 F.lit("</strong></p>")).alias("description"),
        F.when(price > 250000, F.concat(F.lit("<ul><li>A</li><li>"), status,
                                        F.lit("</li></ul>"))).alias("more_info"),
        F.when(price > 100000, status).alias("legal_basis"),
        F.array(status).alias("funding_type"),
        F.when(price > 30000, F.split(priority, "[- ]")).alias("funding_area"),
        F.when(price > 200000, F.array(F.lit("Nord"), priority)).otherwise(_texts("Süd"))
        .alias("funding_location"),
        F.when(status == "P", _texts("Unternehmen", "Hochschule")).alias("eligible_applicants"),
        F.when(status != "O", F.concat(F.lit("Ministerium "), status)).alias("funding_body"),
        F.col("o_orderdate").alias("on_website_from"),
        F.when(F.col("o_orderkey") < F.col("_last"), F.col("o_orderdate"))
        .otherwise(F.coalesce("_next", closed)).alias("on_website_to"),
    )
    none, no_list = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    steady = suppliers.select(
        F.concat(F.lit("s"), "s_suppkey").alias("id_hash"), F.col("s_name").alias("title"),
        F.concat(F.lit("<p>"), "s_name", F.lit("</p>")).alias("description"),
        none.alias("more_info"), none.alias("legal_basis"), no_list.alias("funding_type"),
        _texts("Versorgung").alias("funding_area"), no_list.alias("funding_location"),
        no_list.alias("eligible_applicants"), none.alias("funding_body"),
        F.lit("1995-01-01").cast("timestamp_ntz").alias("on_website_from"),
        F.lit(None).cast("timestamp_ntz").alias("on_website_to"),
    )
    return changing.unionByName(steady).withColumns({
        "id_url": F.concat(F.lit("programm-"), "id_hash"),
        "url": F.concat(F.lit(DETAIL_SITE + "Foerderprogramm/"), "id_hash", F.lit(".html")),
        "checksum": content_checksum(VERSION_FIELDS),
        "load_id": F.datediff("on_website_from", F.lit("1970-01-01").cast("date")).cast("long"),
    })


def user_states(events: DataFrame, every: str = "day") -> DataFrame:
    """Dated snapshots: the last event type of each user in each period with events."""
    run = F.date_trunc(every, "ts").cast("timestamp_ntz")
    return (
        events.groupBy(F.col("user_id").cast("string").alias("id_hash"), run.alias("run_at"))
        .agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("title"))
        .withColumn("checksum", content_checksum(["title"]))
    )


def escape(c: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(plain), F.lit(entity))
    return c


def detail_pages(documents: DataFrame) -> DataFrame:
    """Detail pages in the labelled layout, one per document, with its whole text.

    English and French pages have tabs, the others one content block; Spanish ones of
    source "src0" show a title and nothing else; texts under 50 characters have no title.
    """
    lang, source, number = F.col("lang"), F.col("source"), F.col("doc_id").cast("string")

    def card(inner: Column) -> Column:
        return F.concat(
            F.lit('<dd class="card"> <p class="card--title"> <a class="" title="'
                  + DETAIL_LINK_TITLE + '" href="k.html"> <span class="link--label"> '),
            inner, F.lit(" </span> </a> </p>"))

    def entry(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"<dt> {label}: </dt> <dd> "), value, F.lit(" </dd> "))

    def only(condition: Column, value: Column) -> Column:
        return F.when(condition, value).otherwise("")

    paragraphs = F.concat(
        F.lit("<p>"), F.replace(escape(F.col("text")), F.lit("\n"), F.lit("</p><p>")),
        F.lit("</p>"))
    heading = only(F.col("n_chars") >= 50, F.concat(
        F.lit('<h1 class="title"> Programm <span>'), number, F.lit("</span> ("), source,
        F.lit(" &amp; "), lang, F.lit(") </h1>")))
    contact = F.concat(
        F.lit("<dt>Ansprechpunkt:</dt> "),
        card(F.concat(F.lit("<span>Projekthaus</span>"), source)),
        F.lit('<div class="address"> <p class="adr"> Gasse '), number,
        F.lit(' </p> <p class="locality"> 10115 Ort-'), lang,
        F.lit(' </p> </div> <p class="tel"> Tel: 030 '), number, F.lit("</p>"),
        only(lang == "de", F.concat(F.lit('<p class="fax">Fax: 0309 '), number, F.lit("</p>"))),
        F.lit('<p class="email"> <a href="mailto:'), source,
        F.lit('@example.org"><span class="link--label">Mail</span></a></p>'
              '<p class="website"><a href="https://'), source,
        F.lit('.example.org/">W</a></p></dd>'))
    listed = F.concat(
        F.lit("<dl> "),
        entry("Förderart", F.concat(F.lit("Zuschuss, "), lang)),
        entry("Förderbereich", F.concat(F.lit("Text, Bereich &amp; "), source, F.lit(", "), lang)),
        only(lang != "fr", entry("Fördergebiet", F.lit("bundesweit"))),
        entry("Förderberechtigte", F.lit("")),
        entry("Sonstiges", F.lit("x")),
        entry("Förderart", F.concat(F.lit("Darlehen, "), lang)),
        only(lang == "de", entry("Rechtsgrundlage", F.concat(F.lit("Gesetz "), source))),
        F.lit("<dt>Fördergeber:</dt> "), card(F.concat(F.lit("Ministerium "), source)),
        F.lit("</dd>"), contact,
        F.lit('<dt>Weiterführende Links:</dt> <dd> <a href="https://'), source,
        F.lit('.example.org/a?b=1&amp;c='), number, F.lit('">A</a> <a href="/FDB/'), number,
        F.lit('.html">B</a> <a name="x">C</a> </dd> </dl>'))

    def tab(name: str, body: Column) -> Column:
        return F.concat(
            F.lit(f'<h2 class="opener"> <span class="btn--label">{name}</span> </h2> '
                  '<article class="content--tab-text">'), body, F.lit("</article> "))

    tabbed = F.concat(
        F.lit('<div class="content"> <div class="rich--text"> '),
        tab("Kurzzusammenfassung", paragraphs),
        tab("Zusatzinfos ", F.concat(F.lit("<ul><li>Quelle "), source, F.lit("<li>Zeichen "),
                                     F.col("n_chars").cast("string"), F.lit("</ul>"))),
        tab("Seltsam", F.lit("<p>weg</p>")),
        only(lang == "en", tab("Rechtsgrundlage", F.concat(F.lit("<h3>Recht</h3><p>"), source,
                                                           F.lit("</p>")))),
        F.lit("</div> </div>"))
    single = F.concat(F.lit('<div class="content"> <div class="rich--text">'), paragraphs,
                      F.lit("</div> </div><aside>Service</aside>"))
    bare = (lang == "es") & (source == "src0")
    content = F.when(bare, "").when(lang.isin("en", "fr"), tabbed).otherwise(single)
    html = F.concat(
        F.lit('<!DOCTYPE html><html lang="de"><head><title>x & y</title>'
              '<script>var t="</p><dt>";</script></head><body><header><h1>Portal</h1></header>'
              '<main class="main"> <div class="jumbotron"> <div class="container"> '
              '<div class="content"> '), heading,
        F.lit(' </div> </div> <div class="container"> <div class="content"> '),
        F.when(bare, "").otherwise(listed),
        F.lit(' </div> </div> </div> <div class="container content--main"> '), content,
        F.lit(" </div> </main></body></html>"))
    path = F.when(lang == "es", F.lit("Archiv/")).otherwise(
        F.concat(F.lit("Foerderprogramm/"), source, F.lit("/")))
    url = F.concat(F.lit(DETAIL_SITE), path, F.lit("Doc-"), number, F.lit(".html"))
    return documents.select(F.col("doc_id").alias("page_id"), url.alias("url"), html.alias("html"))


def listing_pages(parts: DataFrame) -> DataFrame:
    """Listing pages of ten part cards each, by part number, with a next-page link.

    Cards of type "ECONOMY" lack the target, those of "Brand#7" the text.
    """
    href = F.when(F.col("p_type") == "ECONOMY", "").otherwise(F.concat(
        F.lit(' href="FDB/Content/DE/Foerderprogramm/'),
        F.replace("p_name", F.lit(" "), F.lit("-")), F.lit('.html"')))
    label = F.when(F.col("p_brand") == "Brand#7", "").otherwise(F.col("p_name"))
    cards = parts.select(
        F.floor(F.col("p_partkey") / 10).alias("page_id"), "p_partkey",
        F.concat(F.lit('<div class="card card--fundingprogram"> <p class="card--title"> <a'), href,
                 F.lit(">"), label, F.lit("</a> </p> </div>")).alias("card"))
    last = parts.select(F.floor(F.max("p_partkey") / 10)).scalar()
    body = F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("p_partkey", "card"))), lambda c: c.card), " ")
    following = F.when(F.col("page_id") < last, F.concat(
        F.lit("?page="), F.col("page_id") + 1)).otherwise("")
    return cards.groupBy("page_id").agg(body.alias("body")).select(
        "page_id",
        F.concat(F.lit("https://www.example.org/Suche.html?page="), "page_id").alias("url"),
        F.concat(F.lit("<html><body>"), "body", F.lit(' <a class="forward button" href="'),
                 following, F.lit('">weiter</a></body></html>')).alias("html"))


def part_pages(parts: DataFrame) -> DataFrame:
    """The stored detail pages behind those cards: one per address, none for "Brand#3"."""
    address = F.concat(F.lit("HTTPS://WWW.example.org/FDB/Content/DE/Foerderprogramm/"),
                       F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(".html#top"))
    return parts.filter("p_brand <> 'Brand#3'").groupBy(address.alias("url")).agg(
        F.min("p_partkey").alias("page_id"))


def shaped_articles(docs: DataFrame) -> DataFrame:
    """One article of known markup per document, in eight shapes, from its narrow columns."""
    shapes = [
        "concat('<h1>', lang, ' ', source, '</h1><p>', n_chars, '</p>')",
        "concat('<h3>', lang, '</h3>\n<p>', source, '<br>', n_chars, '</p>')",
        "concat('<ul><li>', lang, '</li><li>', source, '</li></ul>')",
        "concat('<ol start=\"3\"><li>', lang, '<li>', source, '</ol>')",
        "concat('<table><tr><th>', lang, '</th><th>', source, '</th></tr><tr><td>', n_chars, '</td><td>x</td></tr></table>')",
        "concat('<p>', lang, '</p><pre>', source, '\n  ', n_chars, '</pre>')",
        "concat('<p><a href=\"https://x.example/', n_chars, '\">', source, '</a> <b>', lang, '</b> <del>old</del></p>')",
        "concat('<blockquote>', lang, '<br>', source, '</blockquote>')",
    ]
    cases = " ".join(f"WHEN {i} THEN {shape}" for i, shape in enumerate(shapes))
    return docs.select(F.col("doc_id").alias("page_id"), F.expr(f"CASE doc_id % 8 {cases} END").alias("html"))
