from datetime import timedelta

from conftest import SMALL, rows

from tidemark.operators import extraction, links
from tidemark.plans import catalog
from tidemark.plans.run import read_records, split
from tidemark.sources.history_store import HistoryStore
from tidemark.streaming import ingest
from tidemark.streaming.discovery import Discovery


def start(spark, folder, slices, store, **options):
    return ingest.ingest(
        ingest.page_stream(spark, slices, files_per_batch=1), store, folder + "/checkpoint",
        lambda n: catalog.SCRAPED + timedelta(days=n), rules=extraction.ARTICLE_RULES,
        markers=catalog.PAGE_MARKERS, **options)


def test_stream_ends_in_the_batch_result_and_restarts_quietly(spark, folder):
    pages = catalog.pages(spark, SMALL)
    pages.repartition(2, "page_id").write.parquet(folder + "/slices")
    store = HistoryStore(spark, folder + "/store")
    start(spark, folder, folder + "/slices", store).awaitTermination()
    batch = split(read_records(pages, catalog.SCRAPED, rules=extraction.ARTICLE_RULES,
                               markers=catalog.PAGE_MARKERS)).records
    wanted = rows(batch.select("id_hash"), "id_hash")
    assert rows(store.active().select("id_hash"), "id_hash") == wanted
    runs = store.runs()
    # No new files, new query on the same checkpoint: nothing happens.
    start(spark, folder, folder + "/slices", store).awaitTermination()
    assert store.runs() == runs
    # A lost checkpoint delivers everything again: merged anew, without a new version.
    start(spark, folder + "/again", folder + "/slices", store).awaitTermination()
    assert rows(store.active().select("id_hash"), "id_hash") == wanted
    assert store.retired().count() == 0


def test_second_stream_is_not_taken_for_the_first(spark, folder):
    pages = catalog.pages(spark, SMALL)
    store = HistoryStore(spark, folder + "/store")
    for number in range(2):
        pages.where(f"page_id % 2 = {number}").coalesce(1).write.parquet(f"{folder}/slices{number}")
        start(spark, f"{folder}/stream{number}", f"{folder}/slices{number}", store).awaitTermination()
    batch = split(read_records(pages, catalog.SCRAPED, rules=extraction.ARTICLE_RULES,
                               markers=catalog.PAGE_MARKERS)).records
    assert rows(store.active().select("id_hash"), "id_hash") == rows(batch.select("id_hash"), "id_hash")


def test_replayed_batch_changes_nothing(spark, folder):
    catalog.pages(spark, SMALL).coalesce(1).write.parquet(folder + "/slices")
    store = HistoryStore(spark, folder + "/store")
    start(spark, folder, folder + "/slices", store).awaitTermination()
    commit = store.commits().first()
    assert store.find(commit.source, commit.batch) == commit.run
    assert store.find("another", commit.batch) is None


CARDS = ('<div class="card--fundingprogram"><p class="card--title"><a href="{}">t</a></p></div>')


def test_discovery_equals_the_batch_operators_over_any_arrival(spark, folder):
    """Pages out of order, a link on every page, a stop and a start, and a start without news."""
    def page(n):
        hrefs = ["/hot", f"/{n % 4}", f"/{n}", "http://[broken", "/hot"]
        return n, f"https://a.example/{n}", "".join(CARDS.format(h) for h in hrefs)

    pages = spark.createDataFrame([page(n) for n in range(12)], ingest.PAGE_SCHEMA)
    found = Discovery(spark, folder + "/found", files_per_batch=1)
    assert found.first_seen().collect() == [] and found.discovery_totals().collect() == []
    for numbers in ((7, 3, 9), (0, 11, 5), (), (1, 2, 4, 6, 8, 10)):
        for n in numbers:
            pages.where(f"page_id = {n}").coalesce(1).write.mode("append").parquet(folder + "/pages")
        if numbers:
            found.run(ingest.page_stream(spark, folder + "/pages", files_per_batch=1))
        found.run(ingest.page_stream(spark, folder + "/pages", files_per_batch=1))
        so_far = spark.read.schema(ingest.PAGE_SCHEMA).parquet(folder + "/pages")
        pieces = links.listing_pieces(so_far)
        resolved = links.resolved_links(links.links(pieces))
        assert rows(found.first_seen(), "url") == rows(links.first_seen(resolved), "url")
        wanted = links.duplicate_links(resolved)
        order = "page_no", "pos"
        assert rows(found.duplicate_links().select(*wanted.columns), *order) == rows(wanted, *order)
        assert rows(found.discovery_totals(), "page_no") == rows(links.discovery_totals(pieces, resolved), "page_no")
        assert found.unresolved().count() == so_far.count()


def test_a_repeated_batch_of_the_state_changes_nothing(spark, folder):
    pages = spark.createDataFrame([(n, f"https://a.example/{n}", CARDS.format("/x")) for n in range(3)], ingest.PAGE_SCHEMA)
    pages.write.parquet(folder + "/pages")
    found = Discovery(spark, folder + "/found")
    found.run(ingest.page_stream(spark, folder + "/pages"))
    before = rows(found.first_seen())
    batch = spark.read.parquet(folder + "/found/firsts/batch=0")
    batch.write.parquet(folder + "/found/firsts/batch=9")  # delivered again, and later
    assert rows(found.first_seen()) == before == [("https://a.example/x", 0, 0, "https://a.example/0", 3)]
