"""Every operator as a query over the benchmark tables, keyed by its inventory id."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.html import ANYWHERE, Rule, step
from tidemark.functions.markdown import html_to_markdown
from tidemark.functions.text import content_checksum, license_line, record_key, url_slug
from tidemark.functions.urls import canonical_url
from tidemark.operators import (
    analytics, audit, consolidate, extraction, identity, links, merge, publishing, replay, rule_table,
)
from tidemark.plans import inputs, run
from tidemark.session import shared_folder, small_files, stored
from tidemark.sources import page_files as raw_pages
from tidemark.sources import published, tables
from tidemark.sources.history_store import HistoryStore
from tidemark.streaming import ingest
from tidemark.streaming.discovery import Discovery

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2001-08-15 00:00:00"
SCRAPED = datetime(2025, 6, 19, 2, 0)
STATE_SCHEMA = (
    "id_hash string, title string, checksum string, on_website_from timestamp_ntz, "
    "on_website_to timestamp_ntz, load_id long"
)
PAGE_MARKERS = ("://",)


# --- inputs -----------------------------------------------------------------

def versions(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.order_versions(
        tables.table(spark, folder, "orders"), tables.table(spark, folder, "supplier"))


def current(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship: one row per programme with history (H8)."""
    return consolidate.consolidate(versions(spark, folder))


def published_columns(*columns: str) -> Callable[[SparkSession, str], DataFrame]:
    """The flagship's columns that an analysis uses, written once because it reads them twice."""
    return lambda spark, folder: stored(current(spark, folder).select(*columns), "current")


shares = published_columns("funding_area", "deleted", "on_website_from")
dates = published_columns("id_hash", "deleted", "on_website_from", "last_updated")


def states(spark: SparkSession, folder: str, every: str = "day") -> DataFrame:
    return inputs.user_states(tables.table(spark, folder, "events"), every)


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return tables.table(spark, folder, "pages")


def details(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.detail_pages(tables.table(spark, folder, "documents"))


def detail_records(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extract(details(spark, folder))


def _fields(*names: str) -> Query:
    """Some fields of the detail pages, from a pass that takes only what they are made of."""
    return _over(lambda s, d: extraction.extract(details(s, d), extraction.rules_for(names)), lambda df: df, "page_id", *names)


def navigation(spark: SparkSession, folder: str) -> DataFrame:
    return links.listing_pieces(pages(spark, folder), links.NAVIGATION_RULES)


def listing(spark: SparkSession, folder: str) -> DataFrame:
    return links.listing_pieces(inputs.listing_pages(tables.table(spark, folder, "part")))


def stored_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Parsed once for the operators that look at the cards twice."""
    return stored(listing(spark, folder), "listing")


def resolved(pieces: DataFrame) -> DataFrame:
    return links.resolved_links(links.links(pieces))


def _over(source: Callable, operator: Callable, *select: str) -> Query:
    """Query that applies one operator to one input; lists come out as text."""
    def query(spark: SparkSession, folder: str) -> DataFrame:
        out = operator(source(spark, folder))
        return publishing.flat_lists(out.select(*select) if select else out)
    return query


# --- sources and sinks ------------------------------------------------------

def seed_urls(spark, folder):
    """Configured URLs, and a file that repeats them with blanks and empty lines."""
    urls = pages(spark, folder).select("url")
    file = shared_folder(spark, "seeds")
    urls.select(F.concat(F.lit(" "), "url").alias("value")).union(
        urls.select(F.lit(" ").alias("value"))).write.text(file)
    return tables.seed_urls(spark, urls, file)


def page_source(spark, folder):
    return tables.table(spark, folder, "pages").select(
        "page_id", "url", F.length("html").alias("html_chars"))


def replaced_table(spark, folder):
    path = shared_folder(spark, "replace")
    for _ in range(2):
        published.replace_table(versions(spark, folder), path)
    return publishing.flat_lists(spark.read.parquet(path))


def _weekly(spark, folder, schema: str = STATE_SCHEMA):
    """A new store, the weekly snapshots of the user states, and the weeks in order."""
    store = HistoryStore(spark, shared_folder(spark, "history"), _schema(spark, schema), buckets=8)
    weekly = store.materialise(states(spark, folder, "week"), "snapshots", 0)
    return store, weekly, [r.run_at for r in weekly.select("run_at").distinct().orderBy("run_at").collect()]


def _of(weekly: DataFrame, week: datetime) -> DataFrame:
    return weekly.filter(F.col("run_at") == F.lit(week.isoformat()).cast("timestamp_ntz"))


def _merged(spark, folder, compact_every: int | None = None, mode: str = merge.COMPLETE) -> HistoryStore:
    """Weekly snapshots of the user states, merged run by run."""
    store, weekly, weeks = _weekly(spark, folder)
    for number, week in enumerate(weeks, 1):
        store.merge(_of(weekly, week), number, week, mode=mode, staged=True)
        if compact_every and number % compact_every == 0:
            store.compact()
    return store


def partial_store(spark, folder):
    """The weeks as partial runs: users who are absent stay, and only touched buckets are read."""
    return _merged(spark, folder, compact_every=2, mode=merge.PARTIAL).versions()


def replayed_into_store(spark, folder):
    """Two weeks merged run by run, all others added in one job."""
    store, weekly, weeks = _weekly(spark, folder)
    for number, week in enumerate(weeks[:2], 1):
        store.merge(_of(weekly, week), number, week, mode=merge.COMPLETE, staged=True)
    rest = list(enumerate(weeks, 1))[2:]
    if rest:
        runs = spark.createDataFrame(rest, "run long, run_at timestamp_ntz")
        store.replay(weekly.join(F.broadcast(runs), "run_at"), rest)  # one row per run
    return store.versions()


def repaired_store(spark, folder):
    """A history with returns to earlier content, whose buckets with duplicates are written anew."""
    store = _merged(spark, folder, compact_every=3)
    state = store.state()
    store.drop_duplicates(state.last + 1, state.commits[-1].run_at)
    return store.versions()


def new_watched_field(spark, folder):
    """From the third week on every second user shows a new field; only they get new versions.

    Runs have even numbers; the change of fields is a run of its own between two of them.
    """
    store, weekly, weeks = _weekly(spark, folder, STATE_SCHEMA.replace("checksum", "extra string, checksum", 1))
    both = ["extra", "title"]
    for number, week in enumerate(weeks, 1):
        watched = ["title"] if number < 3 else both
        extra = F.when((F.col("id_hash") % 2 == 0) & F.lit(number >= 3), "even")
        if number == 3:
            store.rewatch(2 * number - 1, week, both)
        snapshot = _of(weekly, week).withColumn("extra", extra.cast("string")).withColumn("checksum", content_checksum(watched))
        store.merge(snapshot, 2 * number, week, mode=merge.COMPLETE, watched=watched)
    return store.versions().drop("checksum")


def merged_store(spark, folder):
    return _merged(spark, folder).versions()


def _schema(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def stored_versions(spark, folder):
    path = shared_folder(spark, "versions")
    versions(spark, folder).write.parquet(path)
    return tables.query(
        spark, "SELECT id_hash, title, on_website_from, on_website_to FROM {v} "
               "WHERE on_website_to IS NOT NULL", v=spark.read.parquet(path))


def full_parquet(spark, folder):
    path = shared_folder(spark, "full")
    published.write_parquet(current(spark, folder), path)
    return publishing.flat_lists(spark.read.parquet(path))


def min_parquet(spark, folder):
    path = shared_folder(spark, "min")
    published.write_parquet(
        publishing.min_table(publishing.min_table(current(spark, folder))), path)
    return publishing.flat_lists(spark.read.parquet(path))


def min_csv(spark, folder):
    path = shared_folder(spark, "csv")
    table = publishing.min_table(current(spark, folder))
    published.write_csv(table, path)
    return published.read_csv(spark, path, table)


def published_read(spark, folder):
    path = shared_folder(spark, "published")
    published.write_parquet(current(spark, folder), path)
    return spark.read.parquet(path).filter("deleted").select("id_hash", "last_updated")


def history_by_sql(spark, folder):
    """Consolidation basics as SQL text over a data frame."""
    return tables.query(
        spark,
        "SELECT id_hash, count_if(on_website_to IS NULL) AS active_versions, "
        "max(on_website_to) AS last_updated FROM {v} GROUP BY id_hash",
        v=versions(spark, folder))


def page_files(spark, folder):
    """Pages as files: UTF-8, the Windows code page by its meta element, and broken UTF-8; read back."""
    path, html = shared_folder(spark, "page-files"), F.col("html")
    ascii_only = F.regexp_replace(html, "[^\\x00-\\x7F]", "")
    stated = F.encode(F.concat(F.lit('<meta charset="ISO-8859-1">ü'), ascii_only), "ISO-8859-1")
    broken = F.concat(F.encode(html, "UTF-8"), F.unhex(F.lit("FF")))
    kind = F.col("page_id") % 3
    content = F.when(kind == 0, F.encode(html, "UTF-8")).when(kind == 1, stated).otherwise(broken)
    raw_pages.write_page_files(pages(spark, folder).select("page_id", content.alias("content")), path, "page_id", "content")
    files = raw_pages.page_files(spark, path, "*.txt").select("content", raw_pages.key_of_file("page_id"))
    with small_files(spark):
        found = stored(raw_pages.decoded_files(files, ["page_id"]), "decoded")
    good = raw_pages.pages_of(found).select("page_id", "charset", F.sha1(F.rtrim("html", F.lit("\n"))).alias("found"))
    return good.union(raw_pages.rejected_files(found).select(
        "page_id", "charset", F.regexp_replace("problem", ", byte .*", "")))


# --- history ----------------------------------------------------------------

def _last_day(spark, folder):
    """The versions active after all days but the last, the last snapshot, its date and number."""
    daily = stored(states(spark, folder), "states")
    last = daily.select(F.max("run_at")).scalar()
    history = replay.replay(daily.filter(F.col("run_at") < last), "run_at")
    active = history.filter("on_website_to IS NULL").select(
        "id_hash", "title", "checksum", "on_website_from", "on_website_to", "load_id")
    snapshot = daily.filter(F.col("run_at") == last).select("id_hash", "title", "checksum")
    number = daily.select(F.count_distinct("run_at")).scalar()
    return stored(active, "active"), snapshot, last, number


def merged_complete(spark, folder):
    return merge.scd2_merge(*_last_day(spark, folder), mode=merge.COMPLETE)


def merged_partial(spark, folder):
    return merge.scd2_merge(*_last_day(spark, folder), mode=merge.PARTIAL, merge_key=["id_hash"])


def merged_scope(spark, folder):
    """Partial merge whose absent rows are retired within the states the batch shows."""
    return merge.scd2_merge(*_last_day(spark, folder), mode=merge.PARTIAL, merge_key=["title"])


def replayed(spark, folder):
    return replay.replay(stored(states(spark, folder), "states"), "run_at").select(
        "id_hash", "title", "checksum", "on_website_from", "on_website_to", "load_id")


def consolidated_from_parts(spark, folder):
    every = stored(versions(spark, folder), "versions")
    return publishing.flat_lists(consolidate.consolidate_parts(
        every.filter("on_website_to IS NULL"), every.filter("on_website_to IS NOT NULL"),
        consolidate.VERSION_COLUMNS.payload(every.columns)))


def reconciled(spark, folder):
    expected = tables.table(spark, folder, "customer").select(F.count(F.lit(1))).scalar()
    return audit.reconcile(current(spark, folder), expected)


def dead_links(spark, folder):
    """A customer's URL counts as valid if an order of theirs was large; suppliers have none."""
    status = tables.table(spark, folder, "orders").groupBy("o_custkey").agg(
        (F.max("o_totalprice") > 300000).alias("is_valid")
    ).select(
        F.concat(F.lit(inputs.DETAIL_SITE + "Foerderprogramm/c"), "o_custkey", F.lit(".html"))
        .alias("url"), "is_valid")
    return audit.dead_links(
        published_columns("id_hash", "url", "last_updated", "deleted")(spark, folder), status).select(
        "id_hash", "url", "last_updated")


# --- identity ---------------------------------------------------------------

def identities(spark, folder):
    return details(spark, folder).select(
        "page_id", "url", url_slug(F.col("url")).alias("id_url"),
        record_key(url_slug(F.col("url"))).alias("id_hash"))


def page_slugs(spark, folder):
    return pages(spark, folder).select(
        "page_id", url_slug(F.col("url"), PAGE_MARKERS).alias("id_url"))


def checksums(spark, folder):
    return tables.table(spark, folder, "documents").select(
        "doc_id", content_checksum(["text", "lang", "source"]).alias("checksum"))


def license_lines(spark, folder):
    return tables.table(spark, folder, "orders").select(
        "o_orderkey", license_line(
            F.col("o_orderpriority"), F.date_format("o_orderdate", "yyyy-MM-dd"),
            F.concat(F.lit("https://www.example.org/"), "o_orderkey")).alias("license_info"))


def checked(spark, folder):
    return run.read_records(details(spark, folder), SCRAPED)


def pages_of_links(spark, folder):
    firsts = links.first_seen(resolved(listing(spark, folder))).select("url", "page_no")
    return links.stored_pages(firsts, inputs.part_pages(tables.table(spark, folder, "part")))


def text_of_links(spark, folder):
    """The stored pages behind the addresses of every second page, with their text."""
    every = pages(spark, folder)
    firsts = every.where("page_id % 2 = 0").groupBy(canonical_url("url", "url").alias("url")).agg(
        F.min("page_id").alias("page_no"))
    found = links.stored_pages(firsts, every, per_read=500)
    return found.select("url", "page_no", "page_id", F.sha1("html").alias("html_sha1"))


def links_without_page(spark, folder):
    """Links of cards that none of the stored pages answers."""
    firsts = links.first_seen(resolved(listing(spark, folder))).select("url", "page_no")
    return links.links_without_page(firsts, inputs.part_pages(tables.table(spark, folder, "part")))


# --- streaming --------------------------------------------------------------

def streamed_pages(spark, folder):
    """Two streams into one store, each with half of the pages and its own checkpoint."""
    store = HistoryStore(spark, shared_folder(spark, "stream"))
    half = F.pmod(F.col("page_id"), F.lit(2))
    for number in range(2):
        slices = shared_folder(spark, "slices")
        (pages(spark, folder).where(half == number).repartition(2, "page_id")
         .write.parquet(slices))
        ingest.ingest(
            ingest.page_stream(spark, slices, files_per_batch=1), store,
            f"{store.root}/checkpoint-{number}", lambda n: SCRAPED + timedelta(days=n),
            rules=extraction.ARTICLE_RULES, markers=PAGE_MARKERS).awaitTermination()
    return store.active().select("id_hash", "id_url")


def _discovered(spark, folder) -> Discovery:
    """Listing pages that arrive in files, the later half of the pages first, in two starts."""
    found = Discovery(spark, shared_folder(spark, "discovery"), files_per_batch=2)
    listings = inputs.listing_pages(tables.table(spark, folder, "part")).select("page_id", "url", "html")
    arriving = f"{found.root}/arriving"
    middle = listings.agg(F.max("page_id") / 2).scalar()
    for late in (F.col("page_id") > middle, F.col("page_id") <= middle):
        listings.where(late).repartition(3, "page_id").write.mode("append").parquet(arriving)
        found.run(ingest.page_stream(spark, arriving, files_per_batch=2))
    return found


def streamed_first_seen(spark, folder):
    return _discovered(spark, folder).first_seen().drop("page_url")


def streamed_duplicates(spark, folder):
    return _discovered(spark, folder).duplicate_links().drop("page_url", "original_pos")


def streamed_totals(spark, folder):
    return _discovered(spark, folder).discovery_totals()


def compacted_store(spark, folder):
    """Weekly snapshots merged run by run with a compaction after every third run."""
    return _merged(spark, folder, compact_every=3).versions()


def rejected_records(spark, folder):
    """What a run rejects, read back from its report: records without title are issues."""
    store = HistoryStore(spark, shared_folder(spark, "reports"))
    run.load_run(details(spark, folder), store, 0, SCRAPED, mode=merge.COMPLETE)
    return run.run_report(store, "issues").select("page_id", "reason")


def counts_of_runs(spark, folder):
    """Two runs over the same pages: what each saw and wrote, from their commits."""
    store = HistoryStore(spark, shared_folder(spark, "counts"), buckets=8)
    for number in range(2):
        run.load_run(details(spark, folder), store, number, SCRAPED, mode=merge.COMPLETE)
    return run.run_counts(store)


def newest_publication(spark, folder):
    """Published after a run over half of the pages and after one over all; readers get the latter."""
    store, out = HistoryStore(spark, shared_folder(spark, "published-store"), buckets=8), shared_folder(spark, "out")
    for number, part in enumerate((details(spark, folder).where("page_id % 2 = 0"), details(spark, folder))):
        run.load_run(part, store, number, SCRAPED + timedelta(days=number), mode=merge.COMPLETE)
        run.publish_history(store, out)
    return published.read_published(spark, out).select("id_hash", "title", "description", "deleted", "on_website_from")


def unresolved_links(spark, folder):
    """Navigation targets whose host is broken on every third page."""
    broken = F.when(F.col("page_no") % 3 == 0, F.concat(F.lit("http://["), "href")).otherwise(F.col("href"))
    found = links.links(navigation(spark, folder)).withColumn("href", broken)
    return links.unresolved_links(found).select("page_no", "pos", "href")


# --- the catalogue ----------------------------------------------------------

def _recent(deleted: bool) -> Callable[[DataFrame], DataFrame]:
    return lambda df: analytics.recent_against_all(
        df, "funding_area", F.lit(AS_OF).cast("timestamp_ntz"), deleted=deleted)


# Another layout is another rule list; here the advertisement takes the title's place.
AD_RULES = (Rule("title", "div", ANYWHERE + step("div", cls="ad"), "all_text"),)


def two_layouts(spark, folder):
    """Articles and labelled detail pages in one table, told apart and read by a rule table."""
    every = pages(spark, folder).unionByName(details(spark, folder).withColumn("page_id", -1 - F.col("page_id")))
    rules = [
        rule_table.rule("detail", 1, "main", ANYWHERE + step("main"), "mark", marks=True),
        rule_table.rule("detail", 1, "heading", ANYWHERE + step("h1", cls="title"), "all_text", "title", "join"),
        rule_table.rule("detail", 1, "label", ANYWHERE + step("dt"), "text"),
        rule_table.rule("detail", 1, "entry", ANYWHERE + step("dd"), "mark"),
        rule_table.rule("detail", 1, "entry_text", ANYWHERE + step("dd"), "text", scope="entry"),
        rule_table.rule("detail", 1, "city", ANYWHERE + step("dd") + ANYWHERE + step("p", cls="locality"), "text", scope="entry"),
        rule_table.rule("article", 2, "article", step("html") + step("body") + step("article"), "mark", marks=True),
        rule_table.rule("article", 2, "headline", ANYWHERE + step("article") + step("h1"), "all_text", "title", "join"),
    ]
    labels = [("detail", "Förderart", "funding_type", "first", "entry_text"),
              ("detail", "Förderbereich", "funding_area", "first", "entry_text"),
              ("detail", "Ansprechpunkt", "city", "first", "city")]
    return rule_table.extract_by_table(
        every, spark.createDataFrame(rules, rule_table.RULES), spark.createDataFrame(labels, rule_table.LABELS))



QUERIES: dict[str, Query] = {
    "s1_seed_urls": seed_urls,
    "s2_page_source": page_source,
    "s3_replace_table": replaced_table,
    "s4_history_store": merged_store,
    "s5_read_versions": stored_versions,
    "s6_full_parquet": full_parquet,
    "s7_min_parquet": min_parquet,
    "s8_min_csv": min_csv,
    "s9_read_published": published_read,
    "s10_sql_over_history": history_by_sql,
    "l1_links": _over(navigation, links.links, "page_no", "pos", "href"),
    "l2_canonical_links": _over(lambda s, d: resolved(navigation(s, d)), lambda df: df,
                                "page_no", "pos", "url"),
    "l3_first_seen": _over(lambda s, d: resolved(navigation(s, d)), links.first_seen,
                           "url", "page_no", "pos", "occurrences"),
    "l3_first_seen_cards": _over(lambda s, d: resolved(listing(s, d)), links.first_seen,
                                 "url", "page_no", "pos", "occurrences"),
    "l4_duplicate_links": _over(
        lambda s, d: stored(resolved(listing(s, d)), "links"), links.duplicate_links,
        "url", "page_no", "pos", "original_page_no", "original_page_url"),
    "l5_listing_quality": _over(navigation, links.listing_quality, "page_no", "cards", "status"),
    "l6_incomplete_cards": _over(listing, links.incomplete_cards,
                                 "page_no", "card_no", "missing_link", "missing_text"),
    "l7_discovery_totals": _over(
        stored_listing, lambda df: links.discovery_totals(df, resolved(df)),
        "page_no", "cards", "new_urls", "total_cards", "total_urls"),
    "l8_next_pages": _over(listing, links.next_pages, "page_no", "next_href"),
    "x1_titles": _over(lambda s, d: extraction.extract(pages(s, d), extraction.ARTICLE_RULES),
                       extraction.records, "page_id", "title"),
    "x2_untitled_pages": _over(detail_records, lambda df: extraction.page_issues(df).filter(
        "reason = 'no title'"), "page_id", "reason"),
    "x3_tabs": _over(detail_records, extraction.records,
                     "page_id", "description", "more_info"),
    "x4_content_block": _over(
        lambda s, d: extraction.extract(pages(s, d), extraction.ARTICLE_RULES),
        lambda df: df, "page_id", "description"),
    "x5_labels": _over(lambda s, d: extraction.label_structure(
        extraction.detail_pieces(details(s, d))), lambda df: df.select("page_id", *[
            F.transform(c, lambda name: F.coalesce(name, F.lit("?"))).alias(c)
            for c in ("tab_fields", "entry_fields")])),
    "x6_repeated_labels": _fields("funding_type"),
    "x7_list_fields": _fields("funding_type", "funding_area", "funding_location", "eligible_applicants"),
    "x8_funding_body": _fields("funding_body"),
    "x9_further_links": _fields("further_links"),
    "x10_institution": _fields("contact_info_institution"),
    "x11_address": _fields("contact_info_street", "contact_info_city"),
    "x12_fax_phone": _fields("contact_info_fax", "contact_info_phone"),
    "x13_email_website": _fields("contact_info_email", "contact_info_website"),
    "x14_other_labels": _fields("legal_basis"),
    "x15_page_issues": _over(detail_records, extraction.page_issues, "page_id", "reason"),
    "i1_slugs": _over(page_slugs, lambda df: df),
    "i2_keys": _over(identities, lambda df: df),
    "i3_checksums": _over(checksums, lambda df: df),
    "i4_license_lines": _over(license_lines, lambda df: df),
    "i5_valid_records": _over(
        lambda s, d: identity.valid_records(checked(s, d)), lambda df: df,
        "id_hash", "id_url", "title", "description"),
    "i5_rejected_records": _over(
        lambda s, d: identity.rejected_records(checked(s, d), ["page_id"]), lambda df: df),
    "i6_repeated_keys": _over(versions, identity.repeated_keys),
    "i6_unique_or_fail": _over(published_columns("id_hash", "deleted"), identity.require_unique, "id_hash", "deleted"),
    "h1_merge_complete": merged_complete,
    "h2_merge_partial": merged_partial,
    "h2_merge_partial_by_title": merged_scope,
    "h3_replay": replayed,
    "h4_retired_aggregate": _over(versions, consolidate.retired_aggregate),
    "h4_update_log": _over(versions, consolidate.update_log),
    "h5_active_slice": _over(versions, consolidate.active_slice),
    "h6_latest_retired": _over(versions, consolidate.latest_retired),
    "h6_latest_retired_ties": _over(
        lambda s, d: stored(versions(s, d), "versions"),
        lambda df: consolidate.latest_retired(df, ties="all")),
    "h7_deleted_keys": _over(versions, consolidate.deleted_keys),
    "h8_consolidated": _over(current, lambda df: df),
    "h8_consolidated_parts": consolidated_from_parts,
    "h8_consolidated_ties": _over(
        lambda s, d: stored(versions(s, d), "versions"),
        lambda df: consolidate.consolidate(df, ties="all")),
    "h8_consolidated_no_carry": _over(
        versions, lambda df: consolidate.consolidate(df, carry_forward=False)),
    "h9_changed_and_active": _over(versions, consolidate.changed_and_active_keys),
    "h10_duplicate_versions": _over(versions, audit.duplicate_versions),
    "h11_drop_duplicates": _over(lambda s, d: stored(versions(s, d), "versions"), audit.drop_duplicate_versions),
    "h12_history_lengths": _over(versions, consolidate.history_lengths),
    "h12_changed_once": _over(versions, consolidate.changed_once),
    "h13_invariants": _over(current, audit.invariants),
    "h14_reconcile": reconciled,
    "l9_pages_of_links": pages_of_links,
    "l9_links_without_page": links_without_page,
    "l9_text_of_links": text_of_links,
    "h15_dead_links": dead_links,
    "p1_min_table": _over(current, publishing.min_table),
    "p2_markdown": _over(
        current, lambda df: publishing.with_markdown(df, ["description", "more_info"]),
        "id_hash", "description", "more_info"),
    "p3_flat_lists": _over(versions, lambda df: df, "id_hash", "on_website_from", "funding_area",
                           "funding_location", "eligible_applicants"),
    "p4_license": _over(current, publishing.with_license, "id_hash", "license_text"),
    "a1_area_counts": _over(current, lambda df: analytics.category_counts(df, "funding_area")),
    "a1_location_counts": _over(
        current, lambda df: analytics.category_counts(df, "funding_location")),
    "a1_applicant_counts": _over(
        current, lambda df: analytics.category_counts(df, "eligible_applicants")),
    "a1_type_counts": _over(current, lambda df: analytics.category_counts(df, "funding_type")),
    "a2_area_shares": _over(
        shares, lambda df: analytics.category_shares(df, "funding_area")),
    "a3_recently_deleted": _over(shares, _recent(True)),
    "a3_recently_added": _over(shares, _recent(False)),
    "a4_freshness": _over(current, analytics.freshness),
    "a5_active_programs": _over(current, analytics.active_programs, "id_hash", "title"),
    "a5_active_count": _over(current, analytics.active_count),
    "a6_profile": _over(current, analytics.profile),
    "a7_weeks": _over(current, analytics.with_week, "id_hash", "week_start_date"),
    "a8_without_first_load": _over(dates, analytics.without_first_load,
                                   "id_hash", "on_website_from"),
    "a9_weekly_added": _over(dates, analytics.weekly_added),
    "a10_weekly_deleted": _over(dates, analytics.weekly_deleted),
    "a10_weekly_deleted_by_update": _over(
        dates, lambda df: analytics.weekly_deleted(df, "last_updated")),
    "a11_weekly_series": _over(dates, analytics.weekly_series),
    "a12_series_if_history": _over(
        dates, lambda df: analytics.if_history(df, analytics.weekly_series(df))),
    "a13_recent": _over(current, lambda df: analytics.recent(
        df, F.lit(AS_OF).cast("timestamp_ntz")), "id_hash", "on_website_from", "deleted"),
    "a14_first_rows": _over(current, lambda df: analytics.first_rows(df, "id_hash"),
                            "id_hash", "title"),
    "a14_row_at": _over(current, lambda df: analytics.row_at(df, "id_hash", 999),
                        "id_hash", "funding_type"),
    "a15_distinct_titles": _over(current, lambda df: analytics.distinct_values(df, "title")),
    "a15_null_among_starts": _over(
        current, lambda df: analytics.has_null(df, "on_website_from")),
    "a16_pick_deleted": _over(current, analytics.pick_deleted, "id_hash", "deleted"),
    "t1_streamed_pages": streamed_pages,
    "l3_streamed_first_seen": streamed_first_seen,
    "l4_streamed_duplicates": streamed_duplicates,
    "l7_streamed_totals": streamed_totals,
    "s4_compacted_store": compacted_store,
    "s4_partial_store": partial_store,
    "h3_replay_into_store": replayed_into_store,
    "h11_repaired_store": repaired_store,
    "i3_new_watched_field": new_watched_field,
    "x15_issues_of_a_run": rejected_records,
    "x15_counts_of_runs": counts_of_runs,
    "s9_newest_publication": newest_publication,
    "l2_unresolved_links": unresolved_links,
    "u1_markdown_of_articles": _over(
        lambda s, d: inputs.shaped_articles(tables.table(s, d, "documents")),
        lambda df: df.select("page_id", html_to_markdown("html").alias("markdown"))),
    "u2_two_layouts": two_layouts,
    "s2_page_files": page_files,
    "u2_rules_for_ads": _over(
        lambda s, d: extraction.extract(pages(s, d), AD_RULES), lambda df: df, "page_id", "title"),
}
