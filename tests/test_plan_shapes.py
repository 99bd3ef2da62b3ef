"""What the physical plans must look like to hold at scale."""

import re

import pytest
from conftest import SMALL

from tidemark.operators import consolidate, links
from tidemark.plans import catalog
from tidemark.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("run") / "versions")
    catalog.versions(spark, SMALL).write.parquet(path)
    return spark.read.parquet(path)


def test_consolidation_is_one_scan_and_one_shuffle(stored):
    text = plan(consolidate.consolidate(stored))
    assert text.count("FileScan") == 1 and exchanges(text) == 1


def test_ties_are_one_scan_and_one_shuffle(stored):
    for frame in (consolidate.consolidate(stored, ties="all"), consolidate.latest_retired(stored, ties="all")):
        text = plan(frame)
        assert text.count("FileScan") == 1 and exchanges(text) == 1


def test_parts_shuffle_each_row_once(stored):
    text = plan(consolidate.consolidate_parts(
        stored.filter("on_website_to IS NULL"), stored.filter("on_website_to IS NOT NULL"),
        ["title", "description"]))
    assert text.count("FileScan") == 2 and exchanges(text) == 2
    assert "IsNull(on_website_to)" in text and "IsNotNull(on_website_to)" in text


@pytest.mark.parametrize("operator", [
    consolidate.retired_aggregate, consolidate.deleted_keys, consolidate.history_lengths,
    consolidate.changed_and_active_keys])
def test_narrow_aggregates_read_narrow_columns(stored, operator):
    text = plan(operator(stored))
    assert exchanges(text) == 1
    assert "ReadSchema: struct<id_hash:string,on_website_to:timestamp_ntz>" in text


def test_replay_shuffles_on_the_key_once(spark, tmp_path):
    catalog.states(spark, SMALL).write.parquet(str(tmp_path / "s"))
    from tidemark.operators import replay
    text = plan(replay.replay(spark.read.parquet(str(tmp_path / "s")), "run_at"))
    assert len(re.findall(r"Exchange hashpartitioning\(id_hash", text)) == 1


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - {
    "s1_seed_urls", "s3_replace_table", "s4_history_store", "s5_read_versions",
    "s6_full_parquet", "s7_min_parquet", "s8_min_csv", "s9_read_published",
    "t1_streamed_pages", "s4_compacted_store", "x15_issues_of_a_run", "s4_partial_store", "h3_replay_into_store",
    "h11_repaired_store", "i3_new_watched_field", "x15_counts_of_runs", "s9_newest_publication",
    "l3_streamed_first_seen", "l4_streamed_duplicates", "l7_streamed_totals"}))
def test_no_cross_joins(spark, name):
    text = plan(catalog.QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(
    n for n in catalog.QUERIES if n[0] in "lxiu" and n not in (
        "x15_issues_of_a_run", "x15_counts_of_runs", "i3_new_watched_field",
        "l3_streamed_first_seen", "l4_streamed_duplicates", "l7_streamed_totals")))
def test_page_text_is_not_shuffled(spark, name):
    """No exchange below a page query carries html or text (its attributes stand in the plan)."""
    frame = catalog.QUERIES[name](spark, SMALL)
    for line in plan(frame).splitlines():
        assert not re.search(r"Exchange .*\b(html|text)#", line)
    stages = frame._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" not in stages


def test_scan_reads_only_what_is_used(spark):
    text = plan(tables.table(spark, SMALL, "pages").select("url"))
    assert "ReadSchema: struct<url:string>" in text


@pytest.mark.parametrize("per_read", [7, 1000])
def test_page_text_is_not_shuffled_without_broadcast_limit(spark, per_read):
    """Also with a real page table whose matches Spark would not broadcast by itself."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pages = tables.table(spark, SMALL, "pages")
        firsts = pages.selectExpr("regexp_replace(url, '#.*$', '') AS url", "page_id AS page_no")
        found = links.stored_pages(firsts, pages, per_read=per_read)
        text = plan(found)
        assert "html" in text and "hashpartitioning" not in text and "SortMergeJoin" not in text
        assert text.count("FileScan") >= (2 if per_read > 50 else 8)
        assert sorted(r.page_no for r in found.select("page_no").collect()) == sorted(
            r.page_no for r in links.page_matches(firsts, pages).select("page_no").collect())
        assert found.columns == ["url", "page_no", "page_id", "html"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
