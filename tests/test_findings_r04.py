"""One test or more per finding of the fourth round, on rows of their own; those of op5 are in ``llm``."""

import hashlib
import os
from datetime import datetime

import pyarrow.parquet as pq
from conftest import rows
from pages import FALLBACK

from tidemark.operators.consolidate import consolidate_parts
from tidemark.plans import catalog
from tidemark.plans.run import load_run, publish_history, run_report
from tidemark.sources import page_files
from tidemark.sources.history_store import HistoryStore


def sha(text):
    return hashlib.sha1(text.encode()).hexdigest()


def test_page_files_need_no_folder_each(spark, folder, monkeypatch):
    """a file per page, but folders per task that writes; negative ids, too."""
    spark.range(-100, 900).selectExpr("id AS page_id", "concat('<p>ä', id) AS html").write.parquet(f"{folder}/pages.parquet")
    monkeypatch.setattr(catalog, "shared_folder", lambda spark, purpose: f"{folder}/{purpose}")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    got = rows(catalog.QUERIES["s2_page_files"](spark, folder), "page_id")
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    assert got == [
        (i, "utf-8", sha(f"<p>ä{i}")) if i % 3 == 0
        else (i, "cp1252", sha(f'<meta charset="ISO-8859-1">ü<p>{i}')) if i >= 0 and i % 3 == 1
        else (i, "utf-8", "not text in its character set") for i in range(-100, 900)]
    found = [(where, name) for where, _, names in os.walk(f"{folder}/page-files") for name in names if name.endswith(".txt")]
    assert len(found) == 1000 and len({where for where, _ in found}) <= 64


def test_page_files_of_repeated_and_missing_keys(spark, folder):
    """rows of one key are one file, also those without key, as before; a second writing changes nothing."""
    pages = spark.createDataFrame(
        [(7, b"a"), (7, b"a"), (None, b"\xff"), (None, None), (8, None), (9, b"")], "page_id int, content binary").repartition(3)
    for _ in range(2):
        page_files.write_page_files(pages, f"file:{folder}/site", "page_id", "content")
    files = page_files.page_files(spark, f"{folder}/site", "*.txt").select("content", page_files.key_of_file("page_id"))
    got = {r.page_id: bytes(r.content) for r in files.collect()}
    assert sorted(got.pop(None).splitlines()) == [b"", b"\xff"]
    assert got == {7: b"a\na\n", 8: b"\n", 9: b"\n"}


def test_no_page_files(spark, folder):
    """an empty table gives an empty folder."""
    page_files.write_page_files(spark.createDataFrame([], "page_id long, content binary"), f"{folder}/site", "page_id", "content")
    assert page_files.page_files(spark, f"{folder}/site", "*.txt").count() == 0


def test_files_are_decoded_in_batches(spark, folder):
    """small files share a batch, none is lost, and each keeps its own columns."""
    page_files.write_page_files(spark.range(300).selectExpr(
        "id", "encode(concat(repeat('x', 20000), id, if(id % 7 = 0, '\u0001', '')), 'UTF-8') AS content"), f"{folder}/site", "id", "content")
    files = page_files.page_files(spark, f"{folder}/site").select("content", page_files.key_of_file("id")).coalesce(1)
    found = page_files.decoded_files(files, ["id"])
    assert rows(found.selectExpr("id", "replace(rtrim('\n', html), 'x', '')", "length(html)"), "id") == [
        (i, f"{i}" + "\x01" * (i % 7 == 0), 20001 + len(str(i)) + (i % 7 == 0)) for i in range(300)]


def codecs(folder):
    names = [f"{where}/{name}" for where, _, found in os.walk(folder) for name in found if name.endswith(".parquet")]
    return {pq.ParquetFile(name).metadata.row_group(0).column(0).compression for name in names if pq.ParquetFile(name).metadata.num_rows}


def test_a_run_keeps_on_disk_what_readers_need(spark, folder):
    """what a run wrote on its way goes with its commit; versions and publications are packed closer."""
    pages = spark.createDataFrame(
        [(n, f"https://x.example/FDB/Foerderprogramm/Bund/P{n}.html", FALLBACK.replace("Programm", f"Programm {n}")) for n in range(6)],
        "page_id long, url string, html string")
    store = HistoryStore(spark, folder + "/store", buckets=2)
    for number, part in enumerate((pages.where("page_id < 4"), pages, pages.where("page_id > 0")), 1):
        assert load_run(part, store, number, datetime(2025, 6, 18 + number), mode="complete")
        left = {name: os.listdir(f"{folder}/store/{name}") for name in ("extracted", "changes") if os.path.isdir(f"{folder}/store/{name}")}
        assert not any(name.startswith("run=") for names in left.values() for name in names)
    assert {r.id_url: r.deleted for r in publish_history(store, folder + "/out").collect()} == {f"bund-p{n}": n == 0 for n in range(6)}
    assert store.versions().count() == 6 and run_report(store, "issues").where("run = 2").count() == 0
    assert codecs(f"{folder}/store/opened") == codecs(f"{folder}/out/publications") == {"ZSTD"}


def test_nothing_closed_is_published_without_a_shuffle(spark, folder):
    """the texts of active versions stay where they are while no version has been closed."""
    schema = "id_hash string, title string, checksum string, on_website_from timestamp_ntz, on_website_to timestamp_ntz, load_id long"
    store = HistoryStore(spark, folder + "/store", spark.createDataFrame([], schema).schema, buckets=2)
    for number, last in ((1, 3), (2, 5), (3, 4)):
        records = spark.createDataFrame([(f"k{i}", f"t{i}", f"c{i}") for i in range(last)], "id_hash string, title string, checksum string")
        store.merge(records, number, datetime(2025, 6, 18 + number), mode="complete")
        full = consolidate_parts(store.active(), store.retired(), ["title"])
        plan = full._jdf.queryExecution().executedPlan().toString()
        assert ("Exchange" in plan) == (number == 3)
        assert rows(full.select("id_hash", "title", "deleted"), "id_hash") == [
            (f"k{i}", f"t{i}", number == 3 and i == 4) for i in range(max(last, 5 if number == 3 else 0))]
    assert not any(name.startswith("run=") for kind in ("staged", "changes") for name in os.listdir(f"{folder}/store/{kind}"))
