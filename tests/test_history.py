"""Merges, replay and consolidation against plain Python on random histories."""

import os
import random
import re
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import audit, consolidate, merge, replay
from tidemark.sources.history_store import HistoryStore

STATE = "id_hash string, title string, checksum string"
VERSION = STATE + (", on_website_from timestamp_ntz, on_website_to timestamp_ntz, load_id long")
START = datetime(2025, 1, 1)


def day(n):
    return START + timedelta(days=n)


def random_snapshots(seed, runs=7, keys=8):
    rng = random.Random(seed)
    return [{f"k{k}": rng.choice("ABC") for k in range(keys) if rng.random() < 0.7}
            for _ in range(runs)]


def brute_force(snapshots):
    """Version list by applying the complete merge run after run."""
    done, active = [], {}
    for number, snapshot in enumerate(snapshots):
        for key, (content, since, load) in list(active.items()):
            if snapshot.get(key) != content:
                done.append((key, content, content, since, day(number), load))
                del active[key]
        for key, content in snapshot.items():
            active.setdefault(key, (content, day(number), number + 1))
    done += [(k, c, c, since, None, load) for k, (c, since, load) in active.items()]
    return sorted(done, key=repr)


def snapshot_frame(spark, snapshot):
    return spark.createDataFrame([(k, c, c) for k, c in snapshot.items()], STATE)


@pytest.mark.parametrize("seed", range(3))
def test_replay_equals_repeated_merges(spark, seed):
    snapshots = random_snapshots(seed)
    observed = spark.createDataFrame(
        [(k, c, c, day(n)) for n, s in enumerate(snapshots) for k, c in s.items()],
        STATE + ", run_at timestamp_ntz")
    columns = VERSION.replace(",", " ").split()[::2]
    got = replay.replay(observed, "run_at").select(*columns).collect()
    assert sorted(map(tuple, got), key=repr) == brute_force(snapshots)


def test_store_equals_brute_force_and_repeats_harmlessly(spark, folder):
    snapshots = random_snapshots(11, runs=4)
    store = HistoryStore(spark, folder, spark.createDataFrame([], VERSION).schema)
    for number, snapshot in enumerate(snapshots):
        assert store.merge(snapshot_frame(spark, snapshot), number + 1, day(number),
                           mode=merge.COMPLETE)
    wanted = brute_force(snapshots)
    assert sorted(map(tuple, store.versions().collect()), key=repr) == wanted
    assert not store.merge(snapshot_frame(spark, {"zz": "Z"}), 4, day(9), mode=merge.COMPLETE)
    assert sorted(map(tuple, store.versions().collect()), key=repr) == wanted
    with pytest.raises(ValueError, match="older"):
        store.merge(snapshot_frame(spark, {}), 0, day(0), mode=merge.COMPLETE)


def test_uncommitted_run_is_invisible_and_replaced(spark, folder):
    store = HistoryStore(spark, folder, spark.createDataFrame([], VERSION).schema)
    store.merge(snapshot_frame(spark, {"a": "A"}), 1, day(0), mode=merge.COMPLETE)
    # A run that died after writing rows but before its commit.
    spark.createDataFrame([("x", "X", "X", day(1), None, 2)], VERSION).write.parquet(
        f"{folder}/opened/run=2")
    assert rows(store.active().select("id_hash")) == [("a",)]
    store.merge(snapshot_frame(spark, {"a": "B"}), 2, day(1), mode=merge.COMPLETE)
    assert rows(store.active().select("id_hash", "title")) == [("a", "B")]
    assert rows(store.retired().select("title", "on_website_to")) == [("A", day(1))]


def test_compaction_changes_no_rows_and_lost_folders_are_errors(spark, folder):
    snapshots = random_snapshots(12, runs=5)
    store = HistoryStore(spark, folder, spark.createDataFrame([], VERSION).schema)
    for number, snapshot in enumerate(snapshots):
        store.merge(snapshot_frame(spark, snapshot), number + 1, day(number), mode=merge.COMPLETE)
        if number in (1, 3):
            assert store.compact() == number + 1
            assert store.compact() == number + 1
    assert sorted(map(tuple, store.versions().collect()), key=repr) == brute_force(snapshots)
    assert any("base/run=2" in path for path in store.superseded())
    os.rename(f"{folder}/base/run=4/part=active", f"{folder}/lost")
    with pytest.raises(AnalysisException):
        store.active().count()


def test_partial_run_writes_what_changes(spark, folder):
    store = HistoryStore(spark, folder, spark.createDataFrame([], VERSION).schema)
    store.merge(snapshot_frame(spark, {f"k{i}": f"{i}" for i in range(20_000)}), 0, day(0), mode=merge.COMPLETE)
    store.merge(snapshot_frame(spark, {"k3": "new"}), 1, day(1), mode=merge.PARTIAL)

    def size(name):
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{folder}/{name}") for f in fs)

    assert size("opened/run=1") + size("closed/run=1") < size("opened/run=0") / 20
    assert store.active().count() == 20_000 and store.retired().count() == 1


def test_other_watched_fields_fail_unless_meant(spark, folder):
    store = HistoryStore(spark, folder, spark.createDataFrame([], VERSION).schema)
    store.merge(snapshot_frame(spark, {"a": "A"}), 0, day(0), mode=merge.COMPLETE, watched=["title"])
    with pytest.raises(ValueError, match="watches other fields"):
        store.merge(snapshot_frame(spark, {"a": "A"}), 1, day(1), mode=merge.COMPLETE, watched=["title", "url"])
    assert store.merge(snapshot_frame(spark, {"a": "A"}), 1, day(1), mode=merge.COMPLETE,
                       watched=["title", "url"], new_watched=True)


def test_partial_merge_never_retires_absent_keys(spark):
    active = spark.createDataFrame(
        [("a", "A", "A", day(0), None, 1), ("b", "B", "B", day(0), None, 1)], VERSION)
    batch = snapshot_frame(spark, {"b": "C", "c": "D"})
    at, load = F.lit("2025-01-02").cast("timestamp_ntz"), F.lit(2).cast("long")
    got = merge.scd2_merge(active, batch, at, load, mode=merge.PARTIAL)
    assert rows(got.select("id_hash", "title", "on_website_to"), "id_hash", "title") == [
        ("a", "A", None), ("b", "B", day(1)), ("b", "C", None), ("c", "D", None)]
    same = merge.scd2_merge(active, batch.filter("false"), at, load, mode=merge.PARTIAL)
    assert rows(same, "id_hash") == rows(active, "id_hash")


def test_equal_content_of_two_keys_is_two_programs(spark):
    active = spark.createDataFrame([("a", "A", "A", day(0), None, 1)], VERSION)
    at, load = F.lit("2025-01-02").cast("timestamp_ntz"), F.lit(2).cast("long")
    got = merge.scd2_merge(active, snapshot_frame(spark, {"b": "A"}), at, load,
                           mode=merge.COMPLETE)
    assert rows(got.select("id_hash", "on_website_to"), "id_hash") == [("a", day(1)), ("b", None)]


def test_mode_is_required(spark):
    with pytest.raises(ValueError, match="mode"):
        merge.plan_changes(None, None, mode="some")


def history(spark):
    """One changed, one deleted with a tie, one untouched, one back after deletion."""
    return spark.createDataFrame([
        ("chg", "A", "1", day(0), day(2), 1), ("chg", "B", "2", day(2), day(4), 2),
        ("chg", None, "3", day(4), None, 3),
        ("del", "A", "1", day(0), day(3), 1), ("del", "B", "2", day(1), day(3), 1),
        ("new", "A", "1", day(5), None, 4),
    ], VERSION)


def test_consolidated_rows(spark):
    got = {r.id_hash: r for r in consolidate.consolidate(history(spark)).collect()}
    assert got["chg"].title == "B"           # carried forward from the latest retired version
    assert got["chg"].previous_update_dates == [day(2), day(4)]
    assert got["chg"].last_updated == day(4) and not got["chg"].deleted
    assert got["chg"].on_website_from == day(2) and got["chg"].first_seen == day(0)
    assert got["del"].deleted and got["del"].title == "B"
    assert got["del"].previous_update_dates == [day(3), day(3)]
    assert got["new"].previous_update_dates is None and got["new"].last_updated is None
    own = {r.id_hash: r for r in consolidate.consolidate(
        history(spark), carry_forward=False).collect()}
    assert own["chg"].title is None and own["del"].title == "B"


def test_parts_and_ties(spark):
    every = history(spark)
    columns = ["title", "checksum"]
    whole = rows(consolidate.consolidate(every, columns), "id_hash")
    parts = consolidate.consolidate_parts(
        every.filter("on_website_to IS NULL"), every.filter("on_website_to IS NOT NULL"), columns)
    assert rows(parts, "id_hash") == whole
    tied = consolidate.consolidate(every, columns, ties="all")
    assert [r.title for r in tied.filter("id_hash = 'del'").orderBy("title").collect()] == [
        "A", "B"]
    with pytest.raises(Exception, match="id_hash repeats: del"):
        consolidate.consolidate(every, columns, ties="fail").collect()


def test_invariants_hold_and_are_reported(spark):
    good = consolidate.consolidate(history(spark)).withColumn("id_url", F.col("id_hash"))
    assert {r.violations for r in audit.invariants(good).collect()} == {0}
    bad = good.withColumn("on_website_from", F.lit(None).cast("timestamp_ntz"))
    assert {r.rule: r.violations for r in audit.invariants(bad).collect()}[
        "deleted row without start date"] == 1


def test_duplicate_cleanup_keeps_newest_load(spark):
    frame = spark.createDataFrame([
        ("a", "T", "1", day(0), day(1), 1), ("a", "T", "1", day(2), None, 3),
        ("a", "U", "2", day(1), day(2), 2), ("b", "T", "1", day(0), None, 1)], VERSION)
    kept = audit.drop_duplicate_versions(frame)
    assert rows(kept.select("id_hash", "checksum", "load_id"), "id_hash", "checksum") == [
        ("a", "1", 3), ("a", "2", 2), ("b", "1", 1)]


# --- the store by key buckets ---------------------------------------------------------------

def small_store(spark, folder, buckets=4, schema=VERSION):
    return HistoryStore(spark, folder, spark.createDataFrame([], schema).schema, buckets=buckets)


def observed(spark, snapshots):
    return spark.createDataFrame([(n, k, c, c) for n, s in snapshots for k, c in s.items()], "run long, " + STATE)


def content(store):
    return sorted(map(tuple, store.versions().collect()), key=repr)


def test_partial_run_reads_the_buckets_of_its_keys_only(spark, folder):
    store = small_store(spark, folder, buckets=16)
    store.merge(snapshot_frame(spark, {f"k{i}": "A" for i in range(300)}), 0, day(0), mode=merge.COMPLETE)
    store.compact()
    store.merge(snapshot_frame(spark, {"k3": "B", "k4": "B"}), 1, day(1), mode=merge.PARTIAL)
    bucket = {r.bucket for r in snapshot_frame(spark, {"k7": ""}).select(store.bucket_of().alias("bucket")).collect()}
    part = store._active(store.state(), bucket)
    text = part._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ = ", text)
    # A one-key run reads one bucket: rows of all others could be lost without it noticing.
    lost = next(d for d in os.listdir(f"{folder}/base/run=0/part=active") if d.startswith("bucket=")
                and d != f"bucket={min(bucket)}")
    os.rename(f"{folder}/base/run=0/part=active/{lost}", f"{folder}/lost")
    store.merge(snapshot_frame(spark, {"k7": "C"}), 2, day(2), mode=merge.PARTIAL)
    assert rows(store.active().where("id_hash = 'k7'").select("title")) == [("C",)]


def test_layout_of_a_store_is_that_of_its_first_run(spark, folder):
    small_store(spark, folder, buckets=4).merge(snapshot_frame(spark, {"a": "A"}), 0, day(0), mode=merge.COMPLETE)
    again = small_store(spark, folder, buckets=9)
    again.merge(snapshot_frame(spark, {"a": "B"}), 1, day(1), mode=merge.PARTIAL)
    assert again.buckets == 4 and rows(again.retired().select("title")) == [("A",)]


@pytest.mark.parametrize("seed,border,compacted", [(1, 3, True), (2, 1, False), (3, 0, False), (4, 5, True)])
def test_replay_into_a_store_equals_run_by_run_merges(spark, folder, seed, border, compacted):
    snapshots = random_snapshots(seed)
    snapshots[4] = {}  # a run that shows nothing
    store = small_store(spark, folder)
    for number in range(border):
        store.merge(snapshot_frame(spark, snapshots[number]), number + 1, day(number), mode=merge.COMPLETE)
    if compacted:
        store.compact()
    rest = [(n + 1, s) for n, s in enumerate(snapshots)][border:]
    calendar = [(n, day(n - 1)) for n, _ in rest]
    assert store.replay(observed(spark, rest), calendar)
    assert content(store) == brute_force(snapshots)
    assert not store.replay(observed(spark, rest), calendar)
    # Later runs go on from there.
    more = {"k0": "Z", "k1": snapshots[-1].get("k1", "Y")}
    store.merge(snapshot_frame(spark, more), 8, day(7), mode=merge.COMPLETE)
    assert content(store) == brute_force([*snapshots, more])
    with pytest.raises(ValueError, match="not after|older"):
        store.replay(observed(spark, [(2, more)]), [(2, day(9)), (9, day(9))])


def test_repair_rewrites_only_buckets_with_duplicates(spark, folder):
    store = small_store(spark, folder, buckets=8)
    snapshots = [{f"k{i}": "A" for i in range(40)}, {f"k{i}": "B" if i == 5 else "A" for i in range(40)}]
    snapshots.append(snapshots[0])  # k5 goes A, B, A: the first A is a planted duplicate
    for number, snapshot in enumerate(snapshots):
        store.merge(snapshot_frame(spark, snapshot), number + 1, day(number), mode=merge.COMPLETE)
        if number == 1:
            store.compact()
    wanted = sorted(map(tuple, audit.drop_duplicate_versions(store.versions()).collect()), key=repr)
    assert len(wanted) == store.versions().count() - 1
    changed = store.drop_duplicates(4, day(3))
    assert len(changed) == 1 and content(store) == wanted
    assert {d for d in os.listdir(f"{folder}/base/run=4-part/part=active") if d[0] == "b"} == {f"bucket={min(changed)}"}
    assert store.drop_duplicates(5, day(4)) == set() and store.drop_duplicates(4, day(4)) == set()
    assert content(store) == wanted and store.runs() == [1, 2, 3, 4]
    # The history goes on, over a base of some buckets and over whole ones.
    for number in (5, 6):
        store.merge(snapshot_frame(spark, {"k5": f"C{number}", "k6": "A"}), number, day(number), mode=merge.PARTIAL)
        if number == 5:
            assert store.compact() == 5
    assert rows(store.active().where("id_hash = 'k5'").select("title", "load_id")) == [("C6", 6)]
    assert store.active().count() == 40 and store.versions().count() == len(wanted) + 2


def test_repair_without_its_commit_changes_nothing(spark, folder):
    store = small_store(spark, folder)
    for number, title in enumerate("ABA"):
        store.merge(snapshot_frame(spark, {"a": title}), number, day(number), mode=merge.COMPLETE)
    before = content(store)
    store.drop_duplicates(3, day(3))
    os.rename(f"{folder}/commits/run=3", f"{folder}/lost")  # it died before its commit
    assert content(store) == before
    assert store.drop_duplicates(3, day(3)) and len(content(store)) == 2


def test_new_watched_field_opens_only_what_shows_it(spark, folder):
    state = "id_hash string, title string, extra string, checksum string"
    wide = state + ", on_website_from timestamp_ntz, on_website_to timestamp_ntz, load_id long"

    def snapshot(values, fields):
        frame = spark.createDataFrame([(k, t, x) for k, (t, x) in values.items()], "id_hash string, title string, extra string")
        return frame.withColumn("checksum", text.content_checksum(fields))

    values = {f"k{i}": ("A", None) for i in range(6)}
    small_store(spark, folder).merge(snapshot(values, ["title"]).drop("extra"), 0, day(0), mode=merge.COMPLETE, watched=["title"])
    store = small_store(spark, folder, schema=wide)
    both = ["extra", "title"]
    assert store.rewatch(1, day(1), both) and not store.rewatch(1, day(1), both)
    values = {k: (t, "new" if int(k[1]) % 2 else None) for k, (t, _) in values.items()}
    store.merge(snapshot(values, both), 2, day(2), mode=merge.COMPLETE, watched=both)
    assert rows(store.retired().select("id_hash", "load_id"), "id_hash") == [("k1", 0), ("k3", 0), ("k5", 0)]
    assert rows(store.active().select("id_hash", "extra", "load_id"), "id_hash") == [
        (f"k{i}", "new" if i % 2 else None, 2 if i % 2 else 0) for i in range(6)]
    with pytest.raises(ValueError, match="watches other fields"):
        store.merge(snapshot(values, ["title"]), 3, day(3), mode=merge.COMPLETE, watched=["title"])


def test_a_late_batch_reads_no_more_folders_than_an_early_one(spark, folder):
    store, read = small_store(spark, folder, buckets=2), []
    for number in range(24):
        state = store.state()
        if store.compaction_due(state):
            store.compact()
            state = store.state()
        since = min(state.since(b) for b in range(2))
        read.append((sum(row.run > since for row in state.commits), len(store.commits().inputFiles())))
        store.merge(snapshot_frame(spark, {f"k{number % 3}": f"{number}"}), number, day(number), mode=merge.PARTIAL, state=state)
    assert max(n for n, _ in read) <= 10 and max(files for _, files in read) <= 12
    assert store.versions().count() == 24 and store.active().count() == 3
