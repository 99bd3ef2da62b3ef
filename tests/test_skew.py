"""Hot keys: the special ways round them give the plain results."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.skew import attach_per_key, running_totals
from tidemark.operators import links


@pytest.fixture(scope="module")
def hot(spark):
    """A third of 6,000 rows share one key."""
    rng = random.Random(5)
    keys = ["hot" if rng.random() < 1 / 3 else f"k{rng.randrange(500)}" for _ in range(6000)]
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, n long")


def test_attach_per_key_is_an_inner_join(spark, hot):
    per_key = hot.groupBy("key").agg(F.count("*").alias("rows"), F.min("n").alias("first"))
    per_key = per_key.filter("key <> 'k3'")
    got = attach_per_key(hot, per_key, ["key"], "rows", salt="n", rows_per_task=100)
    want = hot.join(per_key, "key")
    assert sorted(got.select(*want.columns).collect()) == sorted(want.collect())


def test_no_reducer_takes_more_than_its_share(spark):
    """Half of all rows under one key: salts follow the count."""
    rows = spark.range(8000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("key"), F.col("id").alias("n"))
    per_key = rows.groupBy("key").agg(F.count("*").alias("rows"))
    joined = attach_per_key(rows, per_key, ["key"], "rows", salt="n", rows_per_task=100)
    assert joined.count() == 8000
    salts = rows.filter("key = 'hot'").groupBy(F.pmod(F.xxhash64("n"), F.lit(40))).count()
    assert salts.agg(F.max("count")).first()[0] < 200


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_running_totals(spark, parts):
    rng = random.Random(parts)
    values = sorted((rng.getrandbits(63), (i * 37) % 11) for i in range(100))
    frame = spark.createDataFrame(values, "page long, v long").repartition(5)
    got = running_totals(frame, "page", {"total": "v"}, parts=parts).orderBy("page").collect()
    total = 0
    for row, (page, value) in zip(got, values):
        total += value
        assert (row.page, row.v, row.total) == (page, value, total)
    assert len(got) == len(values)


def test_duplicates_of_a_hot_url(spark):
    rng = random.Random(9)
    found = [(p, i, f"https://x/{p}", "hot" if rng.random() < .4 else f"u{rng.randrange(90)}")
             for p in range(60) for i in range(10)]
    frame = spark.createDataFrame(found, "page_no long, pos int, page_url string, url string")
    first = {}
    want = []
    for page, pos, page_url, url in sorted(found):
        if url in first:
            want.append((url, page, page_url, pos, *first[url]))
        else:
            first[url] = (page, page_url)
    assert sorted(map(tuple, links.duplicate_links(frame).collect())) == sorted(want)
