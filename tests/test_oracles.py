"""Every query with an oracle gives the oracle's rows, on the smallest tables."""

import compare
import pytest
from conftest import SMALL

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
SLOW = {"t1_streamed_pages"}  # has its own test


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW))
def test_matches_oracle(spark, duck, name):
    names, got = compare.spark_rows(QUERIES[name](spark, SMALL))
    wanted_names, wanted = compare.oracle_rows(duck, ORACLES[name])
    assert names == wanted_names
    assert got == wanted


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    flagship = entry.entry(spark)
    assert flagship.count() > 0
    assert {"id_hash", "previous_update_dates", "last_updated", "deleted"} <= set(flagship.columns)


def test_pick_deleted_is_a_deleted_key_and_repeats(spark):
    query = QUERIES["a16_pick_deleted"]
    first, second = query(spark, SMALL).collect(), query(spark, SMALL).collect()
    assert first == second and len(first) == 1 and first[0]["deleted"]
