"""Merging a snapshot into the version table: H1 and H2."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schema import VERSION_COLUMNS, VersionColumns
from tidemark.session import stored

COMPLETE, PARTIAL = "complete", "partial"


def plan_changes(active: DataFrame, snapshot: DataFrame, *, mode: str,
                 merge_key: Sequence[str] | None = None,
                 names: VersionColumns = VERSION_COLUMNS) -> DataFrame:
    """Keys whose state changes, from key and checksum alone: ``key, opens, closes``.

    Only narrow columns are shuffled here, whatever the width of the records. Both sides
    hold one row per key. "complete": a key absent from the snapshot is retired.
    "partial": only absent keys that share a ``merge_key`` value with the snapshot are;
    with the key itself as merge key, none.
    """
    if mode not in (COMPLETE, PARTIAL):
        raise ValueError(f"mode must be {COMPLETE!r} or {PARTIAL!r}")
    merge_key = list(merge_key or [names.key])
    scope = [c for c in merge_key if c != names.key]
    old = active.select(names.key, F.col(names.checksum).alias("_old"), *scope)
    new = snapshot.select(names.key, F.col(names.checksum).alias("_new"))
    how = "full_outer" if mode == COMPLETE or scope else "right_outer"
    both = old.join(new, names.key, how)
    if mode == PARTIAL and scope:
        # Stored, so that the join has one row per scope value on its right and the rows of a
        # hot value can be split; few values are broadcast.
        touched = stored(snapshot.select(*scope).distinct(), "touched").withColumn("_touched", F.lit(True))
        both = both.join(touched, scope, "left").filter(
            F.col("_new").isNotNull() | F.col("_touched"))
    return both.filter(~F.equal_null("_old", "_new")).select(
        names.key,
        F.col("_new").isNotNull().alias("opens"),
        F.col("_old").isNotNull().alias("closes"),
    )


def apply_changes(active: DataFrame, snapshot: DataFrame, changes: DataFrame, run_at: Column,
                  load_id: Column, names: VersionColumns = VERSION_COLUMNS) -> DataFrame:
    """The active rows after a run whose changed keys are known.

    Returns the rows still active and those this run retires; rows retired earlier are not
    touched. Where ``changes`` is read from a table, Spark knows its size: below its
    broadcast limit no record text is shuffled at all, above it the rows meet by key.
    """
    closing = changes.filter("closes").select(names.key, F.lit(True).alias("_closes"))
    opening = changes.filter("opens").select(names.key)
    columns = active.columns
    carried = active.join(closing, names.key, "left").withColumn(
        names.valid_to, F.when(F.col("_closes"), run_at).otherwise(F.col(names.valid_to)))
    opened = snapshot.join(opening, names.key, "left_semi").withColumns({
        names.valid_from: run_at,
        names.valid_to: F.lit(None).cast(active.schema[names.valid_to].dataType),
        names.load: load_id,
    })
    return carried.select(*columns).unionByName(opened.select(*columns))


def scd2_merge(active: DataFrame, snapshot: DataFrame, run_at: Column, load_id: Column, *,
               mode: str, merge_key: Sequence[str] | None = None,
               names: VersionColumns = VERSION_COLUMNS) -> DataFrame:
    """H1 (mode "complete") and H2 (mode "partial") in one lazy plan.

    ``sources.history_store`` runs the two halves apart, with the changes written between.
    """
    changes = plan_changes(active, snapshot, mode=mode, merge_key=merge_key, names=names)
    return apply_changes(active, snapshot, changes, run_at, load_id, names)
