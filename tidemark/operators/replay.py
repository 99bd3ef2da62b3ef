"""Version table of many dated snapshots at once: H3."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schema import VERSION_COLUMNS, VersionColumns
from tidemark.session import stored


def run_calendar(observations: DataFrame, run: str) -> DataFrame:
    """Every run with the one before and the one after: one row per run, however many keys."""
    order = Window.orderBy(run)
    return observations.select(run).distinct().select(
        run,
        F.lag(run).over(order).alias("_run_before"),
        F.lead(run).over(order).alias("_run_after"),
        F.row_number().over(order).cast("long").alias("_run_no"),
    )


def replay(observations: DataFrame, run: str, calendar: DataFrame | None = None,
           names: VersionColumns = VERSION_COLUMNS) -> DataFrame:
    """H3: the versions that repeated complete merges of these snapshots would leave.

    ``observations`` has one row per key and run, so a key never has more rows than there
    are runs and the window per key stays small. The calendar has one row per run and is
    broadcast, so observations never meet on the few values of ``run``. A version starts where the run before
    does not show the same content, and ends at the run after its last sighting. One
    shuffle on the key; the calendar side is small and joins before it. Pass the
    ``calendar`` where the runs are known, for then empty snapshots count as well.
    """
    calendar = stored(run_calendar(observations, run), "calendar") if calendar is None else calendar
    by_key = Window.partitionBy(names.key).orderBy(run)
    before, after = F.lag(F.struct(run, names.checksum)), F.lead(F.struct(run, names.checksum))
    seen = observations.join(F.broadcast(calendar), run).withColumns({
        "_starts": ~F.equal_null(
            before.over(by_key), F.struct(F.col("_run_before"), F.col(names.checksum))),
        "_ends": ~F.equal_null(
            after.over(by_key), F.struct(F.col("_run_after"), F.col(names.checksum))),
    })
    edges = seen.filter("_starts OR _ends")
    # After a start comes its own end, unless the version lasted one run only.
    end = F.when(F.col("_ends"), F.col("_run_after")).otherwise(
        F.lead("_run_after").over(by_key))
    return (
        edges.withColumns({
            names.valid_from: F.col(run), names.valid_to: end, names.load: F.col("_run_no"),
        })
        .filter("_starts")
        .drop("_starts", "_ends", "_run_before", "_run_after", "_run_no",
              *([] if run == names.valid_from else [run]))
    )


def continue_history(active: DataFrame, observations: DataFrame, calendar: DataFrame,
                     names: VersionColumns = VERSION_COLUMNS) -> DataFrame:
    """H3 over a border: what many snapshots do to a history whose active versions are known.

    All inputs are narrow: ``active`` has key, checksum and load, ``observations`` key, checksum
    and ``_run``, ``calendar`` every ``_run`` with its time ``_at`` (one row per run, so it is
    broadcast). Returns key, load, start, end and ``_starts``: a row per version that opens, with
    its end if that is known already, and one per active version that ends. An active version
    is an observation just before the first run; the island it belongs to began earlier.
    """
    order = Window.orderBy("_run")
    runs = F.broadcast(stored(calendar.select(
        "_run", "_at", F.row_number().over(order).alias("_no"), F.lead("_at").over(order).alias("_after")), "calendar"))
    first_at = calendar.agg(F.min_by("_at", "_run")).scalar()
    seen = observations.join(runs, "_run").select(
        names.key, names.checksum, "_no", F.col("_run").alias(names.load), F.col("_at").alias(names.valid_from), "_after")
    known = active.select(
        names.key, names.checksum, F.lit(0).alias("_no"), names.load,
        F.lit(None).cast("timestamp_ntz").alias(names.valid_from), first_at.alias("_after"))
    by_key = Window.partitionBy(names.key).orderBy("_no")
    here = F.struct("_no", names.checksum)
    joined = known.unionByName(seen).withColumns({
        "_starts": ~F.equal_null(F.lag(here).over(by_key), F.struct(F.col("_no") - 1, F.col(names.checksum))),
        "_ends": ~F.equal_null(F.lead(here).over(by_key), F.struct(F.col("_no") + 1, F.col(names.checksum))),
    })
    end = F.when(F.col("_ends"), F.col("_after")).otherwise(F.lead("_after").over(by_key))
    edges = joined.where("_starts OR _ends").withColumn(names.valid_to, end).where("_starts")
    found = edges.select(names.key, names.load, names.valid_from, names.valid_to, (F.col("_no") > 0).alias("_starts"))
    return found.where(F.col("_starts") | F.col(names.valid_to).isNotNull())
