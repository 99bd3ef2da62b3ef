"""From versions to one row per key: H4 to H9 and H12."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.identity import require_unique
from tidemark.schema import VERSION_COLUMNS, VersionColumns


def _retired(names: VersionColumns) -> Column:
    return F.col(names.valid_to).isNotNull()


def _update_dates(names: VersionColumns) -> Column:
    """End dates of a key, sorted; active rows add nothing.

    A run retires at most one version of a key, so the list is never longer than the
    number of runs. ``update_log`` has the same facts as rows.
    """
    return F.sort_array(F.collect_list(names.valid_to))


def retired_aggregate(versions: DataFrame, names: VersionColumns = VERSION_COLUMNS) -> DataFrame:
    """H4: per key its end dates in order, and the latest."""
    return versions.filter(_retired(names)).groupBy(names.key).agg(
        _update_dates(names).alias("previous_update_dates"),
        F.max(names.valid_to).alias("last_updated"),
    )


def update_log(versions: DataFrame, names: VersionColumns = VERSION_COLUMNS) -> DataFrame:
    """H4 in rows: key, end date and how many versions ended then. No list, no width limit."""
    return versions.filter(_retired(names)).groupBy(
        names.key, F.col(names.valid_to).alias("updated_at")
    ).agg(F.count(F.lit(1)).alias("versions"))


def active_slice(versions: DataFrame, columns: Sequence[str] | None = None,
                 names: VersionColumns = VERSION_COLUMNS) -> DataFrame:
    """H5: versions that are still valid."""
    columns = list(columns or names.payload(versions.columns))
    return versions.filter(~_retired(names)).select(names.key, *columns, names.valid_from)


def latest_retired(versions: DataFrame, columns: Sequence[str] | None = None,
                   ties: str = "one", names: VersionColumns = VERSION_COLUMNS) -> DataFrame:
    """H6: the latest retired version of each key with its end dates.

    ties: "one" keeps the version with the greatest (start, checksum) among those that
    share the end date; "all" keeps each; "fail" stops the job on a tie.
    """
    columns = list(columns or names.payload(versions.columns))
    old = versions.filter(_retired(names))
    if ties == "one":
        rest = [*columns, names.valid_from]
        return old.groupBy(names.key).agg(
            F.max_by(F.struct(*rest), _order(names)).alias("_old"),
            _update_dates(names).alias("previous_update_dates"),
            F.max(names.valid_to).alias("last_updated"),
        ).select(names.key, "previous_update_dates", "last_updated",
                 *[F.col(f"_old.{c}").alias(c) for c in rest])
    every = _tied(versions, columns, names).where("last_updated IS NOT NULL").select(
        names.key, F.col("_dates").alias("previous_update_dates"), "last_updated", F.inline("_old"))
    return require_unique(every, names.key) if ties == "fail" else every


def _tied(versions: DataFrame, columns: Sequence[str], names: VersionColumns) -> DataFrame:
    """Per key its active versions and its latest retired ones, ties included, from one shuffle.

    Rows are dealt by key once; both aggregates keep that. The first gathers the versions of
    a key that end at the same time, the second keeps the latest of those lists, so the other
    versions of a key are never held together.
    """
    rest = F.struct(*columns, names.valid_from)
    ends = versions.repartition(names.key).groupBy(names.key, names.valid_to).agg(
        F.collect_list(rest).alias("_list"), F.min(names.valid_from).alias("_first"))
    ended = F.col(names.valid_to).isNotNull()
    repeated = F.when(ended, F.array_repeat(names.valid_to, F.size("_list")))
    return ends.groupBy(names.key).agg(
        F.max_by(F.when(~ended, F.col("_list")), F.when(~ended, F.lit(0))).alias("_new"),
        F.max_by(F.when(ended, F.col("_list")), names.valid_to).alias("_old"),
        F.sort_array(F.flatten(F.collect_list(repeated))).alias("_dates"),
        F.max(names.valid_to).alias("last_updated"),
        F.min("_first").alias("first_seen"),
    )


def _order(names: VersionColumns) -> Column:
    return F.struct(names.valid_to, names.valid_from, names.checksum)


def deleted_keys(versions: DataFrame, names: VersionColumns = VERSION_COLUMNS) -> DataFrame:
    """H7: keys with retired versions only. One aggregate instead of an anti-join."""
    return versions.groupBy(names.key).agg(
        F.bool_and(_retired(names)).alias("_gone")
    ).filter("_gone").select(names.key)


def changed_and_active_keys(versions: DataFrame,
                            names: VersionColumns = VERSION_COLUMNS) -> DataFrame:
    """H9: keys that are active and have been retired before."""
    return versions.groupBy(names.key).agg(
        F.bool_and(_retired(names)).alias("_all"), F.bool_or(_retired(names)).alias("_any")
    ).filter("_any AND NOT _all").select(names.key)


def history_lengths(versions: DataFrame, names: VersionColumns = VERSION_COLUMNS) -> DataFrame:
    """Number of retired versions per changed key, counted without building lists."""
    return versions.filter(_retired(names)).groupBy(names.key).agg(
        F.count(F.lit(1)).alias("list_length"))


def changed_once(versions: DataFrame, names: VersionColumns = VERSION_COLUMNS) -> DataFrame:
    """Keys with exactly one old version."""
    return history_lengths(versions, names).filter("list_length = 1").select(names.key)


def consolidate(versions: DataFrame, columns: Sequence[str] | None = None, *,
                ties: str = "one", carry_forward: bool = True,
                names: VersionColumns = VERSION_COLUMNS) -> DataFrame:
    """H8: one row per key with its update history and whether it was deleted.

    One scan and one shuffle. With ties="one" every map task first reduces a key to its best
    active and best retired version, so hot keys arrive small. "all" and "fail" give every
    active version of a key with every one that shares its latest end, see ``latest_retired``.

    carry_forward: a field empty in the active version is filled from the latest retired
    one. ``first_seen`` is the first start of any version; ``on_website_from`` that of the
    latest retired one, if any.
    """
    columns = list(columns or names.payload(versions.columns))
    if ties != "one":
        tied = _tied(versions, columns, names).select("*", F.explode_outer("_new").alias("_n")).select(
            "*", F.explode_outer("_old").alias("_o")).drop("_new", "_old").withColumnsRenamed({"_n": "_new", "_o": "_old"})
        every = _assemble(tied, columns, carry_forward, names)
        return require_unique(every, names.key) if ties == "fail" else every
    rest = [*columns, names.valid_from]
    retired = _retired(names)
    summary = versions.groupBy(names.key).agg(
        F.max_by(F.struct(*rest), F.when(~retired, F.struct(names.valid_from, names.checksum)))
        .alias("_new"),
        F.max_by(F.struct(*rest), F.when(retired, _order(names))).alias("_old"),
        _update_dates(names).alias("_dates"),
        F.max(names.valid_to).alias("last_updated"),
        F.min(names.valid_from).alias("first_seen"),
    )
    return _assemble(summary, columns, carry_forward, names)


def consolidate_parts(active: DataFrame, retired: DataFrame,
                      columns: Sequence[str] | None = None, *, carry_forward: bool = True,
                      names: VersionColumns = VERSION_COLUMNS) -> DataFrame:
    """H8 for a history stored in two parts, the active one with one row per key.

    Same rows as ``consolidate``; active rows are not aggregated, only joined, and both
    sides of that join have one row per key.
    """
    columns = list(columns or names.payload(active.columns))
    rest = [*columns, names.valid_from]
    new = active.select(names.key, F.struct(*rest).alias("_new"))
    old = retired.groupBy(names.key).agg(
        F.max_by(F.struct(*rest), _order(names)).alias("_old"),
        _update_dates(names).alias("_dates"),
        F.max(names.valid_to).alias("last_updated"),
        F.min(names.valid_from).alias("_first"),
    )
    summary = new.join(old, names.key, "full_outer").withColumn(
        "first_seen", F.least("_first", F.col("_new")[names.valid_from]))
    return _assemble(summary, columns, carry_forward, names)


def _assemble(summary: DataFrame, columns: Sequence[str], carry_forward: bool,
              names: VersionColumns) -> DataFrame:
    """One output row from the best active and the best retired version of a key."""
    gone = F.col("_new").isNull()
    new = {c: F.col("_new")[c] for c in [*columns, names.valid_from]}
    old = {c: F.col("_old")[c] for c in [*columns, names.valid_from]}
    filled = {c: F.coalesce(new[c], old[c]) if carry_forward
              else F.when(gone, old[c]).otherwise(new[c]) for c in columns}
    return summary.select(
        names.key,
        *[value.alias(c) for c, value in filled.items()],
        F.when(F.size("_dates") > 0, F.col("_dates")).alias("previous_update_dates"),
        "last_updated",
        F.coalesce(old[names.valid_from], new[names.valid_from]).alias(names.valid_from),
        gone.alias("deleted"),
        "first_seen",
    )
