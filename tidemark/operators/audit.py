"""Checks and repairs on a history: H10, H11, H13 to H15."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.skew import attach_per_key
from tidemark.schema import VERSION_COLUMNS, VersionColumns
from tidemark.session import stored

RECONCILE_TOLERANCE = 2  # fixed value


def duplicate_versions(versions: DataFrame, names: VersionColumns = VERSION_COLUMNS) -> DataFrame:
    """Key and content that occur in several versions, with their newest load."""
    return versions.groupBy(names.key, names.checksum).agg(
        F.count(F.lit(1)).alias("versions"), F.max(names.load).alias("max_load_id")
    ).filter("versions > 1")


def drop_duplicate_versions(versions: DataFrame,
                            names: VersionColumns = VERSION_COLUMNS) -> DataFrame:
    """The newest load of each key and content; among equals the latest start.

    Groups with several versions are found on narrow columns and stored; only their rows
    are aggregated, all others pass by an anti-join on the narrow keys.
    """
    group = [names.key, names.checksum]
    rest = [c for c in versions.columns if c not in group]
    several = stored(duplicate_versions(versions, names).select(*group), "duplicate-groups")
    still_open = F.col(names.valid_to).isNull()
    newest = F.struct(names.load, names.valid_from, still_open, names.valid_to)
    same = [F.col(f"v.{c}").eqNullSafe(F.col(f"g.{c}")) for c in group]
    kept = (
        versions.alias("v").join(several.alias("g"), same, "left_semi").groupBy(*group)
        .agg(F.max_by(F.struct(*rest), newest).alias("_kept"))
        .select(*group, *[F.col(f"_kept.{c}").alias(c) for c in rest])
        .select(*versions.columns)
    )
    return versions.alias("v").join(several.alias("g"), same, "left_anti").unionByName(kept)


def invariants(consolidated: DataFrame, names: VersionColumns = VERSION_COLUMNS) -> DataFrame:
    """One row per rule with the number of rows that break it, from a single aggregate."""
    start = F.col(names.valid_from)
    rules = {
        "active row without start date": ~F.col("deleted") & start.isNull(),
        "deleted row without start date": F.col("deleted") & start.isNull(),
        "row without key": F.col(names.key).isNull(),
        "row without id_url": F.col("id_url").isNull(),
        "active row updated before its start": ~F.col("deleted") & (F.col("last_updated") < start),
    }
    counts = consolidated.agg(
        *[F.count_if(broken).alias(f"_r{i}") for i, broken in enumerate(rules.values())]
    )
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.col(f"_r{i}").alias("violations"))
        for i, rule in enumerate(rules)
    ])))


def reconcile(consolidated: DataFrame, expected: int | Column,
              tolerance: int = RECONCILE_TOLERANCE) -> DataFrame:
    """Active rows against an outside count."""
    return consolidated.agg(F.count_if(~F.col("deleted")).alias("active")).select(
        "active", F.lit(expected).cast("long").alias("expected")
    ).withColumn("agrees", F.abs(F.col("active") - F.col("expected")) <= tolerance)


def dead_links(consolidated: DataFrame, url_status: DataFrame,
               names: VersionColumns = VERSION_COLUMNS) -> DataFrame:
    """Active rows whose URL is not known to be valid; a missing status is not valid.

    ``url_status`` has one row per URL. The check runs on one row per URL; dead URLs are
    then brought back to their rows with hot ones spread.
    """
    active = consolidated.filter(~F.col("deleted"))
    alive = url_status.filter("is_valid").select("url")
    dead = active.groupBy("url").agg(F.count(F.lit(1)).alias("_rows")).join(
        alive, "url", "left_anti")
    return attach_per_key(active, dead, ["url"], "_rows", salt=names.key).drop("_rows")
