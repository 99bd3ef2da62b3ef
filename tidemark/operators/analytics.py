"""Analyses of the consolidated table: A1 to A16."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import stored

RECENT_DAYS = 30  # fixed value


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """A1: how often each category occurs, most frequent first."""
    return (
        df.select(F.explode(column).alias(column)).filter(F.col(column).isNotNull())
        .groupBy(column).agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), column)
    )


def category_shares(df: DataFrame, column: str, share: str = "share") -> DataFrame:
    """A2: percentage of rows whose list holds the category; one aggregate for all."""
    rows = df.select(F.count(F.lit(1))).scalar()
    return (
        df.select(F.explode(F.array_distinct(column)).alias("category"))
        .filter("category IS NOT NULL")
        .groupBy("category").agg(F.count(F.lit(1)).alias("_n"))
        .select("category", (F.col("_n") / rows * 100).alias(share))
    )


def compare_shares(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """A3: categories of ``a`` with their share there and in ``b``, ascending."""
    return (
        category_shares(a, column, "recent_share")
        .join(category_shares(b, column, "total_share"), "category", "left")
        .fillna(0.0, ["total_share"])
        .orderBy("recent_share", "category")
    )


def freshness(df: DataFrame) -> DataFrame:
    """A4: when the data last changed; the latest start if nothing ever did."""
    return df.agg(F.coalesce(F.max("last_updated"), F.max("on_website_from"))
                  .alias("most_recent_update"))


def active_programs(df: DataFrame) -> DataFrame:
    """A5."""
    return df.filter(~F.col("deleted"))


def active_count(df: DataFrame) -> DataFrame:
    """A5."""
    return df.agg(F.count_if(~F.col("deleted")).alias("active"))


def profile(df: DataFrame) -> DataFrame:
    """One row per column with type, rows and nulls, from a single pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f.name).isNull()).alias(f"_n{i}")
          for i, f in enumerate(df.schema.fields)],
    )
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("type"),
                 F.col("_rows").alias("row_count"), F.col(f"_n{i}").alias("null_count"))
        for i, f in enumerate(df.schema.fields)
    ])))


def with_week(df: DataFrame, date: str = "on_website_from") -> DataFrame:
    """Monday of the week of ``date``."""
    as_given = df.schema[date].dataType
    return df.withColumn("week_start_date", F.date_trunc("week", date).cast(as_given))


def without_first_load(df: DataFrame, date: str = "on_website_from") -> DataFrame:
    """Leaves out the rows of the earliest date."""
    return df.filter(F.col(date) != df.select(F.min(date)).scalar())


def _weekly(df: DataFrame, date: str) -> DataFrame:
    return with_week(without_first_load(df, date), date)


def weekly_added(df: DataFrame, date: str = "on_website_from") -> DataFrame:
    """A9."""
    return (_weekly(df, date).filter(~F.col("deleted")).groupBy("week_start_date")
            .agg(F.count(F.lit(1)).alias("added_count")).orderBy("week_start_date"))


def weekly_deleted(df: DataFrame, date: str = "on_website_from") -> DataFrame:
    """A10: by week of ``date``; pass ``last_updated`` to count by time of deletion."""
    return (_weekly(df, date).filter("deleted").groupBy("week_start_date")
            .agg(F.count(F.lit(1)).alias("deleted_count")).orderBy("week_start_date"))


def weekly_series(df: DataFrame, date: str = "on_website_from") -> DataFrame:
    """Both counts per week in one pass, 0 where one side has none."""
    return (
        _weekly(df, date).groupBy("week_start_date")
        .agg(F.count_if(~F.col("deleted")).alias("added_count"),
             F.count_if(F.col("deleted")).alias("deleted_count"))
        .orderBy("week_start_date")
    )


def if_history(df: DataFrame, result: DataFrame) -> DataFrame:
    """``result`` if some row of ``df`` was ever updated, else no rows."""
    return result.filter(df.select(F.max(F.col("last_updated").isNotNull())).scalar())


def recent(df: DataFrame, as_of: Column, days: int = RECENT_DAYS,
           date: str = "on_website_from") -> DataFrame:
    """Rows of the last ``days`` days before ``as_of``."""
    return df.filter(F.col(date) > as_of - F.expr(f"INTERVAL {int(days)} DAYS"))


def recent_against_all(df: DataFrame, column: str, as_of: Column, *, deleted: bool,
                       days: int = RECENT_DAYS, date: str = "on_website_from") -> DataFrame:
    """A3 on A13: share per category among recently deleted or added rows and among all.

    One pass: rows carry whether they count as recent, and the numbers of rows are kept as
    the count of a category that every row has.
    """
    wanted = F.col("deleted") if deleted else ~F.col("deleted")
    late = F.col(date) > as_of - F.expr(f"INTERVAL {int(days)} DAYS")
    flagged = df.select(F.coalesce(late & wanted, F.lit(False)).alias("_recent"), F.explode(F.concat(
        F.array(F.struct(F.lit(True).alias("all"), F.lit(None).cast("string").alias("category"))),
        F.transform(F.coalesce(F.array_distinct(column), F.array().cast("array<string>")),
                    lambda c: F.struct(F.lit(False).alias("all"), c.alias("category"))))).alias("c"))
    counts = flagged.groupBy("c.all", "c.category").agg(
        F.count_if("_recent").alias("_recent"), F.count(F.lit(1)).alias("_n"))
    counts = stored(counts, "category-counts")
    totals = counts.filter("all").select(F.col("_recent").alias("_rows_recent"), F.col("_n").alias("_rows"))
    row = totals.first()
    if row is None:
        return counts.select("category", F.lit(0.0).alias("recent_share"), F.lit(0.0).alias("total_share")).filter("false")
    return (
        counts.filter("NOT all AND category IS NOT NULL AND _recent > 0")
        .select("category", (F.col("_recent") / row._rows_recent * 100).alias("recent_share"),
                (F.col("_n") / row._rows * 100).alias("total_share"))
        .orderBy("recent_share", "category")
    )


def first_rows(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    """First rows in a stated order; per-task heaps, no full sort."""
    return df.orderBy(order).limit(n)


def row_at(df: DataFrame, order: str, position: int) -> DataFrame:
    """The row at a position, counted from 0; none beyond the end. Nulls come first.

    The position is found on ``order`` alone: its values are dealt by range and written, the
    counts per range tell which one holds the position, and only that one is sorted. The
    whole row is then read by its value. Among rows of equal value the choice is arbitrary.
    """
    ranged = stored(df.select(order).repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "ranged")
    before = 0
    for part, n in sorted((r._part, r["count"]) for r in ranged.groupBy("_part").count().collect()):
        if position < before + n:
            here = ranged.filter(F.col("_part") == part)
            value = here.orderBy(order).offset(position - before).limit(1).first()[order]
            less = here.filter(F.coalesce(F.col(order) < F.lit(value), F.col(order).isNull() & F.lit(value is not None)))
            equal = df.filter(F.col(order).eqNullSafe(F.lit(value)))
            return equal.offset(position - before - less.count()).limit(1)
        before += n
    return df.filter("false")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """A15."""
    return df.select(column).distinct()


def has_null(df: DataFrame, column: str) -> DataFrame:
    """Whether null is among the values."""
    return df.agg((F.count_if(F.col(column).isNull()) > 0).alias("has_null"))


def pick_deleted(df: DataFrame, key: str = "id_hash", seed: int = 0) -> DataFrame:
    """A deleted row chosen by seeded hash: arbitrary, yet the same on every run."""
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.filter("deleted").orderBy(drawn, key).limit(1)
