"""Exact ways round hot keys: joins to one-row-per-key tables, and running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

# Rows of one key that one task is meant to take; a key with more is dealt to several.
ROWS_PER_TASK = 1_000_000


def attach_per_key(rows: DataFrame, per_key: DataFrame, keys: Sequence[str], count: str,
                   salt: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Inner join of many rows per key to one row per key, hot keys spread by salt.

    ``per_key`` holds each key's row count in ``count``, as produced by the aggregate that
    made it. A key gets as many salts as it has times ``rows_per_task`` rows, so no reducer
    gets more, however hot a key is; the one row of such a key is repeated as often. Rows are
    dealt by a hash of the narrow column ``salt``. Keys with more than one salt number at
    most rows / ``rows_per_task``, which bounds what the first join looks up. Nothing is
    left out. ``per_key`` is used twice, so it is written to the shared folder first.
    """
    keys = list(keys)
    per_key = stored(per_key.withColumn(
        "_salts", F.ceil(F.col(count) / rows_per_task).cast("int")), "per-key")
    hot = per_key.filter("_salts > 1").select(*keys, "_salts")
    dealt = F.pmod(F.xxhash64(salt), F.coalesce("_salts", F.lit(1))).cast("int")
    salted = rows.join(hot, keys, "left").withColumn("_salt", dealt).drop("_salts")
    copies = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    return salted.join(copies, [*keys, "_salt"]).drop("_salt")


def running_totals(rows: DataFrame, order: str, totals: dict[str, str],
                   parts: int | None = None) -> DataFrame:
    """Running sums over a whole table ordered by a unique column, without one big window.

    ``totals`` maps result column to summed column. Rows are dealt by range of ``order`` to
    ``parts`` partitions (Spark's shuffle partitions unless given), whatever its values look
    like, and written. Each is summed on its own; one row per partition passes through the
    global window.
    """
    by = [] if parts is None else [parts]
    ranged = stored(rows.repartitionByRange(*by, order).withColumn("_part", F.spark_partition_id()), "ranged")
    per_part = ranged.groupBy("_part").agg(
        *[F.sum(src).alias(f"_sum_{out}") for out, src in totals.items()]
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        "_part",
        *[F.coalesce(F.sum(f"_sum_{out}").over(before), F.lit(0)).alias(f"_off_{out}")
          for out in totals],
    )
    within = Window.partitionBy("_part").orderBy(order).rowsBetween(
        Window.unboundedPreceding, 0)
    joined = ranged.join(F.broadcast(offsets), "_part")  # one row per partition
    return joined.withColumns(
        {out: F.col(f"_off_{out}") + F.sum(src).over(within) for out, src in totals.items()}
    ).drop("_part", *[f"_off_{out}" for out in totals])
