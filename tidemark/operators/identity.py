"""Keys, checksums, licence lines, validation: I1 to I6."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import (
    SLUG_MARKERS, content_checksum, license_line, record_key, url_slug,
)
from tidemark.schema import PROGRAM_SCHEMA, WATCHED_FIELDS


def identify(records: DataFrame, scrape_date: Column,
             watched: Sequence[str] = WATCHED_FIELDS,
             markers: Sequence[str] = SLUG_MARKERS) -> DataFrame:
    """I1 to I4 in one projection: slug, key, checksum, licence line.

    The checksum never sees the scrape date, so a new date alone makes no new version.
    """
    slugged = records.withColumn("id_url", url_slug(F.col("url"), markers))
    return slugged.withColumns({
        "id_hash": record_key(F.col("id_url")),
        "checksum": content_checksum(watched),
        "license_info": license_line(F.col("title"), scrape_date, F.col("url")),
    })


def validate(records: DataFrame, schema: T.StructType = PROGRAM_SCHEMA) -> DataFrame:
    """The fields of ``schema``, other columns untouched, and ``problems`` per row.

    A value that does not fit its type becomes null and counts as a problem; so does a
    missing required value and an empty slug, which would merge unrelated records.
    """
    typed, problems = {}, []
    for field in schema.fields:
        given, fits = _fit(records, field)
        typed[field.name] = fits
        if fits is not given:
            problems.append(F.when(given.isNotNull() & fits.isNull(),
                                   F.lit(f"{field.name}: wrong type")))
        if not field.nullable:
            problems.append(F.when(fits.isNull(), F.lit(f"{field.name}: missing")))
        if field.name == "id_url":
            problems.append(F.when(fits == "", F.lit("id_url: empty")))
    return records.withColumn("problems", F.array_compact(F.array(*problems))).withColumns(typed)


def _fit(records: DataFrame, field: T.StructField) -> tuple[Column, Column]:
    """The given column and its value in the declared type, null where it cannot be had."""
    if field.name not in records.columns:
        missing = F.lit(None).cast(field.dataType)
        return missing, missing
    given, have = F.col(field.name), records.schema[field.name].dataType
    if have.simpleString() == field.dataType.simpleString():
        return given, given
    if isinstance(have, T.ArrayType) != isinstance(field.dataType, T.ArrayType):
        return given, F.lit(None).cast(field.dataType)
    return given, given.try_cast(field.dataType)


def valid_records(validated: DataFrame, schema: T.StructType = PROGRAM_SCHEMA) -> DataFrame:
    return validated.filter(F.size("problems") == 0).select(*schema.fieldNames())


def rejected_records(validated: DataFrame, by: Sequence[str] = ("url",)) -> DataFrame:
    return validated.filter(F.size("problems") > 0).select(*by, "problems")


def repeated_keys(records: DataFrame, key: str = "id_hash") -> DataFrame:
    """Keys that occur more than once; no rows means the check passes."""
    return records.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def require_unique(records: DataFrame, key: str = "id_hash") -> DataFrame:
    """I6 as a gate: the same rows, or a failed job that names a repeated key."""
    bad = repeated_keys(records, key).select(F.min(F.col(key).cast("string"))).scalar()
    failing = F.when(bad.isNotNull(), F.raise_error(F.concat(F.lit(f"{key} repeats: "), bad)))
    return records.filter(failing.cast("boolean").isNull())


def one_per_key(records: DataFrame, order: Sequence[str], key: str = "id_hash",
                repeated: DataFrame | None = None) -> DataFrame:
    """First record of each key in ``order``, so a snapshot has one row per key.

    ``repeated`` (``repeated_keys`` of the same records, best read from a table) keeps all
    other rows out of the shuffle: only records of repeated keys are grouped.
    """
    rest = [c for c in records.columns if c != key]
    many = records if repeated is None else records.join(repeated, key, "left_semi")
    first = (
        many.groupBy(key)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r"))
        .select(key, *[F.col(f"r.{c}").alias(c) for c in rest])
        .select(*records.columns)
    )
    if repeated is None:
        return first
    return records.join(repeated, key, "left_anti").select(*records.columns).unionByName(first)
