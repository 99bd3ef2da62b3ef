"""Column expressions for text, identity and list handling. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import LICENSE_LINE

# fixed values: the part of a detail URL that precedes the slug, in order of preference
SLUG_MARKERS = ("Foerderprogramm/", "Archiv/")


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def split_list(c: Column, separator: str = ", ") -> Column:
    """Text to list; blank or missing text gives null."""
    return F.split(blank_to_null(c), separator)


def first_group(c: Column, pattern: str) -> Column:
    """First capture group, or null where the pattern does not match."""
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def after_first(c: Column, marker: str) -> Column:
    """Text after the first ``marker``, or null where it is absent."""
    at = F.locate(marker, c)
    return F.when(at > 0, F.substr(c, at + F.lit(len(marker))))


def url_slug(url: Column, markers: Sequence[str] = SLUG_MARKERS) -> Column:
    """Long-lived id text of a detail URL; empty where no marker occurs."""
    tail = F.coalesce(*[after_first(url, m) for m in markers], F.lit(""))
    return F.lower(F.replace(F.replace(tail, F.lit("/"), F.lit("-")), F.lit(".html"), F.lit("")))


def record_key(slug: Column) -> Column:
    return F.md5(slug)


def content_checksum(fields: Sequence[str]) -> Column:
    """SHA-256 of the watched fields as JSON, sorted by name, nulls included.

    Equal digest means equal watched fields, which is all that versioning needs.
    """
    return F.sha2(
        F.to_json(F.struct(*sorted(fields)), {"ignoreNullFields": "false"}), 256
    )


def license_line(title: Column, date: Column, url: Column) -> Column:
    """Licence text of one record; null where a part of it is null."""
    slots = {"{title}": title, "{date}": date.cast("string"), "{url}": url}
    pieces, rest = [], LICENSE_LINE
    for slot, value in slots.items():
        before, _, rest = rest.partition(slot)
        pieces += [F.lit(before), value]
    return F.concat(*pieces, F.lit(rest))


def list_columns(df: DataFrame) -> list[str]:
    """Array columns, found from the schema."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]


def lists_to_text(df: DataFrame, separator: str = ", ") -> DataFrame:
    """Join every list column into one text column of the same name."""
    return df.withColumns(
        {c: F.array_join(F.col(c).cast("array<string>"), separator) for c in list_columns(df)}
    )
