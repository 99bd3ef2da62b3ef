"""The published table: P1 to P4."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.markdown import html_to_markdown
from tidemark.functions.text import lists_to_text
from tidemark.schema import LICENSE_TEXT, MARKDOWN_FIELDS, MIN_FIELDS


def min_table(consolidated: DataFrame, columns: Sequence[str] = MIN_FIELDS) -> DataFrame:
    """The published columns."""
    return consolidated.select(*columns)


def with_markdown(df: DataFrame, columns: Sequence[str] = MARKDOWN_FIELDS) -> DataFrame:
    """HTML columns as Markdown; nulls stay null. All columns in one Python pass."""
    return df.withColumns({c: html_to_markdown(c) for c in columns})


def flat_lists(df: DataFrame) -> DataFrame:
    """List columns as text."""
    return lists_to_text(df)


def with_license(df: DataFrame, text: str = LICENSE_TEXT) -> DataFrame:
    """The licence text of the data set next to each record's own line."""
    return df.withColumn("license_text", F.lit(text))
