"""A whole run: pages to records, history, published table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.html import Rule
from tidemark.functions.text import SLUG_MARKERS
from tidemark.operators import extraction, identity
from tidemark.operators.consolidate import consolidate_parts
from tidemark.operators.identity import require_unique
from tidemark.operators.publishing import min_table, with_markdown
from tidemark.schema import LICENSE_TEXT, PROGRAM_SCHEMA, WATCHED_FIELDS
from tidemark.session import release_shuffles
from tidemark.sources.history_store import HistoryStore, State
from tidemark.sources.published import Publication, publish_min, write_parquet


@dataclass(frozen=True)
class Snapshot:
    """What a run found: valid records, one per key, and the three reports."""

    records: DataFrame
    rejected: DataFrame
    issues: DataFrame
    repeated: DataFrame


def read_records(pages: DataFrame, run_at: datetime, *,
                 rules: Sequence[Rule] = extraction.DETAIL_RULES,
                 markers: Sequence[str] = SLUG_MARKERS) -> DataFrame:
    """Pages to identified, checked records with their ``issues`` and ``problems``.

    One parse per page and no shuffle. Every report below reads this result, so write it
    once (``load_run`` does) instead of parsing the pages for each.
    """
    extracted = extraction.extract(pages, rules)
    identified = identity.identify(extracted, F.lit(run_at.isoformat(sep=" ")), markers=markers)
    return identity.validate(identified)


def split(checked: DataFrame, repeated: DataFrame | None = None) -> Snapshot:
    """Sorts checked records into the snapshot and its reports."""
    fields = PROGRAM_SCHEMA.fieldNames()
    valid = checked.filter(F.size("problems") == 0).select("page_id", *fields)
    # A page without title is no record at all: it is an issue, not a rejected record.
    titled = checked.filter(~F.array_contains("problems", "title: missing"))
    return Snapshot(
        records=identity.one_per_key(valid, ["page_id", "url"], repeated=repeated).select(*fields),
        rejected=identity.rejected_records(titled, ["page_id", "url"]),
        issues=extraction.page_issues(checked),
        repeated=identity.repeated_keys(valid),
    )


# What a run counts of its pages, as SQL conditions.
_COUNTED = {
    "pages": "true",
    "untitled": "array_contains(issues, 'no title')",
    "empty": "array_contains(issues, 'no data')",
    "rejected": "NOT array_contains(issues, 'no title') AND size(problems) > 0",
}


def load_run(pages: DataFrame, store: HistoryStore, run: int, run_at: datetime, *,
             mode: str, source: str | None = None, batch: int | None = None,
             rules: Sequence[Rule] = extraction.DETAIL_RULES,
             markers: Sequence[str] = SLUG_MARKERS, state: State | None = None) -> bool:
    """One scheduled run into the store: extract, check, merge, commit.

    What a run sets aside is kept beside it: ``rejected`` records, page ``issues`` and
    ``repeated`` keys are tables of the run (``run_report`` reads them). Their numbers stand in
    the commit (``run_counts``): pages are counted by the pass that writes the records. The
    records as extracted go once the run is committed.
    """
    state = state or store.state()
    if any(row.run == run for row in state.commits):
        return False
    counted = Observation("run")
    checked = store.materialise(read_records(pages, run_at, rules=rules, markers=markers).observe(
        counted, *[F.count_if(F.expr(what)).alias(name) for name, what in _COUNTED.items()]), "extracted", run)
    repeated = store.materialise(split(checked).repeated, "repeated", run)
    found = split(checked, repeated)
    store.materialise(found.rejected, "rejected", run)
    store.materialise(found.issues, "issues", run)
    merged = store.merge(found.records, run, run_at, mode=mode, watched=WATCHED_FIELDS,
                         staged=True, source=source, batch=batch, state=state,
                         counts={**counted.get, "repeated": repeated.count()})
    store.clear(run, "extracted")
    release_shuffles(store.spark)
    return merged


def run_counts(store: HistoryStore) -> DataFrame:
    """What every load run saw, from the commits alone: no report is read."""
    return store.commits().where("counts IS NOT NULL").select(
        "run", *[F.coalesce(F.col("counts")[name], F.lit(0)).alias(name) for name in (*_COUNTED, "repeated")],
        "opened", "closed")


REPORTS = ("rejected", "issues", "repeated")


def run_report(store: HistoryStore, name: str) -> DataFrame:
    """A report of all committed runs, with the ``run`` it belongs to."""
    if name not in REPORTS:
        raise ValueError(f"name must be one of {REPORTS}")
    every = store.spark.read.parquet(f"{store.root}/{name}")
    return every.join(store.commits().select("run"), "run", "left_semi")


def publish_history(store: HistoryStore, folder: str) -> DataFrame:
    """Consolidates the store, checks the key, writes every published file, then shows them.

    Every publication has a folder of its own, and the row that names it is written last: a
    repeated key or a failure on the way leaves readers with the last publication, whose files
    are all of one run. Returns the full table as published.
    """
    columns = PROGRAM_SCHEMA.fieldNames()[1:]
    state = store.state()
    publication = Publication.begin(store.spark, folder, state.last)
    write_parquet(consolidate_parts(store.active(), store.retired(), columns), publication.path("data.parquet"))
    release_shuffles(store.spark)
    full = store.spark.read.parquet(publication.path("data.parquet"))
    require_unique(full).agg(F.count("*")).collect()
    publish_min(with_markdown(min_table(full)), publication.root, LICENSE_TEXT)
    publication.show(full.count())
    return full
