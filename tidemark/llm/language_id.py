"""Language of pages by fusing evidence: text, declared language, address suffix, host.

Text likelihoods come from hashed letter trigrams of documents of known language. What a
declared language or an address suffix says about the true one is counted over all pages,
and so are the languages of hosts: a host's prior is smoothed towards its domain's, that
towards the overall one, each without the page itself. All counts are grouped aggregates;
languages, declared values and suffixes are few, hosts are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices
from tidemark.llm.toxicity import LETTER_CODE, points
from tidemark.session import stored

BUCKETS = 1 << 15
# Neighbouring trigrams repeat each other's evidence, so a long text counts as this many.
EFFECTIVE = 60
HOST_STRENGTH, DOMAIN_STRENGTH, TABLE_STRENGTH = 5.0, 20.0, 1.0


def trigram_buckets(text: str) -> np.ndarray:
    """How often each hashed letter trigram occurs, word boundaries included."""
    c = np.concatenate(([0], LETTER_CODE[points(text)], [0])).astype(np.int64)
    if len(c) < 3:
        return np.zeros(BUCKETS, dtype=np.int64)
    ids = ((c[:-2] << 12 | c[1:-1] << 6 | c[2:]) * 0x9E3779B1 >> 9) & (BUCKETS - 1)
    return np.bincount(ids[c[1:-1] > 0], minlength=BUCKETS)


def text_model(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages in order, and log p(trigram | language); counts over all whole documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for part in in_slices(batches, "text"):
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if text:
                    held = totals.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                    held += trigram_buckets(text)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(total[at])],
                                             names=["lang", "bucket", "n"])

    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL")
    counts = rows.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r.lang for r in counts})
    table = np.full((len(langs), BUCKETS), 0.5)
    for r in counts:
        table[langs.index(r.lang), r.bucket] += r.n
    return langs, np.log(table / table.sum(axis=1, keepdims=True))


def visible_text(html: Column) -> Column:
    """Markup, scripts, styles and comments replaced by blanks."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(bare, r"<[^>]*>|&[A-Za-z0-9#]{1,10};", " ")


def _blank(value: Column) -> Column:
    return F.when(value != "", value)


def page_evidence(pages: DataFrame, langs: list[str], model: np.ndarray, id_col: str = "page_id",
                  url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, domain, suffix, declared, text) with one text log likelihood per language."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, "t"):
            found = []
            for text in part.column(5).to_pylist():
                counts = trigram_buckets(text or "")
                at = np.flatnonzero(counts)
                n = counts.sum()
                found.append((shared.value[:, at] @ counts[at] * min(1.0, EFFECTIVE / max(n, 1))).tolist())
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:5], pa.array(found, pa.list_(pa.float64()))],
                names=["page_id", "host", "domain", "suffix", "declared", "text"])

    host = F.lower(_blank(F.regexp_extract(url_col, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)))
    labels = F.split(host, r"\.")
    declared = F.lower(_blank(F.regexp_extract(html_col, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", 1)))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), host.alias("host"),
        F.when(F.size(labels) >= 2, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(host).alias("domain"),
        F.element_at(labels, -1).alias("suffix"), declared.alias("declared"), visible_text(F.col(html_col)).alias("t"))
    return rows.mapInArrow(run, "page_id long, host string, domain string, suffix string, declared string, text array<double>")


def identify(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url",
             html_col: str = "html", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """One row per page row: page_id, lang, probability, text_lang, declared, suffix, host.

    A page without text has equal likelihoods; a missing declaration or address is no
    evidence, a page without host has the overall prior. Ties go to the first language in
    order. Without documents of known language lang is null. Repeated rows come out as often
    as they came in; an empty table gives an empty result; other columns are ignored.
    """
    langs, model = text_model(docs, lang_col, text_col)
    size = len(langs)
    pages_schema = "page_id long, lang string, probability double, text_lang string, declared string, suffix string, host string"
    if not size:
        rows = page_evidence(pages, langs, np.zeros((1, BUCKETS)), id_col, url_col, html_col)
        return rows.selectExpr("page_id", "cast(null as string) lang", "cast(null as double) probability",
                               "cast(null as string) text_lang", "declared", "suffix", "host").to(
            pages.sparkSession.createDataFrame([], pages_schema).schema)
    rows = page_evidence(pages, langs, model, id_col, url_col, html_col)
    best = F.array_position("text", F.array_max("text")).cast("int") - 1
    rows = stored(rows.withColumn("best", best), "page-evidence")

    # Counts of the languages that texts speak for, by what may tell the language.
    each = [F.count_if(F.col("best") == i).cast("double") for i in range(size)]
    total = F.array(*each).alias("n")
    overall_n = rows.agg(total).first().n
    overall = [(n + 1) / (sum(overall_n) + size) for n in overall_n]

    def table(column: str) -> DataFrame:
        """log p(value | language), smoothed; one narrow row per value."""
        counted = rows.where(F.col(column).isNotNull()).groupBy(column).agg(total)
        kinds = counted.count()
        p = [(F.col("n")[i] + TABLE_STRENGTH) / (overall_n[i] + TABLE_STRENGTH * (kinds + 1)) for i in range(size)]
        return stored(counted.select(column, F.array(*[F.log(x) for x in p]).alias(f"p_{column}")), f"by-{column}")

    domains = stored(rows.where("domain IS NOT NULL").groupBy("domain").agg(total), "domains")
    hosts = stored(rows.where("host IS NOT NULL").groupBy("host").agg(total), "hosts")
    own = [F.when(F.col("best") == i, 1.0).otherwise(0.0) for i in range(size)]

    def smoothed(counts: str, towards: list[Column], strength: float) -> list[Column]:
        """Share per language without the page itself, pulled towards the level above."""
        rest = [F.when(F.col(counts).isNull(), 0.0).otherwise(F.col(counts)[i] - own[i]) for i in range(size)]
        n = sum(rest[1:], rest[0])
        return [(rest[i] + strength * towards[i]) / (n + strength) for i in range(size)]

    joined = (rows.join(table("declared"), "declared", "left").join(table("suffix"), "suffix", "left")
              .join(domains.withColumnRenamed("n", "n_domain"), "domain", "left")
              .join(hosts.withColumnRenamed("n", "n_host"), "host", "left"))
    domain = smoothed("n_domain", [F.lit(p) for p in overall], DOMAIN_STRENGTH)
    joined = joined.withColumn("_domain", F.array(*domain))
    prior = smoothed("n_host", [F.col("_domain")[i] for i in range(size)], HOST_STRENGTH)
    evidence = [F.col("text")[i] + F.log(prior[i]) + F.coalesce(F.col("p_declared")[i], F.lit(0.0))
                + F.coalesce(F.col("p_suffix")[i], F.lit(0.0)) for i in range(size)]
    z = joined.withColumn("_z", F.array(*evidence)).withColumn("_top", F.array_max("_z"))
    names = F.array(*[F.lit(x) for x in langs])
    mass = F.aggregate("_z", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("_top")))
    return z.select(
        "page_id", F.get(names, F.array_position("_z", F.col("_top")).cast("int") - 1).alias("lang"),
        (1 / mass).alias("probability"), F.get(names, F.col("best")).alias("text_lang"), "declared", "suffix", "host")
