"""Benchmark decontamination with DataFrame functions only.

Item texts become a set of normalised word windows. Documents are scanned window by window
for the hash of three of their words; hits are verified on all words, and documents or the
hit words can be removed. The set is broadcast up to ``BROADCAST_ROWS`` windows (some 24 MB of hash
and number); a larger one is met by a shuffle join on the hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, union_all
from tidemark.session import stored

WIDTH = 10
BROADCAST_ROWS = 1_000_000
# What separates words in lower-cased text and in text as written, and a word.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WRITTEN_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
KEY = ["_id", "_text_hash"]


def words(text: str | Column) -> Column:
    """Lower-cased words of a text; none for null."""
    return F.array_remove(F.split(lower_ascii(text), SEPARATORS), "")


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 width: int = WIDTH) -> DataFrame:
    """(item_id, gram): every window of every item; a shorter item is one window."""
    split = items.select(F.col(id_col).alias("item_id"), words(text_col).alias("w"))
    split = split.where(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(width)))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)
    return split.select("item_id", F.explode(
        F.transform(starts, lambda s: F.slice(F.col("w"), s, F.col("n")))).alias("gram")).distinct()


def _probe(w: Column, start: Column, n: Column) -> Column:
    """Hash of the first, middle and last word of a window; ``start`` counts from 0."""
    return F.xxhash64(F.get(w, start), F.get(w, start + F.floor(n / 2).cast("int")), F.get(w, start + n - 1))


def _bounded(frame: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(frame) if rows <= BROADCAST_ROWS else frame


def find_hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_id: str = "item_id", item_text: str = "text",
              width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """Verified hits (_id, _text_hash, pos, n, gram_no) and the items of each gram.

    ``pos`` counts words from 1 (an empty first piece of the split included) and the window covers ``n`` words. Rows are told apart by id
    and text, so repeated rows share their hits.
    """
    windows = stored(item_windows(items, item_id, item_text, width), "item-windows")
    lowered = F.transform("gram", lambda g: F.lower(g))
    grams = stored(windows.select("gram").distinct().withColumns({
        "gram_no": F.monotonically_increasing_id(), "n": F.size("gram"), "g": lowered,
    }).withColumn("probe", _probe(F.col("g"), F.lit(0), F.col("n"))).drop("g"), "grams")
    rows = grams.count()
    lengths = [r.n for r in grams.select("n").distinct().collect()]  # at most ``width`` values
    keyed = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_text_hash"),
                        F.col(text_col).alias("t"))
    # Words are lowered one by one with the plain function, which is coarser than A-Z alone:
    # it can only add candidates. Empty ends of the split stay, so positions agree below.
    split = keyed.select(*KEY, F.split(F.coalesce("t", F.lit("")), WRITTEN_SEPARATORS).alias("w"))
    split = split.select(*KEY, F.transform("w", lambda x: F.lower(x)).alias("w"))

    def scan(n: int) -> DataFrame:
        starts = F.sequence(F.lit(0), F.size("w") - n)
        probes = F.transform(starts, lambda s: _probe(F.col("w"), s, F.lit(n)))
        return split.where(F.size("w") >= n).select(*KEY, F.posexplode(probes).alias("pos", "probe")).select(
            *KEY, (F.col("pos") + 1).alias("pos"), F.lit(n).alias("n"), "probe")

    wanted = _bounded(grams.select("probe", "n").distinct(), rows)
    none = split.select(*KEY, F.lit(0).alias("pos"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("probe"))
    scans = [scan(n) for n in lengths] or [none.where("false")]
    candidates = stored(
        union_all(scans).join(wanted, ["probe", "n"]).select(*KEY, "pos", "n"), "candidates")
    per_doc = candidates.groupBy(*KEY).agg(F.collect_set(F.struct("pos", "n")).alias("c"))
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"c.{k}")) for k in KEY]
    back = keyed.alias("d").join(per_doc.alias("c"), same).select("d._id", "d._text_hash", "t", "c")
    back = back.select(*KEY, F.split(lower_ascii("t"), SEPARATORS).alias("w"), "c")
    shown = back.select(*KEY, F.explode(F.transform("c", lambda p: F.struct(
        p.pos.alias("pos"), p.n.alias("n"),
        F.slice(F.col("w"), p.pos, p.n).alias("gram")))).alias("p")).select(*KEY, "p.*")
    verified = shown.join(_bounded(grams.drop("probe"), rows), ["n", "gram"])
    verified = stored(verified.select(*KEY, "pos", "n", "gram_no").distinct(), "hits")
    gram_items = windows.join(_bounded(grams, rows), "gram").select("gram_no", "item_id").distinct()
    return verified, gram_items


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                  width: int = WIDTH) -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null and empty texts have no words; items without words have no windows, so an empty
    benchmark hits nothing. Items without an id can hit but are not counted in n_items.
    Repeated rows come out as often as they came in; other columns are ignored.
    """
    hits, gram_items = find_hits(docs, items, id_col, text_col, item_id, item_text, width)
    covered = F.transform("spans", lambda s: F.sequence(s.pos, s.pos + s.n - 1))
    spans = hits.groupBy(*KEY).agg(F.collect_set(F.struct("pos", "n")).alias("spans")).select(
        *KEY, F.size(F.array_distinct(F.flatten(covered))).cast("long").alias("n_hit"))
    found = (hits.select(*KEY, "gram_no").distinct().join(gram_items, "gram_no")
             .groupBy(*KEY).agg(F.collect_set(F.col("item_id").cast("string")).alias("items")))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in KEY]
    marked = spans.alias("a").join(found.alias("b"), same, "left").select(
        "a._id", "a._text_hash", "n_hit", "items")
    counted = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_text_hash"),
                          F.size(F.array_remove(F.split(F.coalesce(text_col, F.lit("")), WRITTEN_SEPARATORS), ""))
                          .cast("long").alias("n_words"))
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return counted.alias("a").join(marked.alias("b"), same, "left").select(
        F.col("a._id").alias("doc_id"), "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items_of), ","), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def remove(docs: DataFrame, items: DataFrame, what: str = "documents", id_col: str = "doc_id",
           text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
           width: int = WIDTH) -> DataFrame:
    """The documents without contaminated ones, or with their hit words cut out.

    All columns are kept as they are, whatever their names; with ``what="spans"`` the text
    of hit documents loses the hit words and what follows each up to the next word.
    """
    hits, _ = find_hits(docs, items, id_col, text_col, item_id, item_text, width)
    packed = docs.select(F.struct("*").alias("_row"))
    row = packed.withColumns({"_id": F.col(f"_row.{id_col}"),
                              "_text_hash": F.xxhash64(f"_row.{text_col}")})
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in KEY]
    if what == "documents":
        kept = row.alias("a").join(hits.select(*KEY).distinct().alias("b"), same, "left_anti")
        return kept.select("_row.*")
    spans = hits.groupBy(*KEY).agg(F.collect_set(F.struct("pos", "n")).alias("spans")).select(
        *KEY, F.array_distinct(F.flatten(F.transform(
            "spans", lambda s: F.sequence(s.pos, s.pos + s.n - 1)))).alias("cut"))
    text = F.col(f"_row.{text_col}")
    between, written = F.split(text, WORD), F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    shift = F.when(text.rlike("^" + WORD), 1).otherwise(2)
    left = F.transform(written, lambda w, i: F.when(
        F.array_contains("cut", i + shift), F.lit("")).otherwise(
        F.concat(w, F.element_at(between, i + 2))))
    clean = F.when(F.col("cut").isNull(), text).otherwise(
        F.concat(F.element_at(between, 1), F.array_join(left, "")))
    joined = row.alias("a").join(spans.alias("b"), same, "left").withColumn("_clean", clean)
    return joined.select(*[F.col("_clean").alias(text_col) if c == text_col
                           else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS gram
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0)),
p AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)),
h AS (SELECT p.doc_id, p.s, p.n, g.item_id FROM p JOIN g USING (n, gram)),
c AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS x FROM h) GROUP BY doc_id),
i AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit,
  coalesce(len(i.items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(i.items, ','), '')) AS items_sha256, c.n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)
"""
