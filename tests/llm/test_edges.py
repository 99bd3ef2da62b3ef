"""Every operator and stage on awkward rows and on empty tables."""

import pytest
from helpers import awkward, frame, nothing, words

import corpus_pipeline
from tidemark.llm import (
    decontamination, language_id, length_histogram, maxent_lm, neighbours, quality_knn, sentence_pieces, simhash_dedup,
    substring_dedup, toxicity,
)

LABELS = "doc_id long, quality int, toxic int"
PAGES = "page_id long, url string, html string"


def labels(spark, rows=((1, 0, 1), (3, 1, 0), (4, 1, 0), (6, 0, 1), (None, 1, 1), (7, None, None))):
    return spark.createDataFrame(list(rows), LABELS)


def items(spark, rows=((1, words(1, 12)), (2, ""), (3, None), (4, "twice"), (None, "a"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


OPERATORS = {
    "lm": lambda d, s: maxent_lm.fit_and_score(d, rounds=1),
    "pieces": lambda d, s: sentence_pieces.encode(d),
    "toxicity": lambda d, s: toxicity.score(d, toxicity.fit(d, labels(s))),
    "benchmark": lambda d, s: decontamination.contamination(d, items(s)),
    "simhash": lambda d, s: simhash_dedup.near_duplicates(d),
    "quality": lambda d, s: quality_knn.score(d, quality_knn.fit(d, labels(s))),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_per_row(spark, name):
    docs = awkward(spark)
    got = OPERATORS[name](docs, spark).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in docs.collect())
    assert OPERATORS[name](nothing(spark), spark).collect() == []


def test_repeated_passages_of_awkward_rows(spark):
    assert substring_dedup.repeated_passages(awkward(spark)).collect() == []
    assert substring_dedup.repeated_passages(nothing(spark)).collect() == []


def test_lengths_of_awkward_rows(spark):
    got = {r.n_tokens: r.docs for r in length_histogram.length_table(awkward(spark)).collect()}
    assert sum(got.values()) == 8 and got[0] == 2
    assert length_histogram.length_table(nothing(spark)).collect() == []


def test_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
            (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (1, [0.5, 0.5]), (8, [])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS g", "2 AS side")
    got = neighbours.nearest(v.where("vec_id = 0"), v, k=5).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]
    assert neighbours.nearest(v.where("vec_id = 0"), v.where("vec_id > 90")).collect() == []


def test_pages(spark):
    pages = spark.createDataFrame([
        (1, None, None), (2, "", ""), (3, "https://a.de/x", "<html lang=de><p>und der die das</p>"),
        (None, "http://b.fr", "<html><p>le la les"), (3, "https://a.de/x", "<html lang=de><p>und der die das</p>")], PAGES)
    docs = spark.createDataFrame([(1, "und der die das ist nicht", "de", "s", 1), (2, "le la les des une est", "fr", "s", 1),
                                  (3, None, "de", "s", 1), (4, "x", None, "s", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.page_id, r.lang) for r in language_id.identify(pages.selectExpr("*", "1 AS text", "2 AS best"), docs).collect()]
    assert len(got) == 5 and got.count((3, "de")) == 2 and (None, "fr") in got
    assert [r.lang for r in language_id.identify(pages, nothing(spark)).collect()] == [None] * 5
    assert language_id.identify(pages.where("false"), docs).collect() == []


def test_stages_keep_columns_and_bear_awkward_rows(spark, tmp_path):
    long = words(5, 200)
    tables = {"documents": frame(spark, {10: long, 11: long, 12: words(6, 90) + " " + words(1, 12)}),
              "labels": labels(spark, ((10, 1, 0), (11, 1, 0), (12, 1, 0))), "benchmark": items(spark, ((1, words(1, 12)),))}
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    for docs in (awkward(spark), nothing(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    kept = sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert kept == [10]
