"""Small tables for the training-data operators, with every awkward row they must bear."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int) -> str:
    """Made-up words; different seeds share none in order."""
    return " ".join(f"w{seed}x{(i * 7919 + seed) % 9973}" for i in range(n))


def frame(spark, texts: dict):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    return spark.createDataFrame(rows, SCHEMA)


def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, extra clashing columns."""
    rows = [
        (1, "", "en", "s", 0), (2, None, None, None, None), (None, "no id here", "en", "s", 10),
        (3, words(1, 30_000), "en", "s", 1), (4, "twice twice", "en", "s", 1), (4, "twice twice", "en", "s", 1),
        (5, " \n\t ", "de", "s", 4), (6, "a", "fr", "s", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    extra = ("score", "fp", "key", "doc", "row", "pos", "count", "words", "cuts", "y", "h", "_id", "text_hash", "component_id")
    return docs.selectExpr("*", *[f"'x' AS `{c}`" for c in extra])


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
