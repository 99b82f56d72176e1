"""Documents with odd rows for the tests of the text operators."""

from tallywell.llm.catalog import make_importable

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, score string, bits string, length string, word string"


def documents(spark, rows):
    """Documents from (doc_id, text), with columns whose names operators use inside."""
    make_importable(spark)
    full = [(i, t, "en", "s", None if t is None else len(t), "r", "k", "x", "b", "l", "w") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)
