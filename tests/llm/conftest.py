import pytest
from pyspark.sql import functions as F

CLASHING = ["size", "row", "key", "n_words", "k1", "k2", "fp", "spans", "n", "node", "cell", "chance", "copy", "times"]
PROSE = "the quick brown fox jumps over the lazy dog and runs far away from all of them before night falls again. "


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, and columns whose names clash."""
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n ", None, None, None), (4, "word", "en", "b", 4),
        (None, "text without an id " * 30, "en", "a", 1), (5, PROSE * 900, "en", "a", 1), (6, PROSE * 900, "en", "a", 1),
        (7, PROSE * 3, "de", "b", 1), (7, PROSE * 3, "de", "b", 1), (7, "another text of the same id, ünïcode ﬁn. " * 4, "de", "b", 1),
        (8, "mail me at a.b@c.example.org or 1.2.3.4 now " + PROSE, "en", None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({c: F.lit("clash") for c in CLASHING})


@pytest.fixture(scope="session")
def small_docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def texts(small_docs):
    return {r.doc_id: r.text or "" for r in small_docs.collect()}
