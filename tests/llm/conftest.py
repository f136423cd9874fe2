import duckdb
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def truth():
    """(doc_id, text, lang, source) of the smallest documents."""
    return duckdb.sql(f"select doc_id, text, lang, source from '{SF}/documents.parquet' order by doc_id").fetchall()


LONG = "the quick brown fox jumps over a lazy dog near río año été " * 4000
ODD = [
    (1, None, "en", "a"),
    (2, "", None, None),
    (3, "The same words, again and again.", "en", "a"),
    (4, "The same words, again and again.", "en", "a"),
    (4, "The same words, again and again.", "en", "a"),
    (5, LONG, "en", "a"),
    (6, " \n\t ", "en", None),
    (7, "1234 !!", None, "b"),
    (None, "A row without an id.", "en", "b"),
    (None, None, None, None),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty, blank and very long texts, repeated rows, and extra columns with names that operators use."""
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string")
    names = ["n_chars", "h", "fp", "key", "kept", "row", "score", "size", "value", "component_id", "ids", "decoded", "_id"]
    return df.select("*", *(F.lit(i).alias(n) for i, n in enumerate(names))).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("false")


@pytest.fixture(scope="session")
def got():
    """Rows of a frame as dictionaries, by doc_id."""

    def collect(df):
        rows = [r.asDict(recursive=True) for r in df.collect()]
        return sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))

    return collect
