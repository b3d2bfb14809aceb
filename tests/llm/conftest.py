import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())])


#: Names that operators use themselves.
INNER = ["_id", "_hash", "_rows", "_group", "_size", "_tie", "_key", "_place", "_bucket", "_row", "_copy", "_own", "_range", "_part", "_from"]


@pytest.fixture(scope="session")
def inner_names():
    return INNER


@pytest.fixture(scope="session")
def make(spark):
    """A small documents table from (doc_id, text) or (doc_id, text, source) rows."""

    def build(*rows):
        return spark.createDataFrame([(*row, "src")[:3] for row in rows], DOCS)

    return build


@pytest.fixture(scope="session")
def odd(spark, make):
    """Nulls in every column, empty and blank texts, a long text, ties, repeated rows and columns with clashing names."""
    long_text = " ".join(f"w{k % 977}x{k}" for k in range(60_000))
    rows = [(1, None, "a"), (2, "", "a"), (3, "  \t\n", None), (None, "lone words without an id here", None), (4, long_text, "b"),
            (5, "same text for two rows of it", "b"), (5, "same text for two rows of it", "b"), (6, "same text for two rows of it", None),
            (5, "another text under an id that is taken", "b"), (7, "é ñ 漢字 \U0001f600 ß", "a")]
    docs = make(*rows)
    for name in ("size", "shard", "slot", "score", "predicted", "key", "node", "target", "n_chars", *INNER):
        docs = docs.selectExpr("*", f"'{name}' as {name}")
    return docs


@pytest.fixture(scope="session")
def empty(make):
    return make()


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {row.doc_id: row.text for row in documents.select("doc_id", "text").collect()}
