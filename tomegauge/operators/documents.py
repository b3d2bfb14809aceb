"""Sentences as keyed JSON documents, look-ups by file name, unions of collections."""

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tomegauge.operators.scores import sentence_counts
from tomegauge.operators.sentences import sentence_id
from tomegauge.schemas import INDEX_DOCUMENT, SENTENCE_COLUMNS
from tomegauge.sinks import keyed

# Fixed value: the most documents one look-up returns.
LOOKUP_LIMIT = 10000


def index_documents(sentences: DataFrame) -> DataFrame:
    """``sentence_id, value``: the row as JSON, its key inside and beside it."""
    return keyed_documents(sentences.select(sentence_id().alias("sentence_id"), *SENTENCE_COLUMNS), "sentence_id")


def keyed_documents(rows: DataFrame, key: str) -> DataFrame:
    """``key, value``: any rows as JSON documents under one of their columns."""
    return rows.select(key, as_json("*").alias("value"))


def as_json(*columns: str):
    """The named columns as one JSON object."""
    return F.to_json(F.struct(*columns))


def json_rows(rows: DataFrame) -> DataFrame:
    """Rows as JSON objects, nothing else."""
    return rows.select(as_json("*").alias("value"))


def parse_index_documents(documents: DataFrame) -> DataFrame:
    """Back from JSON documents to sentence rows."""
    return documents.select(F.from_json("value", INDEX_DOCUMENT).alias("doc")).select("doc.*")


def first_sentences(sentences: DataFrame, limit: int = LOOKUP_LIMIT) -> DataFrame:
    """The first rows in key order.

    A plain top-k would send ``limit`` rows of every task to one. So the last
    book wanted is found first, from the sentences per book, of which no more
    than ``limit`` books matter; later books are then filtered out by name.
    """
    ahead = Window.orderBy("fileName").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        sentence_counts(sentences)
        .orderBy("fileName")
        .limit(limit)
        .withColumn("_ahead", F.coalesce(F.sum("doc_count").over(ahead), F.lit(0)))
        .where(F.col("_ahead") < limit)
        .agg(F.max("fileName"))
        .scalar()
    )
    return sentences.where(F.col("fileName") <= last).orderBy("fileName", "position").limit(limit)


def sentences_by_name(sentences: DataFrame, name: str, limit: int | None = None) -> DataFrame:
    """Sentences of the books whose name shares a word with ``name``: ``10`` and ``my/10`` find ``txt/10.txt``.

    The name asked for is cut as the names are, and any word of it may match; one
    without words finds nothing. ``limit`` keeps the first rows in key order; by default all are returned.
    """
    words = sorted({word for word in re.split(r"\W+", name.lower()) if word})
    if not words:
        return sentences.where(F.lit(False))
    named = F.arrays_overlap(F.split(F.lower("fileName"), r"\W+"), F.array(*[F.lit(word) for word in words]))
    found = sentences.where(named)
    return found if limit is None else first_sentences(found, limit)


def sentences_of_book(sentences: DataFrame, file_name: str) -> DataFrame:
    """All sentences of one book by its exact name; the filter reaches the scan.

    Of a stored table with its bucket columns only the bucket of the book is opened.
    """
    return sentences.where(keyed.of_book(sentences, file_name))


def preview(books: DataFrame, characters: int = 150, limit: int = 5) -> DataFrame:
    """The first characters of the first books in name order."""
    return (
        books.select("fileName", F.substring("rawDocument", 1, characters).alias("preview"))
        .orderBy("fileName")
        .limit(limit)
    )


def add_books(books: DataFrame, *others: DataFrame) -> DataFrame:
    """All books of several collections, copies kept."""
    return reduce(DataFrame.unionByName, others, books)


def add_shapes(*collections: DataFrame) -> DataFrame:
    """Documents of differing fields in one table, absent fields NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), collections)


def label_words(lists: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """One lexicon ``word, label`` from several labelled word lists."""
    return reduce(
        DataFrame.unionByName,
        [words.select("word", F.lit(label).alias("label")) for label, words in lists],
    )
