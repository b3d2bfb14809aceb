"""Scores per book, on the sentence table.

Each grouping reads two narrow columns and combines map-side, so what crosses
the network is about one row per book and task, whatever one book's share.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomegauge.functions import grades, text
from tomegauge.sinks import keyed


def sentence_counts(sentences: DataFrame) -> DataFrame:
    """Sentences per book."""
    return sentences.groupBy("fileName").agg(F.count(F.lit(1)).alias("doc_count"))


def corpus_totals(sentences: DataFrame) -> DataFrame:
    """Multi-syllable words and sentences of the whole corpus."""
    return sentences.agg(
        F.sum("multiSyllableCount").alias("sum_multiSyllables"),
        F.count(F.lit(1)).alias("sentenceCount"),
    )


def book_totals(sentences: DataFrame) -> DataFrame:
    """Sentences and multi-syllable words per book."""
    return sentences.groupBy("fileName").agg(
        F.count(F.lit(1)).alias("doc_count"),
        F.sum("multiSyllableCount").alias("sum_multiSyllables"),
    )


def book_scores(sentences: DataFrame, min_sentences: int = 1) -> DataFrame:
    """SMOG grade per book, of books with at least ``min_sentences``."""
    return graded(book_totals(sentences), min_sentences)


def graded(totals: DataFrame, min_sentences: int = 1) -> DataFrame:
    """The same from totals per book, such as those kept beside a stored table: no sentence is read."""
    if min_sentences > 1:
        totals = totals.where(F.col("doc_count") >= min_sentences)
    return totals.select("fileName", "doc_count", "sum_multiSyllables").withColumn(
        "smog", grades.smog(F.col("sum_multiSyllables"), F.col("doc_count"))
    )


def score_buckets(sentences: DataFrame, bucket_limit: int | None = None) -> DataFrame:
    """Scored books with the number of sentences in the books left out.

    ``bucket_limit`` keeps the books with most sentences, ties by name; by
    default none is left out.
    """
    scored = book_scores(sentences)
    if bucket_limit is None:
        return scored.withColumn("sum_other_doc_count", F.lit(0).cast("bigint"))
    kept = scored.orderBy(F.desc("doc_count"), "fileName").limit(bucket_limit)
    total = sentences.agg(F.count(F.lit(1)))
    kept_total = kept.agg(F.sum("doc_count"))
    return kept.withColumn("sum_other_doc_count", total.scalar() - kept_total.scalar())


def books_in_range(
    sentences: DataFrame,
    low: float | str,
    high: float | str,
    bucket_limit: int | None = None,
) -> DataFrame:
    """Books whose rounded grade lies in ``[low, high]``, both ends included."""
    return score_buckets(sentences, bucket_limit).where(F.col("smog").between(float(low), float(high)))


def kept_books_in_range(totals: DataFrame, low: float | str, high: float | str, min_sentences: int = 1) -> DataFrame:
    """``books_in_range`` from totals per book: one row per book is read, nothing is grouped."""
    return graded(totals, min_sentences).where(F.col("smog").between(float(low), float(high)))


def score_texts(books: DataFrame) -> DataFrame:
    """The grades of ``book_scores`` straight from whole texts, one row per book.

    No word crosses a sentence end, so the counts of the text are the sums over
    its sentences and nothing is shuffled. Empty books are dropped by a cheap test
    of their own: one on the count would make Spark count twice.
    """
    counted = books.where(text.has_sentence("rawDocument")).select(
        "fileName",
        F.size(text.sentence_array("rawDocument")).cast("bigint").alias("doc_count"),
        text.multi_syllable_count("rawDocument").cast("bigint").alias("sum_multiSyllables"),
    )
    return counted.withColumn("smog", grades.smog(F.col("sum_multiSyllables"), F.col("doc_count")))


def one_book(scores: DataFrame, file_name: str) -> DataFrame:
    """The row of one book. On ``book_scores`` the filter reaches the scan."""
    return scores.where(F.col("fileName") == file_name)


def score_of_book(sentences: DataFrame, file_name: str) -> DataFrame:
    """The grade of one book; of a stored table with its bucket columns one bucket is opened."""
    return book_scores(sentences.where(keyed.of_book(sentences, file_name)))


def books_of_genre(
    sentences: DataFrame,
    metadata: DataFrame,
    genre: str,
    low: float,
    high: float,
    limit: int | None = None,
) -> DataFrame:
    """Books of a genre with a grade in ``[low, high]``, hardest first.

    ``metadata(fileName, genre)`` has one row per book. It meets the scored
    books, not their sentences: the grouping has shrunk those to one row per book
    and placed them by the join key.
    """
    found = (
        books_in_range(sentences, low, high)
        .drop("sum_other_doc_count")
        .join(metadata.where(F.col("genre") == genre), "fileName")
    )
    return found if limit is None else found.orderBy(F.desc("smog"), "fileName").limit(limit)


def books_without_theme(sentences: DataFrame, flagged: DataFrame, low: float, high: float) -> DataFrame:
    """Books with a grade in ``[low, high]`` that are not in ``flagged(fileName)``."""
    return (
        books_in_range(sentences, low, high)
        .drop("sum_other_doc_count")
        .join(flagged.select("fileName"), "fileName", "left_anti")
    )


def text_totals(sentences: DataFrame) -> DataFrame:
    """The counts all formulae share, per book: sentences, words, syllables, multi-syllable words."""
    return sentences.groupBy("fileName").agg(
        F.count(F.lit(1)).alias("doc_count"),
        F.sum("numWordsInSentence").alias("words"),
        F.sum(text.syllable_count("sentenceText")).alias("syllables"),
        F.sum("multiSyllableCount").alias("sum_multiSyllables"),
    )


def flesch_scores(sentences: DataFrame) -> DataFrame:
    """Flesch reading ease and grade per book."""
    words, count, syllables = F.col("words"), F.col("doc_count"), F.col("syllables")
    return text_totals(sentences).select(
        "fileName",
        "doc_count",
        "words",
        "syllables",
        grades.reading_ease(words, count, syllables).alias("reading_ease"),
        grades.flesch_grade(words, count, syllables).alias("flesch_grade"),
    )
