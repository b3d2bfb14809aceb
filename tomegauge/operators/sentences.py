"""The sentence table: one row per sentence, straight from the books, map-only."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomegauge.functions import text
from tomegauge.schemas import SENTENCE_COLUMNS


def explode_once(rows: DataFrame, array: str, position: str, value: str) -> DataFrame:
    """``posexplode`` of a costly array column, which is replaced by its elements.

    For a plain explode the optimizer infers that the array is not empty and
    pushes that test towards the scan, where it evaluates the array a second
    time, before any repartitioning. The outer form has no such test; the row it
    makes for an empty array is dropped again.
    """
    kept = [column for column in rows.columns if column != array]
    return rows.select(*kept, F.posexplode_outer(array).alias(position, value)).where(
        F.col(position).isNotNull()
    )


def split_books(books: DataFrame, abbreviations: Sequence[str] = ()) -> DataFrame:
    """``books(fileName, rawDocument)`` → one row per sentence with its 0-based position.

    The book text ends here; only the sentence goes on. A book without a
    sentence has no row.
    """
    arrays = books.select(
        "fileName",
        text.sentence_array("rawDocument", abbreviations).alias("_sentences"),
    ).select("fileName", "_sentences", F.size("_sentences").alias("numSentencesInBook"))
    return explode_once(arrays, "_sentences", "position", "sentenceText").select(
        "fileName", "position", "sentenceText", "numSentencesInBook"
    )


def chunk_books(books: DataFrame, size: int) -> DataFrame:
    """``books`` → ``fileName, chunk, rawDocument``: texts cut at white space after ``size`` characters."""
    cut = books.select("fileName", text.chunks("rawDocument", size).alias("_chunks"))
    return explode_once(cut, "_chunks", "chunk", "rawDocument")


def split_chunks(chunks: DataFrame, abbreviations: Sequence[str] = ()) -> DataFrame:
    """``split_books`` of books that come in chunks, so that one book is cut by many tasks.

    ``chunks(fileName, chunk, rawDocument)``: the texts of a book's chunks, in order of ``chunk``, make
    up the book; a chunk ends where white space or the book ends. Sentence ends within a chunk are those of
    the book. What a chunk leaves open is stitched to what the next ones begin with. Positions
    are the sums of the sentences that begin in earlier chunks, from one narrow row per chunk; only
    the pieces at chunk ends are grouped. An abbreviation must not hold white space.
    """
    if any(set(a) & set(text.WHITE_SPACE) for a in abbreviations):
        raise ValueError("an abbreviation with white space might be cut by a chunk")
    whole = F.col("rawDocument")
    before = Window.partitionBy("fileName").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("fileName").orderBy("chunk").rowsBetween(1, Window.unboundedFollowing)
    book = Window.partitionBy("fileName")
    counts = chunks.select(
        "fileName", "chunk", text.sentence_count(whole, abbreviations).alias("_pieces"), text.ends_open(whole, abbreviations).alias("_open")
    )
    goes_on = F.last(F.when(F.col("_pieces") > 0, F.col("_open")), ignorenulls=True).over(before)
    counts = counts.withColumn("_goesOn", F.coalesce(goes_on, F.lit(False)))
    begun = F.col("_pieces") - ((F.col("_pieces") > 0) & F.col("_goesOn")).cast("int")
    counts = counts.withColumns(
        {
            "_first": F.coalesce(F.sum(begun).over(before), F.lit(0)),
            "numSentencesInBook": F.sum(begun).over(book).cast("int"),
            "_more": F.coalesce(F.max("_pieces").over(after), F.lit(0)) > 0,
        }
    )
    pieces = chunks.join(counts, ["fileName", "chunk"]).select(
        "fileName", "chunk", "_first", "_goesOn", "numSentencesInBook",
        F.when(F.col("_pieces") == 0, F.array(whole)).otherwise(text.sentence_array(whole, abbreviations)).alias("_parts"),
        (F.col("_pieces") == 0).alias("_blank"),
        F.when(F.col("_open") & F.col("_more"), F.col("_pieces") - 1).otherwise(-1).alias("_openPart"),
        F.when(F.col("_pieces") > 0, text.space_before(whole)).alias("_lead"),
        F.when(F.col("_pieces") > 0, text.space_after(whole)).alias("_trail"),
    )
    pieces = explode_once(pieces, "_parts", "_place", "sentenceText")
    place, continues = F.col("_place"), (F.col("_place") == 0) & F.col("_goesOn")
    pieces = pieces.where(~F.col("_blank") | F.col("_goesOn")).select(
        "fileName", "chunk", (F.col("_first") + place - F.col("_goesOn").cast("int")).cast("int").alias("position"),
        F.concat(F.when(continues & ~F.col("_blank"), F.col("_lead")).otherwise(""), "sentenceText",
                 F.when(place == F.col("_openPart"), F.col("_trail")).otherwise("")).alias("sentenceText"),
        "numSentencesInBook", (continues | (place == F.col("_openPart"))).alias("_seam"),
    )
    closed = pieces.where(~F.col("_seam")).select("fileName", "position", "sentenceText", "numSentencesInBook")
    parts = F.array_sort(F.collect_list(F.struct("chunk", "sentenceText")))["sentenceText"]
    stitched = pieces.where("_seam").groupBy("fileName", "position", "numSentencesInBook").agg(
        F.trim(F.array_join(parts, ""), F.lit(text.WHITE_SPACE)).alias("sentenceText")
    )
    return closed.unionByName(stitched)


def count_words(sentences: DataFrame, min_syllables: int = text.MULTI_SYLLABLE_FROM) -> DataFrame:
    """Add the word counts of each sentence."""
    return sentences.withColumns(
        {
            "multiSyllableCount": text.multi_syllable_count("sentenceText", min_syllables),
            "numWordsInSentence": text.word_count("sentenceText"),
        }
    )


def sentence_table(
    books: DataFrame,
    min_syllables: int = text.MULTI_SYLLABLE_FROM,
    abbreviations: Sequence[str] = (),
) -> DataFrame:
    """The fact table all questions are asked of."""
    return (
        books.transform(split_books, abbreviations)
        .transform(count_words, min_syllables)
        .select(*SENTENCE_COLUMNS)
    )


def chunked_sentence_table(
    chunks: DataFrame,
    min_syllables: int = text.MULTI_SYLLABLE_FROM,
    abbreviations: Sequence[str] = (),
) -> DataFrame:
    """The same from books in chunks (see ``split_chunks``)."""
    return (
        chunks.transform(split_chunks, abbreviations)
        .transform(count_words, min_syllables)
        .select(*SENTENCE_COLUMNS)
    )


def sentence_id() -> Column:
    """The key ``(fileName, position)`` as one string.

    A 64-bit hash would collide at corpus scale, and a running number depends on
    the partitioning; either would let a reload replace unrelated sentences.
    """
    return F.concat_ws("#", "fileName", "position")


def word_counts(sentences: DataFrame) -> DataFrame:
    """``word, occurrences``: words are counted before anything is joined to them, so a frequent one is one row."""
    return sentence_tokens(sentences).groupBy("word").agg(F.count(F.lit(1)).alias("occurrences"))


def sentence_tokens(sentences: DataFrame, unicode: bool = False) -> DataFrame:
    """One row per word: ``fileName, position, wordPosition, word``."""
    words = sentences.select("fileName", "position", text.tokens("sentenceText", unicode).alias("_words"))
    return explode_once(words, "_words", "wordPosition", "word")
