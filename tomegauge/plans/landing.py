"""Files and tables that queries over file sources read, derived from the given tables.

They are written once per session and corpus, in the shared scratch folder.
"""

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomegauge.functions import text
from tomegauge.operators import documents, search
from tomegauge.operators.sentences import sentence_table
from tomegauge.plans.load import KEY, load_books, load_new_books
from tomegauge.session import scratch_path
from tomegauge.sinks import files, keyed, totals
from tomegauge.sources import books, tables

INDEX_BUCKETS = 16
TABLE_BUCKETS = 8
#: Small, so that passages of the test tables cross chunks.
RUNNING_CHUNK = 16

_written: dict[tuple[str, str, str], str] = {}


def _once(write: Callable[[SparkSession, str, str], None]) -> Callable[[SparkSession, str], str]:
    @wraps(write)
    def path_of(spark: SparkSession, folder: str) -> str:
        key = (spark.sparkContext.applicationId, folder, write.__name__)
        if key not in _written:
            path = scratch_path(spark, write.__name__)
            write(spark, folder, path)
            _written[key] = path
        return _written[key]

    return path_of


def sentences(spark: SparkSession, folder: str) -> DataFrame:
    return sentence_table(tables.document_books(spark, folder))


def conversation_sentences(spark: SparkSession, folder: str) -> DataFrame:
    return sentence_table(tables.conversation_books(spark, folder))


@_once
def book_files(spark: SparkSession, folder: str, path: str) -> None:
    """One text file per document, as the file sources expect them."""
    files.write_listed_files(tables.corpus_documents(spark, folder), path, "doc_id", "text")


@_once
def sentence_store(spark: SparkSession, folder: str, path: str) -> None:
    keyed.create_keyed(sentences(spark, folder), path, KEY, TABLE_BUCKETS, unique=True)


@_once
def reloaded_store(spark: SparkSession, folder: str, path: str) -> None:
    """The sentence table after a second load replaced some sentences and added others."""
    keyed.create_keyed(sentences(spark, folder), path, KEY, TABLE_BUCKETS)
    keyed.merge_keyed(spark, path, second_load(spark, folder), KEY)


@_once
def shortened_store(spark: SparkSession, folder: str, path: str) -> None:
    """The sentence table after the flagged documents were loaded again with less text."""
    keyed.create_keyed(sentences(spark, folder), path, KEY, TABLE_BUCKETS, unique=True)
    flagged = tables.flagged_documents(spark, folder)
    cut = F.substring("rawDocument", 1, 200).alias("rawDocument")
    books_ = tables.document_books(spark, folder).join(flagged, "fileName", "left_semi").select("fileName", cut)
    keyed.merge_keyed(spark, path, sentence_table(books_), KEY, books_.select("fileName"), unique=True)


@_once
def maintained_store(spark: SparkSession, folder: str, path: str) -> None:
    """The table of ``shortened_store`` with its totals, which the second load brought up to date."""
    keyed.create_keyed(sentences(spark, folder), path, KEY, TABLE_BUCKETS, unique=True)
    totals.refresh(spark, path, size=RUNNING_CHUNK)
    flagged = tables.flagged_documents(spark, folder)
    cut = F.substring("rawDocument", 1, 200).alias("rawDocument")
    books_ = tables.document_books(spark, folder).join(flagged, "fileName", "left_semi").select("fileName", cut)
    touched = keyed.merge_keyed(spark, path, sentence_table(books_), KEY, books_.select("fileName"), unique=True)
    totals.refresh(spark, path, touched, RUNNING_CHUNK)


@_once
def refilled_store(spark: SparkSession, folder: str, path: str) -> None:
    """A keyed table that was reset and then loaded, twice."""
    table = sentences(spark, folder)
    keyed.create_keyed(table, path, KEY, TABLE_BUCKETS, unique=True)
    files.reset_table(spark, path, table.schema)
    for _ in range(2):
        keyed.merge_keyed(spark, path, conversation_sentences(spark, folder), KEY)


@_once
def repeated_store(spark: SparkSession, folder: str, path: str) -> None:
    """A first load in which the flagged documents come twice, once counted from three syllables up."""
    flagged = tables.flagged_documents(spark, folder)
    again = sentence_table(tables.document_books(spark, folder).join(flagged, "fileName", "left_semi"), min_syllables=3)
    keyed.create_keyed(sentences(spark, folder).unionByName(again), path, KEY, TABLE_BUCKETS)


def second_load(spark: SparkSession, folder: str) -> DataFrame:
    """Flagged documents counted from three syllables up, and the conversations."""
    flagged = tables.flagged_documents(spark, folder)
    recounted = tables.document_books(spark, folder).join(flagged, "fileName", "left_semi")
    return sentence_table(recounted, min_syllables=3).unionByName(conversation_sentences(spark, folder))


@_once
def document_store(spark: SparkSession, folder: str, path: str) -> None:
    """JSON documents under ``doc_id``: facts about the documents, then their labels in their place."""
    facts = tables.corpus_documents(spark, folder).select("doc_id", "lang", "source")
    labels = tables.corpus_labels(spark, folder).select("doc_id", "quality", "toxic")
    keyed.create_keyed(documents.keyed_documents(facts, "doc_id"), path, ["doc_id"], TABLE_BUCKETS)
    keyed.merge_keyed(spark, path, documents.keyed_documents(labels, "doc_id"), ["doc_id"])


@_once
def json_store(spark: SparkSession, folder: str, path: str) -> None:
    documents.index_documents(sentences(spark, folder)).write.parquet(path)


@_once
def search_index(spark: SparkSession, folder: str, path: str) -> None:
    store = spark.read.parquet(sentence_store(spark, folder))
    search.write_index(store, path, INDEX_BUCKETS)


@_once
def small_block_index(spark: SparkSession, folder: str, path: str) -> None:
    """An index with so small blocks that even the smallest test table has enough of them to skip some."""
    search.write_index(spark.read.parquet(sentence_store(spark, folder)), path, INDEX_BUCKETS, block_sentences=32)


def labelled_words(spark: SparkSession, folder: str, label: str) -> DataFrame:
    """The distinct Unicode tokens of the documents with a label set."""
    labels = tables.corpus_labels(spark, folder).where(F.col(label) == 1).select("doc_id")
    raw = tables.corpus_documents(spark, folder).select("doc_id", "text").join(labels, "doc_id", "left_semi")
    return raw.select(F.explode_outer(text.tokens("text", unicode=True)).alias("word")).dropna().distinct()


def _write_words(words: DataFrame, path: str) -> None:
    words.write.option("encoding", "ISO-8859-1").option("quote", "").csv(path)


@_once
def negative_words(spark: SparkSession, folder: str, path: str) -> None:
    _write_words(labelled_words(spark, folder, "toxic"), path)


@_once
def positive_words(spark: SparkSession, folder: str, path: str) -> None:
    _write_words(labelled_words(spark, folder, "quality"), path)


def word_forms(spark: SparkSession, folder: str) -> DataFrame:
    """``form, lemma`` of the corpus: words less an ``ing``, ``ed`` or ``s``."""
    words = (
        tables.document_books(spark, folder)
        .select(F.explode_outer(text.tokens("rawDocument")).alias("form"))
        .dropna()
        .distinct()
    )
    endings = F.when(F.col("form").endswith("ing"), 3).when(F.col("form").endswith("ed"), 2)
    cut = endings.when(F.col("form").endswith("s"), 1).otherwise(0)
    lemma = F.substring(F.col("form"), F.lit(1), F.length("form") - cut)
    return words.select("form", lemma.alias("lemma"), cut.alias("cut")).where("cut > 0 and lemma <> ''").drop("cut")


@_once
def lemma_file(spark: SparkSession, folder: str, path: str) -> None:
    forms = F.array_join(F.array_sort(F.collect_set("form")), "\t")
    lines = word_forms(spark, folder).groupBy("lemma").agg(forms.alias("forms"))
    files.write_lines(lines.select(F.concat("lemma", F.lit(" -> "), "forms").alias("value")), path)


@_once
def lexicon_file(spark: SparkSession, folder: str, path: str) -> None:
    """The lexicon written twice, as a repeated run would."""
    lexicon = documents.label_words(
        [(name, labelled_words(spark, folder, label)) for name, label in (("negative", "toxic"), ("positive", "quality"))]
    )
    files.write_lexicon(lexicon, path)
    files.write_lexicon(lexicon.unionByName(lexicon), path, distinct=True)


@_once
def line_files(spark: SparkSession, folder: str, path: str) -> None:
    lines = sentences(spark, folder).select("sentenceText")
    files.write_lines(lines, path)
    files.write_lines(lines, path)


@_once
def response_file(spark: SparkSession, folder: str, path: str) -> None:
    files.write_json(documents.sentences_by_name(sentences(spark, folder), "10"), path)


@_once
def reset_store(spark: SparkSession, folder: str, path: str) -> None:
    """A table that held the documents, reset, then loaded with the conversations."""
    table = sentences(spark, folder)
    table.write.parquet(path)
    files.reset_table(spark, path, table.schema)
    conversation_sentences(spark, folder).write.mode("append").parquet(path)


@_once
def loaded_store(spark: SparkSession, folder: str, path: str) -> None:
    """A first batch of files, then all of them."""
    files_ = book_files(spark, folder)
    for limit in (25, None):
        load_books(spark, files_, path, limit, buckets=TABLE_BUCKETS)


@_once
def chunked_store(spark: SparkSession, folder: str, path: str) -> None:
    """All files in one load, of which those above two thousand bytes are read in chunks."""
    load_books(spark, book_files(spark, folder), path, buckets=TABLE_BUCKETS, large=2000)


@_once
def batched_store(spark: SparkSession, folder: str, path: str) -> None:
    """All files in three loads, each going on after the one before."""
    files_, last = book_files(spark, folder), None
    third = books.list_books(spark, files_, glob="*.txt").count() // 3 + 1
    for _ in range(3):
        last = load_books(spark, files_, path, third, buckets=TABLE_BUCKETS, after=last)


@_once
def manifest_store(spark: SparkSession, folder: str, path: str) -> None:
    """A first part of the files by the manifest, then those still new, then none."""
    files_ = book_files(spark, folder)
    for limit in (25, None, None):
        load_new_books(spark, files_, path, limit, buckets=TABLE_BUCKETS)


def document_id():
    """The document a file written by ``book_files`` holds."""
    return F.regexp_extract("fileName", r"doc_id=(\d+)[/.]", 1).cast("bigint").alias("doc_id")


def read_book_files(spark: SparkSession, folder: str, limit: int | None = None) -> DataFrame:
    return books.read_books(spark, book_files(spark, folder), limit, "*.txt")
