"""Tables at rest: corpora in Parquet, the sentence table, JSON documents."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomegauge.functions import text
from tomegauge.operators.documents import parse_index_documents
from tomegauge.schemas import SENTENCE_COLUMNS
from tomegauge.session import spread
from tomegauge.sinks.keyed import in_bucket_of


def corpus_documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def corpus_labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def document_name():
    return F.concat(F.lit("txt/"), F.col("doc_id"), F.lit(".txt"))


def document_books(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as books; few large files are shared out over the cores."""
    raw = corpus_documents(spark, folder).select("doc_id", "text")
    return spread(raw, "doc_id").select(
        document_name().alias("fileName"),
        text.newlines_to_spaces("text").alias("rawDocument"),
    )


def conversation_books(spark: SparkSession, folder: str) -> DataFrame:
    """Each turn of a conversation as a book."""
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "text")
    return spread(turns, "conv_id", "turn").select(
        F.concat(F.lit("chat/"), F.col("conv_id"), F.lit("/"), F.col("turn"), F.lit(".txt")).alias("fileName"),
        text.newlines_to_spaces("text").alias("rawDocument"),
    )


def document_genres(spark: SparkSession, folder: str, genre: str = "source") -> DataFrame:
    """``fileName, genre`` of the documents, from their ``source`` or ``lang``."""
    return corpus_documents(spark, folder).select(document_name().alias("fileName"), F.col(genre).alias("genre"))


def flagged_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``fileName`` of the documents labelled toxic; an unlabelled one is not flagged."""
    return corpus_labels(spark, folder).where(F.col("toxic") == 1).select(document_name().alias("fileName"))


def read_sentences(spark: SparkSession, path: str) -> DataFrame:
    """The sentence table as ``sinks.keyed`` wrote it."""
    return spark.read.parquet(path).select(*SENTENCE_COLUMNS)


def read_book(spark: SparkSession, path: str, file_name: str) -> DataFrame:
    """The sentences of one book from that table; only its bucket is opened."""
    wanted = in_bucket_of(file_name) & (F.col("fileName") == file_name)
    return spark.read.parquet(path).where(wanted).select(*SENTENCE_COLUMNS)


def read_index_documents(spark: SparkSession, path: str) -> DataFrame:
    """Sentence rows from a table of JSON documents."""
    return parse_index_documents(spark.read.parquet(path).select("value"))
