"""Word lists, lexicon and lemma files."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomegauge.operators.documents import label_words
from tomegauge.schemas import LEXICON

# The formats of the dictionary files.
WORD_LIST_ENCODING = "ISO-8859-1"
LEMMA_ARROW = "->"
FORM_SEPARATOR = "\t"

_OUTER_SPACE = r"^[\s\x1c-\x1f\x85\xa0]+|[\s\x1c-\x1f\x85\xa0]+$"


def given_words(spark: SparkSession, words: Sequence[str]) -> DataFrame:
    """A short list given in code as a ``word`` table, made without a Python worker."""
    return spark.range(1).select(F.explode(F.array(*map(F.lit, words))).alias("word"))


def read_word_list(spark: SparkSession, path: str, encoding: str = WORD_LIST_ENCODING) -> DataFrame:
    """``word`` per line, outer white space stripped, blank and comment lines kept.

    The text source hands on the bytes of a line as they are, so they can be
    decoded here, line by line; its own ``encoding`` option is ignored, and the
    CSV source would drop blank lines.
    """
    line = F.decode(F.col("value").cast("binary"), encoding)
    return spark.read.text(path).select(F.regexp_replace(line, _OUTER_SPACE, "").alias("word"))


def build_lexicon(negative: DataFrame, positive: DataFrame) -> DataFrame:
    """One lexicon from two word lists, the negative words first in meaning, not in order."""
    return label_words([("negative", negative), ("positive", positive)])


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """``word, label`` from comma-separated lines."""
    return spark.read.schema(LEXICON).csv(path)


def read_lemmas(spark: SparkSession, path: str) -> DataFrame:
    """``form, lemma`` from lines ``lemma -> form TAB form ...``."""
    parts = spark.read.text(path).select(F.split("value", LEMMA_ARROW, 2).alias("_parts"))
    forms = F.explode(F.split(F.col("_parts")[1], FORM_SEPARATOR))
    return (
        parts.where(F.size("_parts") == 2)
        .select(F.trim(F.col("_parts")[0]).alias("lemma"), forms.alias("form"))
        .select(F.trim("form").alias("form"), "lemma")
        .where(F.col("form") != "")
    )
