"""Lexicon-based sentiment of sentences.

Dictionaries are joined without a broadcast hint: Spark broadcasts one whose
known or measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and
otherwise shuffles, with adaptive skew splitting for frequent words.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomegauge.operators.sentences import sentence_tokens


def lemmatize(tokens: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Add the lemma of each word; an unknown word is its own.

    Of several lemmas for one form the first in order counts.
    """
    forms = lemmas.groupBy(F.col("form").alias("word")).agg(F.min("lemma").alias("_lemma"))
    return (
        tokens.join(forms, "word", "left")
        .withColumn("lemma", F.coalesce("_lemma", "word"))
        .drop("_lemma")
    )


def _signed(lexicon: DataFrame) -> DataFrame:
    """``lemma, _polarity`` of the listed words: 1, -1, or 0 in both lists."""
    return (
        lexicon.where(F.col("label").isin("positive", "negative"))
        .groupBy(F.col("word").alias("lemma"))
        .agg(
            (
                F.max(F.when(F.col("label") == "positive", 1).otherwise(0))
                - F.max(F.when(F.col("label") == "negative", 1).otherwise(0))
            ).alias("_polarity")
        )
    )


def label_lemmas(lemmatized: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Add ``polarity`` of each lemma: 1, -1, or 0 if unlisted or in both lists."""
    return (
        lemmatized.join(_signed(lexicon), "lemma", "left")
        .withColumn("polarity", F.coalesce("_polarity", F.lit(0)))
        .drop("_polarity")
    )


def polar_words(lemmas: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``word, polarity`` of all words that count: forms of a polar lemma, and polar words that are no form.

    Follows from the two dictionaries alone, so no occurrence of a word meets them.
    """
    polar = _signed(lexicon).where(F.col("_polarity") != 0)
    forms = lemmas.groupBy(F.col("form").alias("word")).agg(F.min("lemma").alias("lemma")).where(F.col("word").isNotNull())
    own = polar.select(F.col("lemma").alias("word"), F.col("_polarity").alias("polarity")).join(forms, "word", "left_anti")
    return forms.join(polar, "lemma").select("word", F.col("_polarity").alias("polarity")).unionByName(own)


def sentence_sentiment(sentences: DataFrame, lemmas: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Score and label of every sentence, those without a word included.

    Occurrences meet the polar words only, once. Words and sentences meet in one grouping: the sentence itself adds a row
    with polarity 0, so no join back is needed to keep it.
    """
    words = sentence_tokens(sentences).select("fileName", "position", "word")
    polar = words.join(polar_words(lemmas, lexicon), "word").select("fileName", "position", "polarity")
    bare = sentences.select("fileName", "position", F.lit(0).alias("polarity"))
    score = F.col("score")
    return (
        bare.unionByName(polar)
        .groupBy("fileName", "position")
        .agg(F.sum("polarity").alias("score"))
        .withColumn(
            "sentiment",
            F.when(score > 0, "positive").when(score < 0, "negative").otherwise("neutral"),
        )
    )
