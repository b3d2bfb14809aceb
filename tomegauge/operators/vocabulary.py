"""Questions that look at single words: difficulty lists, flagged words, replacements."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tomegauge.functions import grades, text
from tomegauge.operators.running import running_total
from tomegauge.operators.scores import graded, sentence_counts, text_totals
from tomegauge.operators.sentences import explode_once, sentence_tokens

HEAD_CHARACTERS = 3

# Stand for totals among the words of a book; no token is empty or blank.
SENTENCES, MULTI_SYLLABLES = "", " "

# The collocation statistic of Kiss and Strunk (2006) for abbreviations.
ABBREVIATION_CERTAINTY = 0.99
ABBREVIATION_SCORE = 0.3


def difficult_words(sentences: DataFrame, easy_words: DataFrame) -> DataFrame:
    """Words per book that are not in ``easy_words(word)``."""
    return (
        sentence_tokens(sentences)
        .join(easy_words.select("word"), "word", "left_anti")
        .groupBy("fileName")
        .agg(F.count(F.lit(1)).alias("difficult"))
    )


def dale_chall_scores(sentences: DataFrame, easy_words: DataFrame) -> DataFrame:
    """Dale-Chall score per book for a given list of easy words."""
    totals = sentences.groupBy("fileName").agg(
        F.count(F.lit(1)).alias("doc_count"),
        F.sum("numWordsInSentence").alias("words"),
    )
    return _with_dale_chall(totals, difficult_words(sentences, easy_words))


def _with_dale_chall(totals: DataFrame, difficult: DataFrame) -> DataFrame:
    return (
        totals.join(difficult, "fileName", "left")
        .withColumn("difficult", F.coalesce("difficult", F.lit(0)))
        .withColumn("dale_chall", grades.dale_chall(F.col("difficult"), F.col("words"), F.col("doc_count")))
    )


def compare_formulae(sentences: DataFrame, easy_words: DataFrame) -> DataFrame:
    """All formulae side by side per book, and how far SMOG lies above the Flesch grade."""
    words, count, syllables = F.col("words"), F.col("doc_count"), F.col("syllables")
    return _with_dale_chall(text_totals(sentences), difficult_words(sentences, easy_words)).select(
        "fileName",
        grades.smog(F.col("sum_multiSyllables"), count).alias("smog"),
        grades.reading_ease(words, count, syllables).alias("reading_ease"),
        grades.flesch_grade(words, count, syllables).alias("flesch_grade"),
        "dale_chall",
        F.round(
            grades.smog(F.col("sum_multiSyllables"), count) - grades.flesch_grade(words, count, syllables), 2
        ).alias("smog_minus_flesch"),
    )


def rank_scores(scores: DataFrame) -> DataFrame:
    """Rank each book under each formula: ``fileName, formula, score`` gains ``rank``.

    Hardest first, ties share a rank. Scores have two decimals, so the books are
    counted per distinct score and a running total over those counts gives the
    rank; the books themselves are never sorted.
    """
    counts = (
        scores.groupBy("formula", "score")
        .agg(F.count(F.lit(1)).alias("_books"))
        .withColumn("_grade", F.floor("score"))
    )
    ranks = running_total(
        counts,
        keys=["formula"],
        buckets=[("_grade", F.desc("_grade"))],
        order=[F.desc("score")],
        value="_books",
        name="_above",
    ).select("formula", "score", (F.col("_above") + 1).alias("rank"))
    return scores.join(ranks, ["formula", "score"]).select("fileName", "formula", "score", "rank")


def formula_ranks(sentences: DataFrame, easy_words: DataFrame) -> DataFrame:
    """Rank of each book under each formula, one row per book and formula."""
    return (
        compare_formulae(sentences, easy_words)
        .unpivot("fileName", ["smog", "flesch_grade", "dale_chall"], "formula", "score")
        .where(F.col("score").isNotNull())
        .transform(rank_scores)
    )


def formula_correlations(sentences: DataFrame, easy_words: DataFrame) -> DataFrame:
    """Correlation between the formulae over all books, one row."""
    return compare_formulae(sentences, easy_words).agg(
        F.count(F.lit(1)).alias("books"),
        F.round(F.corr("smog", "flesch_grade"), 4).alias("smog_flesch"),
        F.round(F.corr("smog", "dale_chall"), 4).alias("smog_dale_chall"),
        F.round(F.corr("flesch_grade", "dale_chall"), 4).alias("flesch_dale_chall"),
    )


def charged_share(sentences: DataFrame, flagged_words: DataFrame) -> DataFrame:
    """Share of each book's sentences with a word of ``flagged_words(word)``.

    Only sentences with such a word are told apart; all others are just counted per book.
    """
    hits = (
        sentence_tokens(sentences)
        .join(flagged_words.select("word"), "word", "left_semi")
        .select("fileName", "position")
        .distinct()
        .groupBy("fileName")
        .agg(F.count(F.lit(1)).alias("charged_sentences"))
    )
    charged = F.coalesce("charged_sentences", F.lit(0))
    return (
        sentence_counts(sentences)
        .join(hits, "fileName", "left")
        .select(
            "fileName",
            "doc_count",
            charged.alias("charged_sentences"),
            F.round(charged / F.col("doc_count"), 4).alias("charged_share"),
        )
    )


def words_to_replace(
    sentences: DataFrame,
    levels: float,
    min_sentences: int = 1,
) -> DataFrame:
    """The words to replace in each book to move its grade by ``levels``.

    Down (``levels`` < 0): multi-syllable words, most frequent first, until the
    occurrences cover what must go. Up: the same over the other words. ``needed``
    is the number of occurrences to change, ``before`` those of the words listed
    ahead of this one. ``min_sentences=30`` answers only for books long enough for the published grade.
    """
    count, multi = F.col("doc_count"), F.col("sum_multiSyllables")
    target = grades.multi_syllables_for(grades.smog_exact(multi, count) + float(levels), count)
    missing = multi - target if levels < 0 else target - multi
    # The totals of a book are counted with its words, as two words that no text holds, so that its sentences are cut once.
    tokens = F.coalesce(text.tokens_by_flag("sentenceText", 1 if levels < 0 else 0), F.array().cast("array<string>"))
    candidates = sentences.select(
        "fileName", "multiSyllableCount", F.concat(tokens, F.array(F.lit(SENTENCES), F.lit(MULTI_SYLLABLES))).alias("_words")
    )
    counted = (
        explode_once(candidates, "_words", "_place", "word")
        .groupBy("fileName", "word")
        .agg(
            F.sum(F.when(F.col("word") == MULTI_SYLLABLES, F.col("multiSyllableCount")).otherwise(1)).alias("occurrences"),
            # Found by the grouping: a test on the word itself would be moved before it, and the words be counted once for each use.
            F.max(F.col("word").isin(SENTENCES, MULTI_SYLLABLES)).alias("_total"),
        )
    )
    totals = counted.where("_total").groupBy("fileName").agg(
        F.max(F.when(F.col("word") == SENTENCES, F.col("occurrences"))).alias("doc_count"),
        F.max(F.when(F.col("word") == MULTI_SYLLABLES, F.col("occurrences"))).alias("sum_multiSyllables"),
    )
    needs = (
        graded(totals, min_sentences)
        .select("fileName", F.ceil(missing).alias("needed"))
        .where(F.col("needed") > 0)
    )
    # The head is never NULL, and known as such: a NULL test on one side of the coming join would keep Spark
    # from counting the words once for both sides.
    words = counted.where(~F.col("_total")).select(
        "fileName", "word", "occurrences", F.coalesce(F.substring("word", 1, HEAD_CHARACTERS), F.lit("")).alias("head")
    )
    return (
        running_total(
            words,
            keys=["fileName"],
            buckets=[("occurrences", F.desc("occurrences")), ("head", F.asc("head"))],
            order=[F.asc("word")],
            value="occurrences",
            name="before",
            narrow=lambda starts: starts.join(needs, "fileName").where(F.col("bucket_start") < F.col("needed")),
        )
        .where(F.col("before") < F.col("needed"))
        .select("fileName", "word", "occurrences", "before", "needed")
    )


def _log_likelihood(hits: Column, trials: Column, share: Column) -> Column:
    return hits * F.log(share) + (trials - hits) * F.log(1.0 - share)


def learned_abbreviations(books: DataFrame, least: float = ABBREVIATION_SCORE) -> DataFrame:
    """Words that take a full stop far more often than words do: ``word, with_stop, without_stop, score``.

    A likelihood ratio tells whether a full stop belongs to the word; it counts less for longer words, more for words
    with stops inside, and much less if the word also occurs without. Words are of ASCII letters, between
    white space, in lower case. One grouping of single words and one row of corpus totals; nothing has to be labelled.
    """
    words = books.select(F.regexp_extract_all(F.lower("rawDocument"), F.lit(r"\S++"), F.lit(0)).alias("_words"))
    words = explode_once(words, "_words", "_place", "_word").where(F.col("_word").rlike(r"\A[a-z]+(\.[a-z]+)*\.?\z"))
    stop = F.col("_word").endswith(".")
    counts = words.groupBy(F.rtrim("_word", F.lit(".")).alias("word")).agg(
        F.count_if(stop).alias("with_stop"), F.count_if(~stop).alias("without_stop")
    )
    totals = counts.agg(F.struct(F.sum("with_stop").alias("stops"), F.sum(F.col("with_stop") + F.col("without_stop")).alias("words"))).scalar()
    hits, trials = F.col("with_stop").cast("double"), (F.col("with_stop") + F.col("without_stop")).cast("double")
    ratio = 2.0 * (_log_likelihood(hits, trials, F.lit(ABBREVIATION_CERTAINTY)) - _log_likelihood(hits, trials, totals["stops"] / totals["words"]))
    inside = F.length("word") - F.length(F.replace("word", F.lit("."), F.lit("")))
    letters = (F.length("word") - inside).cast("double")
    score = ratio * F.exp(-letters) * (inside + 1) * F.pow(letters, -F.col("without_stop").cast("double"))
    # A share of one leaves nothing to tell apart.
    found = counts.where((F.col("with_stop") > 0) & (totals["stops"] < totals["words"])).withColumn("score", F.round(score, 4))
    return found.where(F.col("score") >= least)
