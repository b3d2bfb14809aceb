"""Hand-traced cases for cleaning, sentences, tokens and syllables, and random texts against plain Python."""

import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tomegauge.functions import text
from tomegauge.operators.sentences import sentence_tokens, split_books
from tomegauge.plans.catalog import TEST_BOOK
from tomegauge.schemas import BOOKS
from tomegauge.sources.books import clean_paths


def column(spark, values, expression):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", expression(F.col("v")).alias("r"))
    return [row.r for row in rows.orderBy("i").collect()]


def plain_syllables(word):
    runs = len(re.findall("[aeiouy]+", word))
    if len(word) > 2 and word.endswith("es") or len(word) > 1 and word.endswith("e"):
        runs -= 1
    return runs


def plain_tokens(sentence):
    return [token for token in re.split(r"[^a-z0-9_]", sentence.lower()) if token]


def plain_sentences(book):
    marked = re.sub(r"""([.!?]+["')\]]*)[ \t\n\x0b\f\r]+""", "\\1\0", book)
    return [s for s in (part.strip(" \t\n\x0b\f\r") for part in marked.split("\0")) if s]


def test_flags_of_words(spark):
    ones = ["reading", "readability", "any", "pleasant", "machinery", "however", "nobody", "repaired"]
    zeros = ["the", "cake", "table", "boxes", "es", "bees", "apes", "eye", "rhythm", "sky", "", "use", "case", "classes"]
    flags = column(spark, ones + zeros, text.multi_syllable_flag)
    assert flags == [1] * len(ones) + [0] * len(zeros)
    counts = column(spark, ones + zeros, text.multi_syllable_count)
    assert counts == flags


def test_tokens(spark):
    cases = ["Don't STOP, the_cat! Été naïve x2", "", "...", None]
    expected = [["don", "t", "stop", "the_cat", "t", "na", "ve", "x2"], [], [], None]
    assert column(spark, cases, text.tokens) == expected
    assert column(spark, cases[:1], lambda c: text.tokens(c, unicode=True)) == [
        ["don", "t", "stop", "the_cat", "été", "naïve", "x2"]
    ]


def test_raw_flags_keep_case_and_punctuation(spark):
    flags = column(spark, ["About models. Any  idea,", ""], text.multi_syllable_flags)
    # Upper-case vowels are none, and a full stop keeps the last e from being silent.
    assert flags == [[0, 1, 0, 0, 1], [0]]


def test_sentences(spark):
    cases = {
        'He said "No!" Then left.': ['He said "No!"', "Then left."],
        "Version 1.2 is out.Now": ["Version 1.2 is out.Now"],
        "What?!  (Yes.) [Done.] end": ["What?!", "(Yes.)", "[Done.]", "end"],
        "  \t lead and trail. \t ": ["lead and trail."],
        "... ! ?": ["...", "!", "?"],
        "Dr. Smith came.": ["Dr.", "Smith came."],
        "mark \x01 stays. ok": ["mark \x01 stays.", "ok"],
        "": [],
        "   ": [],
    }
    assert column(spark, cases, text.sentence_array) == list(cases.values())
    guarded = column(spark, ["Dr. Smith met Mrs. Doe. adr. x"], lambda c: text.sentence_array(c, ["Dr.", "Mrs"]))
    assert guarded == [["Dr. Smith met Mrs. Doe.", "adr.", "x"]]


def test_test_book(spark, book):
    raw = spark.createDataFrame([TEST_BOOK], "filepath string, rawDocument string")
    cleaned = clean_paths(raw).first()
    assert (cleaned.filepath, cleaned.fileName) == ("999999", "999999")
    rows = book(cleaned.rawDocument).orderBy("position").collect()
    assert [
        (r.position, r.sentenceText, r.numSentencesInBook, r.multiSyllableCount, r.numWordsInSentence) for r in rows
    ] == [
        (0, "A short walk is pleasant!", 3, 1, 5),
        (1, "The machinery,  however, deteriorated considerably.", 3, 4, 5),
        (2, "Nobody repaired it", 3, 2, 3),
    ]


def test_books_without_sentence_vanish(spark):
    books = spark.createDataFrame([("a", "One."), ("b", "  "), ("c", None), ("d", "")], BOOKS)
    assert [r.fileName for r in split_books(books).collect()] == ["a"]


def test_wordless_sentence_is_kept(book):
    row = book("... !").orderBy("position").first()
    assert (row.numWordsInSentence, row.multiSyllableCount) == (0, 0)


def test_too_few_syllables_is_refused():
    with pytest.raises(ValueError):
        text.multi_syllable_count("sentenceText", 1)


TEXTS = st.lists(
    st.text(alphabet=st.sampled_from(list("aeiouysbtE_7 .!?\"')]\n\té\x01-")), max_size=60), min_size=1, max_size=80
)


@settings(max_examples=8, deadline=None)
@given(TEXTS)
def test_random_texts(spark, cases):
    assert column(spark, cases, text.sentence_array) == [plain_sentences(c) for c in cases]
    assert column(spark, cases, text.tokens) == [plain_tokens(c) for c in cases]
    assert column(spark, cases, text.word_count) == [len(plain_tokens(c)) for c in cases]
    for least in (2, 3):
        flags = [[int(plain_syllables(t) >= least) for t in plain_tokens(c)] for c in cases]
        assert column(spark, cases, lambda c: text.multi_syllable_count(c, least)) == [sum(f) for f in flags]
        for flag in (0, 1):
            kept = [[t for t, f in zip(plain_tokens(c), fs) if f == flag] for c, fs in zip(cases, flags)]
            assert column(spark, cases, lambda c: text.tokens_by_flag(c, flag, least)) == kept
    runs = column(spark, cases, lambda c: F.transform(text.token_runs(c), lambda r: F.concat_ws("*", text.run_token(r), text.run_length(r))))
    assert runs == [[f"{t}*{n}" for t, n in sorted(Counter(plain_tokens(c)).items())] for c in cases]
    totals = [sum(max(1, plain_syllables(t)) for t in plain_tokens(c)) for c in cases]
    assert column(spark, cases, text.syllable_count) == totals


def test_short_forms_equal_word_by_word(sentences):
    """On the whole corpus: counts by one expression against counts over the token array."""
    words = text.tokens("sentenceText")
    wrong = sentences.where(
        (F.col("multiSyllableCount") != text.multi_syllable_words(words))
        | (F.col("numWordsInSentence") != F.size(words))
        | (
            text.syllable_count("sentenceText")
            != F.aggregate(F.transform(words, lambda w: text.syllables(w)), F.lit(0), lambda a, b: a + b)
        )
    )
    assert wrong.count() == 0


def test_positions_and_counts_agree(sentences):
    wrong = (
        sentences.groupBy("fileName")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("position").alias("first"),
            F.max("position").alias("last"),
            F.countDistinct("position").alias("distinct"),
            F.max("numSentencesInBook").alias("stated"),
        )
        .where("first <> 0 or last <> n - 1 or distinct <> n or stated <> n")
    )
    assert wrong.count() == 0
    words = sentence_tokens(sentences).count()
    assert words == sentences.agg(F.sum("numWordsInSentence")).first()[0]


@pytest.mark.parametrize("part", ["a.b", 'a."b!', "ab", "be ", "xz", "e", " ", "a. ", "."])
def test_very_long_texts(spark, part):
    """No expression recurses or backtracks, whatever fills the text."""
    n = 100_000
    row = (
        spark.range(1)
        .select(F.repeat(F.lit(part), n).alias("t"))
        .select(
            F.size(text.sentence_array("t")).alias("sentences"),
            F.size(text.sentence_array("t", ["a"])).alias("guarded"),
            F.size(text.tokens("t")).alias("tokens"),
            F.size(text.token_runs("t")).alias("runs"),
            F.size(text.tokens_by_flag("t", 0)).alias("short"),
            F.size(text.tokens_by_flag("t", 1)).alias("long"),
            text.syllable_count("t").alias("syllables"),
            text.word_count("t").alias("words"),
            text.multi_syllable_count("t").alias("multi"),
            text.has_any_term("t", ["zebra"]).alias("found"),
        )
        .first()
    )
    whole = part * n
    assert row.sentences == {"a. ": n, " ": 0}.get(part, 1)
    assert row.guarded == min(row.sentences, 1)
    assert row.tokens == row.words == row.short + row.long == len(plain_tokens(whole))
    assert row.runs == len(set(plain_tokens(whole)))
    assert row.multi == row.long and not row.found
    assert row.syllables == sum(max(1, plain_syllables(t)) for t in plain_tokens(whole))
