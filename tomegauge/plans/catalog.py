"""The registered queries: each reads whole tables, or files derived from them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tomegauge.functions import text
from tomegauge.operators import documents, passages, scores, search, sentences, sentiment, vocabulary
from tomegauge.plans import landing
from tomegauge.plans.landing import sentences as fact
from tomegauge.plans.load import manifest_path
from tomegauge.sinks import keyed, totals
from tomegauge.sources import books, dictionaries, manifest, tables
from tomegauge.stages import readability_stages

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries, shared with their SQL.
PHRASE = "the thing with tion"
RARE_PHRASE = "the thing"
UNICODE_PHRASE = "été el niño"
POSITIVE = ["for", "with", "and", "la", "der", "in", "tion"]
NEGATIVE = ["was", "of", "que", "von", "in", "est", "rewh"]
CHARGED = ["thing", "eau", "ciez", "verden", "rewh"]
LOW, HIGH = "9.5", "14.25"
FIRST, LAST = 30, 59
BOOK = "txt/10.txt"
GENRE = "src3"
TEST_BOOK = (
    "999999",
    "A short walk is pleasant! The machinery,\n\rhowever, deteriorated considerably. Nobody repaired it",
)

_queries: dict[str, Query] = {}


def query(build: Query) -> Query:
    _queries[build.__name__] = build
    return build


def queries() -> dict[str, Query]:
    return dict(_queries)


def lexicon(spark: SparkSession) -> DataFrame:
    return dictionaries.build_lexicon(
        dictionaries.given_words(spark, NEGATIVE), dictionaries.given_words(spark, POSITIVE)
    )


def easy_words(spark: SparkSession, folder: str) -> DataFrame:
    """The distinct words of the benchmark passages."""
    passages_ = spark.read.parquet(f"{folder}/benchmark.parquet")
    return passages_.select(F.explode_outer(text.tokens("text")).alias("word")).dropna().distinct()


# Text columns


@query
def newline_cleaning(spark, folder):
    return tables.document_books(spark, folder)


@query
def book_collection(spark, folder):
    """The test book and the corpus in one table, cleaned."""
    test_book = spark.createDataFrame([TEST_BOOK], "filepath string, rawDocument string")
    corpus = tables.corpus_documents(spark, folder).select(
        F.concat(F.lit("corpus/"), tables.document_name()).alias("filepath"), F.col("text").alias("rawDocument")
    )
    return books.clean_paths(documents.add_books(test_book, corpus))


@query
def base_names(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return pages.select("page_id", text.base_name("url").alias("name"))


@query
def sentence_segmentation(spark, folder):
    return sentences.split_books(tables.document_books(spark, folder))


@query
def guarded_segmentation(spark, folder):
    """Sentences of the conversations, where a full stop after some short words ends none."""
    return sentences.split_books(tables.conversation_books(spark, folder), abbreviations=("of", "the", "la"))


@query
def tokenization(spark, folder):
    words = text.tokens("sentenceText")
    return fact(spark, folder).select(
        "fileName", "position", F.array_join(words, " ").alias("words"), F.size(words).alias("numWordsInSentence")
    )


@query
def unicode_tokenization(spark, folder):
    words = text.tokens("sentenceText", unicode=True)
    return fact(spark, folder).select("fileName", "position", F.array_join(words, " ").alias("words"))


@query
def word_syllables(spark, folder):
    """Every distinct word with its occurrences, syllables and flag."""
    counted = sentences.word_counts(fact(spark, folder))
    return counted.select(
        "word",
        "occurrences",
        text.syllables("word").alias("syllables"),
        text.multi_syllable_flag("word").alias("flag"),
    )


@query
def raw_sentence_flags(spark, folder):
    flagged = fact(spark, folder).select("fileName", "position", text.multi_syllable_flags("sentenceText").alias("f"))
    return flagged.select(
        "fileName",
        "position",
        F.array_join(F.transform("f", lambda flag: flag.cast("string")), " ").alias("flags"),
        text.sum_of_flags("f").alias("multiSyllableCount"),
    )


@query
def token_array_counts(spark, folder):
    """Multi-syllable words from the token array, word by word, from two and from three syllables up."""
    cut = fact(spark, folder).select("fileName", "position", text.tokens("sentenceText").alias("words"))
    return cut.select(
        "fileName",
        "position",
        text.multi_syllable_words("words").alias("from_two"),
        text.multi_syllable_words("words", 3).alias("from_three"),
    )


@query
def sentence_counts_from_three(spark, folder):
    """The sentence table with words counted from three syllables up, as the published grade has it."""
    return sentences.sentence_table(tables.document_books(spark, folder), min_syllables=3)


# The sentence table and its documents


@query
def sentence_table(spark, folder):
    return fact(spark, folder)


@query
def conversation_sentence_table(spark, folder):
    return landing.conversation_sentences(spark, folder)


@query
def sentence_table_by_stages(spark, folder):
    """The sentence table through the ML pipeline surface."""
    raw = tables.document_books(spark, folder)
    return readability_stages().fit(raw).transform(raw)


@query
def sentence_keys(spark, folder):
    return fact(spark, folder).select(sentences.sentence_id().alias("sentence_id"), "fileName", "position")


@query
def index_documents(spark, folder):
    return documents.index_documents(fact(spark, folder))


@query
def json_sentences_by_name(spark, folder):
    return documents.json_rows(documents.sentences_by_name(fact(spark, folder), "10"))


@query
def sentences_by_name(spark, folder):
    return documents.sentences_by_name(fact(spark, folder), "10")


@query
def sentences_by_name_terms(spark, folder):
    """A name of several words, any of which may match."""
    return documents.sentences_by_name(fact(spark, folder), "txt/10")


@query
def sentences_of_book(spark, folder):
    return documents.sentences_of_book(fact(spark, folder), BOOK)


@query
def first_sentences(spark, folder):
    return documents.first_sentences(fact(spark, folder))


@query
def first_hundred_sentences(spark, folder):
    return documents.first_sentences(fact(spark, folder), 100)


@query
def corpus_preview(spark, folder):
    return documents.preview(tables.document_books(spark, folder))


@query
def differing_documents(spark, folder):
    """Documents whose fields differ, in one table."""
    raw = tables.corpus_documents(spark, folder)
    return documents.add_shapes(
        raw.select("doc_id", "lang"),
        raw.select("doc_id", F.col("source").alias("genre")),
        tables.corpus_labels(spark, folder).select("doc_id", "quality"),
    )


# Scores


@query
def sentence_counts(spark, folder):
    return scores.sentence_counts(fact(spark, folder))


@query
def corpus_totals(spark, folder):
    return scores.corpus_totals(fact(spark, folder))


@query
def book_totals(spark, folder):
    return scores.book_totals(fact(spark, folder))


@query
def book_scores(spark, folder):
    return scores.book_scores(fact(spark, folder))


@query
def book_scores_from_thirty(spark, folder):
    return scores.book_scores(fact(spark, folder), min_sentences=30)


@query
def book_scores_from_texts(spark, folder):
    return scores.score_texts(tables.document_books(spark, folder))


@query
def score_buckets(spark, folder):
    return scores.score_buckets(fact(spark, folder), bucket_limit=10)


@query
def books_in_range(spark, folder):
    return scores.books_in_range(fact(spark, folder), LOW, HIGH)


@query
def books_in_range_of_largest(spark, folder):
    """The range over the ten largest books only, as a truncated look-up answers."""
    return scores.books_in_range(fact(spark, folder), LOW, "15.9", bucket_limit=10)


@query
def score_of_book(spark, folder):
    return scores.one_book(scores.book_scores(fact(spark, folder)), BOOK)


@query
def score_of_passage(spark, folder):
    return passages.passage_score(fact(spark, folder), BOOK, 2, 9)


@query
def passage_scores(spark, folder):
    return passages.passage_scores(fact(spark, folder), FIRST, LAST)


@query
def block_scores(spark, folder):
    return passages.block_scores(fact(spark, folder))


@query
def block_distribution(spark, folder):
    return passages.block_distribution(fact(spark, folder))


@query
def block_histogram(spark, folder):
    return passages.block_histogram(fact(spark, folder))


@query
def rolling_scores(spark, folder):
    return passages.rolling_scores(fact(spark, folder))


@query
def block_changes(spark, folder):
    return passages.block_changes(fact(spark, folder))


@query
def genre_quantiles(spark, folder):
    """Quantiles of the block grades per genre, from sketches per book."""
    sketches = passages.grade_sketches(fact(spark, folder)).join(tables.document_genres(spark, folder), "fileName")
    return passages.sketch_quantiles(passages.merged_sketches(sketches, "genre"))


@query
def change_points(spark, folder):
    return passages.change_points(fact(spark, folder))


@query
def learned_abbreviations(spark, folder):
    return vocabulary.learned_abbreviations(tables.document_books(spark, folder))


@query
def book_trends(spark, folder):
    return passages.book_trends(fact(spark, folder))


@query
def books_of_genre(spark, folder):
    genres = tables.document_genres(spark, folder)
    return scores.books_of_genre(fact(spark, folder), genres, GENRE, 5, 15, limit=20)


@query
def books_of_language(spark, folder):
    genres = tables.document_genres(spark, folder, "lang")
    return scores.books_of_genre(fact(spark, folder), genres, "fr", 3, 30)


@query
def books_without_theme(spark, folder):
    return scores.books_without_theme(fact(spark, folder), tables.flagged_documents(spark, folder), 3, 400)


@query
def flesch_scores(spark, folder):
    return scores.flesch_scores(fact(spark, folder))


@query
def dale_chall_scores(spark, folder):
    return vocabulary.dale_chall_scores(fact(spark, folder), easy_words(spark, folder))


@query
def formulae_compared(spark, folder):
    return vocabulary.compare_formulae(fact(spark, folder), easy_words(spark, folder))


@query
def formula_ranks(spark, folder):
    return vocabulary.formula_ranks(fact(spark, folder), easy_words(spark, folder))


@query
def formula_correlations(spark, folder):
    return vocabulary.formula_correlations(fact(spark, folder), easy_words(spark, folder))


@query
def words_to_lower(spark, folder):
    return vocabulary.words_to_replace(fact(spark, folder), -2)


@query
def words_to_lower_from_thirty(spark, folder):
    return vocabulary.words_to_replace(fact(spark, folder), -2, min_sentences=30)


@query
def words_to_raise(spark, folder):
    return vocabulary.words_to_replace(fact(spark, folder), 2)


@query
def charged_share(spark, folder):
    return vocabulary.charged_share(fact(spark, folder), dictionaries.given_words(spark, CHARGED))


# Search


@query
def any_term(spark, folder):
    return search.any_term(fact(spark, folder), PHRASE)


@query
def phrase_search(spark, folder):
    return search.search(fact(spark, folder), PHRASE)


@query
def phrase_search_unicode(spark, folder):
    return search.search(fact(spark, folder), UNICODE_PHRASE, unicode=True)


@query
def phrase_search_by_index(spark, folder):
    store = spark.read.parquet(landing.sentence_store(spark, folder))
    return search.search_index(spark, landing.search_index(spark, folder), store, PHRASE)


@query
def phrase_search_with_rare_term(spark, folder):
    """A frequent and a rare term, by an index of small blocks: most blocks of the frequent term are skipped."""
    store = spark.read.parquet(landing.sentence_store(spark, folder))
    return search.search_index(spark, landing.small_block_index(spark, folder), store, RARE_PHRASE, 5)


@query
def frequent_term_search(spark, folder):
    """One frequent term alone: as many blocks are read as hits are asked for."""
    store = spark.read.parquet(landing.sentence_store(spark, folder))
    return search.search_index(spark, landing.small_block_index(spark, folder), store, "the", 5)


@query
def postings(spark, folder):
    return search.postings(fact(spark, folder), landing.INDEX_BUCKETS).drop("bucket", "block")


# Sentiment


@query
def lemma_counts(spark, folder):
    """Every word with its lemma from the corpus's own dictionary, and how often it occurs."""
    return sentiment.lemmatize(sentences.word_counts(fact(spark, folder)), landing.word_forms(spark, folder))


@query
def labelled_lemmas(spark, folder):
    words = sentences.word_counts(fact(spark, folder)).withColumnRenamed("word", "lemma")
    return sentiment.label_lemmas(words, lexicon(spark)).select("lemma", "polarity", "occurrences")


@query
def sentence_sentiment(spark, folder):
    return sentiment.sentence_sentiment(
        fact(spark, folder), dictionaries.read_lemmas(spark, landing.lemma_file(spark, folder)), lexicon(spark)
    )


# Files and stored tables


@query
def listed_files(spark, folder):
    files = books.list_books(spark, landing.book_files(spark, folder), glob="*.txt")
    return files.select(landing.document_id(), "length")


@query
def first_files(spark, folder):
    files = books.list_books(spark, landing.book_files(spark, folder), 25, "*.txt")
    return files.select(landing.document_id(), "length")


@query
def read_files(spark, folder):
    return landing.read_book_files(spark, folder).select(landing.document_id(), "rawDocument")


@query
def read_first_files(spark, folder):
    return landing.read_book_files(spark, folder, 25).select(landing.document_id(), "rawDocument")


@query
def file_contents(spark, folder):
    contents = books.read_contents(spark, landing.book_files(spark, folder), glob="*.txt")
    return contents.select(F.md5("content").alias("digest"), F.octet_length("content").alias("length"))


@query
def loaded_books(spark, folder):
    """Book files through the batch load, in two batches, into a stored table."""
    loaded = tables.read_sentences(spark, landing.loaded_store(spark, folder))
    return loaded.select(landing.document_id(), *loaded.columns).drop("fileName")


@query
def word_lists(spark, folder):
    """The two ISO-8859-1 word lists as one lexicon."""
    return dictionaries.build_lexicon(
        dictionaries.read_word_list(spark, landing.negative_words(spark, folder)),
        dictionaries.read_word_list(spark, landing.positive_words(spark, folder)),
    )


@query
def stored_lexicon(spark, folder):
    return dictionaries.read_lexicon(spark, landing.lexicon_file(spark, folder))


@query
def stored_lemmas(spark, folder):
    return dictionaries.read_lemmas(spark, landing.lemma_file(spark, folder))


@query
def stored_sentences(spark, folder):
    return tables.read_sentences(spark, landing.sentence_store(spark, folder))


@query
def stored_book(spark, folder):
    """One book's sentences from the stored table: one bucket is read."""
    return tables.read_book(spark, landing.sentence_store(spark, folder), BOOK)


@query
def stored_json_documents(spark, folder):
    return tables.read_index_documents(spark, landing.json_store(spark, folder))


@query
def upserted_sentences(spark, folder):
    return keyed.upsert(fact(spark, folder), landing.second_load(spark, folder), ["fileName", "position"])


@query
def reloaded_sentences(spark, folder):
    return tables.read_sentences(spark, landing.reloaded_store(spark, folder))


@query
def reloaded_shorter_books(spark, folder):
    """After a reload with shorter texts nothing of the longer ones is left."""
    return tables.read_sentences(spark, landing.shortened_store(spark, folder))


@query
def reset_then_loaded(spark, folder):
    return tables.read_sentences(spark, landing.refilled_store(spark, folder))


@query
def created_with_repeats(spark, folder):
    """Of rows with one key in a first load one stays."""
    return tables.read_sentences(spark, landing.repeated_store(spark, folder))


@query
def loaded_in_three(spark, folder):
    """Book files through three limited loads, each going on after the one before."""
    loaded = tables.read_sentences(spark, landing.batched_store(spark, folder))
    return loaded.select(landing.document_id(), *loaded.columns).drop("fileName")


@query
def loaded_in_chunks(spark, folder):
    """Book files through a load that reads the larger ones by lines, in chunks."""
    loaded = tables.read_sentences(spark, landing.chunked_store(spark, folder))
    return loaded.select(landing.document_id(), *loaded.columns).drop("fileName")


@query
def chunked_segmentation(spark, folder):
    """Sentences of texts that are cut into chunks of three hundred characters and stitched."""
    chunks = sentences.chunk_books(tables.document_books(spark, folder), 300)
    return sentences.chunked_sentence_table(chunks)


@query
def loaded_by_manifest(spark, folder):
    """Book files through three incremental loads, of which the last finds nothing new."""
    loaded = tables.read_sentences(spark, landing.manifest_store(spark, folder))
    return loaded.select(landing.document_id(), *loaded.columns).drop("fileName")


@query
def manifest_files(spark, folder):
    """Which load read each file."""
    files = manifest.known_files(spark, manifest_path(landing.manifest_store(spark, folder)))
    return files.select(landing.document_id(), "length", "load")


@query
def totals_of_loads(spark, folder):
    """The totals that the batch load kept beside its table."""
    kept = spark.read.parquet(totals.totals_path(landing.loaded_store(spark, folder)))
    return kept.select(landing.document_id(), "doc_count", "sum_multiSyllables", "words")


@query
def maintained_totals(spark, folder):
    """The totals after a reload with shorter texts."""
    kept = spark.read.parquet(totals.totals_path(landing.maintained_store(spark, folder)))
    return kept.select("fileName", "doc_count", "sum_multiSyllables", "words")


@query
def kept_books_in_range(spark, folder):
    """Books in a range of grades from the kept totals: no sentence is read."""
    kept = spark.read.parquet(totals.totals_path(landing.maintained_store(spark, folder)))
    return scores.kept_books_in_range(kept, LOW, HIGH)


@query
def stored_passage_by_running(spark, folder):
    """A passage of one book by running counts: one bucket, at most two chunks."""
    path = landing.maintained_store(spark, folder)
    running = spark.read.parquet(totals.running_path(path))
    return passages.passage_scores_by_running(spark.read.parquet(path), running, 2, 37, landing.RUNNING_CHUNK, BOOK)


@query
def passage_scores_by_running(spark, folder):
    path = landing.maintained_store(spark, folder)
    running = spark.read.parquet(totals.running_path(path))
    return passages.passage_scores_by_running(spark.read.parquet(path), running, FIRST, LAST, landing.RUNNING_CHUNK)


@query
def stored_book_score(spark, folder):
    """The grade of one book from the stored table: one bucket is opened."""
    return scores.score_of_book(spark.read.parquet(landing.sentence_store(spark, folder)), BOOK)


@query
def stored_passage_score(spark, folder):
    return passages.passage_score(spark.read.parquet(landing.sentence_store(spark, folder)), BOOK, 2, 9)


@query
def reloaded_documents(spark, folder):
    return spark.read.parquet(landing.document_store(spark, folder)).select("doc_id", "value")


@query
def stored_lines(spark, folder):
    return spark.read.text(landing.line_files(spark, folder)).withColumnRenamed("value", "sentenceText")


@query
def stored_response(spark, folder):
    return spark.read.schema(fact(spark, folder).schema).json(landing.response_file(spark, folder))


@query
def reset_table(spark, folder):
    return tables.read_sentences(spark, landing.reset_store(spark, folder))
