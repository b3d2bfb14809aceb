"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

from tomegauge.operators import documents, passages, scores, search, vocabulary
from tomegauge.operators.sentences import sentence_table
from tomegauge.plans import catalog, landing
from tomegauge.sinks import keyed
from tomegauge.sources import tables

QUERIES = catalog.queries()


@pytest.fixture(scope="module")
def store(spark, folder):
    return spark.read.parquet(landing.sentence_store(spark, folder))


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_python(name, spark, folder, physical):
    plan = physical(QUERIES[name](spark, folder))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert word not in plan


def test_sentences_are_cut_once_and_after_the_spread(spark, folder, physical):
    plan = physical(sentence_table(tables.document_books(spark, folder)))
    assert plan.count("regexp_extract_all(rtrim") == 1
    assert plan.index("regexp_extract_all(rtrim") < plan.index("REPARTITION_BY_COL")


def test_sentence_table_adds_no_shuffle(spark, store, physical):
    books = store.select("fileName", F.col("sentenceText").alias("rawDocument"))
    assert "Exchange" not in physical(sentence_table(books))
    assert "Exchange" not in physical(scores.score_texts(books))


def test_book_scores_shuffle_once_and_read_two_columns(store, physical):
    plan = physical(scores.book_scores(store))
    assert plan.count("Exchange") == 1 and "partial_sum" in plan
    assert "ReadSchema: struct<fileName:string,multiSyllableCount:int>" in plan


def test_book_filter_reaches_the_scan(store, physical):
    plan = physical(scores.one_book(scores.book_scores(store), "txt/10.txt"))
    assert "EqualTo(fileName,txt/10.txt)" in plan
    plan = physical(passages.passage_scores(store, 30, 59))
    assert "GreaterThanOrEqual(position,30)" in plan


def test_book_lookup_opens_one_bucket(spark, folder, store):
    path = landing.sentence_store(spark, folder)
    book = tables.read_book(spark, path, "txt/10.txt")
    assert 0 < book.count()
    assert book.rdd.getNumPartitions() == 1
    assert store.select("bucket").distinct().count() > 1


def test_phrase_lookup_reads_only_its_buckets(spark, folder, store, physical):
    found = search.search_index(spark, landing.search_index(spark, folder), store, "thing")
    plan = physical(found)
    assert "In(fileName" in plan and "PartitionFilters: [bucket" in plan


def test_upsert_cuts_copies_before_the_shuffle(store, physical):
    plan = physical(keyed.upsert(store, store, ["fileName", "position"]))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_postings_are_not_shuffled(store, physical):
    assert "Exchange" not in physical(search.postings(store, 16))


def test_index_search_reads_postings_once(spark, folder, store, monkeypatch):
    opened = []
    read = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *paths: opened.append(paths[0]) or read(self, *paths))
    path = landing.search_index(spark, folder)
    opened.clear()
    assert search.search_index(spark, path, store, "the thing of").count() == 20
    assert [name.rsplit("/", 1)[1] for name in opened] == ["statistics", "terms", "postings", "blocks"]


def test_stored_look_ups_open_one_bucket(store, physical):
    for frame in (
        scores.score_of_book(store, "txt/10.txt"),
        passages.passage_score(store, "txt/10.txt", 0, 9),
        documents.sentences_of_book(store, "txt/10.txt"),
    ):
        plan = physical(frame)
        assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan


def test_charged_share_moves_only_sentences_with_a_hit(spark, store, physical):
    plan = physical(vocabulary.charged_share(store, spark.createDataFrame([("thing",)], "word string")))
    assert "partial_max" not in plan and "Union" not in plan


def test_words_are_counted_before_the_lemmas_meet_them(spark, folder, physical):
    plan = physical(catalog.queries()["lemma_counts"](spark, folder))
    assert "occurrences" in plan.split("Join")[1]


def test_score_buckets_group_the_books_once(store, physical):
    assert physical(scores.score_buckets(store, 10)).count("keys=[fileName") <= 4


def test_no_window_gathers_a_whole_book(store, physical):
    for frame in (passages.rolling_scores(store), passages.block_changes(store)):
        plan = physical(frame)
        windows = [line for line in plan.splitlines() if "windowspecdefinition" in line]
        assert windows and all("chunk" in line for line in windows)


def test_replacement_counts_words_once(store):
    frame = vocabulary.words_to_replace(store, -2)
    frame.collect()
    assert "ReusedExchange" in frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("levels", [-2, 2])
def test_words_to_replace_cut_the_sentences_once(store, levels):
    frame = vocabulary.words_to_replace(store, levels, min_sentences=30)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and plan.count("ReusedExchange") >= 2


def test_words_to_replace_of_odd_sentences(spark):
    """Null texts count as sentences, null names and counts give no row; texts of blanks are no words."""
    long = "Deteriorating machinery considerably irritated everybody"
    rows = [("a", 0, long, 3), ("a", 1, None, 0), ("a", 2, "  ", None), (None, 0, long, 3), ("b", 0, long, None), ("b", 1, "Short", None)]
    sentences = spark.createDataFrame(rows, "fileName string, position int, sentenceText string, multiSyllableCount int")
    found = vocabulary.words_to_replace(sentences, -2).collect()
    assert {r.fileName for r in found} == {"a"} and all(r.word.strip() for r in found)
    count, multi = 3, 3
    exact = 1.0430 * (30 * multi / count) ** 0.5 + 3.1291 - 2
    target = count / 30 * ((exact - 3.1291) / 1.0430) ** 2
    assert {r.needed for r in found} == {-(-(multi - target) // 1)}
