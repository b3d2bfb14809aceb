"""Grades, ranges, passages and word replacement on small hand-checked tables."""

import bisect
import functools
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tomegauge.functions import grades
from tomegauge.operators import documents, passages, scores, search, sentiment, vocabulary
from tomegauge.operators.running import running_total
from tomegauge.operators.sentences import split_books
from tomegauge.schemas import BOOKS, LEXICON, SENTENCES
from tomegauge.sources.dictionaries import given_words


SAMPLE = "A short walk is pleasant! The machinery, however, deteriorated considerably. Nobody repaired it"


def rows_of(spark, counts, name="b"):
    """A book of sentences that have the given numbers of multi-syllable words."""
    rows = [(name, i, f"s{i}.", len(counts), c, 10) for i, c in enumerate(counts)]
    return spark.createDataFrame(rows, SENTENCES)


def test_smog_of_test_book(book):
    table = book(SAMPLE)
    row = scores.book_scores(table).first()
    assert (row.doc_count, row.sum_multiSyllables, row.smog) == (3, 7, 11.86)


def test_range_includes_both_ends_and_takes_strings(book):
    table = book(SAMPLE)
    for low, high, found in [("11.86", "12", 1), ("9", "11.86", 1), ("11.87", "12", 0), ("9", "11.85", 0)]:
        assert scores.books_in_range(table, low, high).count() == found


def test_truncated_range_loses_the_books_cut_off(spark):
    table = rows_of(spark, [9] * 3, "long").unionByName(rows_of(spark, [1], "short"))
    easy = grades_of(table, "short")
    assert scores.books_in_range(table, easy, easy).count() == 1
    assert scores.books_in_range(table, easy, easy, bucket_limit=1).count() == 0
    kept = scores.score_buckets(table, 1).first()
    assert (kept.fileName, kept.doc_count, kept.sum_other_doc_count) == ("long", 3, 1)


def grades_of(table, name):
    return scores.one_book(scores.book_scores(table), name).first().smog


def test_bucket_ties_go_by_name(spark):
    table = rows_of(spark, [1, 1], "b").unionByName(rows_of(spark, [1, 1], "a"))
    assert scores.score_buckets(table, 1).first().fileName == "a"


def test_no_words_give_no_flesch_score(book):
    row = scores.flesch_scores(book("... !")).first()
    assert (row.reading_ease, row.flesch_grade) == (None, None)


def test_inverse_of_smog(spark):
    frame = spark.range(1, 50).select(
        (F.col("id") * 3).alias("m"), (F.col("id") + 29).alias("n")
    )
    back = grades.multi_syllables_for(grades.smog_exact(F.col("m"), F.col("n")), F.col("n"))
    assert frame.where(F.abs(back - F.col("m")) > 1e-6).count() == 0


@pytest.mark.parametrize("chunk", [30, 31, 47, 1000])
def test_rolling_scores_do_not_depend_on_chunks(spark, chunk):
    table = rows_of(spark, [(i * 7) % 5 for i in range(400)])
    whole = Window.partitionBy("fileName").orderBy("position").rowsBetween(-29, 0)
    plain = table.select("position", F.sum("multiSyllableCount").over(whole).alias("m")).where("position >= 29")
    ours = passages.rolling_scores(table, chunk_positions=chunk).select("position", "passage_multiSyllables")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))


def test_rolling_scores_need_thirty_neighbours(spark):
    table = rows_of(spark, [1] * 80).where("position <> 40")
    positions = {r.position for r in passages.rolling_scores(table).collect()}
    assert positions == set(range(29, 40)) | set(range(70, 80))


@pytest.mark.parametrize("chunk", [2, 3, 100])
def test_block_changes_do_not_depend_on_chunks(spark, chunk):
    table = rows_of(spark, [i // 30 for i in range(300)])
    ours = passages.block_changes(table, chunk_positions=chunk).orderBy("block").collect()
    assert [r.block for r in ours] == list(range(10))
    assert [r.previous_smog for r in ours[1:]] == [r.smog for r in ours[:-1]]
    assert ours[0].previous_smog is None


def test_unfinished_block_has_no_score(spark):
    assert passages.block_scores(rows_of(spark, [1] * 59)).count() == 1


def test_running_total_equals_one_window(spark):
    rows = spark.range(3000).select(
        (F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 13).alias("v"), F.format_string("%05d", "id").alias("w")
    )
    df = rows.withColumn("head", F.substring("w", 1, 3))
    plain = Window.partitionBy("k").orderBy(F.desc("v"), "w").rowsBetween(Window.unboundedPreceding, -1)
    expected = df.select("k", "w", F.coalesce(F.sum("v").over(plain), F.lit(0)).alias("t"))
    ours = running_total(
        df, ["k"], [("v", F.desc("v")), ("head", F.asc("head"))], [F.asc("w")], "v", "t"
    ).select("k", "w", "t")
    assert ours.exceptAll(expected).count() == 0 == expected.exceptAll(ours).count()


def test_replacing_the_listed_words_reaches_the_grade(sentences):
    listed = vocabulary.words_to_replace(sentences, -2).groupBy("fileName", "needed").agg(
        F.sum("occurrences").alias("covered")
    )
    assert listed.count() > 0
    assert listed.where("covered < needed").count() == 0
    after = (
        scores.book_scores(sentences, 30)
        .join(listed, "fileName")
        .select("smog", grades.smog(F.col("sum_multiSyllables") - F.col("needed"), F.col("doc_count")).alias("new"))
    )
    assert after.where("new > greatest(smog - 2, 3.13) + 0.01").count() == 0


def test_lookup_by_a_word_of_the_name(spark):
    table = rows_of(spark, [1], "txt/10.txt").unionByName(rows_of(spark, [1], "txt/110.txt"))
    assert [r.fileName for r in documents.sentences_by_name(table, "10").collect()] == ["txt/10.txt"]
    assert documents.sentences_by_name(table, "TXT").count() == 2
    assert documents.sentences_by_name(table, "no/10").count() == 1 and documents.sentences_by_name(table, "/").count() == 0
    assert documents.sentences_by_name(rows_of(spark, [0] * 12000, "txt/7.txt"), "7").count() == 12000


@pytest.mark.parametrize("limit", [1, 2, 3, 4, 5, 9])
def test_first_sentences_are_whole(spark, limit):
    table = rows_of(spark, [1, 1, 1], "b").unionByName(rows_of(spark, [1, 1], "a"))
    found = [(r.fileName, r.position) for r in documents.first_sentences(table, limit).collect()]
    assert found == [("a", 0), ("a", 1), ("b", 0), ("b", 1), ("b", 2)][:limit]


def test_search_ranks_and_counts(book):
    table = book("The cat sat. A dog ran by the cat and the other cat. Birds fly. ...")
    hits = search.search(table, "CAT, cat!").collect()
    assert {h.position for h in hits} == {0, 1} and {h.total for h in hits} == {2}
    assert search.search(table, "cat", limit=1).first().total == 2
    assert search.search(table, "zebra").count() == 0
    assert search.search(table, "?!").count() == 0
    assert search.any_term(table, "...").count() == 0


def test_sentiment_rules(spark, book):
    table = book("Good goods. Bad day. Good and bad. Odd one. ...")
    lexicon = spark.createDataFrame(
        [("good", "positive"), ("good", "positive"), ("bad", "negative"), ("odd", "negative"), ("odd", "positive")],
        LEXICON,
    )
    lemmas = spark.createDataFrame([("goods", "good"), ("goods", "zzz")], "form string, lemma string")
    labels = sentiment.sentence_sentiment(table, lemmas, lexicon).orderBy("position").collect()
    assert [(r.score, r.sentiment) for r in labels] == [
        (2, "positive"), (-1, "negative"), (0, "neutral"), (0, "neutral"), (0, "neutral"),
    ]


def test_dale_chall_without_easy_words_and_with_all(spark, book):
    table = book("Cats run. Dogs run.")
    none = vocabulary.dale_chall_scores(table, given_words(spark, ["zebra"])).first()
    every = vocabulary.dale_chall_scores(table, given_words(spark, ["cats", "dogs", "run"])).first()
    assert (none.difficult, none.dale_chall) == (4, round(0.1579 * 100 + 0.0496 * 2 + 3.6365, 2))
    assert (every.difficult, every.dale_chall) == (0, 0.1)


def graded_blocks(spark, grades_, name="b"):
    """A book of thirty-sentence blocks that have about the given numbers of multi-syllable words."""
    return rows_of(spark, [c for g in grades_ for c in [g] + [0] * 29], name)


def cheapest(values, penalty):
    """Least cost over all ways to cut a series, by trying them all."""
    def cost(part):
        mean = sum(part) / len(part)
        return sum((x - mean) ** 2 for x in part)

    n, found = len(values), []
    for mask in range(1 << (n - 1)):
        cuts = [0, *[k + 1 for k in range(n - 1) if mask >> k & 1], n]
        found.append((sum(cost(values[a:b]) + penalty for a, b in zip(cuts, cuts[1:], strict=False)), cuts))
    return min(found)


@pytest.mark.parametrize("penalty", [0.5, 3.0, 12.0, 1000.0])
def test_change_points_against_all_cuts(spark, penalty):
    draw = random.Random(int(penalty))
    books = {f"b{k}": [draw.randrange(0, 3) + draw.choice([0, 20]) * (j > 4) for j in range(draw.randrange(1, 10))] for k in range(12)}
    table = functools.reduce(lambda a, b: a.unionByName(b), [graded_blocks(spark, g, n) for n, g in books.items()])
    smog = {n: [r.smog for r in sorted(passages.block_scores(table.where(f"fileName = '{n}'")).collect(), key=lambda r: r.block)] for n in books}
    found = {}
    for r in sorted(passages.change_points(table, penalty=penalty).collect(), key=lambda r: (r.fileName, r.segment)):
        found.setdefault(r.fileName, []).append(r)
    assert found.keys() == books.keys()
    for name, rows in found.items():
        values = smog[name]
        least, _ = cheapest(values, penalty)
        assert [r.segment for r in rows] == list(range(len(rows)))
        assert rows[0].first_block == 0 and rows[-1].last_block == len(values) - 1
        assert all(a.last_block + 1 == b.first_block for a, b in zip(rows, rows[1:], strict=False))
        parts = [values[r.first_block : r.last_block + 1] for r in rows]
        assert [r.mean_smog for r in rows] == [pytest.approx(sum(p) / len(p), abs=0.0051) for p in parts]
        assert sum(sum((x - sum(p) / len(p)) ** 2 for x in p) + penalty for p in parts) == pytest.approx(least, abs=1e-4)


def test_a_long_book_of_two_halves(spark):
    table = graded_blocks(spark, [3] * 300 + [9] * 300)
    assert [(r.first_block, r.last_block) for r in passages.change_points(table).orderBy("segment").collect()] == [(0, 299), (300, 599)]


def test_merged_sketches_keep_their_rank_error(spark):
    draw = random.Random(4)
    names = [f"b{k}" for k in range(40)]
    blocks = [(n, k, 30, draw.randrange(200)) for n in names for k in range(500)]
    sentences = spark.createDataFrame(blocks, "fileName string, block int, n int, m int").select(
        "fileName", F.explode(F.sequence(F.lit(0), F.lit(29))).alias("i"), (F.col("block") * 30 + F.col("i")).alias("position"),
        F.when(F.col("i") == 0, F.col("m")).otherwise(0).alias("multiSyllableCount"),
    )
    exact = sorted(r.smog for r in passages.block_scores(sentences).collect())
    for size, error in ((200, 0.02), (4096, 0.001)):
        whole = passages.merged_sketches(passages.grade_sketches(sentences, sketch=size), sketch=size)
        for row in passages.sketch_quantiles(whole, [0.0, 0.1, 0.5, 0.9, 1.0]).collect():
            low, high = bisect.bisect_left(exact, row.smog) / len(exact), bisect.bisect_right(exact, row.smog) / len(exact)
            assert row.blocks == 20_000 and low - error <= row.quantile <= high + error


def test_abbreviations_are_learned_from_the_texts(spark):
    draw = random.Random(6)
    words = ["the", "walk", "was", "long", "machine", "cat", "house", "went", "home", "no"]
    names, made, texts = ["dr", "etc", "e.g", "mr"], 0, []
    for k in range(60):
        sentences = []
        for _ in range(20):
            body = draw.choices(words, k=draw.randrange(4, 9))
            if draw.random() < 0.5:
                body.insert(draw.randrange(len(body)), draw.choice(names) + ".")
            sentences.append(" ".join(body) + ".")
        made += len(sentences)
        texts.append((f"t{k}", " ".join(sentences)))
    books = spark.createDataFrame(texts, BOOKS)
    learned = [r.word for r in vocabulary.learned_abbreviations(books).collect()]
    assert sorted(learned) == sorted(names)
    bare, guarded = (split_books(books, a).count() for a in ([], learned))
    assert guarded == made < bare
    assert vocabulary.learned_abbreviations(books.where("false")).count() == 0
    assert vocabulary.learned_abbreviations(spark.createDataFrame([("a", "mr. mr. mr.")], BOOKS)).count() == 0


def test_polar_words_follow_from_the_dictionaries(spark):
    lemmas = spark.createDataFrame([("worse", "bad"), ("better", "good"), ("good", "fine"), ("better", "well")], "form string, lemma string")
    lexicon = spark.createDataFrame([("bad", "negative"), ("good", "positive"), ("odd", "positive"), ("odd", "negative")], LEXICON)
    found = {r.word: r.polarity for r in sentiment.polar_words(lemmas, lexicon).collect()}
    assert found == {"worse": -1, "bad": -1, "better": 1}  # good itself stands for fine
