"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each figure is the median of three runs after one warm-up, and every result is
consumed in full: tables are written as Parquet, queries go to the ``noop`` sink.
Building the search index is reported, not part of the total.
"""

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tomegauge.operators import passages, scores, search, sentences, sentiment, vocabulary  # noqa: E402
from tomegauge.plans import catalog, landing, load  # noqa: E402
from tomegauge.session import local_session, scratch_path  # noqa: E402
from tomegauge.sinks import keyed, totals  # noqa: E402
from tomegauge.sources import dictionaries, tables  # noqa: E402

RUNS = 3
BUCKETS = 16


def consume(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def seconds(run: Callable[[], None]) -> list[float]:
    times = []
    for _ in range(RUNS + 1):
        started = time.perf_counter()
        run()
        times.append(time.perf_counter() - started)
    return times[1:]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "tomegauge-bench")

    flat = scratch_path(spark, "bench-sentences")
    books = tables.document_books(spark, folder)

    def build_table() -> None:
        sentences.sentence_table(books).write.mode("overwrite").parquet(flat)

    times = {"text_to_sentence_table": seconds(build_table)}

    store = scratch_path(spark, "bench-store")
    keyed.create_keyed(spark.read.parquet(flat), store, landing.KEY, BUCKETS, unique=True)
    fact = spark.read.parquet(store)
    index = scratch_path(spark, "bench-index")
    index_seconds = statistics.median(seconds(lambda: search.write_index(fact, index, BUCKETS)))

    library = landing.book_files(spark, folder)
    loads = [scratch_path(spark, "bench-load") for _ in range(RUNS + 1)]
    fresh = iter(loads)
    times["load_books_first"] = seconds(lambda: load.load_books(spark, library, next(fresh), buckets=BUCKETS))
    times["load_books_again"] = seconds(lambda: load.load_books(spark, library, loads[0]))
    by_manifest = scratch_path(spark, "bench-manifest")
    load.load_new_books(spark, library, by_manifest, buckets=BUCKETS)
    times["load_nothing_new"] = seconds(lambda: load.load_new_books(spark, library, by_manifest))
    kept = spark.read.parquet(totals.totals_path(by_manifest))

    easy = catalog.easy_words(spark, folder)
    lexicon = catalog.lexicon(spark)
    lemmas = dictionaries.read_lemmas(spark, landing.lemma_file(spark, folder))
    genres = tables.document_genres(spark, folder)
    flagged = tables.flagged_documents(spark, folder)

    plans: dict[str, Callable[[], DataFrame]] = {
        "score_whole_texts": lambda: scores.score_texts(books),
        "books_in_range": lambda: scores.books_in_range(fact, catalog.LOW, catalog.HIGH),
        "books_in_range_of_largest": lambda: scores.books_in_range(fact, catalog.LOW, catalog.HIGH, 10),
        "kept_books_in_range": lambda: scores.kept_books_in_range(kept, catalog.LOW, catalog.HIGH),
        "books_of_genre": lambda: scores.books_of_genre(fact, genres, catalog.GENRE, 5, 15, 20),
        "books_without_theme": lambda: scores.books_without_theme(fact, flagged, 3, 30),
        "one_book": lambda: tables.read_book(spark, store, catalog.BOOK),
        "one_book_score": lambda: scores.score_of_book(fact, catalog.BOOK),
        "rolling_scores": lambda: passages.rolling_scores(fact),
        "block_distribution": lambda: passages.block_distribution(fact),
        "book_trends": lambda: passages.book_trends(fact),
        "phrase_search_by_index": lambda: search.search_index(spark, index, fact, catalog.PHRASE),
        "phrase_search_skipping_blocks": lambda: search.search_index(spark, index, fact, catalog.RARE_PHRASE),
        "phrase_search_by_scan": lambda: search.search(fact, catalog.PHRASE),
        "flesch_scores": lambda: scores.flesch_scores(fact),
        "dale_chall_scores": lambda: vocabulary.dale_chall_scores(fact, easy),
        "formulae_compared": lambda: vocabulary.compare_formulae(fact, easy),
        "formula_ranks": lambda: vocabulary.formula_ranks(fact, easy),
        "words_to_lower": lambda: vocabulary.words_to_replace(fact, -2),
        "words_to_raise": lambda: vocabulary.words_to_replace(fact, 2),
        "charged_share": lambda: vocabulary.charged_share(fact, dictionaries.given_words(spark, catalog.CHARGED)),
        "sentence_sentiment": lambda: sentiment.sentence_sentiment(fact, lemmas, lexicon),
    }
    for name, plan in plans.items():
        times[name] = seconds(lambda: consume(plan()))

    medians = {name: round(statistics.median(runs), 3) for name, runs in times.items()}
    counts = fact.agg(F.count(F.lit(1)).alias("sentences"), F.sum("numWordsInSentence").alias("words")).first()
    build = medians["text_to_sentence_table"]
    print(
        json.dumps(
            {
                "metric": "readability_total",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "words_per_second": round(counts.words / build),
                "sentences_per_second": round(counts.sentences / build),
                "index_build_seconds": round(index_seconds, 3),
                "runs": RUNS,
                "cores": int(cores),
                "memory": spark.conf.get("spark.driver.memory"),
            }
        )
    )


if __name__ == "__main__":
    main()
