"""Totals kept beside a keyed sentence table, so that questions on whole books or passages need not read sentences.

``<table>_totals`` has a row per book, ``<table>_running`` a row per chunk of a book with
the counts before it. Both are bucketed as the table is and made anew for the buckets a load wrote.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tomegauge.session import scratch_path
from tomegauge.sinks import keyed

#: Positions of a chunk of the running counts.
CHUNK = 1000


def totals_path(path: str) -> str:
    return f"{path.rstrip('/')}_totals"


def running_path(path: str) -> str:
    return f"{path.rstrip('/')}_running"


def totals_of(sentences: DataFrame) -> DataFrame:
    """Per book: sentences, multi-syllable words, words."""
    kept = [c for c in ("buckets", "bucket") if c in sentences.columns]
    return sentences.groupBy(*kept, "fileName").agg(
        F.count(F.lit(1)).alias("doc_count"),
        F.sum("multiSyllableCount").alias("sum_multiSyllables"),
        F.sum("numWordsInSentence").alias("words"),
    )


def running_of(sentences: DataFrame, size: int = CHUNK) -> DataFrame:
    """Per book and chunk of ``size`` positions: what is before it and through it.

    A window gathers the chunks of a book, a thousandth of its sentences.
    """
    kept = [c for c in ("buckets", "bucket") if c in sentences.columns]
    chunks = sentences.groupBy(*kept, "fileName", F.floor(F.col("position") / size).cast("int").alias("chunk")).agg(
        F.count(F.lit(1)).alias("_sentences"), F.sum("multiSyllableCount").alias("_words")
    )
    through = Window.partitionBy(*kept, "fileName").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    chunks = chunks.withColumns(
        {"sentencesThrough": F.sum("_sentences").over(through), "multiSyllablesThrough": F.sum("_words").over(through)}
    )
    return chunks.select(
        *kept, "fileName", "chunk", F.lit(size).alias("chunkSize"),
        (F.col("sentencesThrough") - F.col("_sentences")).alias("sentencesBefore"),
        (F.col("multiSyllablesThrough") - F.col("_words")).alias("multiSyllablesBefore"),
        "sentencesThrough", "multiSyllablesThrough",
    )


def _put(spark: SparkSession, rows: DataFrame, path: str, order: Sequence[str], buckets: int, touched: Sequence[int]) -> None:
    scratch = scratch_path(spark, "totals")
    rows.write.parquet(scratch)
    keyed.replace_buckets(spark, path, spark.read.schema(rows.schema).parquet(scratch), order, buckets, touched)


def refresh(spark: SparkSession, path: str, touched: Sequence[int] | None = None, size: int = CHUNK) -> None:
    """Count the buckets ``touched`` of a keyed sentence table anew, or all of them.

    Reads four narrow columns of these buckets. If a load was broken off before this, call it for all buckets.
    """
    table = spark.read.parquet(path)
    first = table.select("buckets").first() if "buckets" in table.columns else None
    if touched is None:
        for rows, home, order in ((totals_of(table), totals_path(path), ["fileName"]), (running_of(table, size), running_path(path), ["fileName", "chunk"])):
            if first is None:
                rows.write.mode("overwrite").parquet(home)
            else:
                keyed.write_bucketed(rows, home, order)
    elif touched:
        # Of a table that lost all its rows the folders still tell the number of buckets.
        known = first or spark.read.parquet(totals_path(path)).select("buckets").first()
        if known is None:
            return
        buckets = known.buckets
        here = table.where(F.col("bucket").isin(list(touched)))
        _put(spark, totals_of(here), totals_path(path), ["fileName"], buckets, touched)
        _put(spark, running_of(here, size), running_path(path), ["fileName", "chunk"], buckets, touched)


def add(spark: SparkSession, path: str, added: DataFrame, size: int = CHUNK) -> None:
    """Count books that were added to a keyed sentence table, from their rows alone.

    Where the totals hold one of them, as after a load that was broken off, all buckets are counted anew.
    """
    for home in (totals_path(path), running_path(path)):
        if not spark.read.parquet(home).join(added.select("fileName").distinct(), "fileName", "left_semi").isEmpty():
            return refresh(spark, path, None, size)
    keyed.write_bucketed(totals_of(added), totals_path(path), ["fileName"], "append")
    keyed.write_bucketed(running_of(added, size), running_path(path), ["fileName", "chunk"], "append")
