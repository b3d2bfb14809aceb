"""Relevance-ranked phrase search (BM25, any term matches).

Two ways to the same result: ``search`` scans the sentence table and never
shuffles it; ``search_index`` reads only the buckets of its terms from postings
written once by ``write_index``, and of the most frequent term only the blocks
that can hold a hit.
"""

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tomegauge.functions import text
from tomegauge.operators.sentences import explode_once
from tomegauge.sinks import keyed

# Parameters of BM25 and the number of hits shown. Older engines also multiply each
# score by K1 + 1, which gives other numbers in the same order.
K1 = 1.2
B = 0.75
TOP = 20

# The driver holds the hits of an index search.
MOST_HITS = 10000

# Sentences of a block of postings, the same sentences for every term, and postings that a term has per block, on
# average, for its blocks to be described.
BLOCK_SENTENCES = 128
LEAST_PER_BLOCK = 4

# Postings of the rarer terms of a phrase up to which blocks of the most frequent one are skipped: the driver lists their blocks.
MOST_LOOKED_UP = 100_000

# Blocks that a filter names one by one; more of them meet the postings in a join, as a list takes the planner too long.
MOST_NAMED = 1000

# Rows of a page of postings, the least that a reader skips.
PAGE_ROWS = "1024"

HIT_COLUMNS = ["fileName", "position", "multiSyllableCount", "sentenceText"]


def query_terms(phrase: str, unicode: bool = False) -> list[str]:
    """The distinct tokens of a phrase, cut as the sentences are."""
    gap = r"[^\w]+" if unicode else r"[^a-z0-9_]+"
    return sorted({term for term in re.split(gap, phrase.lower()) if term})


def _idf(documents: Column, found: Column) -> Column:
    return F.log(1.0 + (documents - found + 0.5) / (found + 0.5))


def _term_score(idf: Column, tf: Column, length: Column, mean: Column) -> Column:
    # The factor of the term comes last, so scores of one term are in the order of their impacts.
    return idf * _impact(tf, length, mean)


def _impact(tf: Column, length: Column, mean: Column) -> Column:
    return tf / (tf + K1 * (1.0 - B + B * length / mean))


def any_term(sentences: DataFrame, phrase: str, unicode: bool = False) -> DataFrame:
    """Sentences with at least one term of the phrase."""
    terms = query_terms(phrase, unicode)
    if not terms:
        return sentences.where(F.lit(False))
    return sentences.where(text.has_any_term("sentenceText", terms, unicode))


def search(sentences: DataFrame, phrase: str, limit: int = TOP, unicode: bool = False) -> DataFrame:
    """The best hits for a phrase: score, then book and position; ``total`` counts all hits.

    One pass gathers the corpus statistics in a single row, a second scores the
    matching sentences and keeps the top rows of each task. Ranked is the full
    score, its terms added up in a fixed order; only the score shown is rounded.
    """
    terms = query_terms(phrase, unicode)
    if not terms:
        return _no_hits(sentences)
    words = F.col("_words")
    cut = text.tokens("sentenceText", unicode).alias("_words")
    found = [F.array_contains(words, term) for term in terms]
    statistics = (
        sentences.select(cut)
        .select(F.size(words).alias("_length"), *[hit.alias(f"_hit{i}") for i, hit in enumerate(found)])
        .agg(
            F.struct(
                F.count(F.lit(1)).alias("documents"),
                F.avg("_length").alias("mean"),
                F.count_if(F.greatest(F.lit(False), *[F.col(f"_hit{i}") for i in range(len(terms))])).alias("total"),
                *[F.count_if(f"_hit{i}").alias(f"df{i}") for i in range(len(terms))],
            )
        )
        .scalar()
    )
    length = F.size(words)
    parts = [
        _term_score(
            _idf(statistics["documents"], statistics[f"df{i}"]),
            length - F.size(F.array_remove(words, term)),
            length,
            statistics["mean"],
        )
        for i, term in enumerate(terms)
    ]
    return (
        any_term(sentences, phrase, unicode)
        .select(*HIT_COLUMNS, cut)
        .select(*HIT_COLUMNS, sum(parts[1:], parts[0]).alias("_score"), statistics["total"].alias("total"))
        .orderBy(F.desc("_score"), "fileName", "position")
        .limit(limit)
        .select(*HIT_COLUMNS, F.round("_score", 4).alias("score"), "total")
    )


def _no_hits(sentences: DataFrame) -> DataFrame:
    return sentences.where(F.lit(False)).select(
        *HIT_COLUMNS, F.lit(0.0).alias("score"), F.lit(0).cast("bigint").alias("total")
    )


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def block_of(blocks: int) -> Column:
    """The block of a sentence: the same for each of its terms, so terms of a sentence meet in one block."""
    return F.pmod(F.xxhash64("fileName", "position"), F.lit(blocks)).cast("int")


def postings(sentences: DataFrame, buckets: int, unicode: bool = False, blocks: int = 1) -> DataFrame:
    """``term, fileName, position, tf, length`` with the bucket of the term and the block of the sentence.

    Terms are counted within their sentence, so nothing is grouped and nothing shuffled.
    """
    cut = sentences.select(
        "fileName",
        "position",
        text.word_count("sentenceText", unicode).alias("length"),
        text.token_runs("sentenceText", unicode).alias("_runs"),
    )
    rows = explode_once(cut, "_runs", "_place", "_run").select(
        text.run_token("_run").alias("term"), "fileName", "position", text.run_length("_run").alias("tf"), "length"
    )
    return rows.withColumns({"bucket": term_bucket(F.col("term"), buckets), "block": block_of(blocks)})


def block_maxima(rows: DataFrame, mean: float) -> DataFrame:
    """Per bucket, term and block of postings the best one: its impact, and its sentence, the first of equal ones."""
    impact = _impact(F.col("tf"), F.col("length"), F.lit(mean))
    best = F.min(F.struct((-impact).alias("impact"), "fileName", "position")).alias("best")
    return rows.groupBy("bucket", "term", "block").agg(best).select(
        "bucket", "term", "block", (-F.col("best.impact")).alias("impact"), "best.fileName", "best.position"
    )


def _write(rows: DataFrame, path: str, *order: str, dealt: bool = False) -> None:
    """Rebalanced by bucket; rows that come ``dealt`` are written as they lie, a file for each task and bucket."""
    (
        (rows if dealt else rows.hint("rebalance", "bucket"))
        .sortWithinPartitions("bucket", *order)
        .write.mode("overwrite")
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .partitionBy("bucket")
        .parquet(path)
    )


def write_index(
    sentences: DataFrame, path: str, buckets: int = 256, unicode: bool = False, block_sentences: int = BLOCK_SENTENCES
) -> None:
    """Write postings, term frequencies, block maxima and corpus statistics under ``path``.

    The postings are not shuffled: each task writes those of its sentences, a file for each bucket. They are sorted by
    term and block within each file, so a look-up skips the
    pages of other terms and blocks as well as the other buckets, and a frequent term is read by many tasks. The best posting of each block is
    stored for terms with some postings in most blocks; those of a rarer term are all read.
    """
    spark = sentences.sparkSession
    # The sentence table holds the word counts of the default analyser.
    lengths = text.word_count("sentenceText", True) if unicode else F.col("numWordsInSentence")
    statistics = sentences.agg(F.count(F.lit(1)).alias("documents"), F.avg(lengths).alias("mean")).first()
    blocks = max(1, -(-statistics["documents"] // block_sentences))
    _write(postings(sentences, buckets, unicode, blocks), f"{path}/postings", "term", "block", dealt=True)
    rows = spark.read.parquet(f"{path}/postings")
    _write(rows.groupBy("bucket", "term").agg(F.count(F.lit(1)).alias("df")), f"{path}/terms", "term")
    frequent = spark.read.parquet(f"{path}/terms").where(F.col("df") >= LEAST_PER_BLOCK * blocks).select("bucket", "term")
    # Some hundreds however large the table: a term needs LEAST_PER_BLOCK postings a block, and a block has the words of its sentences.
    maxima = block_maxima(rows.join(F.broadcast(frequent), ["bucket", "term"], "left_semi"), statistics["mean"] or 0.0)
    _write(maxima, f"{path}/blocks", "term", "block")
    facts = "documents long, mean double, buckets int, unicode boolean, blocks int"
    spark.createDataFrame([(*statistics, buckets, unicode, blocks)], facts).write.mode("overwrite").parquet(f"{path}/statistics")


class _Lookup:
    """What an index holds for a phrase, and which of it has to be read for the best hits."""

    def __init__(self, spark: SparkSession, path: str, phrase: str, limit: int) -> None:
        self.statistics = spark.read.parquet(f"{path}/statistics").first()
        terms = query_terms(phrase, self.statistics["unicode"])
        if not self.statistics["documents"]:
            terms = []
        self.found: dict[str, int] = {}
        if terms:
            # One row per query term.
            rows = spark.read.parquet(f"{path}/terms").where(self._wanted(terms)).select("term", "df").collect()
            self.found = {row.term: row.df for row in rows}
        self.terms = [term for term in terms if term in self.found]
        self.skipped = None
        if self.terms:
            every = spark.read.parquet(f"{path}/postings")
            self.hits = every.where(self._wanted(self.terms))
            self._skip(spark, path, every, limit)

    def _wanted(self, terms: list[str]) -> Column:
        buckets = [term_bucket(F.lit(term), self.statistics["buckets"]) for term in terms]
        return F.col("bucket").isin(*buckets) & F.col("term").isin(*terms)

    def _skip(self, spark: SparkSession, path: str, every: DataFrame, limit: int) -> None:
        """Read only some blocks of the most frequent term, where its blocks are described and the other terms are rare.

        A sentence with another term as well lies in a block of that term. One without scores what its own posting does,
        so it comes after the best posting of its block; if ``limit`` blocks have a better
        best one, none of the block is among the hits.
        """
        frequent = max(self.terms, key=lambda term: (self.found[term], term))
        rare = [term for term in self.terms if term != frequent]
        blocks = self.statistics["blocks"]
        if self.found[frequent] < LEAST_PER_BLOCK * blocks or limit >= blocks or sum(self.found[t] for t in rare) > MOST_LOOKED_UP:
            return
        maxima = spark.read.parquet(f"{path}/blocks").where(self._wanted([frequent]))
        best = maxima.orderBy(F.desc("impact"), "fileName", "position").limit(limit).select("block")
        needed = {row.block for row in best.collect()}
        if rare:
            needed |= {row.block for row in every.where(self._wanted(rare)).select("block").distinct().collect()}
        if 2 * len(needed) > blocks:
            return
        self.skipped = frequent
        if len(needed) <= MOST_NAMED:
            some = self._wanted([frequent]) & F.col("block").isin(sorted(needed))
            self.hits = every.where(some | self._wanted(rare) if rare else some)
            return
        # No more than MOST_LOOKED_UP and ``limit`` numbers.
        blocks_ = spark.createDataFrame([(block,) for block in needed], "block int")
        self.hits = every.where(self._wanted([frequent])).join(F.broadcast(blocks_), "block", "left_semi").select(*every.columns)
        if rare:
            self.hits = self.hits.unionByName(every.where(self._wanted(rare)))


def search_index(
    spark: SparkSession,
    path: str,
    sentences: DataFrame,
    phrase: str,
    limit: int = TOP,
) -> DataFrame:
    """``search`` over written postings. Only the final hits are looked up in ``sentences``.

    The postings are read once: the hits are counted as they pass by on the way to
    the top rows. Where blocks of the most frequent term are skipped, the sentences without it are counted and the
    others known from its frequency. At most ``MOST_HITS`` may be asked for, as the driver holds them.
    """
    if not 0 < limit <= MOST_HITS:
        raise ValueError(f"limit must be between 1 and {MOST_HITS}")
    known = _Lookup(spark, path, phrase, limit)
    terms, statistics = known.terms, known.statistics
    if not terms:
        return _no_hits(sentences)
    score = {
        term: _term_score(
            _idf(F.lit(statistics["documents"]), F.lit(known.found[term])), F.col("tf"), F.col("length"), F.lit(statistics["mean"])
        )
        for term in terms
    }
    # Added up in the order of the terms, as the scan does, so that both give the same score to the last digit.
    grouped = known.hits.groupBy("fileName", "position").agg(
        *[F.max(F.when(F.col("term") == term, score[term])).alias(f"_part{i}") for i, term in enumerate(terms)]
    )
    parts = [F.coalesce(f"_part{i}", F.lit(0.0)) for i in range(len(terms))]
    counted = Observation()
    if known.skipped is None:
        more, total = 0, F.count(F.lit(1))
    else:
        more, total = known.found[known.skipped], F.count_if(F.col(f"_part{terms.index(known.skipped)}").isNull())
    scored = grouped.observe(counted, total.alias("total"))
    scored = scored.select("fileName", "position", sum(parts[1:], parts[0]).alias("_score"))
    best = scored.orderBy(F.desc("_score"), "fileName", "position").limit(limit).toArrow()
    hits = spark.createDataFrame(best).withColumn("total", F.lit(counted.get["total"] + more).cast("bigint"))
    rows = look_up(sentences, hits, sorted(set(best["fileName"].to_pylist())))
    return rows.orderBy(F.desc("_score"), "fileName", "position").select(
        *HIT_COLUMNS, F.round("_score", 4).alias("score"), "total"
    )


def postings_to_read(spark: SparkSession, path: str, phrase: str, limit: int = TOP) -> DataFrame:
    """``term, postings, needed`` of each term of a phrase that occurs: how many there are, and how many a search reads."""
    known = _Lookup(spark, path, phrase, limit)
    if not known.terms:
        return spark.createDataFrame([], "term string, postings long, needed long")
    counts = known.hits.groupBy("term").agg(F.count(F.lit(1)).alias("needed"))
    found = spark.createDataFrame([(term, known.found[term]) for term in known.terms], "term string, postings long")
    return found.join(counts, "term").select("term", "postings", "needed")


def look_up(sentences: DataFrame, hits: DataFrame, names: list[str]) -> DataFrame:
    """The sentences of a few hits in the books named.

    The hits are known before the table is read, so their books become literal
    filters: on the bucket, which prunes folders, and on the name, which skips
    row groups. Without them twenty hits would cost a scan of the whole table.
    """
    wanted = F.col("fileName").isin(names)
    if "bucket" in sentences.columns:
        wanted = wanted & F.col("bucket").isin([keyed.bucket_of(F.lit(name), F.col("buckets")) for name in names])
    # At most MOST_HITS rows.
    return sentences.where(wanted).join(F.broadcast(hits), ["fileName", "position"])
