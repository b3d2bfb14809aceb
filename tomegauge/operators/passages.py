"""Scores of parts of a book: ranges, blocks, rolling passages, trends."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomegauge.functions import grades
from tomegauge.operators.running import overlapping_chunks
from tomegauge.operators.scores import book_scores, graded
from tomegauge.sinks import keyed

# Fixed value: SMOG is defined on passages of thirty sentences.
PASSAGE_SENTENCES = 30

CHUNK_POSITIONS = 3000

# Size of a quantile sketch: exact up to as many blocks, beyond that ranks err by less than a thousandth.
SKETCH_SIZE = 4096
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)

# What another segment must save in squared grades.
PENALTY = 12.0


def passage_score(sentences: DataFrame, file_name: str, first: int, last: int) -> DataFrame:
    """Grade of sentences ``first`` to ``last`` of one book, both included; of a stored table one bucket is opened."""
    return book_scores(passage(sentences, first, last).where(keyed.of_book(sentences, file_name)))


def passage_scores(sentences: DataFrame, first: int, last: int) -> DataFrame:
    """The same for every book."""
    return book_scores(passage(sentences, first, last))


def passage(sentences: DataFrame, first: int, last: int) -> DataFrame:
    return sentences.where(F.col("position").between(first, last))


def passage_scores_by_running(
    sentences: DataFrame, running: DataFrame, first: int, last: int, size: int, file_name: str | None = None
) -> DataFrame:
    """``passage_scores``, or ``passage_score`` of one book, as the difference of two running counts.

    ``running`` are the counts before each chunk of ``size`` positions (``sinks.totals``). The
    counts before ``first`` and after ``last`` each come from one of its rows and the sentences of at
    most one chunk, so a long passage reads no more than a short one.
    """
    if file_name is not None:
        sentences = sentences.where(keyed.of_book(sentences, file_name))
        running = running.where(keyed.of_book(running, file_name))
    low, high = first // size, (last + 1) // size

    def before(chunk: int, kind: str) -> Column:
        # Past the end of a book its total counts.
        there = F.max(F.when(F.col("chunk") == chunk, F.col(f"{kind}Before")))
        return F.coalesce(there, F.when(F.max("chunk") < chunk, F.max(f"{kind}Through")), F.lit(0))

    ends = running.groupBy("fileName").agg(
        (before(high, "sentences") - before(low, "sentences")).alias("doc_count"),
        (before(high, "multiSyllables") - before(low, "multiSyllables")).alias("sum_multiSyllables"),
    )
    place = F.col("position")
    taken, given = place.between(low * size, first - 1), place.between(high * size, last)
    edges = sentences.where(taken | given).select(
        "fileName", place.alias("position"), F.col("multiSyllableCount").cast("bigint").alias("multiSyllableCount")
    )
    sign = F.when(given, 1).otherwise(0) - F.when(taken, 1).otherwise(0)
    edges = edges.select("fileName", sign.cast("bigint").alias("doc_count"), (sign * F.col("multiSyllableCount")).alias("sum_multiSyllables"))
    summed = ends.unionByName(edges).groupBy("fileName").agg(
        F.sum("doc_count").alias("doc_count"), F.sum("sum_multiSyllables").alias("sum_multiSyllables")
    )
    return graded(summed.where(F.col("doc_count") > 0))


def block_scores(sentences: DataFrame, size: int = PASSAGE_SENTENCES) -> DataFrame:
    """Grade of each full block of ``size`` sentences; a shorter rest has none."""
    return (
        sentences.groupBy("fileName", F.floor(F.col("position") / size).alias("block"))
        .agg(
            F.count(F.lit(1)).alias("doc_count"),
            F.sum("multiSyllableCount").alias("sum_multiSyllables"),
        )
        .where(F.col("doc_count") == size)
        .withColumn("smog", grades.smog(F.col("sum_multiSyllables"), F.col("doc_count")))
    )


def block_distribution(sentences: DataFrame, size: int = PASSAGE_SENTENCES) -> DataFrame:
    """Number, extremes and quartiles of the block grades per book.

    Grades have two decimals, so the exact percentile keeps a bounded count per
    distinct grade however many blocks a book has.
    """
    return (
        block_scores(sentences, size)
        .groupBy("fileName")
        .agg(
            F.count(F.lit(1)).alias("blocks"),
            F.min("smog").alias("min_smog"),
            F.round(F.percentile("smog", 0.25), 4).alias("q1_smog"),
            F.round(F.percentile("smog", 0.5), 4).alias("median_smog"),
            F.round(F.percentile("smog", 0.75), 4).alias("q3_smog"),
            F.max("smog").alias("max_smog"),
        )
    )


def block_histogram(sentences: DataFrame, size: int = PASSAGE_SENTENCES) -> DataFrame:
    """Blocks per whole grade and book."""
    return (
        block_scores(sentences, size)
        .groupBy("fileName", F.floor("smog").alias("grade"))
        .agg(F.count(F.lit(1)).alias("blocks"))
    )


def rolling_scores(
    sentences: DataFrame,
    size: int = PASSAGE_SENTENCES,
    chunk_positions: int = CHUNK_POSITIONS,
) -> DataFrame:
    """Grade of the ``size`` sentences that end at each position, where that many exist."""
    narrow = sentences.select("fileName", "position", "multiSyllableCount")
    frame = (
        Window.partitionBy("fileName", "chunk").orderBy("position").rangeBetween(-(size - 1), Window.currentRow)
    )
    return (
        overlapping_chunks(narrow, "position", size - 1, max(chunk_positions, size))
        .withColumn("passage_sentences", F.count(F.lit(1)).over(frame))
        .withColumn("passage_multiSyllables", F.sum("multiSyllableCount").over(frame))
        .where(F.col("native") & (F.col("passage_sentences") == size))
        .select(
            "fileName",
            "position",
            "passage_multiSyllables",
            grades.smog(F.col("passage_multiSyllables"), F.col("passage_sentences")).alias("smog"),
        )
    )


def block_changes(
    sentences: DataFrame,
    size: int = PASSAGE_SENTENCES,
    chunk_positions: int = CHUNK_POSITIONS,
) -> DataFrame:
    """Grade of each full block beside that of the block before it."""
    order = Window.partitionBy("fileName", "chunk").orderBy("block")
    blocks = block_scores(sentences, size).select("fileName", "block", "smog")
    return (
        overlapping_chunks(blocks, "block", 1, chunk_positions)
        .withColumn("previous_smog", F.lag("smog").over(order))
        .where("native")
        .select(
            "fileName",
            "block",
            "smog",
            "previous_smog",
            F.round(F.col("smog") - F.col("previous_smog"), 2).alias("change"),
        )
    )


def book_trends(sentences: DataFrame, size: int = PASSAGE_SENTENCES) -> DataFrame:
    """Slope of the block grades along each book of two blocks or more."""
    return (
        block_scores(sentences, size)
        .groupBy("fileName")
        .agg(
            F.count(F.lit(1)).alias("blocks"),
            F.round(F.regr_slope("smog", F.col("block").cast("double")), 4).alias("slope"),
        )
        .where(F.col("blocks") > 1)
    )


def grade_sketches(sentences: DataFrame, size: int = PASSAGE_SENTENCES, sketch: int = SKETCH_SIZE) -> DataFrame:
    """A quantile sketch of the block grades per book: ``fileName, blocks, sketch``, which may be stored and merged."""
    return block_scores(sentences, size).groupBy("fileName").agg(
        F.count(F.lit(1)).alias("blocks"), F.kll_sketch_agg_double("smog", sketch).alias("sketch")
    )


def merged_sketches(sketches: DataFrame, *by: str, sketch: int = SKETCH_SIZE) -> DataFrame:
    """The sketches of groups of books, or without ``by`` of all: the grades themselves are not read again."""
    return sketches.groupBy(*by).agg(F.sum("blocks").alias("blocks"), F.kll_merge_agg_double("sketch", sketch).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """A row per sketch and quantile: the least grade whose rank reaches it."""
    pairs = [
        F.struct(F.lit(float(q)).alias("quantile"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias("smog"))
        for q in quantiles
    ]
    kept = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*kept, F.inline(F.array(*pairs)))


def _cost(at: Column, place: Column, total: Column, square: Column) -> Column:
    """Least cost of the grades so far, if the last segment begins after candidate ``at``: squared distances from the means."""
    length = (place - at["place"]).cast("double")
    gap = total - at["total"]
    return at["cost"] + ((square - at["square"]) - gap * gap / length)


def change_points(sentences: DataFrame, size: int = PASSAGE_SENTENCES, penalty: float = PENALTY) -> DataFrame:
    """Each book's blocks in segments of about equal grade: ``fileName, segment, first_block, last_block, mean_smog``.

    The segments are those with the least sum of squared distances from their mean grades, plus ``penalty`` per
    segment; of equal sums (to six decimals) the one whose last segment begins first. Found in one pass over a book's full blocks that
    keeps only beginnings which may still be best (Killick, Fearnhead and Eckley 2012). A row holds one book's
    grades, a thirtieth of its sentences; the time grows with the square of the blocks of a book that never changes.
    """
    blocks = block_scores(sentences, size).groupBy("fileName").agg(
        F.array_sort(F.collect_list(F.struct("block", "smog")))["smog"].alias("grades")
    )
    start = F.struct(
        F.lit(0).alias("place"), F.lit(0.0).alias("cost"), F.lit(0.0).alias("total"), F.lit(0.0).alias("square"),
        F.array().cast("array<int>").alias("cuts"),
    )
    state = F.struct(F.array(start).alias("open"), start.alias("best"))

    def step(so_far: Column, grade: Column) -> Column:
        place = so_far["best"]["place"] + 1
        total, square = so_far["best"]["total"] + grade, so_far["best"]["square"] + grade * grade
        # Bound once: each candidate with its cost up to here.
        costed = F.transform(so_far["open"], lambda at: F.struct(_cost(at, place, total, square).alias("sum"), at.alias("at")))
        least = F.array_min(F.transform(costed, lambda c: F.struct(F.round(c["sum"] + penalty, 6).alias("cost"), c["at"]["place"].alias("from"), c["at"]["cuts"].alias("cuts"))))
        joined = F.transform(
            F.array(F.struct(costed.alias("costed"), least.alias("least"))),
            lambda x: F.struct(
                F.filter(x["costed"], lambda c: c["sum"] <= x["least"]["cost"]).alias("costed"),
                F.struct(
                    place.alias("place"), x["least"]["cost"].alias("cost"), total.alias("total"), square.alias("square"),
                    F.concat(x["least"]["cuts"], F.array(x["least"]["from"])).alias("cuts"),
                ).alias("best"),
            ),
        )[0]
        return F.transform(
            F.array(joined),
            lambda x: F.struct(F.concat(F.transform(x["costed"], lambda c: c["at"]), F.array(x["best"])).alias("open"), x["best"].alias("best")),
        )[0]

    found = blocks.select("fileName", "grades", F.aggregate("grades", state, step)["best"]["cuts"].alias("cuts"))
    rows = found.select("fileName", "grades", "cuts", F.posexplode("cuts").alias("segment", "first_block"))
    end = F.coalesce(F.try_element_at("cuts", F.col("segment") + 2), F.size("grades"))
    part = F.slice("grades", F.col("first_block") + 1, end - F.col("first_block"))
    mean = F.aggregate(part, F.lit(0.0), lambda a, x: a + x) / F.size(part)
    return rows.select("fileName", "segment", "first_block", (end - 1).alias("last_block"), F.round(mean, 2).alias("mean_smog"))
