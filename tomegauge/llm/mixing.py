"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Each source has a target number of words. A target above the size of the source
is met by complete epochs first: every document is taken as often as the target
holds the source. What is left of the target is a weighted sample without
replacement: a document with quality weight w and a pseudo-random u in (0, 1) has
the key -ln(u) / w, and documents are taken in ascending order of their keys until the
budget is used up. u is drawn from the id and a seed, so reruns agree.

Keys are mapped to (0, 1) and cut into buckets. The bucket totals are summed
first, one row per bucket; only the bucket in which a budget ends is sorted
document by document. No task sees a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tomegauge.llm.common import nested, unnested, word_count

#: Key buckets of a source. More buckets mean fewer documents in the one that is sorted.
BUCKETS = 16384
#: A target never exceeds this many times its source.
MOST = 3.0
ADDED = ["size", "source_size", "target", "taken", "copies"]


def targets(sizes: DataFrame, most: float = MOST) -> DataFrame:
    """``source, source_size`` with ``target`` added.

    Sources by code point, null last, weigh 1, 2, 3, 1, 2, 3 and so on and share the
    sum of all sizes. A target stops at ``most`` times its source, and the excess
    is shared again by weight. With the sources in ascending order of their limit
    per weight, those that stop are the first few, which gives the answer in one pass.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("_fill", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    ranked = sizes.withColumn("_weight", (F.row_number().over(by_name) - 1) % 3 + 1)
    ranked = ranked.withColumn("_limit", F.col("source_size") * F.lit(float(most)))
    ranked = ranked.withColumn("_fill", F.col("_limit") / F.col("_weight"))
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("_limit").over(by_limit), F.lit(0.0))
    heavy = F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(by_limit), F.lit(0))
    ranked = ranked.withColumn("_share", left / heavy)
    # The first source whose own limit is not reached fixes the share per weight of all that follow.
    level = F.max(F.when(F.col("_share") <= F.col("_fill"), F.col("_share"))).over(every)
    target = F.least(F.col("_limit"), F.col("_weight") * F.coalesce(level, F.col("_fill")))
    return ranked.select("source", "source_size", target.alias("target"))


def chance(doc_id: Column, seed: int) -> Column:
    """A fixed pseudo-random number in (0, 1) drawn from the id: 52 bits of an md5."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f"#{seed}"))
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(float(1 << 52))


def sampling_key(doc_id: Column, weight: Column | None, seed: int) -> Column:
    """-ln(u) / w: ascending keys sample by weight without replacement."""
    weight = F.lit(1.0) if weight is None else weight.cast("double")
    return -F.log(chance(doc_id, seed)) / F.when(weight > 0, weight).otherwise(F.lit(1.0))


def text_quality() -> Column:
    """A weight from the text alone: the share of characters that are letters or white space, 0.1 at least."""
    odd = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\p{L}\s]"))
    return F.greatest(F.lit(0.1), 1 - odd / F.greatest(F.lit(1), F.length(F.coalesce("text", F.lit("")))))


def _before(window) -> Column:
    return F.coalesce(F.sum("_size").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the size of each text and its hash, all that the mix needs of it; the text itself may be dropped."""
    return docs.withColumn("_size", word_count(F.col("text"))).withColumn("_tie", F.xxhash64("text"))


def _planned(rows: DataFrame, whole: bool, most: float) -> DataFrame:
    """Rows with ``source``, ``_size``, ``_key`` and ``_tie``, and what the mix takes: ``_epochs`` whole and ``_part`` words more."""
    rows = rows.withColumn("_bucket", F.floor((1 - F.exp(-F.col("_key"))) * BUCKETS))

    totals = rows.groupBy("source", "_bucket").agg(F.sum("_size").alias("_size"))
    sizes = targets(totals.groupBy("source").agg(F.sum("_size").alias("source_size")), most)
    sizes = sizes.withColumn("_epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    sizes = sizes.withColumn("_budget", F.round(F.col("target") - F.col("_epochs") * F.col("source_size")).cast("long"))
    sizes = sizes.withColumnRenamed("source", "_source")
    start = totals.withColumn("_start", _before(Window.partitionBy("source").orderBy("_bucket")))
    start = start.withColumnsRenamed({"_size": "_total", "source": "_from", "_bucket": "_at"})
    plan = start.join(sizes, F.col("_from").eqNullSafe(F.col("_source"))).drop("_source")

    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("_from")) & (F.col("_bucket") == F.col("_at")))
    open_bucket = (F.col("_start") < F.col("_budget")) & (F.col("_start") + F.col("_total") > F.col("_budget"))
    order = Window.partitionBy("source", "_bucket").orderBy("_key", F.desc("_size"), "_tie")
    settled = rows.where(~open_bucket).withColumn("_part", F.when(F.col("_start") < F.col("_budget"), F.col("_size")).otherwise(F.lit(0)))
    ending = rows.where(open_bucket).withColumn("_room", F.col("_budget") - F.col("_start") - _before(order))
    part = F.greatest(F.lit(0), F.least("_size", "_room"))
    if whole:
        part = F.when(part * 2 >= F.col("_size"), F.col("_size")).otherwise(F.lit(0))
    ending = ending.withColumn("_part", part.cast("long")).drop("_room")
    return settled.withColumn("_part", F.col("_part").cast("long")).union(ending)


def mix(
    docs: DataFrame, weight: Column | None = None, seed: int = 1, whole: bool = False, most: float = MOST,
    size: Column | None = None, tie: Column | None = None,
) -> DataFrame:
    """``docs(doc_id, text, source)`` with ``size, source_size, target, taken, copies`` added; all rows stay.

    ``size`` and ``tie`` may name columns that measured() made, where the text has been dropped.

    ``taken`` counts the words the mix takes of a row, repeats included. The document
    in which a budget ends gives just the words that are left of it, or, with
    ``whole``, counts fully if at least half of it fits and else not at all; ``copies``
    is ``taken`` in documents, rounded up.

    A null text has size 0 and gives nothing; a null source is a source of its
    own, the last. Quality weights that are null or not positive count as 1. Rows
    with equal ids have equal keys; the larger goes first, then by text hash, and the
    order of equal rows changes nothing. Columns named like the new ones are replaced, all others
    are kept as they were; no rows give no rows.
    """
    rows = nested(
        docs, F.col("source"), sampling_key(F.col("doc_id"), weight, seed).alias("_key"),
        (word_count(F.col("text")) if size is None else size).alias("_size"),
        (F.xxhash64("text") if tie is None else tie).alias("_tie"), without=ADDED,
    )
    rows = _planned(rows, whole, most)
    taken = F.col("_epochs") * F.col("_size") + F.col("_part")
    return rows.select(
        *unnested(docs, ADDED), F.col("_size").alias("size"), "source_size", "target", taken.cast("long").alias("taken"),
        (F.col("_epochs") + F.when(F.col("_part") > 0, 1).otherwise(0)).cast("int").alias("copies"),
    )


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with a column ``_weight``: 2 for documents labelled good, 0.5 for bad, 1 for the others.

    Of several labels of an id the mean counts. Ids are matched exactly; a null id has no label.
    """
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("_mean"))
    marks = marks.select(F.col("doc_id").alias("_marked"), F.pow(F.lit(4.0), F.col("_mean") - 0.5).alias("_weight"))
    return docs.join(marks, F.col("doc_id") == F.col("_marked"), "left").drop("_marked")


def mixed(docs: DataFrame, weight: Column | None = None, seed: int = 1, most: float = MOST) -> DataFrame:
    """The rows of the mix: a document appears as often as it is taken, whole, with its columns as they were.

    The plan is made on ids and sizes; per source it comes down to a number of
    epochs and the last key taken after them, so the texts are not shuffled unless
    the sources are too many to broadcast. Rows equal to the last one taken are taken too.
    Documents without words, null texts among them, are taken in complete epochs only. A null source is a source
    of its own; a null doc_id draws one key for all such rows. Columns may have any names; an empty table gives no rows.
    """
    weight = text_quality() if weight is None else weight
    key = sampling_key(F.col("doc_id"), weight, seed).alias("_key")
    facts = [F.col("source"), key, word_count(F.col("text")).alias("_size"), F.xxhash64("text").alias("_tie")]
    plan = _planned(docs.select(*facts), True, most)
    mark = F.struct("_key", (-F.col("_size")).alias("_less"), "_tie")
    cuts = plan.groupBy("source").agg(F.max("_epochs").alias("_epochs"), F.max(F.when(F.col("_part") > 0, mark)).alias("_last"))
    cuts = cuts.withColumnRenamed("source", "_from")
    own = nested(docs, *facts)
    own = own.join(cuts, F.col("source").eqNullSafe(F.col("_from")))
    more = F.when((F.col("_size") > 0) & (F.struct("_key", (-F.col("_size")).alias("_less"), "_tie") <= F.col("_last")), 1).otherwise(0)
    own = own.withColumn("_copies", (F.col("_epochs") + more).cast("int")).where("_copies > 0")
    return own.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*unnested(docs))
