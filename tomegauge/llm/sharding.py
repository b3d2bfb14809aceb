"""Contiguous shards of about equal bytes, by prefix sums in DataFrame functions only.

Rows are put in order of their id and dealt out to ranges of ids. The totals of
the ranges, one row each, are summed up first; then each range adds up its own rows.
That gives every row its place among all bytes, and the cut points are equal parts of the sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tomegauge.llm.common import nested, partitions_for, range_splits, unnested, with_range

SHARDS = 8
ADDED = ["size", "shard", "slot"]


def shard(docs: DataFrame, shards: int = SHARDS, ranges: int | None = None) -> DataFrame:
    """``docs(doc_id, text)`` with ``size, shard, slot`` added; every row stays.

    ``size`` is the UTF-8 bytes of the text plus 1; a null text has no bytes. Rows
    are ordered by doc_id (null last), then by a hash of the text; equal rows may
    change places with each other. A row belongs to the shard in which the middle of
    its bytes falls, so a shard is off an equal part by at most the largest
    row at either end; shards may stay empty where a row is larger than a part.
    ``slot`` counts the rows of a shard from 0 in that order. Columns named like the
    new ones are replaced, all others are kept as they were. An empty table gives no rows.
    """
    ranges = ranges or partitions_for(docs)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    rows = nested(docs, F.col("doc_id"), size.alias("_size"), F.xxhash64("text").alias("_tie"), without=ADDED)
    rows = with_range(rows, "doc_id", range_splits(docs, "doc_id", ranges), "_place")

    totals = rows.groupBy("_place").agg(F.sum("_size").alias("_bytes"), F.count("*").alias("_rows"))
    earlier = Window.orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = totals.select(
        F.col("_place").alias("_range"),
        F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(Window.partitionBy()).alias("_all"),
    )
    order = Window.partitionBy("_place").orderBy(F.col("doc_id").asc_nulls_last(), "_tie", "_size")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_sum", F.sum("_size").over(running)).withColumn("_rank", F.row_number().over(order))
    rows = rows.join(starts, F.col("_place") == F.col("_range"))
    rows = rows.withColumn("_shard", F.least(F.lit(shards - 1), F.expr(f"(2 * (_bytes_before + _sum) - _size) * {shards} div (2 * _all)")))
    rows = rows.withColumn("_rank", F.col("_rows_before") + F.col("_rank") - 1)
    firsts = rows.groupBy("_shard").agg(F.min("_rank").alias("_first")).withColumnRenamed("_shard", "_of")
    rows = rows.join(F.broadcast(firsts), F.col("_shard") == F.col("_of"))  # one row per shard
    return rows.select(
        *unnested(docs, ADDED), F.col("_size").alias("size"), F.col("_shard").cast("int").alias("shard"),
        (F.col("_rank") - F.col("_first")).alias("slot"),
    )
