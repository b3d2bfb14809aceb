"""Windows and running totals that do not gather a large group in one task."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlapping_chunks(df: DataFrame, position: str, overlap: int, size: int) -> DataFrame:
    """Cut each book into chunks of ``size`` positions, each led in by ``overlap`` earlier ones.

    Adds ``chunk`` and ``native`` (false for lead-in rows). A frame that looks
    back at most ``overlap`` positions sees the same rows in its chunk as in the
    whole book, so a window may be partitioned by chunk and a long book spreads
    over many tasks.
    """
    if size <= overlap:
        raise ValueError("size must exceed overlap")
    place = F.col(position)
    chunk = F.floor(place / size)
    leads_in = place % size >= size - overlap
    copies = F.when(leads_in, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    return df.withColumn("chunk", F.explode(copies)).withColumn(
        "native", F.col("chunk") == F.floor(place / size)
    )


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    buckets: Sequence[tuple[str, Column]],
    order: Sequence[Column],
    value: str,
    name: str,
    narrow: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Sum of ``value`` over the rows before each row of its group, exact, in two steps.

    ``buckets`` are (column, ascending order of it) pairs that cut the ordered
    group into consecutive runs; ``order`` sorts within a run. The bucket totals
    are summed first, one row per bucket; then each bucket adds up its own rows.
    No task sees all rows of a group. ``narrow`` may drop or widen the bucket
    rows (``keys``, buckets, ``bucket_start``) before they meet the others.
    """
    names = [column for column, _ in buckets]
    before = (Window.unboundedPreceding, -1)
    across = Window.partitionBy(*keys).orderBy(*[o for _, o in buckets]).rowsBetween(*before)
    starts = (
        df.groupBy(*keys, *names)
        .agg(F.sum(value).alias("_total"))
        .withColumn("bucket_start", F.coalesce(F.sum("_total").over(across), F.lit(0)))
        .drop("_total")
    )
    if narrow is not None:
        starts = narrow(starts)
    within = Window.partitionBy(*keys, *names).orderBy(*order).rowsBetween(*before)
    return (
        df.join(starts, [*keys, *names])
        .withColumn(name, F.col("bucket_start") + F.coalesce(F.sum(value).over(within), F.lit(0)))
        .drop("bucket_start")
    )
