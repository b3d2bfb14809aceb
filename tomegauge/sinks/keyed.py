"""Keyed tables on Parquet: a row with a known key replaces the old one."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tomegauge.session import scratch_path

BUCKETS = 256

#: Parts of a table, by the hash of the first key, by which a merge tells rows that the batch cannot meet.
SLOTS = 1 << 20


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark cuts each key to one row before the shuffle as well as after it
    (``WindowGroupLimit``), so a key with very many copies stays cheap.
    """
    newest = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_place", F.row_number().over(newest)).where(F.col("_place") == 1).drop("_place")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` with the rows of ``new`` added, or put in the place of those with the same key.

    Of several new rows with one key the greatest by their other columns counts.
    """
    others = [F.desc(column) for column in new.columns if column not in keys]
    batches = old.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
    return latest(batches, keys, [F.desc("_batch"), *others]).drop("_batch")


def bucket_of(key: Column | str, buckets: Column | int) -> Column:
    count = F.lit(buckets) if isinstance(buckets, int) else buckets
    return F.pmod(F.xxhash64(key), count).cast("int")


def in_bucket_of(value: str) -> Column:
    """Whether a row's bucket is that of ``value``: a filter on folders, before any file is opened."""
    return F.col("bucket") == bucket_of(F.lit(value), F.col("buckets"))


def of_book(table: DataFrame, file_name: str) -> Column:
    """The rows of one book; where the table has its bucket columns, other buckets are not opened."""
    named = F.col("fileName") == file_name
    return in_bucket_of(file_name) & named if {"bucket", "buckets"} <= set(table.columns) else named


def _bucketed(rows: DataFrame, bucket_by: str, buckets: int) -> DataFrame:
    return rows.withColumns({"buckets": F.lit(buckets), "bucket": bucket_of(bucket_by, buckets)})


def write_bucketed(rows: DataFrame, path: str, order: Sequence[str], mode: str = "static", dealt: bool = False) -> None:
    """Rebalanced by bucket: one file per bucket where it fits, more where a bucket is hot.

    Rows that come ``dealt`` by bucket, as from the files of a keyed table, are written as they lie, without a shuffle.

    Rows are sorted within each file, so a look-up by key skips row groups. The
    number of buckets is part of the folder names, so that readers need not know it. A ``dynamic`` write replaces only
    the buckets that have rows, an ``append`` adds files to them.
    """
    (
        (rows if dealt else rows.hint("rebalance", "bucket"))
        .sortWithinPartitions("bucket", *order)
        .write.mode("append" if mode == "append" else "overwrite")
        .option("partitionOverwriteMode", "dynamic" if mode == "dynamic" else "static")
        .partitionBy("buckets", "bucket")
        .parquet(path)
    )


def newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; of several the greatest by their other columns counts."""
    return latest(rows, keys, [F.desc(column) for column in rows.columns if column not in keys])


def create_keyed(
    rows: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS, unique: bool = False
) -> None:
    """First load of a keyed table, bucketed by the first of its keys.

    Of rows with one key only the newest stays; ``unique`` says that there are none, which saves a shuffle.
    """
    rows = rows if unique else newest(rows, keys)
    write_bucketed(_bucketed(rows, keys[0], buckets), path, keys)


def _names(spark: SparkSession, names: DataFrame, key: str) -> DataFrame:
    """The distinct names, written once: small as they are they can be sent to the old rows, and what they come from is read once."""
    names_path = scratch_path(spark, "names")
    names.select(key).distinct().write.parquet(names_path)
    return spark.read.parquet(names_path)


def _buckets_of(names: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets of keys, at most ``buckets`` numbers."""
    return [row.bucket for row in names.select(bucket_of(key, buckets).alias("bucket")).distinct().collect()]


def _apart(spark: SparkSession, here: DataFrame, gone: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows that share no slot with a name that is both in ``here`` and in ``gone``, and the others.

    The slots are at most ``SLOTS`` numbers, however many names there are, so they can always be sent to the rows.
    """
    held = here.select(key).distinct().join(gone.select(key).distinct(), key, "left_semi")
    slots_path = scratch_path(spark, "slots")
    held.select(bucket_of(key, SLOTS).alias("_slot")).distinct().write.parquet(slots_path)
    slots = F.broadcast(spark.read.schema("_slot int").parquet(slots_path))
    slotted = here.withColumn("_slot", bucket_of(key, SLOTS))
    return tuple(slotted.join(slots, "_slot", how).drop("_slot") for how in ("left_anti", "left_semi"))


def _add(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], gone: DataFrame, touched: Sequence[int], unique: bool) -> bool:
    """Add rows to a table that holds nothing under the names ``gone``; where it does, nothing is written.

    The least and greatest name let the look-up skip row groups, as the files are sorted by key.
    """
    table = spark.read.parquet(path)
    ends = gone.agg(F.min(keys[0]).alias("least"), F.max(keys[0]).alias("greatest")).first()
    near = F.col(keys[0]).between(F.lit(ends.least), F.lit(ends.greatest))
    here = table.where(F.col("bucket").isin(list(touched)) & near).select(keys[0])
    if not here.join(gone, gone.columns, "left_semi").isEmpty():
        return False
    buckets = table.select("buckets").first().buckets
    write_bucketed(_bucketed(rows if unique else newest(rows, keys), keys[0], buckets), path, keys, "append")
    spark.catalog.refreshByPath(path)
    return True


def _file_names(table: DataFrame) -> set[str]:
    return {file.rsplit("/", 1)[-1] for file in table.inputFiles()}


def add_keyed(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], names: DataFrame, unique: bool = False) -> DataFrame | None:
    """Add a batch to a keyed table with rows that holds nothing under ``names``; gives the rows added, as read back.

    None if the table does hold some, or there are no names: then nothing is written, and ``merge_keyed`` has to be called.
    """
    table = spark.read.parquet(path)
    buckets = table.select("buckets").first().buckets
    gone = _names(spark, names, keys[0])
    touched = _buckets_of(gone, keys[0], buckets)
    before = _file_names(table)
    if not touched or not _add(spark, path, rows, keys, gone, touched, unique):
        return None
    table = spark.read.parquet(path)
    # Each write has names of its own, one for each task; other files are not opened.
    return table.where(F.col("_metadata.file_name").isin(sorted(_file_names(table) - before)))


def merge_keyed(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    keys: Sequence[str],
    names: DataFrame | None = None,
    unique: bool = False,
) -> list[int] | None:
    """Load rows into a keyed table; gives the buckets written, None for all.

    Without ``names`` a row replaces the one with the same key. With ``names``, one column
    named as the first key, all rows under these names are replaced: what the batch
    no longer holds of them goes. A table without rows, as after a reset, is made anew.

    Where the table holds nothing under ``names``, the batch is added to it. Else
    only the buckets the batch touches are read and rewritten. Of their rows only those are shuffled whose books
    the batch may hold; the others stay in the tasks that read them. The merged rows are first
    written to the scratch folder, as a table cannot be overwritten while it is read,
    and from there by ``replace_buckets``. A lost executor costs a task.
    """
    table = spark.read.parquet(path)
    found = table.select("buckets").first() if "buckets" in table.columns else None
    if found is None:
        if "buckets" not in table.columns and not table.isEmpty():
            raise ValueError(f"{path} holds rows but is not a keyed table")
        create_keyed(rows, path, keys, unique=unique)
        return None
    buckets = found.buckets
    if names is None:
        # Written once, as the old table is cut by its keys and the merged one holds its rows.
        batch_path = scratch_path(spark, "batch")
        rows.write.parquet(batch_path)
        rows = spark.read.schema(rows.schema).parquet(batch_path)
        gone = rows.select(*keys).distinct()
    else:
        gone = _names(spark, names, keys[0])
    touched = _buckets_of(gone, keys[0], buckets)
    if not touched:
        return []
    if names is not None and _add(spark, path, rows, keys, gone, touched, unique):
        return touched
    here = table.where(F.col("bucket").isin(touched))
    batch = _bucketed(rows if unique else newest(rows, keys), keys[0], buckets)
    stay, near = _apart(spark, here, gone, keys[0])
    old = near.join(gone, gone.columns, "left_anti")
    moved = old.select(*table.columns).unionByName(batch.select(*table.columns)).hint("rebalance", "bucket")
    merged = scratch_path(spark, "merged")
    write_bucketed(stay.select(*table.columns).unionByName(moved), merged, keys, dealt=True)
    replace_buckets(spark, path, spark.read.schema(table.schema).parquet(merged), keys, buckets, touched, dealt=True)
    return touched


def replace_buckets(
    spark: SparkSession, path: str, merged: DataFrame, order: Sequence[str], buckets: int, touched: Sequence[int], dealt: bool = False
) -> None:
    """Put the rows of ``merged``, which must not be read from the table, in the place of the buckets ``touched``.

    Spark's dynamic partition overwrite does it in one commit. It leaves buckets without rows alone, so
    those are overwritten with an empty file each. A call that was broken off may be repeated.
    """
    write_bucketed(merged, path, order, "dynamic", dealt)
    filled = {row.bucket for row in merged.select("bucket").distinct().collect()}  # at most ``buckets`` numbers
    empty = merged.drop("buckets", "bucket").where(F.lit(False))
    for bucket in sorted(set(touched) - filled):
        empty.write.mode("overwrite").parquet(f"{path.rstrip('/')}/buckets={buckets}/bucket={bucket}")
    spark.catalog.refreshByPath(path)
