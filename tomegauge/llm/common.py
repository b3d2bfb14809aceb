"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tomegauge.session import scratch_path

#: A word, as all operators here cut texts.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that Python holds at once; texts may be long.
BATCH_ROWS = 500
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Applications whose executors have the package.
_SHIPPED: set[str] = set()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """Write a table to the shared scratch folder and read it back, which cuts its lineage.

    What is read back survives the loss of any executor. With ``tidy`` Spark removes
    the shuffle files of the work as soon as the table is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true" if tidy else before)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def ready_for_python(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch, as one text may have megabytes, and give executors this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="tomegauge-")) / "tomegauge.zip"  # served by the driver
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def folded(text: Column) -> Column:
    """A-Z to lower case, nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % divisor


def new_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns that clash with the names an operator adds."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def nested(docs: DataFrame, *columns: Column, without: Sequence[str] = ()) -> DataFrame:
    """The rows as one struct ``_row``, less the columns ``without``, beside what an operator derives from them.

    Whatever names the caller's columns have, they clash with none of an operator; ``unnested`` gives them back.
    """
    kept = new_names(docs, without).columns
    whole = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(None).alias("none"))
    return docs.select(whole.alias("_row"), *columns)


def unnested(docs: DataFrame, without: Sequence[str] = ()) -> list[Column]:
    """The caller's columns out of ``_row``; ``docs`` is the table that was nested."""
    return [F.col(f"_row.`{c}`").alias(c) for c in new_names(docs, without).columns]


def partitions_for(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def range_splits(df: DataFrame, key: str, parts: int) -> list[float]:
    """At most ``parts - 1`` ascending cut points that deal the rows out about evenly by key.

    Only these few numbers reach the driver.
    """
    if parts < 2:
        return []
    shares = [k / parts for k in range(1, parts)]
    found = df.select(F.percentile_approx(F.col(key).cast("double"), shares, 10000)).first()[0]
    return sorted(set(found or []))


def with_range(df: DataFrame, key: str, splits: Sequence[float], name: str) -> DataFrame:
    """Number of the key range a row falls in, ascending; null keys come last."""
    if not splits:
        return df.withColumn(name, F.lit(0))
    edges = [-float("inf"), *splits, float("inf")]
    bucket = Bucketizer(splits=edges, inputCol="_key", outputCol="_range", handleInvalid="keep")
    placed = bucket.transform(df.withColumn("_key", F.col(key).cast("double")))
    return placed.withColumn(name, F.coalesce(F.col("_range").cast("int"), F.lit(len(edges)))).drop("_key", "_range")
