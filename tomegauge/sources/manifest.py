"""The manifest of a library: one stored row per file that was loaded, so that a load opens only new or changed files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILES = T.StructType(
    [
        T.StructField("address", T.StringType()),
        T.StructField("fileName", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("load", T.LongType()),
    ]
)

SAME_FILE = ["address", "length", "modified"]


def known_files(spark: SparkSession, path: str) -> DataFrame:
    """The files as they were loaded last, one row each. Those found gone are left out."""
    rows = spark.read.schema(FILES).parquet(path)
    last = rows.groupBy("address").agg(F.max_by(F.struct("fileName", "length", "modified", "load"), "load").alias("last"))
    return last.select("address", "last.*").where(F.col("modified").isNotNull())


def changed_files(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Listed files that are new, or have another length or time than when they were loaded."""
    return listed.join(known.select(*SAME_FILE), SAME_FILE, "left_anti").select("address", "fileName", "length", "modified")


def unchanged_files(listed: DataFrame, known: DataFrame) -> DataFrame:
    """The other listed files: loaded as they are."""
    return listed.join(known.select(*SAME_FILE), SAME_FILE, "left_semi")


def gone_files(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Files that were loaded and are no longer there."""
    return known.join(listed.select("address"), "address", "left_anti")


def record_files(files: DataFrame, path: str, load: int, gone: bool = False) -> None:
    """Add what a finished load read to the manifest, or that it found files gone."""
    modified = F.lit(None).cast("timestamp") if gone else F.col("modified")
    rows = files.select("address", "fileName", "length", modified.alias("modified"), F.lit(load).cast("long").alias("load"))
    rows.write.mode("append").parquet(path)


def last_load(spark: SparkSession, path: str) -> int:
    """Number of the last load of a manifest, 0 of an empty one."""
    return spark.read.schema(FILES).parquet(path).agg(F.coalesce(F.max("load"), F.lit(0))).first()[0]
