"""Session for local runs, and the shared scratch folder."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app_name: str = "tomegauge", memory: str = "12g") -> SparkSession:
    """A session for tests and the benchmark. On a cluster the caller brings its own."""
    shuffle = os.cpu_count() if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_fallbacks: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back on a temporary folder of this machine, one
    per application. The settings of the session stay as they are.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        application = spark.sparkContext.applicationId
        if application not in _fallbacks:
            _fallbacks[application] = tempfile.mkdtemp(prefix="tomegauge-")
        shared = _fallbacks[application]
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Share the rows of a scan that has fewer splits than the cluster has cores.

    Splits of a file with one row group are mostly empty, so a few splits may
    mean a single busy task. A scan with enough splits stays as it is: a large
    input is never shuffled for this. The number of shuffle partitions is left to
    adaptive execution.
    """
    if df.rdd.getNumPartitions() >= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(*keys)
