"""Stages from raw documents to balanced shards.

Each stage takes the documents its predecessor kept, works on all of them and
gives those it keeps; the last one adds the shard of each.

All but the last give the columns they were given, of any names. Null and empty texts score as texts without words and are no copies and no leaks;
mixing takes them in complete epochs only. Null ids and sources are kept as they are. Rows that repeat count as copies, of
which one stays, unless they have no words. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tomegauge.llm import decontamination, mixing, near_dedup, sharding, toxicity
from tomegauge.llm.common import read_table, stored


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents predicted toxic by a model of the labelled ones among ``docs``."""
    return toxicity.without_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by a similarity of 0.8 of their five-word shingles."""
    return near_dedup.dedup(docs, width=5, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontamination.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops whole documents so that each source comes near its target number of words."""
    return mixing.mixed(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``size, shard, slot``: contiguous shards of about equal bytes."""
    return sharding.shard(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: The stages hold trained models and sketches, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
