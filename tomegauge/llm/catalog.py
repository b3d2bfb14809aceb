"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tomegauge.llm import decontamination, hard_negatives, language_model, mixing, near_dedup, oracle, passages, runs, secrets, sharding, tokens, toxicity, url_filters, winnowing
from tomegauge.llm.common import read_table, remainder


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return secrets.findings(docs, F.col("source"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(read_table(spark, sf_dir, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 7) == 2
    found = language_model.scores(read_table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mixing.measured(read_table(spark, sf_dir, "documents")).select("doc_id", "source", "_size", "_tie")
    weighted = mixing.quality(docs, read_table(spark, sf_dir, "labels"))
    found = mixing.mix(weighted, F.col("_weight"), size=F.col("_size"), tie=F.col("_tie"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.scored(docs, read_table(spark, sf_dir, "labels"))
    return found.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    config = Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")
    found = tokens.round_trip(read_table(spark, sf_dir, "documents"), config, end=2)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_and_next(read_table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_crc32", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")))
    return sharding.shard(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return runs.digests(runs.periodic_runs(runs.with_loops(docs)))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0, label)


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(
        "SELECT * FROM VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), "
        "('net', '/es/', 'block'), ('net', '/fr/', 'block') AS rules(host, path, verdict)"
    )
    found = url_filters.judged(read_table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return found.select("page_id", "host", "path", "rule", "verdict")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_secret_scan, op2_substring_dedup, op3_minhash_near_dedup, op4_lm_scores, op5_mix_sources, op6_toxicity, op7_decontamination, op8_wavelet_tokens, op9_fingerprints, op10_sharding, op11_periodic_runs, op12_hard_negatives, op13_url_filters]
    return {query.__name__: query for query in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
