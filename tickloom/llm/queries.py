"""The operators as named queries over whole tables, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import (
    cotraining, decontaminate, katz, lines, minhash, mixing, neighbours, oracles, phrases, repeats, sharding, spelling, toxicity, urls,
)

#: The rules of op11: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _line_digest(docs: DataFrame) -> DataFrame:
    kept = lines.deduplicate_lines(docs.select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return kept.select("doc_id", "line_count", "lines_removed", digest.alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_source_mixing": lambda s, d: mixing.mix(
            _table(s, d, "documents").select("doc_id", "source", "text")).drop("text"),
        "op2_embedding_near_dedup": lambda s, d: neighbours.near_duplicates(
            _table(s, d, "embeddings")).drop("audited_recall"),
        "op3_sharding": lambda s, d: sharding.place(
            _table(s, d, "documents").select("doc_id", "source"), corpus_pipeline.SHARDS),
        "op4_quality_cotraining": lambda s, d: cotraining.quality(_table(s, d, "documents"), _table(s, d, "labels")),
        "op5_line_dedup": lambda s, d: _line_digest(_table(s, d, "documents")),
        "op6_minhash_near_dedup": lambda s, d: minhash.near_duplicates(_table(s, d, "documents")),
        "op7_toxicity": lambda s, d: toxicity.toxicity(_table(s, d, "documents"), _table(s, d, "labels")),
        "op8_katz_scores": lambda s, d: katz.scores(_table(s, d, "documents")),
        "op9_repeated_substrings": lambda s, d: repeats.remove_repeats(_table(s, d, "documents")),
        "op10_benchmark_decontamination": lambda s, d: decontaminate.contamination(
            _table(s, d, "documents"), _table(s, d, "benchmark")).drop("hit_words"),
        "op11_url_filters": lambda s, d: urls.judge(
            _table(s, d, "pages"), s.createDataFrame(URL_RULES, "host string, path string, verdict string")),
        "op12_phrase_collocations": lambda s, d: phrases.collocations(_table(s, d, "documents")),
        "op13_spelling_variants": lambda s, d: spelling.variants(_table(s, d, "documents")),
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    shards = corpus_pipeline.SHARDS
    owners = [shards[i] for i in sharding.fill(shards, sharding.table_size(len(shards)))]
    return {
        "op2_embedding_near_dedup": oracles.NEIGHBOURS,
        "op3_sharding": oracles.sharding(owners),
        "op5_line_dedup": oracles.LINES,
        "op9_repeated_substrings": oracles.REPEATS,
        "op6_minhash_near_dedup": oracles.MINHASH,
        "op10_benchmark_decontamination": oracles.DECONTAMINATE,
        "op11_url_filters": oracles.URLS,
        "op12_phrase_collocations": oracles.PHRASES,
        "op13_spelling_variants": oracles.SPELLING,
    }
