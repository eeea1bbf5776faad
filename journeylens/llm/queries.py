"""One registered query per operator, over its whole table, with the digest columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, centroids, oracles, packing, pii, quality_rules, resampling, secrets, suffix_array, toxicity, warc, word_automaton
from .common import table
from .knn_graph import near_duplicates
from .shingle_join import near_copies


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_documents(spark, sf_dir), table(spark, sf_dir, "labels", "doc_id", "quality"))


def _places(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(kind: str, name: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(name)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"] != pii.CONTEXT)
    return pii.find(_documents(spark, sf_dir)).select(
        "doc_id",
        *(_count(kind, f"n_{kind}") for kind in pii.KINDS),
        F.sha2(_places(base), 256).alias("base_sha256"),
        _places(F.col("spans")).alias("spans"),
    )


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(_documents(spark, sf_dir))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, folder = warc.archive(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return warc.read(index, folder, with_payload=False).select(*columns)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(_documents(spark, sf_dir), ranks, public_tokenizers.PATTERN).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(_documents(spark, sf_dir), table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_documents(spark, sf_dir), table(spark, sf_dir, "labels", "doc_id", "quality"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"] != secrets.RANDOM)
    return secrets.find(_documents(spark, sf_dir)).select(
        "doc_id",
        *(_count(kind, f"n_{kind}") for kind in secrets.KINDS),
        F.sha2(_places(base), 256).alias("base_sha256"),
        _places(F.col("spans")).alias("spans"),
    )


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_automaton.draw(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark", "text"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.without_repeats(_documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_digest(*centroids.cluster(table(spark, sf_dir, "embeddings", "vec_id", "embedding")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_quality_rules, op2_pii, op3_ngram_jaccard_join, op4_warc, op5_byte_bpe, op6_toxicity,
        op7_embedding_near_dedup, op8_best_fit_packing, op9_quality_classifier, op10_secret_scan,
        op11_target_resampling, op12_suffix_dedup, op13_centroid_clusters,
    )
    return {query.__name__: query for query in named}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_ngram_jaccard_join": oracles.NEAR_COPIES,
        "op4_warc": oracles.ARCHIVED,
        "op7_embedding_near_dedup": oracles.NEAR_DUPLICATES,
        "op11_target_resampling": oracles.TARGET_RESAMPLING,
        "op12_suffix_dedup": oracles.REPEATED_PASSAGES,
        "op13_centroid_clusters": oracles.centroid_clusters(),
    }
