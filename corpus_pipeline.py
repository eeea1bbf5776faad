"""From raw documents to packed training sequences: five stages, each written as Parquet and read by the next one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from journeylens.llm import packing, pii, quality_rules, resampling
from journeylens.llm.common import table
from journeylens.llm.shingle_join import near_copies
from journeylens.runtime import bound_batches, materialize


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return quality_rules.keep(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Judges what the rules left by models of the good text and of all raw text, before any filter."""
    bound_batches(spark)
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    raw = table(spark, sf_dir, "documents", "doc_id", "text")
    return resampling.keep(docs, labels, raw=raw)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies; of rows that repeat its id, that of the least text,
    then of the least other columns. Rows without an id are in no group and stay."""
    bound_batches(spark)
    found = near_copies(docs.select("doc_id", "text"))
    dropped = materialize(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("dropped_id")).distinct())
    # One plan at every size: the dropped ids may be broadcast here and too many there.
    kept = docs.join(dropped.hint("merge"), docs["doc_id"] == dropped["dropped_id"], "left_anti")
    row = F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)))
    least = kept.filter("doc_id is not null").groupBy(F.col("doc_id").alias("id_")).agg(
        F.min_by(row, F.struct(F.col("text"), F.to_json(row))).alias("row")
    )
    one = least.select(*(F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(docs.columns)))
    return one.unionByName(kept.filter("doc_id is null"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; n_chars follows the new text."""
    bound_batches(spark)
    changed = pii.redact(docs)
    length = F.char_length(F.coalesce("text", F.lit(""))).cast(dict(docs.dtypes).get("n_chars", "long"))
    return changed.withColumn("n_chars", length) if "n_chars" in docs.columns else changed


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return packing.pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("n-gram Jaccard join", near_copies_stage),
    ("PII", personal_data_stage),
    ("best-fit packing", packing_stage),
]

#: Two stages score by models trained here, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
