"""From raw documents to token ids: five stages, each on all that the one before kept.

1. language: documents whose language cannot be told go.
2. near_duplicates: of each class of similar documents the one with the smallest id stays.
3. decontamination: documents that hold a window of a benchmark item go.
4. secrets: secrets are replaced by a mark, and ``n_chars`` follows the new text.
5. tokens: every document is encoded, and decoded again: its token ids, their number, and digests of both.

Rows without an id cannot be compared and stay in stage 2; rows that share an id stay or go together
there. A null text has no language and goes in stage 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.llm import decontaminate, jaccard_join, language_id, pieces, secrets
from riskstream.llm.storage import broadcast_if_small, new_folder, remove


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, language_id.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    later = jaccard_join.join(docs).filter("doc_id <> class_id").select("doc_id").distinct()
    return docs.join(broadcast_if_small(later), "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit = decontaminate.scan(docs, items).filter("n_hit > 0").select(F.col("doc_id").alias("id"), "version")
    hit = broadcast_if_small(hit.distinct())
    same = docs["doc_id"].eqNullSafe(hit["id"]) & (F.xxhash64(docs["text"]) == hit["version"])
    return docs.join(hit, same, "left_anti")


def hidden_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.with_tokens(docs, pieces.model_file())


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", hidden_secrets),
    ("tokens", tokens),
]

#: SQL can state neither the trained model nor the merges; the tests run the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of ``sf_dir`` through all stages, each written and read again."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        folder = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            remove(spark, before)
        before = folder
    return docs
