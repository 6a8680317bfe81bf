"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskstream.llm import (
    decontaminate,
    host_rules,
    html_text,
    jaccard_join,
    language_id,
    license_scan,
    negatives,
    pieces,
    quality_fm,
    secrets,
    substring_dedup,
    term_pipeline,
    weighted_sampling,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def register(function: Query) -> Query:
        REGISTRY[name] = function
        return function

    return register


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_licenses")
def licenses(spark, sf):
    found = license_scan.scan(_table(spark, sf, "documents"))
    spans = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"], m["end"]))
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.sort_array(F.array_distinct("matches.license")), ",").alias("licenses"),
        F.array_join(spans, ",").alias("spans"),
    )


@query("op2_decontamination")
def contaminated(spark, sf):
    found = decontaminate.scan(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op3_secrets")
def find_secrets(spark, sf):
    found = secrets.scan(_table(spark, sf, "documents"))

    def n(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    joined = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", n("assign"), n("access"), n("hex"), "base_sha256", joined.alias("spans"), n("cost")
    )


@query("op4_html_extraction")
def main_text(spark, sf):
    return html_text.extract_pages(_table(spark, sf, "pages"))


@query("op5_quality")
def quality(spark, sf):
    return quality_fm.assess(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


@query("op6_jaccard_join")
def similar_documents(spark, sf):
    return jaccard_join.join(_table(spark, sf, "documents"))


@query("op7_substring_dedup")
def repeated_passages(spark, sf):
    return substring_dedup.dedup(_table(spark, sf, "documents"))


@query("op8_host_rules")
def host_verdicts(spark, sf):
    return host_rules.judge(_table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op9_sentencepiece")
def encode_pieces(spark, sf):
    return pieces.with_digests(_table(spark, sf, "documents"), pieces.model_file())


@query("op10_language")
def languages(spark, sf):
    return language_id.identify(_table(spark, sf, "documents"))


@query("op11_ranked_search")
def ranked_search(spark, sf):
    return term_pipeline.rank(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


@query("op12_fingerprints")
def document_fingerprints(spark, sf):
    found = weighted_sampling.fingerprints(_table(spark, sf, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        weighted_sampling.text_of("samples").alias("fingerprint"),
        weighted_sampling.text_of("edited_samples").alias("edited_fingerprint"),
        weighted_sampling.likeness("samples", "edited_samples").alias("near_edited"),
        weighted_sampling.likeness("samples", "next_samples").alias("near_next"),
    )


@query("op13_hard_negatives")
def hard_negatives(spark, sf):
    return negatives.mine(_table(spark, sf, "embeddings"))
