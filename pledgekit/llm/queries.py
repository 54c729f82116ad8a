"""The dealt operators as registered queries over their whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pledgekit.llm import (
    hard_negatives,
    language,
    license_scan,
    mixing,
    near_dedup,
    packing,
    quality_model,
    quality_rules,
    repeats,
    secret_scan,
    topk,
    url_filter,
    vector_codes,
)

TOKENIZER = public_tokenizers.path(packing.VOCABULARY)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": corpus_pipeline.run}
SQL: dict[str, str] = {
    "op3_quality_rules": quality_rules.SQL,
    "op4_mixing": mixing.SQL,
    "op8_exact_top_k": topk.SQL,
    "op11_vector_codes": vector_codes.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_license_scan": license_scan.SQL,
}


def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_digest(table(spark, sf_dir, "documents"), TOKENIZER)


@register
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


@register
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


@register
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    apart = language.held_out(F.col("doc_id"), 4, 2)
    model = language.learn_languages(docs.filter(~apart))
    return language.identify_languages(docs, model).select("doc_id", apart.alias("held_out"), "lang_pred", "score")


@register
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    apart = language.held_out(F.col("doc_id"), 5, 0)
    model = quality_model.learn_quality(docs.filter(~apart), labels.filter(~apart))
    return quality_model.score_quality(docs, model).select("doc_id", apart.alias("held_out"), "score", "predicted")


@register
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages)


@register
def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@register
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.span_digest(secret_scan.secret_spans(table(spark, sf_dir, "documents")))


@register
def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digest(table(spark, sf_dir, "documents"))


@register
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


@register
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, moved)


@register
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))
