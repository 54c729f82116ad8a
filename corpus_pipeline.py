"""From raw documents to packed training sequences: five stages, each a DataFrame to the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pledgekit.llm import mixing, near_dedup, packing, quality_model, secret_scan
from pledgekit.runtime import stage

TOKENIZER = public_tokenizers.path(packing.VOCABULARY)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from the labelled ones among them, does not reject.

    A null or empty text is scored like any other. Without labels of both kinds every document has one and the same score.
    Repeated rows stay or go together, rows without a key are scored too, an empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.filter_quality(docs, quality_model.learn_quality(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id.

    Documents without words, and those without a key, are in no group and stay. Repeated rows of a kept document stay
    (they are one document, listed twice); an empty table stays empty.
    """
    return near_dedup.drop_near_duplicates(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts replaced by a mark; lengths follow the new texts.

    A null text stays null with a null length, an empty one empty with length 0. All rows stay, repeated ones too.
    """
    return secret_scan.redact_secrets(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, once, or left out, so that sources meet their targets.

    A null source is a source of its own. Documents without words have size 0 and may be left out. Repeated rows count
    each, rows without a key share one place in the order, an empty table stays empty.
    """
    # Whole rows travel as one column, so that no column of theirs can clash with the mix's own.
    rows = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("row"))
    mixed = mixing.mix(rows, mixing.word_count(F.col("text")), carry=["row"])
    return mixing.repeat_rows(mixed, ["row"]).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every (repeated) document lies in the packed sequences.

    A null or empty text is one piece of one id. Repeated rows are packed each; an empty table gives no rows.
    """
    return packing.pack_digest(docs, TOKENIZER)


STAGES = [
    ("quality_classifier", keep_good),
    ("near_dedup", drop_copies),
    ("secret_scan", redact),
    ("mixing", mix),
    ("packing", pack),
]

# Learned models, hashed buckets and a tokenizer have no SQL form; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; between stages, rows are written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, build in STAGES[:-1]:
        docs = stage(build(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
