"""The corpus pipeline: each stage reads what the one before it kept, as Parquet, and its decisions
hold for the next. ``STAGES`` names them in order; ``run`` applies them to `documents`."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obolus.llm import exact_dedup, language_id, minhash, packing, quality_rules
from obolus.llm.common import give_back, shared_folder, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told (operator 10, learned from the learning folds of `documents`)."""
    return language_id.keep_known(docs, language_id.fit(table(spark, sf_dir, "documents"), ~language_id.held_out()))


def clean_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules (operator 6), without the lines that fail; n_chars follows."""
    return quality_rules.keep_clean(docs).withColumn("n_chars", F.length("text").cast("long"))


def distinct_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text (operator 4): the one with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def distinct_content(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (operator 5): five words, similarity 0.8 or more."""
    return minhash.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences (operator 9)."""
    return packing.pack(docs, packing.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json")), public_tokenizers.PATTERN)


STAGES = [("language ID", known_language), ("quality rules", clean_text), ("exact dedup", distinct_text), ("MinHash near-dedup", distinct_content), ("packing", packed)]

#: Language centroids, min-max hashing and packing have no SQL; the tests hold each stage against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage gives is written to the shared folder and read again; what the driver
    held of its model or sample goes back to the machine before the next stage."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{k}")
        del out
        give_back()
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
