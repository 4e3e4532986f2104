"""The queries of this subpackage: each operator over its whole table, with its usual parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obolus.llm import (bpe, decontaminate, exact_dedup, language_id, license_scan, minhash, packing, quality_classifier, quality_rules, spelling, toxicity, url_filter,
                        whitening)
from obolus.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.rules_table(spark))


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(table(spark, sf_dir, "documents"))


@query
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(table(spark, sf_dir, "documents"), size=3, percent=85)


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measure(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lost_words")


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.score(docs, quality_classifier.fit(docs, table(spark, sf_dir, "labels")))


@query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    both = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, and_decode=True)
    return both.select("doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json")), public_tokenizers.PATTERN)


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs, ~language_id.held_out()))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(spelling.vocabulary(table(spark, sf_dir, "documents")))


@query
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))
