"""One registered query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, chat, language, mixing, negatives, phrases, quality, secrets, simhash, spotsigs, token_counts, topk, toxicity)
from .common import held_out, table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of 3-word shingles; groups of fingerprints that differ in at most 2 bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language, score and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs), keep=["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred",
                        F.col("lang_score").alias("score"), F.col("lang_accepted").alias("accepted"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: rules and Markov models."""
    docs = table(spark, sf_dir, "documents")
    found = F.col("found")
    return secrets.scan(docs, secrets.train(docs)).select(
        "doc_id", *[secrets.count_of(found, k).alias(f"n_{k}") for k in secrets.KINDS],
        F.sha2(secrets.span_text(found, rules_only=True), 256).alias("base_sha256"),
        secrets.span_text(found).alias("spans"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, its offending sentences and where the worst starts."""
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"), "sentences", "worst_sentence")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations in chat markup."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SpotSigs fingerprint of every document and of its edited text, and their likeness."""
    return spotsigs.next_document_likeness(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, rules and robust outlier verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the 32k piece vocabulary."""
    found = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.withColumn("over_limit", F.col("n_tokens") > 4096)


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus mixed to 95 % of the greatest source entropy, at most 4 copies, on as
    many tokens as it has."""
    return mixing.mix(table(spark, sf_dir, "documents"), entropy=0.95, max_repeats=4.0, budget=1.0)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document by the multilingual 50k ranks, as digests."""
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of two to four words of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five hard negatives for each of five positives of every anchor."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows, F.col("vec_id") % 100 == 0, scale=256, label=label)


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest inner products of every query vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20, scale=64)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash_near_dedup, op2_language_id, op3_secret_scan, op4_toxicity, op5_chat_format,
                            op6_document_fingerprints, op7_quality_rules, op8_token_counts, op9_source_mix,
                            op10_byte_bpe, op11_phrase_collocations, op12_hard_negatives, op13_top_k)
}
ORACLE: dict[str, str] = {"op5_chat_format": chat.ORACLE, "op11_phrase_collocations": phrases.ORACLE,
                          "op12_hard_negatives": negatives.ORACLE, "op13_top_k": topk.ORACLE}
