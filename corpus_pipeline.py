"""The corpus pipeline: five stages over ``documents``, each written and read again.

1. language ID: documents without an accepted language go;
2. SimHash near-dedup: one document of each group stays;
3. secret scan: secrets are masked in the texts (``n_chars`` follows), no document goes;
4. mixing: sources are drawn to 95 % of the greatest source entropy, at most four
   copies of a document, on as many tokens as there are;
5. byte-level BPE: ids and digests of every drawn document.

Stages 1 to 4 return the columns of ``documents``.  All documents can go through
an earlier stage's filter: an empty table gives empty tables.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.llm import bpe, language, mixing, secrets, simhash
from refinery.llm.common import shared, table


def _own(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model accepts."""
    names = ("__lang_pred", "__lang_score", "__lang_accepted")
    return language.identify(docs, language.fit(docs), names=names).where("__lang_accepted").select(*_own(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.deduplicate(docs, shingle=3, radius=2)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    masked = secrets.redact(docs, secrets.train(docs))
    return masked.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType)).select(*_own(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture draws them."""
    own = _own(docs)
    tagged = mixing.tagged(docs)
    planned = mixing.plan(mixing.token_rows(tagged), entropy=0.95, max_repeats=4.0, budget=1.0)
    return mixing.realise(tagged, planned).select(*own)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids, their digest and the digest of the decoded bytes of every document."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), with_ids=True)


STAGES = [("language_id", language_id), ("simhash_near_dedup", near_dedup), ("secret_scan", secret_scan),
          ("source_mix", source_mix), ("byte_bpe", byte_bpe)]
#: Trained models, fingerprints and BPE can't be put in SQL; tests/llm/test_llm_pipeline.py has
#: each stage in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
