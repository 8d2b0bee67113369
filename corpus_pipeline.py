"""The corpus pipeline: quality, near copies, benchmark passages, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; what it returns is written as Parquet and read
again for the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.llm import bpe, decontam, ngram_join, quality, secret_scan
from evidentia.llm.queries import table
from evidentia.llm.scratch import Scratch, drop_since, mark


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go: poor or toxic by the posterior."""
    return quality.accept(docs, table(spark, sf_dir, "labels"), Scratch(spark, "quality"))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, Jaccard similarity of 0.8 or more."""
    return ngram_join.deduplicate(docs, "doc_id", "text", Scratch(spark, "near-copies"), k=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, "text", table(spark, sf_dir, "benchmark"), "item_id", "text")


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are redacted; the number of characters follows."""
    done = secret_scan.redact(docs, "text")
    return done.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).select(*docs.columns)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed), with digests of the ids and of the bytes decoded from them."""
    coded = bpe.encode(docs, "text", public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded_col="decoded")
    return coded.select("doc_id", "lang", "source", "n_tokens", "token_ids", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_copies_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("byte-level BPE", tokens_stage),
]

#: The fitted classifier and the token ids are beyond SQL; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage needed besides its result goes once that is written."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        began = mark()
        docs = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        drop_since(began)
    return docs
