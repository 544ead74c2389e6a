"""The corpus pipeline: quality rules, near duplicates, repeated passages,
benchmark decontamination, tokens. Each stage works on all that the one before
kept; run() writes each stage's result to the shared folder and reads it again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quire.llm import bpe, decontam, jaccard, quality, suffix
from quire.session import checkpoint_dir, prepare
from quire.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    prepare(spark)
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    prepare(spark)
    return jaccard.near_duplicates_kept(docs, percent=80, n=5, dims=256, tile=1 << 18, repeats=False)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that occurred before. What has no text left goes, null
    and already empty texts with it."""
    prepare(spark)
    return suffix.remove_repeated_passages(docs).filter("text <> ''")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark windows; a document goes only if nothing else is left."""
    return decontam.decontaminate(docs, table(prepare(spark), sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids of every remaining text (null: none), their number and digest, and the digest of the text they give back."""
    done = bpe.token_digests(docs.select("doc_id", "text"), bpe.default_tokenizer(), with_ids=True)
    return done.select("doc_id", "tokens.*")


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("benchmark_decontamination", decontamination),
    ("bpe_encoding", tokens),
]

#: Near duplicates, repeated passages and BPE have no SQL form; tests hold run() against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(prepare(spark), sf_dir, "documents")
    place = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{name}")
        docs = spark.read.parquet(f"{place}/{name}")
    return docs
