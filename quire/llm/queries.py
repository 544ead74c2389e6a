"""Registered queries of the training-data operators: each applies one operator
to its whole table and derives the columns of its contract from the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, chat, counts, decontam, extract, jaccard, langid, merkle, packing, quality, repair, spans, suffix
from quire.llm.oracle import ORACLE as ORACLE
from quire.session import prepare
from quire.sources.tables import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    done = spans.remove_repeated_runs(docs, spans="spans")
    return done.select("doc_id", F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), "spans", "text")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    return quality.quality_measures(docs).select("doc_id", "quality.*")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text", "lang")
    out = langid.held_out()
    network = langid.train(docs, ~out)
    return langid.predict(docs.drop("lang"), network).select("doc_id", out.alias("held_out"), "language.*")


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    found = jaccard.jaccard_components(docs)
    return found.select(jaccard.visible(F.col("id")).alias("doc_id"), "n_shingles", jaccard.visible(F.col("component")).alias("component_id"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits.spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    return (found.select("doc_id", F.col("hits.n_words").alias("n_words"), n_hit.alias("n_hit"),
                         F.size("hits.items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"))
            .withColumn("contaminated", F.col("n_hit") > 0))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    return bpe.token_digests(docs, bpe.default_tokenizer()).select("doc_id", "tokens.*")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    done = suffix.remove_repeated_passages(docs, spans="spans")
    removed = F.aggregate(F.coalesce("spans", F.array().cast("array<array<bigint>>")), F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    return done.select("doc_id", removed.alias("n_removed"), "spans", "text")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(prepare(spark), sf_dir, "pages").select("page_id", "url", "html")
    done = pages.select("page_id", "url", extract.extracted(F.col("html")).alias("text"))
    return done.withColumn("n_chars", F.length("text").cast("long"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    counted = docs.select("doc_id", n_bytes.alias("n_bytes"), counts.token_count(F.col("text"), bpe.default_tokenizer()).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


#: The contract's extra conversation.
MARKED = "\\### Assistant: </turn> ok"


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(prepare(spark), sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(MARKED).alias("text"))
    done = chat.digests(chat.format_conversations(chat.linear_tree(rows.unionByName(extra))))
    return done.withColumn("conv_id", jaccard.visible(F.col("conv_id"))).drop("branch")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, packing.default_tokenizer(), end_id=2).select("doc_id", "piece.*")


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage to rows (conv_id, turn, role, text); a dropped row stays with live = false."""
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")])
    fault, text = F.crc32(key) % 20, F.coalesce("text", F.lit(" "))
    changed = rows.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
                          F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), fault.alias("fault"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return changed.select("conv_id", "turn", "role", "text", (F.col("fault") != 0).alias("live"), copies).drop("col")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(prepare(spark), sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return repair.with_digest(*repair.repair(rows, F.col("live")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    rest = [F.col(c) for c in ("doc_id", "source", "lang")]
    tampered = merkle.leaf_hash(*rest, F.try_add(F.col("n_chars"), F.when(hit, 1).otherwise(0)), F.col("text"))
    leaves = docs.select("doc_id", "lang", merkle.leaf_hash(*rest, F.col("n_chars"), F.col("text")).alias("leaf"), F.when(hit, tampered).alias("tampered"))
    done = merkle.manifest(leaves, "lang", ["doc_id"])
    return (done.select("doc_id", "leaf", "proof.subroot", "proof.root", merkle.proof_digest(F.col("proof.path")).alias("proof_sha256"),
                        merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof.path")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_substring_dedup, op2_quality_rules, op3_language_id, op4_ngram_jaccard, op5_decontamination,
                            op6_bpe, op7_suffix_array_dedup, op8_html_extraction, op9_token_counts, op10_chat_formatting, op11_packing, op12_conversation_repair, op13_merkle_manifest)
}
