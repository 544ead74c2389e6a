"""Registered queries for summaries, group prompts and the digest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.session import cut_lineage, prepare
from quire.sources.tables import table

# The two digest prompt versions.
DIGEST_VERSIONS = [
    ("ver1", "Write one news brief that merges these related reports."),
    ("ver2", "Write a short headline list with one line per report."),
]


def q_extractive(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.plans.summarise import extractive_summary, token_weights
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return extractive_summary(docs, "doc_id", "text", weights=token_weights(docs, "text"))


def _weights(spark: SparkSession, sf: str) -> DataFrame:
    """Token weights over all articles."""
    from quire.plans.summarise import token_weights
    return token_weights(table(spark, sf, "documents").select("text"), "text")


def _group_bodies(picks: DataFrame, weights: DataFrame) -> DataFrame:
    """Per group: headlines in rank order (D9) and the body of the prompt (K2, D8):
    the notes of its picked articles, which are of bounded length each."""
    from quire.plans.enrich import article_notes, with_order
    picks = cut_lineage(picks.select("pid", "cluster", "group_rank", "in_rank", "h1", "article"))
    picks = picks.join(article_notes(with_order(picks, "pid", "article", weights), "pid", "article"), "pid")
    # one aggregation (one pass over the picks) for all three outputs
    items = F.sort_array(F.collect_list(F.struct("in_rank", "h1", "notes")))
    g = picks.groupBy("cluster").agg(F.min("group_rank").alias("group_rank"), items.alias("_items"))
    return g.select(
        "cluster", "group_rank",
        F.array_join(F.transform("_items", lambda x: x["h1"]), " | ").alias("titles"),
        F.array_join(F.transform("_items", lambda x: x["notes"]),
                     "\n\n").alias("body"))


def _versions(df: DataFrame, key: str, weights: DataFrame) -> DataFrame:
    """Both prompt versions through the completer, one column each."""
    from quire.plans.enrich import complete, responses_to_columns, task_prompts, with_order
    prompts = task_prompts(with_order(df, key, "body", weights), key, "body", [(v, i) for v, i in DIGEST_VERSIONS])
    return responses_to_columns(complete(prompts, key), key, [v for v, _ in DIGEST_VERSIONS])


def _scored(spark, sf):
    from quire.plans.catalog import _scored_clusters
    return cut_lineage(_scored_clusters(spark, sf).select("pid", "cluster", "sort_cri", "doc_id", "text_key"))


def _texts(spark, sf, rows):
    from quire.plans.catalog import _with_texts
    return _with_texts(spark, sf, cut_lineage(rows))


def q_prompt_group(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    from quire.plans.digest import pick_in_groups, rank_groups
    s = _scored(spark, sf)
    g = _group_bodies(_texts(spark, sf, pick_in_groups(s, rank_groups(s))), _weights(spark, sf))
    return g.select("cluster", "group_rank", "titles", "body")


def q_digest(spark: SparkSession, sf: str) -> DataFrame:
    """Digest rows (K12): ranked groups first, then the best single articles
    up to the quota; each row has its headlines, both summary versions and
    whether they could be made."""
    prepare(spark)
    from quire.plans.digest import pick_in_groups, pick_singles, rank_groups
    s = _scored(spark, sf)
    groups = cut_lineage(rank_groups(s))
    n_groups = groups.count()
    weights = _weights(spark, sf)
    g = cut_lineage(_group_bodies(_texts(spark, sf, pick_in_groups(s, groups)), weights))
    gv = _versions(g.select(F.col("cluster").cast("string").alias("key"), "body"), "key", weights)
    grows = g.select(F.col("cluster").cast("string").alias("key"), "group_rank", "titles").join(gv, "key") \
             .select(F.col("group_rank").alias("digest_rank"), F.lit("group").alias("kind"), "key", "titles",
                     "ver1", "ver2", "status")
    singles = pick_singles(s, n_groups)
    # at most the quota (<= 25) rows here, so an unpartitioned window is bounded
    singles = singles.withColumn("srank", F.row_number().over(Window.orderBy(F.desc("sort_cri"), F.asc("pid"))) - 1)
    from quire.plans.enrich import article_notes, with_order
    singles = cut_lineage(_texts(spark, sf, singles).select("pid", "srank", "h1", "article"))
    sb = cut_lineage(singles.join(article_notes(with_order(singles, "pid", "article", weights), "pid", "article"), "pid").select(
        F.col("pid").alias("key"), "srank", F.col("h1").alias("titles"), F.col("notes").alias("body")))
    sv = _versions(sb.select("key", "body"), "key", weights)
    srows = sb.join(sv, "key").select((F.col("srank") + F.lit(n_groups)).alias("digest_rank"),
                                      F.lit("single").alias("kind"), "key", "titles", "ver1", "ver2", "status")
    return grows.unionByName(srows)


DIGEST_QUERIES = {
    "q_extractive": q_extractive,
    "q_prompt_group": q_prompt_group,
    "q_digest": q_digest,
}
