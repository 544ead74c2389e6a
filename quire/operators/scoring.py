"""Article and topic scoring."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.keywords import in_keywords, keyword_tag
from quire.operators.indexing import with_keyed_index

# Weights of the article score.
ARTICLE_WEIGHTS = {
    "in_keywords": 0.2,
    "focus": 0.4,
    "extender": 0.15,
    "attachments": 0.15,
    "position_score": 0.05,
}


def tag_keywords(df: DataFrame, keywords: Iterable[str]) -> DataFrame:
    """Adds ``in_keywords`` (2 x headline matches + text matches) and ``keywords_tag``.
    Row rules are native expressions, never Python row functions (M3)."""
    kws = list(keywords)
    return (df.withColumn("in_keywords", in_keywords(F.col("h1"), F.col("text"), kws))
              .withColumn("keywords_tag", keyword_tag(F.col("text"), kws)))


def position_score(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """``log1p`` of the 0-based row position in an explicit order."""
    order = order or ["dt", "pid"]
    return (with_keyed_index(df, ["pid"], order, "position")
            .withColumn("position_score", F.log1p(F.col("position").cast("double"))))


def article_score(df: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """Weighted sum of the scoring columns into ``sort_cri``."""
    w = dict(ARTICLE_WEIGHTS, **(weights or {}))
    expr = None
    for column, weight in w.items():
        term = F.col(column).cast("double") * F.lit(float(weight))
        expr = term if expr is None else expr + term
    return df.withColumn("sort_cri", expr)


def score_articles(df: DataFrame, keywords: Iterable[str],
                   weights: Mapping[str, float] | None = None,
                   order: list[str] | None = None) -> DataFrame:
    """Keyword tagging, position score and the weighted article score."""
    return article_score(position_score(tag_keywords(df, keywords), order), weights)


def topic_article_score(df: DataFrame, key: str = "tno", date_col: str = "published_dt",
                        extender_col: str = "extender", id_col: str = "pid",
                        keep_above_half_max: bool = True) -> DataFrame:
    """Topic-article score = 1.5 * extender + date weight.

    Dates of a topic are ranked by article count (ties: earlier date first);
    weight = number of dates - rank (0-based). The count table has one row
    per (topic, date), so its windows are partitioned by topic. With
    ``keep_above_half_max`` only rows scoring strictly above half the
    topic's maximum are kept.
    """
    counts = df.groupBy(key, date_col).agg(F.count(F.lit(1)).alias("date_count"))
    by_topic = Window.partitionBy(key)
    ranked = counts.withColumn(
        "date_weight",
        (F.count(F.lit(1)).over(by_topic)
         - (F.row_number().over(by_topic.orderBy(F.desc("date_count"), F.asc(date_col))) - 1)
         ).cast("long"))
    scored = (df.join(ranked.select(key, date_col, "date_weight"), [key, date_col], "inner")
                .withColumn("score", F.col(extender_col).cast("double") * 1.5 + F.col("date_weight")))
    if keep_above_half_max:
        # Per-topic maximum by a partial aggregate joined back on the key,
        # not a window over the article table: a hot topic stays splittable.
        top = scored.groupBy(key).agg(F.max("score").alias("_max"))
        scored = (scored.join(top, key, "inner")
                        .filter(F.col("score") > F.col("_max") / 2).drop("_max"))
    return scored
