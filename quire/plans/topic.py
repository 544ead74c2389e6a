"""Topic-abstract and metadata-service jobs: date-normalised articles (K14),
tagger input/output tables (K15) and the person-name pass (K10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.dates import resolve_day_mentions, resolve_relative_dates, story_date
from quire.functions.text import (clean_article, embedding_text, entity_words, flatten_tagger,
                                  name_entries, parse_name_list, pos_filter, split_keywords)
from quire.operators.names import annotate_all, name_dictionary


def normalise_articles(df: DataFrame, content_col: str = "content", dt_col: str = "published_dt",
                       variant: str = "v2") -> DataFrame:
    """Cleaned text with concrete dates (K14): byline/marker/tag removal,
    story date from the raw dateline, relative words and day mentions."""
    out = (df.withColumn("story_dt", story_date(F.col(dt_col), F.col(content_col), variant))
             .withColumn("_clean", clean_article(F.col(content_col))))
    out = out.withColumn("_rel", resolve_relative_dates(F.col("_clean"), F.col("story_dt")))
    return (out.withColumn("article", resolve_day_mentions(F.col("_rel"), F.col("story_dt")))
               .drop("_clean", "_rel"))


def tagger_input(articles: DataFrame, key: str = "pid") -> DataFrame:
    """One row per article for the word-segmentation service: title,
    cleaned content and the keyword list (K15)."""
    return articles.select(key, F.col("h1").alias("title"), clean_article(F.col("content")).alias("content"),
                           split_keywords(F.col("keywords")).alias("keywords"))


def join_tagger_output(articles: DataFrame, tagged: DataFrame, key: str = "pid") -> DataFrame:
    """Join the tagger's (key, cut, pos, entity) output back; an article the
    tagger did not return keeps its row with null text and a status (Q22)."""
    t = tagged.select(key, flatten_tagger(F.col("cut")).alias("_w"), flatten_tagger(F.col("pos")).alias("_t"),
                      flatten_tagger(F.col("entity")).alias("_e"))
    j = articles.join(t, key, "left")
    kept = pos_filter(F.col("_w"), F.col("_t"))
    ents = entity_words(F.col("_e"))
    return (j.withColumn("embed_text", F.when(F.col("_w").isNotNull(), embedding_text(F.col("h1"), kept, ents)))
             .withColumn("tag_status", F.when(F.col("_w").isNull(), F.lit("missing")).otherwise(F.lit("ok")))
             .drop("_w", "_t", "_e"))


def person_name_pass(df: DataFrame, text_col: str, names_col: str) -> DataFrame:
    """Parse each row's name list, make one dictionary of all lists and annotate every
    text with it (K10): ``annotated``, and ``n_names``, the entries of the row's list."""
    listed = parse_name_list(F.col(names_col))
    entries = df.select(F.explode(name_entries(listed)).alias("e")).select("e.*")
    out = annotate_all(df, text_col, name_dictionary(entries))
    return out.withColumn("n_names", F.coalesce(F.size(listed), F.lit(0)))
