"""Landed JSON documents: topic item lists (A4), article documents
and service requests (A19). Documents are read with an explicit schema
(``spark.read.schema(s).json(path)`` or ``from_json`` on a text column);
malformed or incomplete documents go to a quarantine DataFrame with a reason
instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.dates import parse_minute_time
from quire.functions.text import attachment_count, clean_article, join_content, photo_url_count
from quire.schemas import ARTICLE_JSON_SCHEMA, REQUEST_SCHEMA, TOPIC_JSON_SCHEMA

REQUIRED_REQUEST_KEYS = ["content", "entity_list", "name_list"]


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON-lines (or multi-line with ``multiLine``) files under ``path``."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def flatten_topics(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Topic documents -> (items (tno, pid, published_dt, h1), quarantine).
    A document without ``ResultData.Items`` is a structure error."""
    ok = docs.filter(F.col("ResultData.Items").isNotNull())
    bad = docs.filter(F.col("ResultData.Items").isNull()).select(
        "tno", F.lit("missing ResultData.Items").alias("reason"))
    items = ok.select("tno", F.inline("ResultData.Items")).select(
        "tno", F.col("Id").alias("pid"), F.col("CreateTime").alias("published_dt"),
        F.col("HeadLine").alias("h1"))
    return items, bad


def topic_counts(docs: DataFrame) -> DataFrame:
    """Number of items per topic document."""
    return docs.select("tno", F.coalesce(F.size("ResultData.Items"), F.lit(0)).alias("article_num"))


def flatten_articles(docs: DataFrame) -> DataFrame:
    """Article documents -> one flat row each (A5): cleaned text, keyword
    list, photo counts and the parsed creation time."""
    news = F.col("ResultData.News")
    return docs.select(
        news["Id"].alias("pid"),
        parse_minute_time(F.col("ResultData.MetaData.DateCreated")).alias("published_dt"),
        news["Title"].alias("h1"),
        news["Content"].alias("content"),
        clean_article(news["Content"]).alias("article"),
        news["Keywords"].alias("keywords"),
        news["TypeName"].alias("category"),
        photo_url_count(F.coalesce(news["Photos"], F.array())).cast("int").alias("extender"),
        attachment_count(news["Photos"]).cast("int").alias("attachments"),
    )


def parse_article_json(df: DataFrame, json_col: str) -> DataFrame:
    return df.select(F.from_json(F.col(json_col), ARTICLE_JSON_SCHEMA).alias("d")).select("d.*")


def parse_topic_json(df: DataFrame, json_col: str) -> DataFrame:
    return df.select(F.from_json(F.col(json_col), TOPIC_JSON_SCHEMA).alias("d")).select("d.*")


def _missing_keys(json_col: Column) -> Column:
    keys = F.coalesce(F.json_object_keys(json_col), F.array().cast("array<string>"))
    missing = F.filter(F.array(*[F.lit(k) for k in REQUIRED_REQUEST_KEYS]),
                       lambda k: ~F.array_contains(keys, k))
    return missing


def validate_requests(df: DataFrame, json_col: str = "body",
                      key_cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Requests -> (valid rows with the joined content text, quarantine with
    the reason). Required keys: content, entity_list, name_list."""
    keys = key_cols or [c for c in df.columns if c != json_col]
    missing = _missing_keys(F.col(json_col))
    parsed = df.select(*keys, F.col(json_col), missing.alias("_missing"),
                       F.json_object_keys(F.col(json_col)).isNull().alias("_malformed"),
                       F.from_json(F.col(json_col), REQUEST_SCHEMA).alias("r"),
                       F.try_variant_get(F.try_parse_json(json_col), "$.content", "string").alias("_plain"),
                       F.schema_of_variant(F.try_variant_get(F.try_parse_json(json_col), "$.content", "variant")).alias("_kind"))
    # not a JSON object at all (from_json would give a struct of nulls)
    bad_json = F.col("_malformed")
    # content is a list of texts, or one text; anything else has no text to join
    is_text = F.coalesce(F.col("_kind") == "STRING", F.lit(False))
    is_list = F.coalesce(F.col("_kind").isin("ARRAY<STRING>", "ARRAY<VOID>"), F.lit(False))
    is_bad = bad_json | (F.size("_missing") > 0) | ~(is_text | is_list)
    reason = F.when(bad_json, F.lit("malformed json")).otherwise(
        F.when(F.size("_missing") > 0, F.concat(F.lit("missing: "), F.array_join("_missing", ",")))
        .otherwise(F.lit("content is neither a text nor a list of texts")))
    valid = parsed.filter(~is_bad).select(
        *keys, F.when(is_text, F.col("_plain")).otherwise(join_content(F.col("r.content"))).alias("text"),
        F.col("r.entity_list").alias("entity_list"), F.col("r.name_list").alias("name_list"))
    quarantine = parsed.filter(is_bad).select(*keys, reason.alias("reason"))
    return valid, quarantine
