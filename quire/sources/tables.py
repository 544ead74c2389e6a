"""Driver-table access and the article view built from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.schemas import ARTICLE_COLUMNS

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# Fixed epoch of the article clock: article ``i`` is stamped this instant plus i minutes.
ARTICLE_EPOCH = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table; column pruning and filters reach the scan through Catalyst."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def headline(text: Column) -> Column:
    """Headline stand-in: the first line of the text."""
    return F.substring_index(text, "\n", 1)


def articles(spark: SparkSession, sf_dir: str, with_embeddings: bool = False,
             early: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The article table of the digest job, derived from ``documents``.

    pid = doc_id as text, dt = epoch + doc_id minutes, h1 = first line,
    article = text = the whole document, category = source,
    focus = labels.quality (0 when unlabelled), extender = n_chars % 3,
    attachments = n_chars % 5. ``labels`` is a dimension keyed by doc_id;
    the join is an equi-join so Catalyst may broadcast it only when its
    statistics say it is small, and otherwise shuffles both sides on doc_id.
    With embeddings every article stays; one without a vector has null there
    and is noise to the clustering.

    ``early`` works on the rows before the joins (all columns but focus and
    embeddings), each row by itself; the texts that it drops are in no shuffle.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("focus"))
    out = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("pid"),
        (F.to_timestamp_ntz(F.lit(ARTICLE_EPOCH))
         + F.make_dt_interval(F.lit(0), F.lit(0), F.col("doc_id").cast("int"))).alias("dt"),
        headline(F.col("text")).alias("h1"),
        F.col("text").alias("article"),
        F.col("text").alias("text"),
        (F.col("n_chars") % 3).cast("int").alias("extender"),
        (F.col("n_chars") % 5).cast("int").alias("attachments"),
        F.col("source").alias("category"),
        F.col("doc_id"),
    )
    out = early(out) if early else out
    out = out.join(labels, "doc_id", "left").withColumn("focus", F.coalesce(F.col("focus"), F.lit(0)).cast("int"))
    if with_embeddings:
        emb = table(spark, sf_dir, "embeddings").select(
            F.col("vec_id").alias("doc_id"), F.col("embedding").alias("embeddings"))
        out = out.join(emb, "doc_id", "left")
    if early:
        return out
    return out.select("pid", "dt", "h1", "article", "text", "focus", "extender", "attachments", "category", "doc_id",
                      *(["embeddings"] if with_embeddings else []))


def article_columns(df: DataFrame) -> DataFrame:
    """Project onto the canonical article columns (A3); nulls and absent columns get the default."""
    return df.select(*[(F.coalesce(F.col(c), F.lit(d)) if c in df.columns and d is not None
                        else F.col(c) if c in df.columns else F.lit(d)).alias(c) for c, d in ARTICLE_COLUMNS])
