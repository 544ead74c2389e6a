"""Inverted index for BM25 search at corpus scale (H1 over postings).

``build_postings`` explodes each document's tokens once and counts them per
(document, token): rows (token, id, tf, dl), grouped on a key that is never
hot (the document id is part of it). ``write_postings`` range-partitions the
rows on the token and sorts them, so every file covers a token range and the
parquet min/max statistics let a query read only its own terms. A search
then filters the postings to the query tokens (pushed down to the scan),
derives each term's document frequency from those rows, sums
idf * tf_norm per document and keeps the top k. The work follows the
postings of the query terms, not the size of the corpus; a very common term
is still processed by many tasks because the sum is grouped by document.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.tokens import py_tokens, tokens
from quire.operators.search import B, K1, RECALL_SIZE


def build_postings(df: DataFrame, id_col: str, field: str) -> DataFrame:
    """(token, id, tf, dl) for every distinct token of every document."""
    t = df.select(F.col(id_col).alias("id"), tokens(F.col(field)).alias("_tok"))
    t = t.select("id", F.size("_tok").alias("dl"), F.explode("_tok").alias("token"))
    return t.groupBy("token", "id").agg(F.count(F.lit(1)).alias("tf"), F.first("dl").alias("dl"))


def corpus_figures(df: DataFrame, field: str) -> tuple[int, float]:
    """(N, average document length) in one aggregate."""
    row = df.select(F.size(tokens(F.col(field))).alias("dl")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl")).first()
    return int(row["n"] or 0), float(row["avgdl"] or 0.0)


def write_postings(postings: DataFrame, path: str, partitions: int | None = None) -> None:
    """Token-ordered parquet: one token range per file, sorted inside. The
    range bounds are on (token, id), so the postings of one very common
    token are split over several files instead of landing in one task."""
    spark = postings.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (postings.repartitionByRange(n, "token", "id").sortWithinPartitions("token", "id")
             .write.mode("overwrite").parquet(path))


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def index_search(postings: DataFrame, n_docs: int, avgdl: float, query: str,
                 k: int = RECALL_SIZE) -> tuple[DataFrame, int]:
    """(top-k (id, score), total matching documents) from the postings."""
    q = sorted(set(py_tokens(query)))
    if not q:
        empty = postings.sparkSession.createDataFrame([], "id long, score double")
        return empty, 0
    hits = postings.filter(F.col("token").isin(q))
    dfreq = dict(hits.groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect())   # <= len(q) rows
    idf = {t: math.log(1.0 + (n_docs - dfreq.get(t, 0) + 0.5) / (dfreq.get(t, 0) + 0.5)) for t in q}
    idf_map = F.create_map(*[x for t in q for x in (F.lit(t), F.lit(idf[t]))])
    tf = F.col("tf").cast("double")
    norm = tf * F.lit(K1 + 1) / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("dl") / F.lit(avgdl or 1.0)))
    per_doc = (hits.withColumn("part", F.element_at(idf_map, F.col("token")) * norm)
                   .groupBy("id").agg(F.sum("part").alias("score")))
    total = per_doc.count()
    return per_doc.orderBy(F.desc("score"), F.asc("id")).limit(k), total
