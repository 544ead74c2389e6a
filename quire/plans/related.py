"""Related articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import category_url
from quire.operators.pairs import cosine_topk_between
from quire.session import cut_lineage

# Related articles per article and the similarity threshold.
RELATED_K = 3
RELATED_THRESHOLD = 0.5


def related_articles(current: DataFrame, earlier: DataFrame, done: DataFrame, id_col: str = "doc_id",
                     vec_col: str = "embeddings", k: int = RELATED_K, threshold: float = RELATED_THRESHOLD,
                     mode: str = "default") -> DataFrame:
    """For every not-done current article, its k most similar articles among
    current and earlier ones: (pid, rank, related_url, sim).

    default: the article itself is excluded by id and only similarities
    above ``threshold`` count. reference: the original ranking, i.e. all
    candidates including the article itself, similarities at or below the
    threshold set to 0 but still ranked (ties by id), ranks 2..k+1 kept.

    Only not-done articles are compared, each with the whole pool. Articles
    without a vector have no related ones and are none.
    """
    pool = current.unionByName(earlier, allowMissingColumns=True)
    todo = current.join(done, "pid", "left_anti").select(F.col(id_col).alias("a"), "pid")
    left = cut_lineage(current.join(done, "pid", "left_anti").select(id_col, vec_col))
    vecs = cut_lineage(pool.select(id_col, vec_col).filter(F.size(vec_col) > 0))     # read many times below
    if mode == "default":
        rel = cosine_topk_between(left, vecs, id_col, vec_col, k, threshold=threshold)
    elif mode == "reference":
        rel = cosine_topk_between(left, vecs, id_col, vec_col, k + 1, include_self=True, clamp=threshold)
        rel = rel.filter(F.col("rank").between(2, k + 1))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    url = pool.select(F.col(id_col).alias("b"), category_url(F.col("category"), F.col("pid")).alias("related_url"))
    return rel.join(todo, "a").join(url, "b").select("pid", "rank", "related_url", "sim")
