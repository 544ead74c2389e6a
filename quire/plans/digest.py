"""Morning-digest job: exclude routine items, tag, cluster, score and rank
groups (J5), pick articles per group and singles (E2-E4, D9), and assemble
the digest prompts (K2, K12)."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.cluster import dbscan, select_eps, select_eps_by_group
from quire.operators.indexing import indexed, rank_within, with_keyed_index
from quire.operators.pairs import nearest_distance
from quire.operators.scoring import article_score, tag_keywords
from quire.session import cut_lineage

# The routine-item pattern (lottery results, market closes,
# weekly round-ups and similar standing items), kept verbatim.
ROUTINE_PATTERN = (r"早安世|一週大事|開箱老照|(今|雙贏|威力)彩|大樂透|三大法人|新台幣.盤|"
                   r"新台幣[升貶].*收|(電子|金融|台股)期|台股[開收].*點|^台股[漲跌].{2,7}點$")

# Default eps band (high, low) and the group quantile.
EPS_BAND = (0.8, 0.5)
GROUP_QUANTILE = 0.2


def exclude_routine(df: DataFrame, pattern: str = ROUTINE_PATTERN, col: str = "article") -> DataFrame:
    """Drop rows whose text matches the routine-item pattern (B2)."""
    return df.filter(~F.coalesce(F.col(col).rlike(pattern), F.lit(False)))


def flag_membership(df: DataFrame, ids: DataFrame, key: str = "pid", name: str = "focus") -> DataFrame:
    """1 when ``key`` occurs in ``ids`` else 0 (C3). Left join on the distinct
    ids; the planner broadcasts them only when their statistics are small."""
    flags = ids.select(F.col(ids.columns[0]).cast("string").alias(key)).distinct() \
               .withColumn("_hit", F.lit(1))
    return (df.drop(name).join(flags, key, "left")
              .withColumn(name, F.coalesce(F.col("_hit"), F.lit(0)).cast("int")).drop("_hit"))


def exclude_and_tag(df: DataFrame, keywords: Iterable[str], exclude_pattern: str | None = ROUTINE_PATTERN) -> DataFrame:
    """Articles without routine items, with in_keywords and keywords_tag. What comes after it reads no text."""
    return tag_keywords(exclude_routine(df, exclude_pattern) if exclude_pattern else df, keywords)


def tag_cluster_score(df: DataFrame, keywords: Iterable[str], eps: float | None = None,
                      band: tuple[float, float] = EPS_BAND, exclude_pattern: str | None = ROUTINE_PATTERN,
                      weights: Mapping[str, float] | None = None,
                      order: list[str] | None = None,
                      group_col: str | None = None, tagged: bool = False) -> tuple[DataFrame, float]:
    """Articles with in_keywords, keywords_tag, position, cluster, position_score, sort_cri.
    ``tagged``: ``df`` has been through ``exclude_and_tag`` already."""
    order = order or ["dt", "pid"]
    a = df if tagged else exclude_and_tag(df, keywords, exclude_pattern)
    # reliable checkpoints: the index, the neighbour job, the edge job, the component
    # labels and the scores below all read these tables instead of re-running
    # the scan, the joins and the keyword regexes
    a = cut_lineage(with_keyed_index(cut_lineage(a) if tagged else a, ["pid"], order, "position"))
    if eps is None and group_col:
        # eps chosen inside every group (e.g. every day), as a per-row column
        per = select_eps_by_group(nearest_distance(a, "position", "embeddings", group_col=group_col)
                                  .join(a.select(F.col("position").alias("id"), group_col), "id"),
                                  group_col, band[0], band[1])
        a = a.join(per, group_col, "left")
        a = dbscan(a, "position", "embeddings", None, name="cluster", group_col=group_col, eps_col="eps")
        # the score's position counts inside the group, as each day is a run of its own
        a = rank_within(a, group_col, [F.col(c) for c in order], "position_in_group", None,
                        slim=list(dict.fromkeys([group_col, "position", *order])), unique=["position"])
        place = F.col("position_in_group").cast("double") - 1
        return article_score(a.withColumn("position_score", F.log1p(place)), weights), float("nan")
    # only rows with a vector are counted into blocks
    if eps is None:
        eps = select_eps(nearest_distance(a, "position", "embeddings", group_col=group_col), band[0], band[1])
    a = dbscan(a, "position", "embeddings", eps, name="cluster", group_col=group_col)
    a = a.withColumn("position_score", F.log1p(F.col("position").cast("double")))
    return article_score(a, weights), eps


def rank_groups(scored: DataFrame, quantile: float = GROUP_QUANTILE, group_col: str | None = None) -> DataFrame:
    """Cluster totals (D1), strict quantile cut (B12, D2) and order (E8, F2):
    (cluster, total, top, group_rank). One cluster alone equals its own
    quantile and is therefore dropped, as in the original rule. With
    ``group_col`` (a day) totals are cut and ranked inside each group."""
    if group_col:
        return _rank_in_groups(scored, quantile, group_col)
    # clustered rows only (B10); noise rows are the singles below
    groups = (scored.filter(F.col("cluster") > -1).groupBy("cluster")
                    # rounded: the last digits of a float sum vary with the partitioning
                    .agg(F.round(F.sum("sort_cri"), 9).alias("total"), F.round(F.max("sort_cri"), 9).alias("top")))
    # one index in the final order serves the quantile too: ascending
    # position p is descending index n-1-p, and the groups above the
    # threshold are a prefix of this order, so their index is their rank
    ranked, n = indexed(groups, [F.desc("total"), F.desc("top"), F.asc("cluster")], "group_rank")
    if n == 0:
        return ranked
    h = (n - 1) * quantile
    lo = math.floor(h)
    hi = min(lo + 1, n - 1)
    got = dict(ranked.filter(F.col("group_rank").isin(n - 1 - lo, n - 1 - hi))
                     .select("group_rank", "total").collect())
    v_lo, v_hi = got[n - 1 - lo], got[n - 1 - hi]
    threshold = round(v_lo + (h - lo) * (v_hi - v_lo), 9)
    return ranked.filter(F.col("total") > F.lit(threshold))


def _rank_in_groups(scored: DataFrame, quantile: float, group_col: str) -> DataFrame:
    """rank_groups inside each value of ``group_col``: the exact interpolated
    quantile is one aggregate, the ranks are skew-safe in-group ranks."""
    totals = cut_lineage(scored.filter(F.col("cluster") > -1).groupBy(group_col, "cluster")
                         .agg(F.round(F.sum("sort_cri"), 9).alias("total"), F.round(F.max("sort_cri"), 9).alias("top")))
    bound = totals.groupBy(group_col).agg(F.round(F.percentile("total", F.lit(quantile)), 9).alias("_bound"))
    ranked = rank_within(totals, group_col, [F.desc("total"), F.desc("top"), F.asc("cluster")], "_rank", None)
    kept = ranked.join(bound, group_col).filter(F.col("total") > F.col("_bound"))
    return kept.select(group_col, "cluster", "total", "top", (F.col("_rank") - 1).alias("group_rank"))


def pick_in_groups(scored: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of ranked groups, best first; a group of fewer than 4 keeps all,
    otherwise floor(size / 2) (E2, E3). The in-group rank comes from
    ``rank_within`` so one very large cluster is still spread over tasks."""
    # the groups are few rows beside the articles; a hot cluster stays splittable in this join
    g = scored.join(groups.select("cluster", "group_rank"), "cluster", "inner")
    g = rank_within(g, "cluster", [F.desc("sort_cri"), F.asc("pid")], "in_rank", "size",
                    slim=["cluster", "sort_cri", "pid"], unique=["pid"])
    quota = F.when(F.col("size") < 4, F.col("size")).otherwise(F.floor(F.col("size") / 2))
    return g.filter(F.col("in_rank") <= quota)


def singles_quota(n_groups: int) -> int:
    """Singles shown beside the groups: 25 - groups while below 25, else 5."""
    return 25 - n_groups if n_groups < 25 else 5


def pick_singles_by_group(scored: DataFrame, ranked: DataFrame, group_col: str) -> DataFrame:
    """pick_singles inside each value of ``group_col``; ``ranked`` are its ranked
    clusters, whose number sets the group's quota."""
    n = F.coalesce(F.col("_n"), F.lit(0))
    counts = ranked.groupBy(group_col).agg(F.count(F.lit(1)).alias("_n"))
    noise = rank_within(scored.filter(F.col("cluster") < 0), group_col, [F.desc("sort_cri"), F.asc("pid")], "single_rank", None,
                        slim=[group_col, "sort_cri", "pid"], unique=["pid"])
    return noise.join(counts, group_col, "left").filter(
        F.col("single_rank") <= F.when(n < 25, F.lit(25) - n).otherwise(F.lit(5))).drop("_n")


def pick_singles(scored: DataFrame, n_groups: int) -> DataFrame:
    """Best noise rows up to the quota (top-k by score, ties by pid)."""
    m = singles_quota(n_groups)
    noise = scored.filter(F.col("cluster") < 0)
    return noise.orderBy(F.desc("sort_cri"), F.asc("pid")).limit(m)
