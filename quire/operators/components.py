"""Connected components by alternating large-star / small-star rounds
(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014).

Edges are kept as distinct undirected pairs. Each round is a grouped minimum
(partial aggregation, so a hub node is combined map-side) and one equi-join;
rounds run until the edge set is a forest of stars, which takes O(log^2 n) rounds.
The edge table is checkpointed reliably every round, so the driver loop has
a short lineage and a lost executor costs at most one round.
At the fixed point every non-root node has exactly one edge, to the smallest
node id of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import cut_lineage


def _canon(df: DataFrame, x: str, y: str) -> DataFrame:
    return (df.filter(F.col(x) != F.col(y))
              .select(F.least(x, y).alias("u"), F.greatest(x, y).alias("v"))
              .distinct())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    m = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = both.filter(F.col("v") > F.col("u")).join(m, "u").select(F.col("v").alias("x"), F.col("m").alias("y"))
    # deduplicate under a hash partitioning on the larger endpoint: the
    # small-star step groups and joins on exactly that column, so it reuses
    # this partitioning instead of shuffling twice more
    canon = (out.filter(F.col("x") != F.col("y"))
                .select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")))
    return canon.repartition("v").dropDuplicates(["u", "v"])


def _small_star(e: DataFrame) -> DataFrame:
    # orient every edge from the larger to the smaller endpoint
    o = e.select(F.col("v").alias("hi"), F.col("u").alias("lo"))
    m = o.groupBy("hi").agg(F.min("lo").alias("m"))
    spokes = o.join(m, "hi").select(F.col("lo").alias("x"), F.col("m").alias("y"))
    hub = m.select(F.col("hi").alias("x"), F.col("m").alias("y"))
    return _canon(spokes.unionByName(hub), "x", "y")


def _is_star_forest(e: DataFrame) -> bool:
    """Exact fixed-point test: every node is either a centre (only smaller
    endpoint) or a leaf with exactly one edge. Connectivity is preserved by
    both star steps, so a star forest is the component partition, and each
    centre, being smaller than its leaves, is its component's minimum."""
    tags = (e.select(F.col("u").alias("n"), F.lit(1).alias("is_u"), F.lit(0).alias("is_v"))
             .unionByName(e.select(F.col("v").alias("n"), F.lit(0).alias("is_u"), F.lit(1).alias("is_v"))))
    per = tags.groupBy("n").agg(F.max("is_u").alias("cu"), F.sum("is_v").alias("lv"))
    return per.filter(((F.col("cu") == 1) & (F.col("lv") > 0)) | (F.col("lv") > 1)).limit(1).count() == 0


def connected_components(edges: DataFrame, src: str = "a", dst: str = "b",
                         max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node that has at least one edge; root = smallest node id."""
    e = cut_lineage(_canon(edges, src, dst))
    rounds = 0
    while not _is_star_forest(e):
        if rounds >= max_rounds:
            raise RuntimeError("connected components did not converge")
        # materialise between the steps: small-star reads its input in
        # three branches, which would otherwise each recompute large-star
        e = cut_lineage(_small_star(cut_lineage(_large_star(e))))
        rounds += 1
    roots = e.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    leaves = e.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return leaves.unionByName(roots)
