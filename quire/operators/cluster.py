"""Density clustering over embedding vectors (J1-J4) and eps selection.

With ``min_samples = 2`` a point with one neighbour within eps is already a
core point, so DBSCAN labels are exactly the connected components of the
graph ``dist <= eps`` that have two or more points; isolated points are noise
(-1). Clusters are numbered in the order of their first row, i.e. by the
smallest position id of the component. The result is one labelled
DataFrame, so no union of per-cluster fragments is needed (G2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.components import connected_components
from quire.operators.indexing import rank_within, with_global_index
from quire.operators.pairs import nearest_distance, range_edges, range_neighbours, range_star_edges
from quire.session import cut_lineage


def _number_roots(node_root: DataFrame, name: str) -> DataFrame:
    """Map each component root to 0, 1, 2... in root order (no single-task window)."""
    roots = node_root.select("root").distinct()
    return with_global_index(roots, [F.col("root")], name)


def label_components(df: DataFrame, id_col: str, node_root: DataFrame,
                     name: str = "cluster") -> DataFrame:
    numbered = _number_roots(node_root, name)
    labels = node_root.join(numbered, "root").select(F.col("node").alias(id_col), name)
    return (df.join(labels, id_col, "left")
              .withColumn(name, F.coalesce(F.col(name), F.lit(-1)).cast("int")))


def dbscan(df: DataFrame, id_col: str, vec_col: str, eps: float | None, min_samples: int = 2,
           edges: DataFrame | None = None, name: str = "cluster",
           group_col: str | None = None, eps_col: str | None = None,
           blocks: int | None = None) -> DataFrame:
    """DBSCAN labels in ``name`` (-1 = noise). ``id_col`` is the row position
    (a unique long); all rows are returned, with or without noise. With
    ``group_col`` (e.g. the publication day) points are only neighbours
    inside their group, so the pair work grows with the group sizes, not
    with the square of the table."""
    if min_samples <= 2 and edges is None:
        # only connectivity matters: tiles emit local stars, not every edge
        star = range_star_edges(df, id_col, vec_col, eps, blocks=blocks, group_col=group_col, eps_col=eps_col)
        return label_components(df, id_col, connected_components(star), name)
    if edges is None and not group_col:
        # counts and stars leave the tiles, never every edge; a row that is not core has few neighbours and names them
        part = cut_lineage(range_neighbours(df, id_col, vec_col, eps, min_samples - 2, blocks=blocks))
        deg = part.groupBy(F.col("id").alias("n")).agg(F.sum("n").alias("deg"))
        core = cut_lineage(deg.filter(F.col("deg") + 1 >= min_samples).select(F.col("n").alias("core")))
        inner = df.join(core, df[id_col].cast("long") == core["core"], "left_semi")
        ce = range_star_edges(inner, id_col, vec_col, eps, blocks=blocks)
        beside = part.filter("near IS NOT NULL").select(F.col("id").alias("a"), F.explode("near").alias("b"))
    else:
        e = edges if edges is not None else range_edges(df, id_col, vec_col, eps, blocks=blocks, group_col=group_col)
        e = e.filter(F.col("dist") <= eps).select("a", "b")
        if min_samples <= 2:
            return label_components(df, id_col, connected_components(e), name)
        # General min_samples (J4): core = degree + 1 >= min_samples.
        e = cut_lineage(e)
        beside = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        deg = beside.groupBy(F.col("a").alias("n")).agg(F.count(F.lit(1)).alias("deg"))
        core = deg.filter(F.col("deg") + 1 >= min_samples).select(F.col("n").alias("core"))
        ce = (e.join(core.withColumnRenamed("core", "a"), "a", "left_semi")
                .join(core.withColumnRenamed("core", "b"), "b", "left_semi"))
    comp = connected_components(ce)
    single = (core.join(comp.select(F.col("node").alias("core")), "core", "left_anti")
                  .select(F.col("core").alias("node"), F.col("core").alias("root")))
    comp = comp.unionByName(single)
    numbered = _number_roots(comp, name)
    core_lab = comp.join(numbered, "root").select(F.col("node"), F.col(name))
    # border points: non-core with a core neighbour take the smallest neighbouring label
    border = (beside.join(core_lab.withColumnRenamed("node", "b"), "b")
                    .join(core.withColumnRenamed("core", "a"), "a", "left_anti")
                    .groupBy("a").agg(F.min(name).alias(name))
                    .withColumnRenamed("a", "node"))
    labels = core_lab.unionByName(border).withColumnRenamed("node", id_col)
    return (df.join(labels, id_col, "left")
              .withColumn(name, F.coalesce(F.col(name), F.lit(-1)).cast("int")))


def dbscan_two_stage(df: DataFrame, id_col: str, vec_col: str, eps: float, eps2: float,
                     edges: DataFrame | None = None) -> DataFrame:
    """Two-stage clustering (J3). Stage-1 labels in ``cluster``; inside every stage-1 cluster the points
    are clustered again with ``eps2`` into ``cluster2`` (numbered from 0 per
    stage-1 cluster in row order; -1 = stage-2 noise; null for stage-1 noise)."""
    s1 = dbscan(df, id_col, vec_col, eps, edges=edges, name="cluster")
    lab = s1.select(F.col(id_col).alias("a"), F.col("cluster").alias("ca"))
    if edges is not None:
        e2 = (edges.filter(F.col("dist") <= eps2)
              .join(lab, "a")
              .join(lab.select(F.col("a").alias("b"), F.col("ca").alias("cb")), "b")
              .filter((F.col("ca") == F.col("cb")) & (F.col("ca") >= 0))
              .select("a", "b"))
    elif eps2 <= eps:
        # what is within eps2 is in one stage-1 cluster already
        e2 = range_star_edges(df, id_col, vec_col, eps2)
    else:
        e2 = range_star_edges(s1.filter(F.col("cluster") >= 0), id_col, vec_col, eps2, group_col="cluster")
    comp = connected_components(e2)
    roots = (comp.join(lab.select(F.col("a").alias("node"), "ca"), "node")
                 .select("ca", "root").distinct())
    # number the (distinct) roots inside each stage-1 cluster; rank_within
    # spreads one very large stage-1 cluster over several tasks
    numbered = (rank_within(roots, "ca", [F.col("root")], "_r", None)
                .withColumn("cluster2", (F.col("_r") - 1).cast("int")))
    labels = comp.join(numbered.select("root", "cluster2"), "root").select(
        F.col("node").alias(id_col), "cluster2")
    return (s1.join(labels, id_col, "left")
              .withColumn("cluster2", F.when(F.col("cluster") >= 0,
                                             F.coalesce(F.col("cluster2"), F.lit(-1)))
                          .cast("int")))


def _band_floor(low: float, high: float, d_min: float, max_steps: int = 500) -> float:
    """Lower band bound after the step-up rule: the smallest distance may
    not be a candidate, so the bound rises by 0.01 (float addition, as a
    loop would) until it is at or above the smallest distance."""
    cur = low
    for _ in range(max_steps):
        if not (cur < d_min < high):
            return cur
        cur = cur + 0.01
    raise ValueError("no eps candidate within the step budget")


def _eps_candidates(nn: DataFrame, high: float, low: float, dist_col: str):
    """(drops table, band floor). ``nn`` is checkpointed first: the blocked
    nearest-neighbour job then runs once, not once per statistic."""
    nn = cut_lineage(nn.select(F.col(dist_col).alias("d")))
    d = F.col("d")
    d_min = nn.agg(F.min(d)).first()[0]
    if d_min is None:
        return None, None
    floor = _band_floor(low, high, d_min)
    band = nn.filter((d > floor) & (d < high)).select("d").distinct()
    below = nn.filter(d <= floor).agg(F.max(d).alias("d"))
    vals = band.unionByName(below).filter(F.col("d").isNotNull())
    idx = with_global_index(vals, [F.desc("d")], "i")
    nxt = idx.select((F.col("i") - 1).alias("i"), F.col("d").alias("next_d"))
    drops = (idx.join(nxt, "i").filter((F.col("d") > floor) & (F.col("d") < high))
                .select("d", "next_d", (F.col("d") - F.col("next_d")).alias("drop")))
    return drops, floor


def select_eps(nn: DataFrame, high: float = 0.8, low: float = 0.5, dist_col: str = "nn_dist",
               default_eps: float | None = None) -> float:
    """eps = the nearest-neighbour distance just before the largest drop
    among distances strictly inside (low, high), sorted descending (J2, D5, E6).

    Only scalars reach the driver. The candidate values are deduplicated
    (a repeated value's inner gaps are zero and never win) and each gets
    its next smaller distinct value through a global index and an equi-join.
    """
    drops, floor = _eps_candidates(nn, high, low, dist_col)
    best = drops.agg(F.max_by("d", F.struct("drop", "d")).alias("eps")).first()[0] if drops is not None else None
    if best is None:
        if default_eps is not None:
            return default_eps
        raise ValueError(f"no nearest-neighbour distance inside ({floor}, {high})")
    return float(best)


def eps_drops(nn: DataFrame, high: float, low: float, dist_col: str = "nn_dist") -> DataFrame:
    """The candidate table behind ``select_eps``: (d, next_d, drop)."""
    return _eps_candidates(nn, high, low, dist_col)[0]


def _step_values(low: float, max_steps: int = 500) -> list[float]:
    """The lower bounds the step-up rule can reach, by repeated addition."""
    vals, cur = [], low
    for _ in range(max_steps):
        vals.append(cur)
        cur = cur + 0.01
    return vals


def select_eps_by_group(nn: DataFrame, group_col: str, high: float = 0.8, low: float = 0.5,
                        dist_col: str = "nn_dist") -> DataFrame:
    """(group, eps) with the eps rule applied to every group on its own,
    as one job for all groups: the step-up bound is an expression over the
    literal list of reachable bounds, the "next smaller distance" comes from
    the skew-safe in-group rank, and the arg-max is a grouped ``max_by``.
    A group with no candidate gets a null eps."""
    g, d = F.col(group_col), F.col("d")
    nn = cut_lineage(nn.select(g.alias("g"), F.col(dist_col).alias("d")))
    steps = F.array(*[F.lit(v) for v in _step_values(low)])
    floors = nn.groupBy("g").agg(F.min("d").alias("dmin")).select(
        "g", F.when((F.col("dmin") > low) & (F.col("dmin") < high),
                    F.element_at(F.filter(steps, lambda s: s >= F.col("dmin")), 1))
              .otherwise(F.lit(low)).alias("floor"))
    nf = nn.join(floors, "g")
    band = nf.filter((d > F.col("floor")) & (d < high)).select("g", "d").distinct()
    below = nf.filter(d <= F.col("floor")).groupBy("g").agg(F.max("d").alias("d"))
    vals = band.unionByName(below)
    ranked = rank_within(vals, "g", [F.desc("d")], "r", None)
    nxt = ranked.select("g", (F.col("r") - 1).alias("r"), F.col("d").alias("next_d"))
    drops = (ranked.join(nxt, ["g", "r"]).join(floors, "g")
                   .filter((d > F.col("floor")) & (d < high))
                   .withColumn("drop", d - F.col("next_d")))
    return drops.groupBy("g").agg(F.max_by("d", F.struct("drop", "d")).alias("eps")) \
                .withColumnRenamed("g", group_col)


def nn_then_eps(df: DataFrame, id_col: str, vec_col: str, high: float, low: float) -> float:
    return select_eps(nearest_distance(df, id_col, vec_col), high, low)
