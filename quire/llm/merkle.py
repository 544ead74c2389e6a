"""Merkle manifest of a dataset: one hash tree for each value of a column, and one over their roots.

Every node of a tree carries the interval of leaf ranks that it covers, and
that interval is its label. Three things follow from labels alone:

* the nodes of a level have disjoint intervals, so the ancestor of a node at a
  level is the one whose interval contains the node's: a join by level and by
  bucket (the interval's start divided by the level's width), the containment
  being checked;
* a node's parent is its ancestor one level up;
* its siblings are the nodes of its level whose intervals make up the parent's
  interval without its own: before it those that end where it begins, behind it
  those that begin where it ends.

Levels are dealt in bands of BAND. A band's nodes are made from groups of at
most 2**BAND nodes of the level below it, so a tree of any size takes one
shuffle for each band, each 64 times smaller than the last. Proofs go the other
way, from the root down: a band's lowest nodes take the siblings of their
ancestors in the band, then the proof of the band's ancestor, which at most
2**BAND of them share. No key gathers more than that, whatever share of the
rows one tree has; ranks come from prefix sums over range partitions.

A leaf is the hash of a row's columns, each written as ``-`` if null, else as
its UTF-8 byte count, ``:`` and its value. While a level has more than one node,
every two consecutive ones become the hash of both, a last one alone the hash
of itself. A single leaf is its tree's root. The trees' roots, ordered by tree
(null first, then by UTF-8 bytes), make the tree of the whole set in the same way.

Rows that tie in the order are ordered by their leaf hash. Repeated rows are
leaves of their own. A null tree value is a tree. An empty table gives no rows.
Columns of any names pass through.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import fresh, small
from quire.operators.indexing import numbered
from quire.session import cut_lineage

#: Levels of a tree that one shuffle makes.
BAND = 6

_NODE = "array<struct<lo:bigint,hi:bigint,digest:string>>"
_PATH = "array<struct<left:string,right:string>>"


def written(column: Column) -> Column:
    """A value as it enters a leaf: ``-`` if null, else byte count, colon, value."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*columns: Column) -> Column:
    """Lowercase hex sha256 of the written columns."""
    return F.sha2(F.concat(*[written(c) for c in columns]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of its path."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings of a path, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _band(base: DataFrame, level: int) -> DataFrame:
    """Nodes (tree, level, lo, hi, digest, depth) of ``level`` to ``level + BAND``, from all those of ``level``."""
    nodes = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest")))
    made = base.groupBy("tree", "depth", F.shiftright("lo", level + BAND).alias("bucket")).agg(nodes.alias("n0"))
    for k in range(BAND):
        pair = lambda a: F.transform(F.sequence(F.lit(0), F.size(a) - 1, F.lit(2)), lambda i: F.struct(
            F.get(a, i)["lo"].alias("lo"), F.coalesce(F.get(a, i + 1)["hi"], F.get(a, i)["hi"]).alias("hi"),
            F.sha2(F.concat(F.get(a, i)["digest"], F.coalesce(F.get(a, i + 1)["digest"], F.lit(""))), 256).alias("digest")))
        made = made.withColumn(f"n{k + 1}", F.when(F.col("depth") > level + k, pair(F.col(f"n{k}"))).otherwise(F.array().cast(_NODE)))
    levels = F.array(*[F.struct(F.lit(level + k).alias("level"), F.col(f"n{k}").alias("nodes")) for k in range(BAND + 1)])
    return (made.select("tree", "depth", F.explode(levels).alias("l")).select("tree", "depth", "l.level", F.explode("l.nodes").alias("n"))
            .select("tree", "depth", "level", "n.lo", "n.hi", "n.digest"))


def _bucket(start: str, level: str) -> Column:
    """Which interval of a level's width a rank lies in."""
    return F.expr(f"shiftright({start}, cast({level} as int))")


def _with_siblings(nodes: DataFrame, level: int) -> DataFrame:
    """Nodes of a band that have a parent in it, with the digests beside them: (tree, level, lo, hi, left, right)."""
    child = nodes.filter(F.col("level") < level + BAND).withColumn("bucket", _bucket("lo", "level + 1"))
    parent = nodes.filter(F.col("level") > level).select(
        "tree", (F.col("level") - 1).alias("level"), _bucket("lo", "level").alias("bucket"), F.col("lo").alias("plo"), F.col("hi").alias("phi"))
    inside = (child.join(parent, ["tree", "level", "bucket"]).filter((F.col("plo") <= F.col("lo")) & (F.col("hi") <= F.col("phi")))
              .groupBy("tree", "level", "plo", "phi").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("inside")))
    own = inside.withColumn("own", F.explode("inside"))
    beside = lambda test: F.array_join(F.transform(F.filter("inside", test), lambda x: x["digest"]), "")
    return own.select("tree", "level", F.col("own.lo").alias("lo"), F.col("own.hi").alias("hi"),
                      beside(lambda x: x["hi"] <= F.col("own.lo")).alias("left"), beside(lambda x: x["lo"] >= F.col("own.hi")).alias("right"))


def _paths_in_band(base: DataFrame, nodes: DataFrame, level: int) -> DataFrame:
    """(tree, depth, lo, path) of every node of ``level``: what stands beside it and its ancestors in the band."""
    steps = F.sequence(F.lit(level), F.least(F.lit(level + BAND), F.col("depth")) - 1)
    rising = (base.filter(F.col("depth") > level).select("tree", "depth", F.col("lo").alias("at"), F.col("hi").alias("to"), F.explode(steps).alias("level"))
              .withColumn("bucket", _bucket("at", "level")))
    above = _with_siblings(nodes, level).withColumn("bucket", _bucket("lo", "level"))
    met = rising.join(above, ["tree", "level", "bucket"]).filter((F.col("lo") <= F.col("at")) & (F.col("to") <= F.col("hi")))
    steps = F.sort_array(F.collect_list(F.struct("level", "left", "right")))
    path = F.transform(steps, lambda s: F.struct(s["left"].alias("left"), s["right"].alias("right")))
    return met.groupBy("tree", "depth", F.col("at").alias("lo")).agg(path.alias("path"))


def _forest(leaves: DataFrame, over: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(tree, rank, path, subroot) of leaves (tree, rank, digest). ``over`` turns the
    trees' roots (tree, subroot) into (tree, subroot, rest): what follows a root on a path."""
    n = F.count(F.lit(1))
    depth = F.when(n < 2, 0).otherwise(F.length(F.bin(n - 1))).cast("int")  # the bits of n - 1
    sizes = cut_lineage(leaves.groupBy("tree").agg(depth.alias("depth")))
    most = sizes.agg(F.max("depth")).first()[0] or 0
    base = leaves.join(small(sizes), "tree").select("tree", "depth", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest")
    single = base.filter("depth = 0")
    roots, bands = [single.select("tree", F.col("digest").alias("subroot"))], []
    for level in range(0, most, BAND):
        nodes = cut_lineage(_band(base, level))
        bands.append((level, base, nodes))
        top = nodes.filter(F.col("level") == F.least(F.lit(level + BAND), F.col("depth")))
        roots.append(top.filter(F.col("depth") <= level + BAND).select("tree", F.col("digest").alias("subroot")))
        base = top.filter(F.col("depth") > level + BAND).drop("level")
    ends = cut_lineage(over(cut_lineage(reduce(DataFrame.unionByName, roots))))
    below = None  # (tree, lo, path, subroot) of the nodes that the band ends at
    for level, base, nodes in reversed(bands):
        own = _paths_in_band(base, nodes, level)
        # a tree's last band has 2**BAND lowest nodes at most
        whole = own.filter(F.col("depth") <= level + BAND).join(ends, "tree").select("tree", "lo", F.concat("path", "rest").alias("path"), "subroot")
        if below is not None:
            on = below.select("tree", F.shiftright("lo", level + BAND).alias("bucket"), F.col("path").alias("rest"), "subroot")
            inner = own.filter(F.col("depth") > level + BAND).withColumn("bucket", F.shiftright("lo", level + BAND))
            whole = whole.unionByName(inner.join(on, ["tree", "bucket"]).select("tree", "lo", F.concat("path", "rest").alias("path"), "subroot"))
        below = cut_lineage(whole) if level else whole
    done = single.join(ends, "tree").select("tree", "lo", F.col("rest").alias("path"), "subroot")
    done = done if below is None else done.unionByName(below)
    return done.withColumnRenamed("lo", "rank")


def manifest(leaves: DataFrame, tree: str, order: list[str], digest: str = "leaf", out: str = "proof") -> DataFrame:
    """``leaves`` with ``out`` (replaced if there is one): a struct of subroot, root and path, an array of
    (left, right) from the leaf to the root (see ``fold``).

    ``digest`` is the column of leaf hashes, ``tree`` the one that tells trees apart, ``order`` the order in a tree.
    The columns of ``leaves`` are range-shuffled and written once, so pass no more than shall come back.
    """
    leaves = leaves.drop(out)
    t, r = fresh(leaves, "tree_"), fresh(leaves, "rank_")
    ranked = cut_lineage(numbered(leaves, [tree], [*order, digest], r, t)[0])
    root = []

    def over(roots: DataFrame) -> DataFrame:
        """Trees are numbered in their order, so a tree's number is its root's rank in the tree over all."""
        found = _forest(roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), F.col("subroot").alias("digest")),
                        lambda whole: whole.withColumn("rest", F.array().cast(_PATH)))
        found = cut_lineage(found)
        root.extend(found.select("subroot").limit(1).collect())
        return roots.join(found.select(F.col("rank").alias("tree"), F.col("path").alias("rest")), "tree")

    paths = _forest(ranked.select(F.col(t).alias("tree"), F.col(r).alias("rank"), F.col(digest).alias("digest")), over)
    top = F.lit(root[0].subroot if root else None).cast("string")
    proof = F.struct("subroot", top.alias("root"), "path").alias(out)
    return ranked.join(paths.select(F.col("tree").alias(t), F.col("rank").alias(r), proof), [t, r]).drop(t, r)
