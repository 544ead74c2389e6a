"""Randomised properties: components vs union-find, global index vs sort,
results independent of the partitioning of the input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.operators.components import connected_components
from quire.operators.indexing import rank_within, with_global_index

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in parent}


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=80),
       st.integers(1, 6))
def test_components_match_union_find(spark, edges, parts):
    df = spark.createDataFrame(edges, "a long, b long").repartition(parts)
    got = {r.node: r.root for r in connected_components(df).collect()}
    want = {n: r for n, r in union_find([(a, b) for a, b in edges if a != b]).items()}
    assert got == want


@SETTINGS
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=200, unique=True), st.integers(1, 7))
def test_global_index_is_sort_position(spark, values, parts):
    df = spark.createDataFrame([(v, v % 3) for v in values], "v long, g long").repartition(parts)
    got = {r.v: r.i for r in with_global_index(df, [F.col("v")], "i", num_partitions=parts).collect()}
    assert got == {v: i for i, v in enumerate(sorted(values))}
    ranks = {r.v: r.r for r in rank_within(df, "g", [F.desc("v")], "r", None).collect()}
    for g in range(3):
        members = sorted((v for v in values if v % 3 == g), reverse=True)
        assert [ranks[v] for v in members] == list(range(1, len(members) + 1))
