"""Ranks by prefix sums over range partitions against a plain sort."""

import random

import pytest
from pyspark.sql import functions as F

from quire.operators.indexing import indexed, numbered, rank_within


def _rows(n=600, seed=3):
    rng = random.Random(seed)
    # one key with half of all rows, null keys, many keys of one row
    return [(i, "hot" if i % 2 else None if i % 14 == 0 else f"k{rng.randrange(120)}", rng.randrange(5), rng.randrange(9)) for i in range(n)]


def _expected(rows):
    out, groups, total = {}, {}, 0
    for i, k, v, f in sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[2], r[0])):
        g = groups.setdefault(k, [len(groups), 0])
        out[i] = (g[1], g[0], total)
        g[1] += 1
        total += f
    return out, {k: g[1] for k, g in groups.items()}


@pytest.mark.parametrize("parts", [None, 1, 3, 40])
def test_numbered_against_a_sort(spark, parts):
    rows = _rows()
    df = spark.createDataFrame(rows, "id long, k string, v int, f long")
    got, n = numbered(df, ["k"], [F.col("v"), F.col("id")], "r", "g", "size", ("f", "before"), parts)
    want, sizes = _expected(rows)
    assert n == len(rows) and got.columns == ["id", "k", "v", "f", "r", "g", "before", "size"]
    seen = got.collect()
    assert {x.id: (x.r, x.g, x.before) for x in seen} == want
    assert all(x["size"] == sizes[x.k] for x in seen) and len(seen) == len(rows)


def test_numbered_of_nothing_and_of_one_group(spark):
    none = spark.createDataFrame([], "id long, k string")
    assert indexed(none, ["id"])[1] == 0 and rank_within(none, "k", ["id"]).count() == 0
    one = spark.createDataFrame([(i, None) for i in range(50)], "id long, k string")
    assert sorted(r.in_rank for r in rank_within(one, "k", ["id"]).collect()) == list(range(1, 51))
    assert {r["size"] for r in rank_within(one, "k", ["id"]).collect()} == {50}


def test_no_task_gets_a_hot_key(spark):
    """A key with half of all rows: its rows stay spread over their range partitions, without any broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
        got = numbered(df, ["k"], ["id"], "r", num_partitions=20)[0]
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2]
        assert got.filter("k = 'hot'").agg(F.max("r")).first()[0] == 9_999
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
