"""Hand-worked scoring, ranking, search and selection cases."""

import datetime as dt
import math

from pyspark.sql import functions as F

from quire.operators.scoring import article_score, tag_keywords, topic_article_score
from quire.operators.search import match_search, vector_search
from quire.operators.stats import exact_quantile
from quire.plans.digest import pick_in_groups, rank_groups, singles_quota
from quire.sources.scans import settled_new


def test_keyword_score_and_tag(spark):
    df = spark.createDataFrame([("地震 地震", "花蓮地震，地震規模6")], "h1 string, text string")
    r = tag_keywords(df, ["地震", "花蓮", "颱風", ""]).first()
    assert r.in_keywords == 7 and r.keywords_tag == "地震|花蓮"


def test_article_score_values(spark):
    df = spark.createDataFrame([(3, 1, 2, 1, float(i)) for i in (0, 1, 9)],
                               "in_keywords int, focus int, extender int, attachments int, position double")
    df = df.withColumn("position_score", F.log1p("position"))
    got = [round(r.sort_cri, 6) for r in article_score(df).orderBy("position").collect()]
    assert got == [1.45, 1.484657, 1.565129]


def test_topic_article_score(spark):
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    df = spark.createDataFrame([(1, "a", d1, 2), (1, "b", d1, 0), (1, "c", d2, 1), (1, "d", d3, 0)],
                               "tno int, pid string, published_dt date, extender int")
    got = {r.pid: r.score for r in topic_article_score(df).collect()}
    assert got == {"a": 6.0, "c": 3.5}


def test_cluster_ranking_and_quantile(spark):
    rows = [(0, 4.0, 2.5), (1, 1.0, 0.6), (2, 4.0, 3.0), (3, 2.0, 1.0), (4, 8.0, 2.0)]
    g = spark.createDataFrame(rows, "cluster int, total double, top double")
    assert math.isclose(exact_quantile(g, "total", 0.2), 1.8)
    # rows of articles whose sums and maxima reproduce the table above
    arts = spark.createDataFrame(
        [("p%d_%d" % (c, i), c, v) for c, tot, top in rows for i, v in enumerate([top, tot - top]) if v > 0],
        "pid string, cluster int, sort_cri double")
    ranked = rank_groups(arts).orderBy("group_rank").collect()
    assert [r.cluster for r in ranked] == [4, 2, 0, 3]
    one = spark.createDataFrame([("x", 0, 1.0), ("y", 0, 2.0)], "pid string, cluster int, sort_cri double")
    assert rank_groups(one).count() == 0


def test_selection_sizes(spark):
    sizes = [1, 2, 3, 4, 5, 6, 7, 9]
    arts = spark.createDataFrame([(f"{n}_{i}", n, float(i)) for n in sizes for i in range(n)],
                                 "pid string, cluster int, sort_cri double")
    groups = spark.createDataFrame([(n, i) for i, n in enumerate(sizes)], "cluster int, group_rank long")
    picked = {r.cluster: r.n for r in pick_in_groups(arts, groups).groupBy("cluster")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert picked == {1: 1, 2: 2, 3: 3, 4: 2, 5: 2, 6: 3, 7: 3, 9: 4}
    assert [singles_quota(g) for g in (0, 24, 25, 30)] == [25, 1, 5, 5]


def test_bm25_fixture(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, "c c c c")], "id long, text string")
    hits, total = match_search(df, "id", "text", "a")
    rows = hits.collect()
    assert total == 1 and len(rows) == 1 and rows[0].id == 1
    assert round(rows[0].score, 6) == 1.348640


def test_vector_search_fixture(spark):
    pts = {"a": (1.0, 0.0), "b": (0.8, 0.6), "c": (0.6, 0.8), "d": (0.0, 1.0)}
    df = spark.createDataFrame([(k, list(v)) for k, v in pts.items()], "id string, v array<double>")
    got = [(r.id, round(r.score, 6)) for r in vector_search(df, "id", "v", [1.0, 0.0]).collect()]
    assert got == [("a", 2.0), ("b", 1.8), ("c", 1.6), ("d", 1.0)]


def test_duplicate_pids(spark):
    old, fresh = dt.datetime(2024, 1, 1, 8, 0), dt.datetime(2024, 1, 1, 11, 50)
    now = dt.datetime(2024, 1, 1, 12, 0)
    hits = spark.createDataFrame([("a", old), ("a", fresh), ("b", old)], "pid string, dt timestamp_ntz")
    done = spark.createDataFrame([], "pid string")
    assert settled_new(hits, done, "pid", "dt", now).count() == 3
    twice = spark.createDataFrame([("a", old), ("a", old)], "pid string, dt timestamp_ntz")
    assert settled_new(twice, done, "pid", "dt", now).count() == 2
    assert settled_new(twice, done, "pid", "dt", now, multiplicity="reference").count() == 4


def test_related_fixture(spark):
    from quire.plans.related import related_articles
    pts = {"a": (1.0, 0.0), "b": (0.8, 0.6), "c": (0.6, 0.8), "d": (0.0, 1.0)}
    cur = spark.createDataFrame([(i, k, "x", list(v)) for i, (k, v) in enumerate(pts.items())],
                                "doc_id long, pid string, category string, embeddings array<double>")
    earlier = cur.limit(0)
    done = spark.createDataFrame([], "pid string")
    for mode, want in (("default", ["b", "c"]), ("reference", ["b", "c", "d"])):
        rows = related_articles(cur, earlier, done, threshold=0.5, mode=mode).filter(F.col("pid") == "a").collect()
        assert [r.related_url.split("/")[1] for r in sorted(rows, key=lambda r: r.rank)] == want


def test_index_search_matches_scan_search(spark, tmp_path):
    from quire.operators.index import build_postings, corpus_figures, index_search, read_postings, write_postings
    docs = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, "c c c c"), (4, "A c b")], "id long, text string")
    path = str(tmp_path / "postings")
    write_postings(build_postings(docs, "id", "text"), path, partitions=2)
    n, avgdl = corpus_figures(docs, "text")
    p = read_postings(spark, path)
    got, total = index_search(p, n, avgdl, "a c")
    want, want_total = match_search(docs, "id", "text", "a c")
    assert total == want_total == 4
    assert [(r.id, round(r.score, 9)) for r in got.collect()] == [(r.id, round(r.score, 9)) for r in want.collect()]
    plan = p.filter(F.col("token").isin(["a", "c"]))._jdf.queryExecution().executedPlan().toString()
    assert "In(token" in plan
