"""Blocked pair job, components, DBSCAN and eps selection against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators.cluster import dbscan, dbscan_two_stage, select_eps
from quire.operators.components import connected_components
from quire.operators.indexing import rank_within, with_global_index
from quire.operators.pairs import cosine_topk, nearest_distance, range_edges


def points_df(spark, pts):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(pts)], "id long, v array<double>")


def brute_dbscan(pts, eps, min_samples):
    """Textbook DBSCAN (scan order = row order, clusters numbered as met)."""
    n = len(pts)
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    nb = [np.nonzero(d[i] <= eps)[0] for i in range(n)]
    core = [len(x) >= min_samples for x in nb]
    lab = [-1] * n
    c = -1
    for i in range(n):
        if lab[i] != -1 or not core[i]:
            continue
        c += 1
        lab[i] = c
        stack = [i]
        while stack:
            j = stack.pop()
            if not core[j]:
                continue
            for k in nb[j]:
                if lab[k] == -1:
                    lab[k] = c
                    stack.append(k)
    return lab


@pytest.mark.parametrize("blocks", [1, 2, 5])
def test_edges_and_nn_match_brute_force(spark, blocks):
    rng = np.random.default_rng(7)
    pts = rng.normal(size=(120, 5))
    df = points_df(spark, pts)
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    eps = 2.0
    want = {(i, j) for i in range(120) for j in range(i + 1, 120) if d[i, j] <= eps}
    got = {(r.a, r.b) for r in range_edges(df, "id", "v", eps, blocks=blocks).collect()}
    assert got == want
    np.fill_diagonal(d, np.inf)
    nn = {r.id: r.nn_dist for r in nearest_distance(df, "id", "v", blocks=blocks).collect()}
    for i in range(120):
        assert math.isclose(nn[i], d[i].min(), rel_tol=1e-12)


@pytest.mark.parametrize("blocks", [1, 3])
def test_cosine_topk_matches_brute_force(spark, blocks):
    rng = np.random.default_rng(3)
    pts = rng.normal(size=(60, 4))
    df = points_df(spark, pts)
    u = pts / np.linalg.norm(pts, axis=1)[:, None]
    sims = u @ u.T
    np.fill_diagonal(sims, -np.inf)
    got = {}
    for r in cosine_topk(df, "id", "v", 3, blocks=blocks).collect():
        got.setdefault(r.a, []).append((r.rank, r.b))
    for i in range(60):
        want = list(np.argsort(-sims[i], kind="stable")[:3])
        assert [b for _, b in sorted(got[i])] == want


def test_fixture_clusters_and_no_noise(spark):
    pts = [(0, 0), (0.5, 0), (1, 0), (5, 5), (5.3, 5), (9, 9)]
    lab = {r.id: r.cluster for r in dbscan(points_df(spark, pts), "id", "v", 0.5).collect()}
    assert [lab[i] for i in range(6)] == [0, 0, 0, 1, 1, -1]
    five = dbscan(points_df(spark, pts[:5]), "id", "v", 0.5).collect()
    assert len(five) == 5 and all(r.cluster >= 0 for r in five)


@pytest.mark.parametrize("min_samples", [2, 3])
def test_dbscan_matches_textbook(spark, min_samples):
    rng = np.random.default_rng(11)
    for trial in range(3):
        pts = np.vstack([rng.normal(c, 0.3, size=(15, 2)) for c in ((0, 0), (3, 3), (0, 4))]
                        + [rng.uniform(-2, 6, size=(10, 2))])
        df = points_df(spark, pts)
        got = {r.id: r.cluster for r in dbscan(df, "id", "v", 0.45, min_samples=min_samples).collect()}
        assert [got[i] for i in range(len(pts))] == brute_dbscan(pts, 0.45, min_samples)


def test_components_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 200)] + [(500, 300), (301, 300)], "a long, b long")
    comp = {r.node: r.root for r in connected_components(edges).collect()}
    assert all(comp[i] == 0 for i in range(201))
    assert comp[500] == comp[301] == comp[300] == 300


def test_two_stage(spark):
    pts = [(0, 0), (0.4, 0), (1.2, 0), (1.6, 0), (9, 9)]
    rows = {r.id: (r.cluster, r.cluster2) for r in
            dbscan_two_stage(points_df(spark, pts), "id", "v", 0.8, 0.5).collect()}
    assert rows == {0: (0, 0), 1: (0, 0), 2: (0, 1), 3: (0, 1), 4: (-1, None)}


def test_eps_selection_cases(spark):
    def nn(vals):
        return spark.createDataFrame([(float(v),) for v in vals], "nn_dist double")
    assert select_eps(nn([0.9, 0.78, 0.75, 0.58, 0.55, 0.45]), 0.8, 0.5) == 0.75
    assert select_eps(nn([0.9, 0.78, 0.70, 0.60, 0.555]), 0.8, 0.5) == 0.70
    with pytest.raises(ValueError):
        select_eps(nn([0.95, 0.9, 0.3]), 0.8, 0.5)


@pytest.mark.parametrize("parts", [1, 8])
def test_global_index_and_rank_within(spark, parts):
    df = spark.range(0, 500).select((F.col("id") * 7 % 500).alias("k"), (F.col("id") % 3).alias("g"))
    got = with_global_index(df, [F.col("k")], "i", num_partitions=parts).collect()
    assert sorted((r.k, r.i) for r in got) == [(k, k) for k in range(500)]
    rw = rank_within(df, "g", [F.col("k")], "r", "size").collect()
    for g in range(3):
        ks = sorted(r.k for r in rw if r.g == g)
        assert sorted((r.k, r.r) for r in rw if r.g == g) == [(k, i + 1) for i, k in enumerate(ks)]


def test_grouped_pairs_stay_inside_groups(spark):
    rng = np.random.default_rng(5)
    pts = rng.normal(size=(80, 3))
    rows = [(i, [float(x) for x in p], "d1" if i < 40 else "d2") for i, p in enumerate(pts)]
    df = spark.createDataFrame(rows, "id long, v array<double>, day string")
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    same = np.array([[(i < 40) == (j < 40) for j in range(80)] for i in range(80)])
    want = {(i, j) for i in range(80) for j in range(i + 1, 80) if d[i, j] <= 1.2 and same[i, j]}
    got = {(r.a, r.b) for r in range_edges(df, "id", "v", 1.2, group_col="day", block_rows=16).collect()}
    assert got == want
    lab = {r.id: r.cluster for r in dbscan(df, "id", "v", 1.0, group_col="day").collect()}
    a = {r.id: r.cluster for r in dbscan(df.filter("day = 'd1'"), "id", "v", 1.0).collect()}
    # labels of the first group agree with a run on that group alone
    assert all((lab[i] == -1) == (a[i] == -1) for i in range(40))
    for i in range(40):
        for j in range(40):
            if a[i] >= 0 and a[j] >= 0:
                assert (a[i] == a[j]) == (lab[i] == lab[j])


def test_eps_and_dbscan_per_group(spark):
    from quire.operators.cluster import select_eps_by_group
    dists = {"d1": [0.9, 0.78, 0.75, 0.58, 0.55, 0.45], "d2": [0.9, 0.78, 0.70, 0.60, 0.555], "d3": [0.95, 0.3]}
    nn = spark.createDataFrame([(g, float(v)) for g, vs in dists.items() for v in vs], "day string, nn_dist double")
    got = {r.day: r.eps for r in select_eps_by_group(nn, "day", 0.8, 0.5).collect()}
    assert got["d1"] == 0.75 and got["d2"] == 0.70 and got.get("d3") is None
    # per-group eps column drives the clustering of each group
    pts = [(0, (0, 0), "a", 0.6), (1, (0.5, 0), "a", 0.6), (2, (1.0, 0), "a", 0.6),
           (3, (0, 0), "b", 0.4), (4, (0.5, 0), "b", 0.4), (5, (0.8, 0), "b", 0.4)]
    df = spark.createDataFrame([(i, [float(x) for x in p], g, e) for i, p, g, e in pts],
                               "id long, v array<double>, day string, eps double")
    lab = {r.id: r.cluster for r in dbscan(df, "id", "v", None, group_col="day", eps_col="eps").collect()}
    assert lab[0] == lab[1] == lab[2] >= 0
    assert lab[3] == -1 and lab[4] == lab[5] >= 0 and lab[4] != lab[0]


def clustered(rng, centers, each, dim):
    mid = rng.normal(size=(centers, dim)) * 50
    return np.vstack([m + rng.normal(scale=0.4, size=(each, dim)) for m in mid])


def brute_distances(pts):
    return np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))


@pytest.mark.parametrize("block_rows", [16, 1000])
def test_pivot_cells_prune_and_lose_nothing(spark, block_rows):
    from quire.operators.pairs import range_pair_work
    rng = np.random.default_rng(5)
    pts = clustered(rng, 12, 25, 8)
    pts[:100] = pts[0] + rng.normal(scale=1e-3, size=(100, 8))      # one cell with a third of all rows
    df, d = points_df(spark, pts), brute_distances(pts)
    want = {(i, j) for i in range(300) for j in range(i + 1, 300) if d[i, j] <= 1.2}
    got = [(r.a, r.b) for r in range_edges(df, "id", "v", 1.2, blocks=12, block_rows=block_rows).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    np.fill_diagonal(d, np.inf)
    nn = {r.id: r.nn_dist for r in nearest_distance(df, "id", "v", blocks=12, block_rows=block_rows).collect()}
    assert len(nn) == 300 and all(math.isclose(nn[i], d[i].min(), rel_tol=1e-9) for i in range(300))
    work = range_pair_work(df, "id", "v", 1.2, blocks=12, block_rows=block_rows).first()
    assert work.rows == 300 and work.pairs_all == 300 * 299 // 2 and work.skipped_share > 0.6


def test_pivot_cells_without_structure_skip_nothing(spark):
    from quire.operators.pairs import range_pair_work
    rng = np.random.default_rng(6)
    pts = rng.normal(size=(200, 64))
    pts /= np.linalg.norm(pts, axis=1)[:, None]
    work = range_pair_work(points_df(spark, pts), "id", "v", 1.3, blocks=5).first()
    assert work.pairs_compared == work.pairs_all == 200 * 199 // 2 and work.skipped_share == 0


def test_pivot_cells_edge_cases(spark):
    from quire.operators.pairs import range_pair_work
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.0, 0.0]), (1, [0.0, 0.0]), (2, [3.0, 0.0]), (3, [nan, 0.0]), (4, [inf, 0.0]), (5, None),
            (6, []), (7, [None, 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    assert [tuple(r) for r in range_edges(df, "id", "v", 1.0).collect()] == [(0, 1, 0.0)]
    assert {r.id: r.nn_dist for r in nearest_distance(df, "id", "v").collect()} == {0: 0.0, 1: 0.0, 2: 3.0}
    one = df.filter("id = 2")
    assert nearest_distance(one, "id", "v").count() == 0 and range_edges(one, "id", "v", 9.0).count() == 0
    none = df.filter("id < 0")
    assert nearest_distance(none, "id", "v").count() == 0 and range_edges(none, "id", "v", 1.0).count() == 0
    assert range_pair_work(none, "id", "v", 1.0).first().pairs_all == 0
    labels = {r.id: r.cluster for r in dbscan(df, "id", "v", 1.0).collect()}
    assert labels == {0: 0, 1: 0, 2: -1, 3: -1, 4: -1, 5: -1, 6: -1, 7: -1}


def brute_topk(left, right, k, threshold=None, include_self=False, clamp=None):
    def unit(v):
        v = np.array(v, dtype=float)
        n = np.linalg.norm(v)
        return v / n if n else v
    out = {}
    for a, av in left:
        sims = []
        for b, bv in right:
            if a == b and not include_self:
                continue
            s = float(unit(av) @ unit(bv))
            if clamp is not None and s <= clamp:
                s = 0.0
            if threshold is None or s > threshold:
                sims.append((-s, b))
        out[a] = [b for _, b in sorted(sims)[:k]]
    return {a: b for a, b in out.items() if b}


@pytest.mark.parametrize("options", [{}, {"threshold": 0.5}, {"threshold": -0.2},
                                     {"include_self": True, "clamp": 0.5}, {"include_self": True, "clamp": 0.9995}])
def test_topk_between_visits_only_what_can_count(spark, options):
    from quire.operators.pairs import cosine_topk_between, topk_pair_work
    rng = np.random.default_rng(8)
    pts = clustered(rng, 10, 20, 6)
    pts[60:130] = pts[60] + rng.normal(scale=1e-2, size=(70, 6))     # a cell with a third of all rows
    right = [(i, [float(x) for x in p]) for i, p in enumerate(pts)] + [(200, [0.0] * 6), (7000, [0.0] * 6)]
    left = [r for r in right if r[0] % 3 == 0 or r[0] == 200]
    schema = "id long, v array<double>"
    bad = [(900, None), (901, []), (902, [float("nan")] * 6)]
    l_df, r_df = spark.createDataFrame(left + bad, schema), spark.createDataFrame(right + bad, schema)
    got = {}
    for r in cosine_topk_between(l_df, r_df, "id", "v", 4, block_rows=30, **options).orderBy("a", "rank").collect():
        got.setdefault(r.a, []).append(r.b)
    assert got == brute_topk(left, right, 4, **options)
    work = topk_pair_work(l_df, r_df, "id", "v", 4, block_rows=30, **options).first()
    assert 0 < work.tiles and work.pairs_compared <= len(left) * len(right)
    if options.get("threshold") == 0.5:
        assert work.pairs_compared < 0.6 * len(left) * len(right)


def test_topk_between_empty_sides(spark):
    from quire.operators.pairs import cosine_topk_between, topk_pair_work
    some = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1])], "id long, v array<double>")
    none = some.filter("id < 0")
    for a, b in ((none, some), (some, none), (none, none)):
        assert cosine_topk_between(a, b, "id", "v", 2).count() == 0
        assert topk_pair_work(a, b, "id", "v", 2).first().pairs_compared == 0


def test_tiles_hold_many_narrow_rows_and_cells_share_blocks(spark):
    from quire.operators.cells import in_blocks, vectors
    from quire.operators.pairs import _cells_of, _in_reach
    pts = np.random.default_rng(1).normal(size=(20000, 4)).astype("float32")
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pts)], "id long, v array<float>")
    rows = vectors(df, "id", "v")
    assert rows.schema["v"].dataType.simpleString() == "array<float>"
    cells = _cells_of(rows, None, None)
    per = {r["blk"]: r["count"] for r in in_blocks(rows, cells).groupBy("blk").count().collect()}
    assert sum(per.values()) == 20000 and len(per) < 2 * len(cells.ids)
    # as many copies as blocks at most, however many pivots there are
    assert _in_reach(df, "id", "v", 100.0, None, None).count() == 20000 * len(per)


def test_many_small_cells_share_few_blocks():
    from quire.operators.cells import _block_numbers
    centers = np.arange(40.0)[:, None]
    first, blocks = _block_numbers(centers, np.array([10] * 39 + [250]), 100, 100)
    assert blocks.tolist() == [1] * 39 + [3] and len(set(first[:39])) == 4 and first[39] == 4
    first, blocks = _block_numbers(centers, np.array([10] * 40), 100, 0)
    assert first.tolist() == list(range(40))


@pytest.mark.parametrize("k,clamp,include_self", [(3, None, False), (4, 0.3, True), (2, None, True)])
def test_topk_of_a_tile_in_chunks(monkeypatch, k, clamp, include_self):
    from quire.operators import pairs
    monkeypatch.setattr(pairs, "CHUNK", 7)
    monkeypatch.setattr(pairs, "WIDE", 5)
    rng = np.random.default_rng(k)
    v = np.repeat(rng.normal(size=(20, 3)), 3, axis=0)
    v /= np.linalg.norm(v, axis=1)[:, None]
    ids = rng.permutation(60)
    a, b, s = pairs._topk_rows(ids, v, ids, v, k, None, include_self, clamp)
    sims = (v @ v.T).round(9)
    for i in range(60):
        row = [(0.0 if clamp is not None and sims[i, j] <= clamp else sims[i, j], ids[j]) for j in range(60) if include_self or i != j]
        want = sorted(row, key=lambda x: (-x[0], x[1]))[:k]
        assert np.allclose(s[a == ids[i]], [w[0] for w in want])
        assert len(set(b[a == ids[i]])) == k


def test_copies_make_no_square_of_edges(spark):
    from quire.operators.pairs import range_neighbours, range_star_edges
    pts = [(i, [float(i % 3), 0.0]) for i in range(600)] + [(600, [50.0, 0.0]), (601, [50.5, 0.0])]
    df = spark.createDataFrame(pts, "id long, v array<double>")
    part = range_neighbours(df, "id", "v", 0.6, 1).collect()
    assert sum(r.n for r in part) == 3 * 200 * 199 + 2
    assert all(r.near is None or len(r.near) <= 1 for r in part) and len(part) < 602 * 12
    assert {r.id: r.near for r in part if r.id >= 600} == {600: [601], 601: [600]}
    assert range_star_edges(df, "id", "v", 0.6).count() < 602 * 12
    lab = {r.id: r.cluster for r in dbscan(df, "id", "v", 0.6, min_samples=3).collect()}
    assert lab[600] == lab[601] == -1 and [lab[i] for i in range(3)] == [0, 1, 2]


@pytest.mark.parametrize("eps2", [0.6, 1.5])
def test_two_stages_without_edges(spark, eps2):
    pts = np.random.default_rng(3).uniform(size=(80, 2)) * 8
    df = points_df(spark, pts)
    got = {r.id: (r.cluster, r.cluster2) for r in dbscan_two_stage(df, "id", "v", 1.0, eps2).collect()}
    edges = range_edges(df, "id", "v", max(1.0, eps2))
    want = {r.id: (r.cluster, r.cluster2) for r in dbscan_two_stage(df, "id", "v", 1.0, eps2, edges=edges).collect()}
    assert got == want
