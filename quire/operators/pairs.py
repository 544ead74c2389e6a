"""Blocked all-pairs vector jobs: range edges (C6), nearest-neighbour
distance (C7) and top-k cosine neighbours (C8).

Rows are hashed into B blocks; each row is sent to the B unordered block
pairs that contain its block, so one task sees two blocks (or one, on the
diagonal) and compares them with a numpy Gram matrix in small chunks. Task
memory is bounded by ``block_rows`` (about 2 * block_rows * dim doubles plus
one chunk) whatever the table size; the replication factor is B. By default a
block holds ``BLOCK_VALUES`` components, 16 MB as doubles, so narrow vectors are
copied to few blocks, and float vectors travel as floats. Only qualifying output
leaves a task: edges within ``eps`` (for clustering at most one for each row),
counts, one partial minimum per row, or at most k neighbours per row. Distances
of emitted edges are recomputed by direct subtraction so the ``<= eps`` test does
not depend on Gram rounding.

Edges and nearest distances over a whole table, and the top-k of one table in
another, are cut into pivot cells (``cells``): a row is not sent to blocks that
the triangle inequality puts out of its reach. Jobs within a group, and the
top-k within one table, are cut by a hash alone.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.cells import choose_pivots, in_blocks, make_cells, measured, replicated, sent, vector, vectors

#: Left and right rows of one chunk of a tile; pairs that are looked at closely, or held, at once.
CHUNK, WIDE = 512, 1024
CLOSE, HELD = 1 << 16, 1 << 20
#: Components of a block, and the rows that it has at least and at most.
BLOCK_VALUES, MIN_ROWS, MAX_ROWS = 1 << 21, 1024, 1 << 16
#: Rows for each pivot.
PIVOT_ROWS = 4096
SLACK = 1e-6


def rows_of_block(df: DataFrame, vec_col: str, block_rows: int | None = None) -> int:
    """``block_rows``, or as many rows as ``BLOCK_VALUES`` components make."""
    if block_rows:
        return block_rows
    first = df.select(F.size(vec_col).alias("n")).filter("n > 0").first()
    return max(MIN_ROWS, min(MAX_ROWS, BLOCK_VALUES // first["n"])) if first else MAX_ROWS


def choose_blocks(spark, n: int, block_rows: int = 4096) -> int:
    """Enough blocks to bound task memory, and enough block pairs to use the cores."""
    par = spark.sparkContext.defaultParallelism
    by_size = math.ceil(n / max(block_rows, 1))
    by_cores = math.ceil(math.sqrt(2 * par))
    return max(1, min(max(by_size, by_cores), max(n, 1)))


GROUP = "_grp"


def _replicate(df: DataFrame, id_col: str, vec_col: str, blocks: int,
               group_col: str | None = None, block_rows: int = 4096,
               eps_col: str | None = None) -> DataFrame:
    """Rows -> (group, bi, bj, blk, id, v), one copy per block pair of the row's block.

    With ``group_col`` rows are only paired inside their group (e.g. one
    day of articles), and every group gets its own block count from its row
    count (a grouped count joined on the group key), so a group holding a
    large share of the rows is cut into proportionally more blocks."""
    cols = [F.col(id_col).cast("long").alias("id"), vector(df, vec_col).alias("v")]
    if group_col:
        cols.append(F.col(group_col).alias(GROUP))
    if eps_col:
        cols.append(F.col(eps_col).cast("double").alias("_eps"))
    base = df.select(*cols).filter(F.col("v").isNotNull() & (F.size("v") > 0))
    if group_col:
        per = base.groupBy(GROUP).agg(F.count(F.lit(1)).alias("_n")).select(
            GROUP, F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(block_rows))).cast("int").alias("_nb"))
        base = base.join(per, GROUP)
        nb = F.col("_nb")
    else:
        base = base.withColumn(GROUP, F.lit(0))
        nb = F.lit(blocks)
    base = base.withColumn("blk", F.pmod(F.xxhash64("id"), nb).cast("int"))
    rep = base.withColumn("other", F.explode(F.sequence(F.lit(0), nb - 1)))
    return (rep.withColumn("bi", F.least("blk", "other"))
               .withColumn("bj", F.greatest("blk", "other"))
               .drop("other", "_nb"))


def _split(pdf: pd.DataFrame):
    bi, bj = int(pdf["bi"].iloc[0]), int(pdf["bj"].iloc[0])
    left = pdf[pdf["blk"] == bi]
    right = left if bi == bj else pdf[pdf["blk"] == bj]
    lid = left["id"].to_numpy(np.int64)
    rid = right["id"].to_numpy(np.int64)
    lv = np.stack(left["v"].to_numpy()).astype(np.float64) if len(left) else np.zeros((0, 0))
    rv = np.stack(right["v"].to_numpy()).astype(np.float64) if len(right) else np.zeros((0, 0))
    return bi == bj, lid, lv, rid, rv


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a - b) ** 2).sum(axis=1))


def _chunks(n_left: int, n_right: int):
    """Slices of a tile, one chunk of left rows by one of right rows after the other."""
    for i in range(0, n_left, CHUNK):
        for j in range(0, n_right, WIDE):
            yield slice(i, i + CHUNK), slice(j, j + WIDE)


def _gram(lv: np.ndarray, rv: np.ndarray):
    """Squared lengths of both sides, and both sides widened so that one product gives squared distances."""
    ln, rn = (lv * lv).sum(axis=1), (rv * rv).sum(axis=1)
    return ln, rn, np.column_stack([lv, ln, np.ones(len(lv))]), np.column_stack([-2.0 * rv, np.ones(len(rv)), rn])


def _same(a: np.ndarray, b: np.ndarray) -> np.ndarray | None:
    """Where ids of a chunk are equal; None if none are."""
    return a[:, None] == b[None, :] if np.isin(a, b).any() else None


def _near_pairs(pdf: pd.DataFrame, eps_fixed: float | None, measure: bool):
    """(left ids, right ids, places, distances) of the pairs of a tile within eps, chunk by chunk; each unordered
    pair once. Without ``measure`` only pairs near the border are measured, and distances are None."""
    # a fixed eps, or the group's own eps carried in the rows
    eps = eps_fixed if eps_fixed is not None else pdf["_eps"].iloc[0]
    if eps is None or not np.isfinite(eps):
        return              # a group without an eps has no edges: all noise
    diag, lid, lv, rid, rv = _split(pdf)
    if not len(lid) or not len(rid):
        return
    ln, rn, la, ra = _gram(lv, rv)
    for left, right in _chunks(len(lid), len(rid)):
        d2 = la[left] @ ra[right].T
        # the Gram form's rounding grows with the norms, so the slack does too
        room = 64 * np.finfo(float).eps * (ln[left].max() + rn[right].max())
        ii, jj = np.nonzero(d2 <= (eps + SLACK) ** 2 + SLACK + room)
        sure = d2[ii, jj] < max(eps - SLACK, 0.0) ** 2 - SLACK - room
        ii, jj = ii + left.start, jj + right.start
        keep = lid[ii] < rid[jj] if diag else lid[ii] != rid[jj]
        ii, jj, sure = ii[keep], jj[keep], sure[keep]
        for s in range(0, len(ii), CLOSE):
            i, j, ok = ii[s:s + CLOSE], jj[s:s + CLOSE], sure[s:s + CLOSE]
            if measure:
                dist = _exact(lv[i], rv[j])
                ok = dist <= eps
                yield lid[i[ok]], rid[j[ok]], dist[ok]
            else:
                at = np.flatnonzero(~ok)
                ok[at] = _exact(lv[i[at]], rv[j[at]]) <= eps
                yield lid[i[ok]], rid[j[ok]], None


def _edges_fn(eps_fixed: float | None):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [(np.minimum(a, b), np.maximum(a, b), d) for a, b, d in _near_pairs(pdf, eps_fixed, True) if len(a)]
        out = [np.concatenate([f[i] for f in found]) if found else np.empty(0) for i in range(3)]
        return pd.DataFrame({"a": out[0].astype(np.int64), "b": out[1].astype(np.int64), "dist": out[2]})
    return run


def _neighbours_fn(eps: float, most: int):
    """For each row of a tile that has neighbours in it: how many, and which if there are at most ``most``."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # rows are told apart by their place, as ids may repeat
        pdf = pdf.assign(row=np.arange(len(pdf)))
        ids, n, near = pdf["id"].to_numpy(np.int64), np.zeros(len(pdf), np.int64), [[] for _ in range(len(pdf))]
        for i, j in _near_rows(pdf, eps):
            for me, other in ((i, j), (j, i)):
                order = np.argsort(me, kind="stable")
                rows, first, count = np.unique(me[order], return_index=True, return_counts=True)
                for r, at, c in zip(rows[n[rows] < most], first[n[rows] < most], count[n[rows] < most]):
                    near[r].extend(ids[other[order[at:at + most]]].tolist())
                n[rows] += count
        has = np.flatnonzero(n)
        few = pd.Series([near[r] if n[r] <= most else None for r in has], dtype=object)
        return pd.DataFrame({"id": ids[has], "n": n[has], "near": few})
    return run


def _local_stars(a: np.ndarray, b: np.ndarray):
    """Connected components of one tile's edges (min-label propagation with
    pointer jumping, vectorised): returns (node, root) with root = the
    smallest id of the node's local component, for non-root nodes only."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    ia, ib = inv[:len(a)], inv[len(a):]
    lab = np.arange(len(nodes))
    while True:
        new = lab.copy()
        np.minimum.at(new, ia, lab[ib])
        np.minimum.at(new, ib, lab[ia])
        new = new[new]
        if np.array_equal(new, lab):
            break
        lab = new
    keep = lab != np.arange(len(nodes))
    return nodes[keep], nodes[lab[keep]]


def _star_edges_fn(eps: float | None):
    """Edges within eps, reduced inside the task to one edge from every node
    to the smallest node of its local component: same connectivity, far
    fewer edges, and the global star rounds start from stars. They are reduced
    whenever ``HELD`` are at hand, so a tile of near copies needs no more memory."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        held, n = [], 0

        def stars():
            node, root = _local_stars(*(np.concatenate([h[i] for h in held]) for i in range(2)))
            return root, node

        for a, b, _ in _near_pairs(pdf, eps, False):
            if len(a):
                held.append((a, b))
                n += len(a)
            if n > HELD + len(pdf):
                held = [stars()]
                n = len(held[0][0])
        a, b = stars() if held else (np.empty(0, np.int64), np.empty(0, np.int64))
        return pd.DataFrame({"a": a, "b": b})
    return run


def _nn_fn():
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        diag, lid, lv, rid, rv = _split(pdf)
        ids, mins = [], []
        if len(lid) and len(rid):
            _, _, la, ra = _gram(lv, rv)
            sides = [[np.full(len(x), np.inf), np.full(len(x), -1)] for x in (lid, rid)]

            def lower(side, part, arg, val, start):
                best, at = side
                better = val < best[part]
                best[part][better] = val[better]
                at[part][better] = arg[better] + start

            for left, right in _chunks(len(lid), len(rid)):
                d2 = la[left] @ ra[right].T
                same = _same(lid[left], rid[right])
                if same is not None:
                    d2[same] = np.inf
                j = np.argmin(d2, axis=1)
                lower(sides[0], left, j, d2[np.arange(len(d2)), j], right.start)
                if not diag:
                    i = np.argmin(d2, axis=0)
                    lower(sides[1], right, i, d2[i, np.arange(d2.shape[1])], left.start)
            for (_, at), own, mine, theirs in ((sides[0], lid, lv, rv), *([] if diag else [(sides[1], rid, rv, lv)])):
                fin = np.flatnonzero(at >= 0)
                for s in range(0, len(fin), CLOSE):
                    some = fin[s:s + CLOSE]
                    ids.append(own[some])
                    mins.append(_exact(mine[some], theirs[at[some]]))
        if not ids:
            return pd.DataFrame({"id": pd.Series([], dtype="int64"),
                                 "nn_dist": pd.Series([], dtype="float64")})
        return pd.DataFrame({"id": np.concatenate(ids), "nn_dist": np.concatenate(mins)})
    return run


def _best(src_ids, dst_ids, sims, k: int, threshold: float | None, clamp: float | None):
    """Of similarities (rows = src, columns = dst) the k best of each row: (src, dst, value)."""
    kk = min(k, sims.shape[1])
    if kk == 0:
        return src_ids[:0], dst_ids[:0], np.empty(0)
    if clamp is not None:
        sims = np.where(np.isfinite(sims) & (sims <= clamp), 0.0, sims)
    # all that reach the k-th value; ties are then broken by id, so the result
    # does not depend on how rows fall into tiles
    last = -np.partition(-sims, kk - 1, axis=1)[:, kk - 1]
    rows, cols = np.nonzero(sims >= last[:, None])
    vals = sims[rows, cols]
    order = np.lexsort((dst_ids[cols], -vals, rows))
    rows, cols, vals = rows[order], cols[order], vals[order]
    ok = (np.arange(len(rows)) - np.searchsorted(rows, rows) < kk) & np.isfinite(vals)
    if threshold is not None:
        ok &= vals > threshold
    return src_ids[rows[ok]], dst_ids[cols[ok]], vals[ok]


def _topk_rows(a, av, b, bv, k: int, threshold: float | None, include_self: bool, clamp: float | None):
    """The k best of the rows ``b`` for each row of ``a``: (a, b, value). ``b`` is gone through by
    ascending id, so what comes later and only ties never counts, however many rows tie."""
    order = np.argsort(b, kind="stable")
    b, bv = b[order], bv[order]
    out = []
    for s in range(0, len(a), CHUNK):
        ids, held = a[s:s + CHUNK], None
        worth = np.full(len(ids), -np.inf)       # what a row must beat
        for t in range(0, len(b), WIDE):
            sims, theirs = av[s:s + CHUNK] @ bv[t:t + WIDE].T, b[t:t + WIDE]
            same = None if include_self else _same(ids, theirs)
            if same is not None:
                sims[same] = -np.inf
            if held is None:
                got = _best(np.arange(len(ids)), theirs, sims, k, threshold, clamp)
            else:
                if clamp is not None:
                    sims = np.where(np.isfinite(sims) & (sims <= clamp), 0.0, sims)
                rows, cols = np.nonzero(sims > worth[:, None])
                if not len(rows):
                    continue
                got = [np.concatenate(x) for x in zip(held, (rows, theirs[cols], sims[rows, cols]))]
                at = np.lexsort((got[1], -got[2], got[0]))
                got = [x[at] for x in got]
                ok = np.arange(len(at)) - np.searchsorted(got[0], got[0]) < k
                got = [x[ok] for x in got]
            held = got
            full = np.flatnonzero(np.bincount(held[0], minlength=len(ids)) >= k)
            worth[:] = -np.inf if threshold is None else threshold
            worth[full] = held[2][np.searchsorted(held[0], full, "right") - 1]
        if held is not None:
            out.append((ids[held[0]], held[1], held[2]))
    return [np.concatenate([o[i] for o in out]) if out else np.empty(0) for i in range(3)]


def _topk_frame(parts) -> pd.DataFrame:
    a, b, v = (np.concatenate([p[i] for p in parts]) if parts else np.empty(0) for i in range(3))
    return pd.DataFrame({"a": a.astype(np.int64), "b": b.astype(np.int64), "sim": v.astype(np.float64)})


def _topk_fn(k: int, threshold: float | None, include_self: bool = False, clamp: float | None = None):
    """Local top-k per row. ``clamp``: similarities at or below it become 0
    and still compete (ties by id, exact via lexsort); ``include_self`` keeps
    the row itself as a candidate."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        diag, lid, lv, rid, rv = _split(pdf)
        parts = []
        if len(lid) and len(rid):
            lnorm = np.linalg.norm(lv, axis=1)
            rnorm = np.linalg.norm(rv, axis=1)
            lu = lv / np.where(lnorm == 0, 1, lnorm)[:, None]
            ru = rv / np.where(rnorm == 0, 1, rnorm)[:, None]
            parts = [_topk_rows(lid, lu, rid, ru, k, threshold, include_self, clamp)]
            if not diag:
                parts.append(_topk_rows(rid, ru, lid, lu, k, threshold, include_self, clamp))
        return _topk_frame(parts)
    return run


def _near_rows(pdf: pd.DataFrame, eps: float):
    """(left, right) row places (column ``row``) of the pairs of a tile within eps, chunk by chunk."""
    # places stand in for ids, which go along to leave out pairs of one id
    ids = pdf["id"].to_numpy(np.int64)
    for i, j, _ in _near_pairs(pdf.assign(id=pdf["row"]), eps, False):
        ok = ids[i] != ids[j]
        yield i[ok], j[ok]


def _blocks_for(df: DataFrame, blocks: int | None, block_rows: int) -> int:
    if blocks:
        return blocks
    return choose_blocks(df.sparkSession, df.count(), block_rows)


def _pivots_for(rows: DataFrame, blocks: int | None, block_rows: int) -> tuple[int, int]:
    """How many pivots to choose, and up to how many rows their cells may share a block. A number of
    blocks that the caller gives is the number of pivots, and no cells share."""
    if blocks:
        return blocks, 0
    n = rows.count()
    few = choose_blocks(rows.sparkSession, n, block_rows)
    return max(few, math.ceil(n / PIVOT_ROWS)), math.ceil(n / few)


def _cells_of(rows: DataFrame, blocks: int | None, block_rows: int | None):
    """Cells of ``vectors`` rows; None for an empty table."""
    block_rows = rows_of_block(rows, "v", block_rows)
    pivots, shared = _pivots_for(rows, blocks, block_rows)
    return make_cells(rows, pivots, block_rows, shared)


def _in_reach(df: DataFrame, id_col: str, vec_col: str, eps: float,
              blocks: int | None, block_rows: int | None) -> DataFrame | None:
    """Rows copied to the block pairs that may hold a row within ``eps`` of them."""
    rows = vectors(df, id_col, vec_col)
    cells = _cells_of(rows, blocks, block_rows)
    if cells is None:
        return None
    cells = cells.reaching({i: eps for i in range(len(cells.ids))})
    return replicated(in_blocks(rows, cells), cells)


def _range_tiles(df: DataFrame, id_col: str, vec_col: str, eps: float | None, blocks: int | None,
                 block_rows: int | None, group_col: str | None, eps_col: str | None, fn, schema: str) -> DataFrame:
    if group_col:
        rep = _replicate(df, id_col, vec_col, 1, group_col, rows_of_block(df, vec_col, block_rows), eps_col if eps is None else None)
        return rep.groupBy(GROUP, "bi", "bj").applyInPandas(fn, schema)
    rep = _in_reach(df, id_col, vec_col, eps, blocks, block_rows)
    if rep is None:
        return df.sparkSession.createDataFrame([], schema)
    return rep.groupBy("bi", "bj").applyInPandas(fn, schema)


def range_edges(df: DataFrame, id_col: str, vec_col: str, eps: float,
                blocks: int | None = None, block_rows: int | None = None,
                group_col: str | None = None) -> DataFrame:
    """Euclidean range self-join: (a, b, dist) with a < b and dist <= eps
    (within ``group_col`` when given)."""
    return _range_tiles(df, id_col, vec_col, float(eps), blocks, block_rows, group_col, None,
                        _edges_fn(float(eps)), "a long, b long, dist double")


def range_star_edges(df: DataFrame, id_col: str, vec_col: str, eps: float | None,
                     blocks: int | None = None, block_rows: int | None = None,
                     group_col: str | None = None, eps_col: str | None = None) -> DataFrame:
    """(a, b) edges with the same connected components as the ``dist <= eps``
    graph, pre-reduced to stars inside each task (no distances). With
    ``eps_col`` (constant within each group) every group uses its own eps."""
    if eps is None and not (eps_col and group_col):
        raise ValueError("give eps, or eps_col together with group_col")
    fixed = float(eps) if eps is not None else None
    return _range_tiles(df, id_col, vec_col, fixed, blocks, block_rows, group_col, eps_col,
                        _star_edges_fn(fixed), "a long, b long")


def range_neighbours(df: DataFrame, id_col: str, vec_col: str, eps: float, most: int,
                     blocks: int | None = None, block_rows: int | None = None) -> DataFrame:
    """(id, n, near): how many rows of another id lie within ``eps`` of a row, in parts (one for each
    tile that has any; a row's number is their sum), and in each part their ids if there are at most
    ``most`` (else null). So a row with ``most`` neighbours or fewer names them all, and no part is
    longer, however many near copies the table holds."""
    return _range_tiles(df, id_col, vec_col, float(eps), blocks, block_rows, None, None,
                        _neighbours_fn(float(eps), most), "id long, n long, near array<long>")


def range_pair_work(df: DataFrame, id_col: str, vec_col: str, eps: float,
                    blocks: int | None = None, block_rows: int | None = None) -> DataFrame:
    """What pruning leaves of ``range_edges``, in one row: (rows, tiles,
    pairs_compared, pairs_all, skipped_share). A tile without rows on both sides
    compares nothing. An empty table gives zeros."""
    rep = _in_reach(df, id_col, vec_col, float(eps), blocks, block_rows)
    if rep is None:
        return df.sparkSession.createDataFrame(
            [(0, 0, 0, 0, 0.0)], "rows long, tiles long, pairs_compared long, pairs_all long, skipped_share double")
    left = F.count(F.when(F.col("blk") == F.col("bi"), True))
    right = F.count(F.when(F.col("blk") == F.col("bj"), True))
    tile = rep.groupBy("bi", "bj").agg(left.alias("l"), right.alias("r"))
    same = F.col("bi") == F.col("bj")
    pairs = F.when(same, F.expr("l * (l - 1) div 2")).otherwise(F.col("l") * F.col("r"))
    out = tile.select("l", same.alias("same"), pairs.alias("pairs")).agg(
        F.sum(F.when(F.col("same"), F.col("l"))).alias("rows"),
        F.count(F.when(F.col("pairs") > 0, True)).alias("tiles"),
        F.sum("pairs").alias("pairs_compared"))
    out = out.withColumn("pairs_all", F.expr("rows * (rows - 1) div 2"))
    return out.withColumn("skipped_share", F.when(F.col("pairs_all") > 0, 1 - F.col("pairs_compared") / F.col("pairs_all"))
                                            .otherwise(F.lit(0.0)))


def _own_nearest(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rows of one block with ``near`` lowered to the nearest other row of the block."""
    own = _nn_fn()(pdf.assign(blk=0, bi=0, bj=0))
    best = pdf["id"].map(own.groupby("id")["nn_dist"].min()).fillna(np.inf)
    return pdf.assign(near=np.minimum(pdf["near"], best))


def nearest_distance(df: DataFrame, id_col: str, vec_col: str,
                     blocks: int | None = None, block_rows: int | None = None,
                     group_col: str | None = None) -> DataFrame:
    """Distance from each row to its closest other row (in its group): (id, nn_dist).

    Over a whole table in two rounds: the first gives each row the distance to the
    nearest pivot or row of its own block, the second visits only the blocks that
    may hold a nearer one."""
    schema = "id long, nn_dist double"
    if group_col:
        rep = _replicate(df, id_col, vec_col, 1, group_col, rows_of_block(df, vec_col, block_rows))
        part = rep.groupBy(GROUP, "bi", "bj").applyInPandas(_nn_fn(), schema)
        return part.groupBy("id").agg(F.min("nn_dist").alias("nn_dist"))
    from quire.session import cut_lineage
    rows = vectors(df, id_col, vec_col)
    cells = _cells_of(rows, blocks, block_rows)
    if cells is None:
        return df.sparkSession.createDataFrame([], schema)
    placed = in_blocks(rows, cells)
    placed = cut_lineage(placed.groupBy("blk").applyInPandas(_own_nearest, placed.schema))
    reach = {r["cell"]: r["m"] for r in placed.groupBy("cell").agg(F.max("near").alias("m")).collect()}
    rep = replicated(placed, cells.reaching(reach), "near").filter(F.col("bi") != F.col("bj"))
    part = rep.groupBy("bi", "bj").applyInPandas(_nn_fn(), schema)
    known = placed.filter(F.col("near") < float("inf")).select("id", F.col("near").alias("nn_dist"))
    return known.unionByName(part).groupBy("id").agg(F.min("nn_dist").alias("nn_dist"))


def cosine_topk(df: DataFrame, id_col: str, vec_col: str, k: int, threshold: float | None = None,
                blocks: int | None = None, block_rows: int | None = None,
                include_self: bool = False, clamp: float | None = None,
                group_col: str | None = None) -> DataFrame:
    """For every row its k most cosine-similar other rows: (a, b, sim, rank).

    Each task keeps at most k candidates per row, so per row at most k * B
    candidates are shuffled before the final ``row_number() <= k`` (ties by id).
    """
    from pyspark.sql import Window
    block_rows = rows_of_block(df, vec_col, block_rows)
    b = 1 if group_col else _blocks_for(df, blocks, block_rows)
    rep = _replicate(df, id_col, vec_col, b, group_col, block_rows)
    cand = rep.groupBy(GROUP, "bi", "bj").applyInPandas(_topk_fn(int(k), threshold, include_self, clamp),
                                                 "a long, b long, sim double")
    w = Window.partitionBy("a").orderBy(F.desc("sim"), F.asc("b"))
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _units(rows: DataFrame) -> DataFrame:
    """(id, v, zero): vectors of length one; a vector of length zero stays as it is."""
    def run(batches):
        for pdf in batches:
            if len(pdf):
                v = np.stack(pdf["v"].to_numpy()).astype(np.float64)
                norm = np.linalg.norm(v, axis=1)
                unit = v / np.where(norm == 0, 1, norm)[:, None]
                yield pd.DataFrame({"id": pdf["id"], "v": list(unit), "zero": norm == 0})
    return rows.mapInPandas(run, "id long, v array<double>, zero boolean")


def _sides(pdf: pd.DataFrame):
    """Ids and vectors of a tile's left rows and right rows; None if one has none."""
    parts = [pdf[pdf["is_left"]], pdf[~pdf["is_left"]]]
    if not all(len(p) for p in parts):
        return None
    return [(p["id"].to_numpy(np.int64), np.stack(p["v"].to_numpy()).astype(np.float64)) for p in parts]


def _similarities(a, av, b, bv, include_self: bool):
    """Row chunks of a tile: (place of the first row, similarities)."""
    step = max(1, CHUNK * WIDE // max(len(b), 1))
    for s in range(0, len(a), step):
        sims = av[s:s + step] @ bv.T
        same = None if include_self else _same(a[s:s + step], b)
        if same is not None:
            sims[same] = -np.inf
        yield s, sims


def _reach_fn(k: int, threshold: float | None, include_self: bool, clamp: float | None):
    """Left rows of a first-round tile with ``reach``: no row farther away than that
    can be among the k best, for k rows of this tile are as near."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left = pdf[pdf["is_left"]]
        worth = np.full(len(left), -1.0 if threshold is None else max(threshold, -1.0))
        both = _sides(pdf)
        if both and both[1][1].shape[0] >= k:
            (a, av), (b, bv) = both
            for s, sims in _similarities(a, av, b, bv, include_self):
                kth = -np.partition(-sims, k - 1, axis=1)[:, k - 1]
                worth[s:s + len(kth)] = np.maximum(worth[s:s + len(kth)], kth)
        reach = np.sqrt(np.maximum(2.0 - 2.0 * worth, 0.0))
        if clamp is not None:
            # at or below the clamp all similarities are 0 and ids decide
            reach[worth <= max(clamp, 0.0)] = np.inf
        return pd.DataFrame({"id": left["id"], "v": left["v"], "blk": left["blk"], "cell": left["cell"], "reach": reach})
    return run


def _topk_tiles(left: DataFrame, right: DataFrame, k: int, threshold: float | None, block_rows: int,
                include_self: bool, clamp: float | None) -> DataFrame | None:
    """(bi, bj, id, v, is_left): units with a length, dealt into tiles of a left and a
    right block. The first round compares a left block with one right block of its
    cell, the second sends rows only where the k-th similarity found can be beaten."""
    from quire.session import cut_lineage
    pivots, shared = _pivots_for(right, None, block_rows)
    chosen = choose_pivots(right, pivots)
    if chosen is None:
        return None
    theirs, mine = (measured(x, *chosen, block_rows, shared) for x in (right, left))
    l_rows, r_rows = in_blocks(left, mine), in_blocks(right, theirs)
    # a left block meets one right block of its (first) cell; which one goes by its number
    meets: dict[int, int] = {}
    for p, m, q, n in zip(mine.first, mine.blocks, theirs.first, theirs.blocks):
        for i in range(m if n else 0):
            meets.setdefault(int(p + i), int(q + i % n))
    spark = left.sparkSession
    pairs = spark.createDataFrame(list(meets.items()), "bi long, bj long")
    first = (l_rows.select(F.col("blk").alias("bi"), "id", "v", "cell", F.lit(True).alias("is_left"))
             .unionByName(r_rows.join(pairs, r_rows["blk"] == pairs["bj"])
                          .select("bi", "id", "v", "cell", F.lit(False).alias("is_left"))))
    first = first.withColumn("blk", F.col("bi"))
    found = cut_lineage(first.groupBy("bi").applyInPandas(
        _reach_fn(k, threshold, include_self, clamp), "id long, v array<double>, blk long, cell int, reach double"))
    reach = {r["cell"]: r["m"] for r in found.groupBy("cell").agg(F.max("reach").alias("m")).collect()}
    mine, theirs = mine.reaching(reach), theirs.reaching({})
    return (sent(found, theirs, "reach").select(F.col("blk").alias("bi"), F.col("other").alias("bj"), "id", "v",
                                                F.lit(True).alias("is_left"))
            .unionByName(sent(r_rows, mine).select(F.col("other").alias("bi"), F.col("blk").alias("bj"), "id", "v",
                                                   F.lit(False).alias("is_left"))))


def cosine_topk_between(left: DataFrame, right: DataFrame, id_col: str, vec_col: str, k: int,
                        threshold: float | None = None, block_rows: int | None = None,
                        include_self: bool = False, clamp: float | None = None) -> DataFrame:
    """``cosine_topk`` of the rows of ``left`` only, among those of ``right`` (unique ids):
    (a, b, sim, rank). Both sides fall into cells around pivots of the right side. A
    first round with one block each gives every left row a k-th similarity; in the
    second it visits only blocks that can beat it, and a right row goes only to left
    blocks that may want it. A vector of length zero has similarity 0 with all:
    the k + 1 smallest ids on the right are then all that can count."""
    from pyspark.sql import Window

    schema = "a long, b long, sim double"
    block_rows = block_rows or rows_of_block(right, vec_col) // 2      # units are doubles, on both sides
    l_all, r_all = (_units(vectors(x, id_col, vec_col)) for x in (left, right))
    l_rows, r_rows = (x.filter(~F.col("zero")).select("id", "v") for x in (l_all, r_all))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        both = _sides(pdf)
        if not both:
            return _topk_frame([])
        (a, av), (b, bv) = both
        return _topk_frame([_topk_rows(a, av, b, bv, k, threshold, include_self, clamp)])

    def with_zero(rows: DataFrame, others: DataFrame) -> DataFrame:
        ids = [r["id"] for r in others.select("id").orderBy("id").limit(k + 1).collect()]
        out = rows.select(F.col("id").alias("a"), F.explode(F.array(*map(F.lit, ids)).cast("array<long>")).alias("b"),
                          F.lit(0.0).alias("sim"))
        return out if include_self else out.filter(F.col("a") != F.col("b"))

    tiles = _topk_tiles(l_rows, r_rows, k, threshold, block_rows, include_self, clamp)
    cand = (tiles.groupBy("bi", "bj").applyInPandas(run, schema) if tiles is not None
            else left.sparkSession.createDataFrame([], schema))
    if threshold is None or threshold < 0:
        cand = cand.unionByName(with_zero(l_rows, r_all.filter("zero"))).unionByName(with_zero(l_all.filter("zero"), r_all))
    w = Window.partitionBy("a").orderBy(F.desc("sim"), F.asc("b"))
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def topk_pair_work(left: DataFrame, right: DataFrame, id_col: str, vec_col: str, k: int,
                   threshold: float | None = None, block_rows: int | None = None,
                   include_self: bool = False, clamp: float | None = None) -> DataFrame:
    """What pruning leaves of the second round of ``cosine_topk_between``, in one row:
    (tiles, pairs_compared). No row on one side gives zeros."""
    block_rows = block_rows or rows_of_block(right, vec_col) // 2
    l_rows, r_rows = (_units(vectors(x, id_col, vec_col)).filter(~F.col("zero")).select("id", "v")
                      for x in (left, right))
    tiles = _topk_tiles(l_rows, r_rows, k, threshold, block_rows, include_self, clamp)
    if tiles is None:
        return left.sparkSession.createDataFrame([(0, 0)], "tiles long, pairs_compared long")
    n_left, n = F.count(F.when(F.col("is_left"), True)), F.count(F.lit(1))
    per = tiles.groupBy("bi", "bj").agg((n_left * (n - n_left)).alias("pairs"))
    return per.agg(F.count(F.when(F.col("pairs") > 0, True)).alias("tiles"),
                   F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs_compared"))
