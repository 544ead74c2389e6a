"""Pivot cells: exact pruning for the blocked pair jobs.

A few rows of a bounded sample, chosen far apart, are pivots; every row belongs
to the cell of its nearest pivot, and a cell knows its radius. A cell is cut by
a hash of the id into blocks of about ``block_rows`` rows, so a cell that holds
a third of all rows is no hot spot; small cells next to one another share a block,
so that there are no more blocks, and copies of a row, than rows ask for. A row x
that looks for rows within ``reach`` of it is sent to the blocks of cell q only if

    d(x, pivot of q) <= radius of q + max(reach of x, greatest reach in q)

By the triangle inequality every other row of q is out of reach of x, and x out
of reach of it, so no pair is lost. On data without structure nothing is
pruned and every row goes to every block, as without pivots.

Pivots decide only how much is skipped, never which pairs are found. At most
``MAX_PIVOTS`` pivots of together ``PIVOT_VALUES`` components, and four sampled
rows for each, come to the driver; one row for each cell follows (radius,
count, reach). Rows without a vector, or with a null, NaN or infinite
component, are in no pair."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PIVOTS = 1024
PIVOT_VALUES = 1 << 20
SAMPLED = 4
# Distances come from a Gram form, whose rounding grows with the norms.
SLACK = 4e-6


def vector(df: DataFrame, vec_col: str) -> Column:
    """A vector column as it travels: floats stay floats (tasks widen them), all else becomes doubles."""
    v = F.col(vec_col)
    return v if df.select(v).schema[0].dataType.simpleString() == "array<float>" else v.cast("array<double>")


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the rows that can be in a pair."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), vector(df, vec_col).alias("v")).filter(F.size("v") > 0)
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return rows.filter(finite)


def _type(rows: DataFrame) -> str:
    return rows.schema["v"].dataType.simpleString()


def _far_apart(points: np.ndarray, k: int) -> np.ndarray:
    """Places of up to ``k`` points, each the farthest from those before it."""
    chosen = [0]
    near = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < k:
        best = int(near.argmax())
        if near[best] <= 0:
            break
        chosen.append(best)
        near = np.minimum(near, ((points - points[best]) ** 2).sum(axis=1))
    return np.array(chosen)


def distances(v: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row by pivot distances, and the slack that their rounding needs."""
    vn, cn = (v * v).sum(axis=1), (centers * centers).sum(axis=1)
    d2 = vn[:, None] + cn[None, :] - 2.0 * v @ centers.T
    return np.sqrt(np.maximum(d2, 0)), SLACK * (np.sqrt(vn)[:, None] + np.sqrt(cn)[None, :])


@dataclass(frozen=True)
class Cells:
    """Pivots with what is known of their cells, small enough for a task's closure."""
    ids: np.ndarray
    centers: np.ndarray
    radius: np.ndarray          # -1 for a cell without rows
    first: np.ndarray           # number of the cell's first block
    blocks: np.ndarray          # blocks that the cell is cut into
    reach: np.ndarray           # greatest reach of a row of the cell

    def reaching(self, reach: dict[int, float]) -> Cells:
        return replace(self, reach=np.array([reach.get(i, -np.inf) for i in range(len(self.ids))]))


def choose_pivots(rows: DataFrame, pivots: int) -> tuple[np.ndarray, np.ndarray] | None:
    """(ids, vectors) of up to ``pivots`` rows far apart; None for an empty table."""
    first = rows.select(F.size("v").alias("n")).first()
    if first is None:
        return None
    pivots = max(1, min(pivots, MAX_PIVOTS, PIVOT_VALUES // first["n"]))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLED * pivots).toPandas()
    points = np.stack(sample["v"].to_numpy()).astype(np.float64)
    at = _far_apart(points, pivots)
    return sample["id"].to_numpy(np.int64)[at], points[at]


def make_cells(rows: DataFrame, pivots: int, block_rows: int, shared: int = 0) -> Cells | None:
    """Cells of ``vectors`` rows; None for an empty table."""
    chosen = choose_pivots(rows, pivots)
    return measured(rows, *chosen, block_rows, shared) if chosen else None


def _chain(points: np.ndarray) -> list[int]:
    """All places, each followed by the nearest that is left."""
    left, at, out = np.ones(len(points), bool), 0, []
    while True:
        out.append(at)
        left[at] = False
        if not left.any():
            return out
        at = int(np.where(left, ((points - points[at]) ** 2).sum(axis=1), np.inf).argmin())


def _block_numbers(centers: np.ndarray, n: np.ndarray, block_rows: int, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """(first block, blocks) of cells of ``n`` rows: cells that have fewer than ``shared`` rows
    together, one next to the other, fall into one block."""
    first, blocks = np.zeros(len(n), np.int64), -(-n // max(block_rows, 1))
    at, held = 0, 0                     # the number of the next block, rows of the open one before it
    for c in _chain(centers):
        if not n[c]:
            continue
        if held and held + n[c] <= shared:
            first[c], held = at - 1, held + n[c]
        else:
            first[c], held = at, n[c]
            at += blocks[c]
            held = held if blocks[c] == 1 else 0
    return first, blocks


def measured(rows: DataFrame, ids: np.ndarray, centers: np.ndarray, block_rows: int, shared: int = 0) -> Cells:
    """The cells that ``rows`` form around given pivots; cells of together up to ``shared`` rows share a block."""
    def nearest(batches):
        for pdf in batches:
            if len(pdf):
                d, room = distances(np.stack(pdf["v"].to_numpy()).astype(np.float64), centers)
                cell = d.argmin(axis=1)
                mine = np.arange(len(d)), cell
                yield pd.DataFrame({"cell": cell, "d": d[mine] + room[mine]})

    found = (rows.select("v").mapInPandas(nearest, "cell int, d double")
                 .groupBy("cell").agg(F.max("d").alias("r"), F.count(F.lit(1)).alias("n")).collect())
    radius, n = np.full(len(ids), -1.0), np.zeros(len(ids), np.int64)
    for r in found:
        radius[r["cell"]], n[r["cell"]] = r["r"], r["n"]
    first, blocks = _block_numbers(centers, n, block_rows, min(shared, block_rows))
    return Cells(ids, centers, radius, first, blocks, np.full(len(ids), np.inf))


def in_blocks(rows: DataFrame, cells: Cells) -> DataFrame:
    """(id, v, cell, blk, near): each row's cell and block, and the exact distance
    to the nearest pivot that is another row (infinite if there is none)."""
    def run(batches):
        first = cells.first
        for pdf in batches:
            if not len(pdf):
                continue
            v = np.stack(pdf["v"].to_numpy()).astype(np.float64)
            d, _ = distances(v, cells.centers)
            cell = d.argmin(axis=1)
            sub = pdf["h"].to_numpy() % cells.blocks[cell]
            d[pdf["id"].to_numpy()[:, None] == cells.ids[None, :]] = np.inf
            other = d.argmin(axis=1)
            near = np.sqrt(((v - cells.centers[other]) ** 2).sum(axis=1))
            near[~np.isfinite(d[np.arange(len(v)), other])] = np.inf
            yield pd.DataFrame({"id": pdf["id"], "v": pdf["v"], "cell": cell, "blk": first[cell] + sub, "near": near})

    hashed = rows.select("id", "v", F.xxhash64("id").alias("h"))
    return hashed.mapInPandas(run, f"id long, v {_type(rows)}, cell int, blk long, near double")


def sent(placed: DataFrame, theirs: Cells, reach_col: str | None = None) -> DataFrame:
    """(blk, other, id, v): placed rows, one copy for each block of ``theirs`` that may
    hold a row within the reach of either. Without ``reach_col`` only the reach of
    their cells counts. Only block numbers are made in Python; the copies are made
    by an explode."""
    def run(batches):
        inside = theirs.radius >= 0
        spans = [np.arange(a, a + n) for a, n in zip(theirs.first, theirs.blocks)]
        none = np.empty(0, np.int64)
        for pdf in batches:
            if not len(pdf):
                continue
            v = np.stack(pdf["v"].to_numpy()).astype(np.float64)
            d, room = distances(v, theirs.centers)
            reach = pdf["reach"].to_numpy(np.float64)[:, None] if reach_col else -np.inf
            ok = inside[None, :] & (d <= theirs.radius[None, :] + np.maximum(reach, theirs.reach[None, :]) + room)
            others = [np.unique(np.concatenate([none] + [spans[q] for q in np.flatnonzero(row)])) for row in ok]
            yield pd.DataFrame({"id": pdf["id"], "v": pdf["v"], "blk": pdf["blk"], "others": others})

    cols = ["id", "v", "blk"] + ([F.col(reach_col).alias("reach")] if reach_col else [])
    out = placed.select(*cols).mapInPandas(run, f"id long, v {_type(placed)}, blk long, others array<long>")
    return out.select("blk", F.explode("others").alias("other"), "id", "v")


def replicated(placed: DataFrame, cells: Cells, reach_col: str | None = None) -> DataFrame:
    """Placed rows -> (bi, bj, blk, id, v), one copy for each pair of the row's own
    block with a block of the same table in reach."""
    rep = sent(placed, cells, reach_col)
    return rep.select(F.least("blk", "other").alias("bi"), F.greatest("blk", "other").alias("bj"), "blk", "id", "v")
