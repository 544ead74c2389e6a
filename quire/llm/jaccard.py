"""N-gram Jaccard join by a count-vector R-tree.

A document is the set of its distinct shingles of N words. Two documents link when
100 * |A and B| >= PERCENT * |A or B|. Shingles are hashed into groups, and a
document is the point of its group counts: the overlap of two documents is at
most the sum of the smaller count of every group, which bounds whole boxes of
points as well as pairs. Surviving pairs are verified on the shingle sets.

One tree over all documents would not prune: in so many dimensions the boxes of
unrelated texts overlap, and its self-join is quadratic. So the tree has three
levels, each a Spark stage:

1. Cells. Equal sets fall together first; one class stands for all its copies.
   Classes are cut by size into bands, and in a band of largest difference D the
   shingles are dealt into more than D fine groups. Two linking sets differ in D
   groups at most, so some filled group has equal content in both: the classes
   are keyed by the content of filled groups and meet in that cell. Of the groups
   with equal content the first in any fixed order comes after at most D others, so
   D + 1 groups are enough; those with the most shingles are taken, as unrelated
   texts seldom share several shingles and nothing else of a group. (Cells
   are complete as a set has more filled groups than D; where chance could leave
   fewer, in small bands, several independent dealings are used, so that a miss
   is as unlikely as a clash of two 64-bit hashes.)
2. Boxes. In a cell, points (``dims`` coarse group counts: 64 will do for 90
   percent, lower thresholds need more to tell long texts apart) are packed by size into
   boxes; box pairs, then point pairs, survive only if sizes and summed minima
   allow a link. What survives joins the cell's classes into candidate groups.
   A cell over CELL classes is not pruned but taken whole, as one group.
3. Tiles. Candidate groups are dealt into tiles by size and hash; tile pairs that
   can link meet in one task, which counts exact intersections. A group of any
   size, also a third of all rows, is so spread over many tasks; each sends on
   only a spanning forest of its links. Components follow by star contraction.

Defined results: null, empty and word-less texts have the empty set and link
with nothing; with fewer words than a shingle the whole sequence is the one shingle. Copies
are one class. A null id is the smallest id, and a component that has one shows
as null. Rows with the same doc_id are taken row by row, a row's own text
deciding; (id, fp), fp a hash of the text, names a row, and the smallest one of
a component names the row that stays of it. Other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import NULL_ID, U64, Words, fresh, groups, id_columns, mix, ngrams, small, with_id
from quire.operators.components import connected_components
from quire.session import cut_lineage

PERCENT = 90
N = 3
DIMS = 64
BOX = 32
CELL = 2048
TILE_DOCS = 2048
TILE_SHINGLES = 1 << 21


class Bands:
    """Size bands of a threshold, and how shingles are dealt to fine groups in each."""

    def __init__(self, percent: int):
        self.percent = percent
        #: Below this size only equal sets link.
        self.least = -(-percent // (100 - percent)) if percent < 100 else 1 << 62
        self.edges = [self.least]
        self.dealt: dict[int, tuple[int, int]] = {}

    def edge(self, k: int) -> int:
        while len(self.edges) <= k:
            self.edges.append(max(self.edges[-1] + 1, self.edges[-1] * 3 // 2))
        return self.edges[k]

    def of(self, n: int) -> list[int]:
        """The bands in which a set of n meets all partners that are at least as large, and smaller ones."""
        k = 0
        while self.edge(k + 1) <= n:
            k += 1
        out = [k]
        while self.edge(out[-1] + 1) * self.percent <= 100 * n:
            out.append(out[-1] + 1)
        return out

    def differ(self, k: int, n: int) -> int:
        """In how many shingles a set of n and a partner that it meets in band k differ at most."""
        p, top = self.percent, self.edge(k + 1) - 1
        return (100 - p) * (n + min(top, 100 * n // p)) // (100 + p)

    def dealing(self, k: int) -> tuple[int, int]:
        """(fine groups, independent dealings) of band k: the fewest keys with which some
        set has too few filled groups in every dealing with a chance below e**-32."""
        if k not in self.dealt:
            p, top = self.percent, self.edge(k + 1) - 1
            d = (100 - p) * 2 * top // (100 + p)
            low = max(self.least, -(-self.edge(k) * p // 100))
            found = []
            for m in range(d + 2, 3 * d + 8):
                worst = -math.inf
                for n in {low, (low + top) // 2, top}:
                    own = self.differ(k, n)  # groups that a partner can change
                    if own >= 1:
                        worst = max(worst, math.lgamma(m + 1) - math.lgamma(own + 1) - math.lgamma(m - own + 1) + n * math.log(own / m))
                dealings = 1 if worst == -math.inf else math.ceil(32 / -worst) if worst < -1 else 99
                found.append((m * dealings, m, dealings))
            self.dealt[k] = min(found)[1:]
        return self.dealt[k]


def shingle_sets(texts: list[bytes], n: int = N) -> list[np.ndarray]:
    """Sorted distinct hashes of the n-word shingles of each text."""
    w = Words([t.lower() for t in texts])
    grams, out = ngrams(w.hash, n), []
    for lo, hi in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if hi - lo >= n:
            out.append(np.unique(grams[lo:hi - n + 1]))
        else:
            out.append(ngrams(w.hash[lo:hi], hi - lo) if hi > lo else np.empty(0, U64))
    return out


def signature(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def cell_keys(s: np.ndarray, bands: Bands) -> np.ndarray:
    """The keys of the cells in which a set is sure to meet its partners: of its filled groups those
    with the most shingles, one more than a partner can change."""
    if len(s) < bands.least:
        return np.empty(0, U64)
    out = []
    for k in bands.of(len(s)):
        m, dealings = bands.dealing(k)
        most = bands.differ(k, len(s)) + 1
        for seed in range(dealings):
            x = mix(s + U64(0x632BE59BD9B4E019 * (seed + 1) % (1 << 64)))
            group = (x >> U64(32)).astype(np.int64) % m
            content = np.zeros(m, U64)
            np.add.at(content, group, mix(x))
            count = np.bincount(group, minlength=m)
            name = mix(np.arange(m).astype(U64) + U64((k << 40) + (seed << 32)))
            key = mix(content ^ name)
            order = np.lexsort((key, -count))[:most]  # the same order in every set: equal cells have equal counts
            out.append(key[order[count[order] > 0]])
    return np.concatenate(out)


def _points(words: int, dims: int):
    """(id, fp, n, sig, point): the point as ``dims`` (a power of 2) counts of two bytes, or four in very large sets."""
    shift = U64(64 - dims.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in groups(batch.column("text"), 1 << 19):
                sets = shingle_sets(texts, words)
                points = [np.bincount((s >> shift).astype(np.int64), minlength=dims) for s in sets]
                k = len(sets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(at, k), batch.column("fp").slice(at, k), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([signature(s) for s in sets], pa.int64()),
                     pa.array([p.astype("<u4" if len(s) > 60_000 else "<u2").tobytes() for p, s in zip(points, sets)], pa.binary())],
                    ["id", "fp", "n", "sig", "point"])
    return run


def _cells(percent: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(percent), set()
        for batch in batches:
            for _, texts in groups(batch.column("text"), 1 << 19):
                keys, sigs = [], []
                for s in shingle_sets(texts, words):
                    sig = signature(s)
                    if sig in seen:
                        continue
                    if len(seen) < 200_000:  # copies met in this task need no second set of keys
                        seen.add(sig)
                    keys.append(cell_keys(s, bands))
                    sigs.append(np.full(len(keys[-1]), sig))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(sigs).astype(np.int64))], ["key", "sig"])
    return run


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (key, sig) in order: the members of each cell of several classes, under a
    name made of the members, so that cells with the same members become one.
    Cells over CELL classes come as pairs with their first class."""
    rest_k, rest_s = np.empty(0, np.int64), np.empty(0, np.int64)
    large: tuple[int, int] | None = None  # the key and first class of a large cell that is being read

    def cut(key: np.ndarray, sig: np.ndarray, final: bool):
        nonlocal rest_k, rest_s, large
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])))
        key, sig = key[new], sig[new]
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        end = np.append(start[1:], len(key))
        cells, sigs, heads = [], [], []
        keep = len(key)
        for k in np.flatnonzero((end - start > 1) | (end == len(key)) | (start == 0)).tolist():
            a, b = int(start[k]), int(end[k])
            if large is not None and large[0] == key[a]:
                cells.append(np.zeros(b - a, np.int64))
                sigs.append(sig[a:b])
                heads.append(np.full(b - a, large[1]))
                continue
            if b == len(key) and not final:
                if b - a <= CELL:
                    keep = a
                    continue
            if b - a > CELL:
                large = (int(key[a]), int(sig[a]))
                cells.append(np.zeros(b - a, np.int64))
                heads.append(np.full(b - a, sig[a]))
                sigs.append(sig[a:b])
            elif b - a > 1:
                cells.append(np.full(b - a, xxhash.xxh3_64_intdigest(sig[a:b].tobytes()) - (1 << 63)))
                heads.append(np.zeros(b - a, np.int64))
                sigs.append(sig[a:b])
        rest_k, rest_s = key[keep:], sig[keep:]
        if cells:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (cells, sigs, heads)], ["cell", "sig", "head"])
        return None

    for batch in batches:
        if batch.num_rows:
            out = cut(np.concatenate((rest_k, batch.column("key").to_numpy())), np.concatenate((rest_s, batch.column("sig").to_numpy())), False)
            if out is not None:
                yield out
    if len(rest_k):
        out = cut(rest_k, rest_s, True)
        if out is not None:
            yield out


class Forest:
    """Union-find over 0..k-1."""

    def __init__(self, k: int):
        self.up = list(range(k))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def box_join(n: np.ndarray, points: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of points that the bounds let through."""
    order = np.lexsort((*points.T[:2], n))
    n, points = n[order], points[order]
    cuts = list(range(0, len(n), BOX))
    boxes = [(c, min(c + BOX, len(n))) for c in cuts]
    top = np.array([points[a:b].max(0) for a, b in boxes])
    least, most = n[cuts], np.array([n[b - 1] for _, b in boxes])
    forest, out = Forest(len(n)), []
    for i, (a, b) in enumerate(boxes):
        for j in range(i, len(boxes)):
            if 100 * most[i] < percent * least[j]:
                break  # boxes are in order of size
            if (100 + percent) * np.minimum(top[i], top[j]).sum() < percent * (least[i] + least[j]):
                continue
            c, d = boxes[j]
            shared = np.minimum(points[a:b, None, :], points[None, c:d, :]).sum(-1, dtype=np.int64)
            ok = ((100 + percent) * shared >= percent * (n[a:b, None] + n[None, c:d])) & (100 * n[a:b, None] >= percent * n[None, c:d])
            for x, y in np.argwhere(ok).tolist():
                if a + x < c + y and forest.join(a + x, c + y):
                    out.append((int(order[a + x]), int(order[c + y])))
    return out


def _runs(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.RecordBatch]:
    """The batches of sorted rows, cut so that each holds whole groups of ``by``."""
    held: list[pa.RecordBatch] = []

    def key(batch, i):
        return tuple(batch.column(c)[i].as_py() for c in by)

    for batch in batches:
        if not batch.num_rows:
            continue
        last = key(batch, batch.num_rows - 1)
        lo = batch.num_rows - 1
        while lo > 0 and key(batch, lo - 1) == last:
            lo -= 1
        if held and (lo > 0 or key(held[-1], held[-1].num_rows - 1) != last):
            held.append(batch.slice(0, lo))
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
        elif not held and lo > 0:
            yield batch.slice(0, lo)
        held.append(batch.slice(lo))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _edges_of(percent: int, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _runs(batches, ["cell"]):
            cell, sig, n = (batch.column(c).to_numpy() for c in ("cell", "sig", "n"))
            point = batch.column("point").to_pylist()
            start = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
            a, b = [], []
            for lo, hi in zip(start.tolist(), [*start[1:].tolist(), len(cell)]):
                points = np.array([np.frombuffer(p, "<u2" if len(p) == 2 * dims else "<u4") for p in point[lo:hi]], np.int32)
                for x, y in box_join(n[lo:hi], points, percent):
                    a.append(sig[lo + x])
                    b.append(sig[lo + y])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def tile_links(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within ``left`` (right None), or between left and
    right; right's numbers follow left's. Intersections are counted by products of
    0/1 matrices over the shingles that several sets have."""
    sets = left + (right or [])
    k, size = len(sets), np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    own = np.repeat(np.arange(k), size)
    order = np.argsort(values, kind="stable")
    values, own = values[order], own[order]
    new = np.concatenate(([True], values[1:] != values[:-1]))
    column = np.cumsum(new) - 1
    common = np.bincount(column) > 1
    number = np.cumsum(common) - 1
    keep = common[column]
    column, own = number[column[keep]], own[keep]
    split = len(left) if right is not None else k
    rows = slice(split, k) if right is not None else slice(0, k)
    shared = np.zeros((split, rows.stop - rows.start), np.float32)
    wide = max(256, (1 << 23) // k)
    total = int(common.sum())
    edge = np.searchsorted(column, np.arange(0, total + wide, wide))
    for step, (lo, hi) in enumerate(zip(edge[:-1], edge[1:])):
        m = np.zeros((k, min(wide, total - step * wide)), np.float32)
        m[own[lo:hi], column[lo:hi] - step * wide] = 1
        shared += m[:split] @ m[rows].T
    linked = (100 + percent) * shared >= percent * (size[:split, None] + size[None, rows]).astype(np.float64)
    forest, out = Forest(k), []
    for x, y in np.argwhere(linked).tolist():
        y += rows.start
        if x != y and forest.join(x, y):
            out.append((x, y))
    return out


def _links_of(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _runs(batches, ["comp", "pair"]):
            comp, pair, sig = (batch.column(c).to_numpy() for c in ("comp", "pair", "sig"))
            side = batch.column("side").to_numpy(zero_copy_only=False)
            data = batch.column("shingles").to_pylist()
            start = np.flatnonzero(np.concatenate(([True], (comp[1:] != comp[:-1]) | (pair[1:] != pair[:-1]))))
            a, b = [], []
            for lo, hi in zip(start.tolist(), [*start[1:].tolist(), len(comp)]):
                at = [*(i for i in range(lo, hi) if not side[i]), *(i for i in range(lo, hi) if side[i])]
                split = sum(not side[i] for i in at)
                sets = [np.frombuffer(data[i], U64) for i in at]
                one_tile = split == len(sets)
                if len(sets) < 2 or not split:
                    continue
                for x, y in tile_links(sets[:split], None if one_tile else sets[split:], percent):
                    a.append(sig[at[x]])
                    b.append(sig[at[y]])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for _, texts in groups(batch.column("text"), 1 << 19):
                sets = {sig: s for sig, s in ((signature(s), s) for s in shingle_sets(texts, words)) if sig not in seen}
                if len(seen) < 200_000:  # rows repeated under one id and text
                    seen.update(sets)
                yield pa.RecordBatch.from_arrays([pa.array(list(sets), pa.int64()), pa.array([s.tobytes() for s in sets.values()], pa.binary())], ["sig", "shingles"])
    return run


def _tiles(classes: DataFrame, percent: int, shingles: int = TILE_SHINGLES) -> DataFrame:
    """(comp, pair, side, sig): every class of a candidate group in all tile pairs it takes
    part in. A tile is (size bin, number); sizes that can link are in the same or in
    neighbouring bins. Tiles are numbered within a group; a pair names two of them."""
    ratio = math.log(100 / percent) if percent < 100 else 1.0
    size_bin = F.floor(F.log(F.col("n").cast("double")) / F.lit(ratio)).cast("int")
    binned = classes.withColumn("bin", size_bin)
    top = F.exp((F.col("bin") + 1) * F.lit(ratio))
    room = F.greatest(F.lit(1), F.least(F.lit(TILE_DOCS), F.floor(F.lit(shingles) / top)))
    counts = binned.groupBy("comp", "bin").agg(F.count("*").alias("size")).withColumn("tiles", F.ceil(F.col("size") / room).cast("int"))
    next_ = counts.select("comp", (F.col("bin") - 1).alias("bin"), F.col("tiles").alias("above"))
    before = counts.select("comp", (F.col("bin") + 1).alias("bin"), F.col("tiles").alias("below"))
    plan = (counts.drop("size").join(next_, ["comp", "bin"], "left").join(before, ["comp", "bin"], "left")
            .fillna(0, ["above", "below"]))
    placed = binned.join(plan, ["comp", "bin"]).withColumn("tile", F.pmod(F.xxhash64("sig"), F.col("tiles")).cast("int"))
    visit = lambda lo_bin, lo, hi_bin, hi, side: F.struct(
        F.xxhash64(lo_bin, lo, hi_bin, hi).alias("pair"), side.alias("side"))
    own = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda x: visit(
        F.col("bin"), F.least(x, F.col("tile")), F.col("bin"), F.greatest(x, F.col("tile")), x < F.col("tile")))
    none = F.array().cast("array<struct<pair:bigint,side:boolean>>")
    up = F.when(F.col("above") > 0, F.transform(F.sequence(F.lit(0), F.col("above") - 1), lambda x: visit(
        F.col("bin"), F.col("tile"), F.col("bin") + 1, x, F.lit(False)))).otherwise(none)
    down = F.when(F.col("below") > 0, F.transform(F.sequence(F.lit(0), F.col("below") - 1), lambda x: visit(
        F.col("bin") - 1, x, F.col("bin"), F.col("tile"), F.lit(True)))).otherwise(none)
    seen = placed.select("comp", "sig", F.explode(F.concat(own, up, down)).alias("v"))
    return seen.select("comp", "v.pair", "v.side", "sig")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, n: int = N,
                       dims: int = DIMS, tile: int = TILE_SHINGLES) -> DataFrame:
    """(id, fp, n_shingles, component, component_fp): one row for each row of ``docs``; component is the
    smallest id reachable by links (NULL_ID stands for a null id), with component_fp the smallest (id, fp)."""
    rows = with_id(docs, id_col, text_col)
    points = cut_lineage(rows.mapInArrow(_points(n, dims), "id long, fp long, n long, sig long, point binary"))
    filled = points.filter("n > 0")
    classes = filled.groupBy("sig").agg(F.min(F.struct("id", "fp")).alias("rep"), F.first("n").alias("n"), F.first("point").alias("point"))

    keys = rows.select("text").mapInArrow(_cells(percent, n), "key long, sig long")
    cells = keys.repartition("key").sortWithinPartitions("key", "sig").mapInArrow(_members, "cell long, sig long, head long")
    cells = cut_lineage(cells.dropDuplicates())
    stars = cells.filter("cell = 0 and head <> 0").select(F.col("head").alias("a"), F.col("sig").alias("b"))
    inside = cells.filter("not (cell = 0 and head <> 0)").select("cell", "sig").join(classes.drop("rep"), "sig")
    pruned = inside.repartition("cell").sortWithinPartitions("cell").mapInArrow(_edges_of(percent, dims), "a long, b long")
    candidates = connected_components(pruned.unionByName(stars))

    grouped = cut_lineage(candidates.withColumnsRenamed({"node": "sig", "root": "comp"}).join(classes.drop("point"), "sig"))
    texts = rows.join(small(grouped.select("rep.id", "rep.fp").distinct()), ["id", "fp"], "left_semi")
    sets = texts.select("text").mapInArrow(_sets(n), "sig long, shingles binary")
    tiles = _tiles(grouped, percent, tile).join(sets, "sig")
    links = (tiles.repartition("comp", "pair").sortWithinPartitions("comp", "pair")
             .select("comp", "pair", "side", "sig", "shingles").mapInArrow(_links_of(percent), "a long, b long"))
    linked = connected_components(links).withColumnsRenamed({"node": "sig"})

    named = linked.join(classes.select("sig", "rep"), "sig")
    least = named.groupBy("root").agg(F.min("rep").alias("least"))
    joined = cut_lineage(named.join(least, "root").select("sig", "least"))
    by_class = classes.select("sig", "rep").join(small(joined), "sig", "left").select("sig", F.coalesce("least", "rep").alias("first"))
    empty = points.filter("n = 0").select("id", "fp", "n", F.col("id").alias("component"), F.col("fp").alias("component_fp"))
    full = filled.join(by_class, "sig").select("id", "fp", "n", F.col("first.id").alias("component"), F.col("first.fp").alias("component_fp"))
    return full.unionByName(empty).withColumnRenamed("n", "n_shingles")


def near_duplicates_kept(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, n: int = N,
                         repeats: bool = True, **sizes: int) -> DataFrame:
    """``docs`` with one document of each group of links: the one with the smallest id, and
    under that id the smallest hash of its text. Rows that repeat its id and text stay with
    it as one document, unless ``repeats`` is false; rows without an id are documents of
    their own, so of their copies one stays. Of such rows it is the smallest by all columns."""
    found = jaccard_components(docs, id_col, text_col, percent, n, **sizes)
    other = (F.col("component") != F.col("id")) | (F.col("component_fp") != F.col("fp"))
    alone = F.col("n_shingles") > 0 if not repeats else (F.col("n_shingles") > 0) & (F.col("id") == NULL_ID)
    named = cut_lineage(found.groupBy("id", "fp").agg(F.max(other).alias("gone"), F.count_if(alone).alias("copies")).filter("gone or copies > 1"))
    a, b = fresh(docs, "id"), fresh(docs, "fp")
    keyed = docs.withColumns(dict(zip((a, b), id_columns(id_col, text_col))))
    gone, many = (small(named.filter(x).select(F.col("id").alias(a), F.col("fp").alias(b))) for x in ("gone", "not gone"))
    if many.isEmpty():
        return keyed.join(gone, [a, b], "left_anti").drop(a, b)
    once = keyed.join(many, [a, b], "left_semi").groupBy(a, b).agg(F.min(F.struct(*docs.columns)).alias("row"))
    rest = small(named.select(F.col("id").alias(a), F.col("fp").alias(b)))
    return keyed.join(rest, [a, b], "left_anti").drop(a, b).unionByName(once.select("row.*"))


def visible(component):
    """A component as shown: null where it stands for a null id."""
    return F.when(component != NULL_ID, component)
