"""Global row index and in-group ranks without a single-partition window.

``row_number()`` over an empty partition spec moves the whole table into one
task, and one over a group moves the group there. Instead the rows are
range-partitioned on (key, order), each partition is sorted, and the result is
checkpointed (so partition contents are fixed even if a task is re-run). One
pass sums each partition up in one row: its first and last key, how many rows
and groups it has, how long its last group is. Prefix sums over these rows (one
for each partition, whatever the table's size) say where each partition starts
counting, and a second pass counts on from there. No row is joined back on its
group, so one key with a third of all rows stays spread over its partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.session import cut_lineage


def _differs(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Where two arrays of equal length differ; null equals null."""
    unlike = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    return unlike | (a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False))


def _new_groups(batch: pa.RecordBatch, keys: list[str], before: pa.RecordBatch | None) -> np.ndarray:
    """Where a row's key is not that of the row before; ``before`` is the last row of the previous batch."""
    new = np.zeros(batch.num_rows, bool)
    for k in keys:
        col = batch.column(k)
        new[1:] |= _differs(col.slice(0, len(col) - 1), col.slice(1))
        if before is not None:
            new[:1] |= _differs(before.column(k), col.slice(0, 1))
    return new


def _summary(keys: list[str], running: str | None):
    """Per partition: rows, groups, total of ``running``, rows of the first and the last group, their keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, groups, total, first_run, last_run, first, last = 0, 1, 0, 0, 0, None, None
        for b in batches:
            if not b.num_rows:
                continue
            new = _new_groups(b, keys, last)
            at = np.flatnonzero(new)
            last_run = b.num_rows - int(at[-1]) if len(at) else last_run + b.num_rows
            if groups == 1:
                first_run += int(at[0]) if len(at) else b.num_rows
            n, groups, last = n + b.num_rows, groups + len(at), b.slice(b.num_rows - 1, 1)
            total += (pc.sum(b.column(running)).as_py() or 0) if running else 0
            first = first if first is not None else b.slice(0, 1)
        if n:
            ends = [pa.StructArray.from_arrays([x.column(k) for k in keys], keys) if keys else pa.array([None], pa.int32()) for x in (first, last)]
            yield pa.RecordBatch.from_arrays([first.column("_qpart"), *(pa.array([v], pa.int64()) for v in (n, groups, total, first_run, last_run)), *ends],
                                             ["_qpart", "n", "groups", "total", "first_run", "last_run", "first", "last"])
    return run


def numbered(df: DataFrame, key: list[str], order: list[Column | str], rank: str = "rank", group: str | None = None,
             size: str | None = None, running: tuple[str, str] | None = None, num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """``df`` with 0-based ``rank`` (long) of each row inside its ``key`` group following ``order``, and the row count.

    ``group`` adds the dense 0-based number of the group (groups ascend by key, null first), ``size`` the
    group's number of rows, ``running`` = (column, name) the sum of an integer column over all rows before.
    With no key the whole table is one group. Keys are of atomic types. Rows that tie in ``order`` get
    different ranks in any order. Rows come back in partitions that follow (key, order).
    """
    sort = [*[F.col(k).asc_nulls_first() for k in key], *order]
    # without an explicit count the range shuffle may be coalesced by AQE:
    # it only merges adjacent ranges, so the global order is kept, and
    # small inputs do not spread over hundreds of near-empty partitions
    shuffled = df.repartitionByRange(num_partitions, *sort) if num_partitions else df.repartitionByRange(*sort)
    ranged = cut_lineage(shuffled.sortWithinPartitions(*sort)).withColumn("_qpart", F.spark_partition_id())
    add = running[0] if running else None
    ends = T.StructType([df.schema[k] for k in key]) if key else T.IntegerType()
    schema = T.StructType([T.StructField("_qpart", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("n", "groups", "total", "first_run", "last_run")],
                           T.StructField("first", ends), T.StructField("last", ends)])
    slim = ranged.select("_qpart", *dict.fromkeys([*key, *([add] if add else [])]))
    start, known, rows = {}, {}, 0  # by partition: (group number, rows of that group before, total before); group sizes
    g = carry = total = 0
    prev = None
    for s in sorted(slim.mapInArrow(_summary(key, add), schema).collect(), key=lambda r: r._qpart):
        if prev is not None and prev.last != s.first:
            g, carry = g + 1, 0
        start[s._qpart] = (g, carry, total)
        known[g] = known.get(g, 0) + s.first_run
        carry = s.last_run + (carry if s.groups == 1 else 0)
        g, total, rows, prev = g + s.groups - 1, total + s.total, rows + s.n, s
        if s.groups > 1:
            known[g] = s.last_run
    names = [c for c in (rank, group, running and running[1]) if c]

    def count_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at, g, total = None, 0, 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            if last is None:
                g, at, total = start[b.column("_qpart")[0].as_py()]
            new = _new_groups(b, key, last)
            place = np.arange(b.num_rows)
            begin = np.maximum.accumulate(np.where(new, place, -at))
            number = g + np.cumsum(new)
            out = [pa.array(place - begin)]
            if group:
                out.append(pa.array(number))
            if running:
                v = pc.fill_null(b.column(add), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                sums = total + np.cumsum(v)
                out.append(pa.array(sums - v))
                total = int(sums[-1])
            if size:
                out.append(pa.array([known.get(x) for x in number.tolist()], pa.int64()))
            g, at, last = int(number[-1]), int(place[-1] - begin[-1]) + 1, b.slice(b.num_rows - 1, 1)
            yield pa.RecordBatch.from_arrays([*b.columns, *out], schema=pa.schema([*b.schema, *[pa.field(c, pa.int64()) for c in added]]))

    added = [*names, *(["_qsize"] if size else [])]
    done = ranged.mapInArrow(count_on, T.StructType([*ranged.schema, *[T.StructField(c, T.LongType()) for c in added]]))
    if size:
        # a group inside one partition is counted there: its key has no more rows than the partition
        inside = ranged.groupBy("_qpart", *key).count().select("_qpart", *[F.col(k).alias(f"_q_{k}") for k in key], F.col("count").alias("_qcount"))
        same = [F.col(k).eqNullSafe(F.col(f"_q_{k}")) for k in key]
        done = (done.withColumn("_qp", F.col("_qpart")).drop("_qpart").join(inside, [F.col("_qp") == inside["_qpart"], *same], "left")
                .withColumn(size, F.coalesce("_qsize", "_qcount")).drop("_qp", "_qsize", "_qcount", *[f"_q_{k}" for k in key]))
    return done.select(*df.columns, *names, *([size] if size else [])), rows


def with_global_index(df: DataFrame, order: list[Column | str], name: str = "idx",
                      num_partitions: int | None = None) -> DataFrame:
    """Append a 0-based ``long`` index following ``order`` (which must be a total order)."""
    return indexed(df, order, name, num_partitions)[0]


def indexed(df: DataFrame, order: list[Column | str], name: str = "idx",
            num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """``with_global_index`` plus the row count it already knows."""
    return numbered(df, [], order, name, num_partitions=num_partitions)


def with_keyed_index(df: DataFrame, key: list[str], order: list[str], name: str = "idx") -> DataFrame:
    """Global index (ascending over the ``order`` columns) computed on the
    slim key + order projection and joined back on the unique ``key``: the
    range sampling, the shuffle and the checkpoint then carry only those
    columns, not wide rows such as article text. Where a key repeats, the
    whole rows are indexed instead, each once."""
    if _repeats(df.select(*key), key):  # joined back, k rows of a key would become k * k
        return with_global_index(df, [F.col(c) for c in order], name)
    slim_cols = list(dict.fromkeys(list(key) + list(order)))
    slim = with_global_index(df.select(*slim_cols), [F.col(c) for c in order], name).select(*key, name)
    return df.join(slim, list(key), "inner")


def _repeats(keys: DataFrame, key: list[str]) -> bool:
    return keys.groupBy(*key).count().filter("count > 1").limit(1).count() > 0


def rank_within(df: DataFrame, key: str, order: list[Column | str], name: str = "in_rank",
                size_name: str | None = "size", slim: list[str] | None = None,
                unique: list[str] | None = None) -> DataFrame:
    """1-based row number inside each ``key`` group following ``order``.

    Equivalent to ``row_number() over (partition by key order by ...)``, by
    ``numbered``: one large group is spread over many range partitions, and no
    row is joined back on the key.

    With ``slim`` (the key, order and ``unique`` columns) the ranking runs
    on that narrow projection and is joined back on the ``unique`` key, so
    wide rows (article text) are neither range-shuffled nor checkpointed.
    """
    if slim and _repeats(df.select(*unique), list(unique)):
        slim = None
    base = df.select(*slim) if slim else df
    out = numbered(base, [key], order, name, size=size_name)[0].withColumn(name, F.col(name) + 1)
    if slim:
        extra = [name] + ([size_name] if size_name else [])
        out = df.join(out.select(*unique, *extra), unique, "inner")
    return out
