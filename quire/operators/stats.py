"""Exact order statistics and small aggregates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators.indexing import with_global_index


def exact_quantile(df: DataFrame, col: str, q: float) -> float | None:
    """Linear-interpolation quantile (as pandas / ``quantile_cont``).

    The values are sorted through the range-partitioned global index; only
    the two neighbouring order statistics come back to the driver, so no task
    ever holds all values (``percentile`` would merge them in one buffer).
    """
    vals = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    n = vals.count()
    if n == 0:
        return None
    h = (n - 1) * q
    lo = math.floor(h)
    hi = min(lo + 1, n - 1)
    idx = with_global_index(vals, [F.col("v")], "i")
    got = dict(idx.filter(F.col("i").isin(lo, hi)).select("i", "v").collect())
    v_lo, v_hi = got[lo], got[hi]
    return v_lo + (h - lo) * (v_hi - v_lo)


def keep_above_quantile(df: DataFrame, col: str, q: float) -> DataFrame:
    """Rows with ``col`` strictly above the q-quantile of ``col``."""
    t = exact_quantile(df, col, q)
    if t is None:
        return df.limit(0)
    return df.filter(F.col(col) > F.lit(t))


def keep_above_half_max(df: DataFrame, col: str) -> DataFrame:
    """Rows strictly above half of the column maximum."""
    mx = df.agg(F.max(col)).first()[0]
    if mx is None:
        return df.limit(0)
    return df.filter(F.col(col) > F.lit(mx) / 2)


def arg_max_first(value: Column, *order: Column) -> Column:
    """Value at the largest ``order`` tuple (D5); callers add tie-breakers."""
    return F.max_by(value, F.struct(*order))
