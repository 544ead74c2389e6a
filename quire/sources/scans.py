"""Date scans, settle filter and the not-yet-done selection."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows per scan page and the settle delay in minutes.
SCAN_PAGE = 1000
SETTLE_MINUTES = 30


def day_scan(df: DataFrame, date_col: str, day: str | _dt.date, order: list[Column | str],
             limit: int | None = SCAN_PAGE) -> DataFrame:
    """Rows whose timestamp falls on ``day`` (A1). ``to_date(ts) = d`` is
    rewritten by Catalyst into a pushed range on the scan."""
    out = df.filter(F.to_date(F.col(date_col)) == F.lit(day).cast("date")).orderBy(*order)
    return out.limit(limit) if limit else out


def date_range_scan(df: DataFrame, date_col: str, start, end, order: list[Column | str],
                    limit: int | None = None) -> DataFrame:
    """Rows with ``start <= date <= end`` inclusive (A2): all of them, or the
    first ``limit`` in order where a page is asked for."""
    d = F.to_date(F.col(date_col))
    out = df.filter(d.between(F.lit(start).cast("date"), F.lit(end).cast("date"))).orderBy(*order)
    return out.limit(limit) if limit else out


def hit_count(df: DataFrame) -> DataFrame:
    """Total matches next to the page returned."""
    return df.agg(F.count(F.lit(1)).alias("total"))


def preview(df: DataFrame, n: int, fields: list[str] | None = None) -> DataFrame:
    """First n rows, optionally only the listed fields that exist."""
    cols = [c for c in (fields or df.columns) if c in df.columns]
    return df.select(*cols).limit(n)


def settled(df: DataFrame, ts_col: str, now, minutes: int = SETTLE_MINUTES) -> DataFrame:
    """Rows older than ``now - minutes`` (B1); ``now`` is passed in, never read from the clock."""
    limit = F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return df.filter(F.col(ts_col) < limit)


def not_done(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the done set (C1, G4): a left anti join;
    the planner broadcasts ``done`` only when its size statistics allow."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def settled_new(hits: DataFrame, done: DataFrame, key: str, ts_col: str, now,
                minutes: int = SETTLE_MINUTES, multiplicity: str = "distinct") -> DataFrame:
    """All hits of every key that has at least one settled, not-done hit.

    ``distinct`` (default): a semi join against the distinct qualifying keys,
    so a key with k hits yields k rows. ``reference``: an inner self join that
    repeats each hit once per qualifying hit of its key (k * k rows).
    """
    qualifying = not_done(settled(hits, ts_col, now, minutes), done, key)
    if multiplicity == "distinct":
        return hits.join(qualifying.select(key).distinct(), key, "left_semi")
    if multiplicity == "reference":
        return hits.join(qualifying.select(key), key, "inner")
    raise ValueError(f"unknown multiplicity {multiplicity!r}")


def new_done_keys(selected: DataFrame, key: str) -> DataFrame:
    """Keys to append to the done set after a run."""
    return selected.select(key).distinct()
