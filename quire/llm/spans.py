"""Substring dedup by sliding sentence spans: every run of several consecutive
sentences is hashed, runs are joined globally, and sentences covered by any
non-first repeated run are removed.

A run has MIN_SENTENCES sentences or more and MIN_WORDS words or more: for each
sentence the shortest such run that begins with it, and the shortest that ends
with it, so a repeated passage is covered to its last sentence. A text of one
sentence is one run if it is long enough. Sentences are compared lower-cased
(A-Z) and with white space made even. The first occurrence is the one with the
smallest (doc_id, place); it stays.

Shuffle: one, by run hash. Before it, each task keeps only its own first
occurrence of a run (a later one in the same task cannot be the first of all,
and is known to be covered at once), so a run that a third of all documents
share reaches its reducer at most once per task.

Nulls and empty texts have no runs and stay as they are. A null doc_id orders
before all others. Repeated rows (same id, same text) are one occurrence and
are treated alike. Other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import U64, fresh, groups, id_columns, mix, small, with_id
from quire.llm.decontam import cut
from quire.session import cut_lineage

MIN_SENTENCES = 2
MIN_WORDS = 20
#: Runs that a task holds before it sends them on.
HELD = 200_000

_END = re.compile(rb"(?:[.!?]+[\"')\]]*(?=\s)|\xe3\x80\x82|\xef\xbc\x81|\xef\xbc\x9f)\s*|\n\s*")
PLACES = "key long, id long, fp long, lo long, hi long, later boolean"
_NAMES = ["key", "id", "fp", "lo", "hi", "later"]


def sentences(text: bytes) -> list[tuple[int, int]]:
    """Byte spans of the sentences."""
    out, at = [], 0
    for m in _END.finditer(text):
        if text[at:m.end()].strip():
            out.append((at, m.end()))
        at = m.end()
    if text[at:].strip():
        out.append((at, len(text)))
    return out


def runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, run hash, first byte, end byte) of every run."""
    own, lo, hi, words, h = [], [], [], [], []
    for k, text in enumerate(texts):
        for a, b in sentences(text):
            parts = text[a:b].lower().split()
            own.append(k)
            lo.append(a)
            hi.append(b)
            words.append(len(parts))
            h.append(xxhash.xxh3_64_intdigest(b" ".join(parts)))
    n = len(own)
    if not n:
        return np.empty(0, np.int64), np.empty(0, U64), np.empty(0, np.int64), np.empty(0, np.int64)
    own, lo, hi = np.array(own), np.array(lo), np.array(hi)
    cum = np.concatenate(([0], np.cumsum(words)))
    i = np.arange(n)
    end = np.searchsorted(own, own, "right")
    begin = np.searchsorted(own, own, "left")
    j = np.maximum(np.searchsorted(cum, cum[:-1] + MIN_WORDS) - 1, i + MIN_SENTENCES - 1)
    s = np.minimum(np.searchsorted(cum, cum[1:] - MIN_WORDS, "right") - 1, i - MIN_SENTENCES + 1)
    alone = (end - begin == 1) & (np.diff(cum) >= MIN_WORDS)
    ok, back = j < end, s >= begin
    first = np.concatenate((i[ok], s[back], i[alone]))
    last = np.concatenate((j[ok], i[back], i[alone]))
    pair = np.unique(first * (n + 1) + last)
    first, last = pair // (n + 1), pair % (n + 1)
    # the hash of a run: a rolling sum over its sentences, moved to place 0
    base = U64(0xD6E8FEB86659FD93)
    up = np.multiply.accumulate(np.concatenate((np.ones(1, U64), np.full(n, base, U64))))
    down = np.multiply.accumulate(np.concatenate((np.ones(1, U64), np.full(n, U64(pow(int(base), -1, 1 << 64)), U64))))
    prefix = np.concatenate((np.zeros(1, U64), np.cumsum(mix(np.array(h, U64)) * up[:n])))
    key = mix((prefix[last + 1] - prefix[first]) * down[first] + (last - first + 1).astype(U64))
    return own[first], key, lo[first], hi[last]


def local_firsts(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """One task's (key, id, fp, lo, hi): the first of each key goes on under its key;
    another place of the key is marked and spread, as it is settled."""
    key, who, fp, lo, hi = (np.concatenate([p[k] for p in parts]) for k in range(5))
    order = np.lexsort((lo, fp, who, key))
    key, who, fp, lo, hi = (x[order] for x in (key, who, fp, lo, hi))
    same = np.concatenate(([False], key[1:] == key[:-1]))
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(key))))
    later = (who != who[head]) | (fp != fp[head]) | (lo != lo[head])
    keep = later | ~same  # the same place twice (a repeated row) goes on once
    spread = mix((who ^ (fp << 1) ^ (lo << 40)).view(U64))
    key = np.where(later, spread, key).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (key, who, fp, lo, hi, later)], _NAMES)


def gathered(found: Iterator[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """local_firsts over pieces of about HELD places."""
    parts, n = [], 0
    for p in found:
        parts.append(p)
        n += len(p[0])
        if n >= HELD:
            yield local_firsts(parts)
            parts, n = [], 0
    if n:
        yield local_firsts(parts)


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            who, fp = (batch.column(c).to_numpy() for c in ("id", "fp"))
            for at, texts in groups(batch.column("text")):
                own, key, lo, hi = runs(texts)
                yield key, who[at + own], fp[at + own], lo, hi
    return gathered(found())


def later_places(places: DataFrame) -> DataFrame:
    """Of rows as local_firsts gives them, those that are not the first of their key."""
    rank = F.rank().over(W.partitionBy("key").orderBy("id", "fp", "lo"))
    return places.withColumn("rank", rank).filter((F.col("rank") > 1) | F.col("later")).select("id", "fp", "lo", "hi")


_SPANS = pa.list_(pa.list_(pa.int64()))


@F.arrow_udf(T.ArrayType(T.ArrayType(T.LongType())))
def union_spans(spans: pa.Array) -> pa.Array:
    """Sorted, disjoint [lo, hi) from a list of {lo, hi}."""
    out = []
    for some in spans.to_pylist():
        merged: list[list[int]] = []
        for x in sorted((s["lo"], s["hi"]) for s in some):
            if merged and x[0] <= merged[-1][1]:
                merged[-1][1] = max(x[1], merged[-1][1])
            else:
                merged.append(list(x))
        out.append(merged)
    return pa.array(out, _SPANS)


def spans_by_text(later: DataFrame) -> DataFrame:
    """(id, fp, spans): one row a text, as long as the text's own list of places."""
    lists = later.groupBy("id", "fp").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    return cut_lineage(lists.select("id", "fp", union_spans("spans").alias("spans")))


def with_spans(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str, out: str) -> DataFrame:
    """``docs`` with column ``out``: the spans of the row's text, or null."""
    a, b = fresh(docs, "id"), fresh(docs, "fp")
    keyed = docs.withColumns(dict(zip((a, b), id_columns(id_col, text_col))))
    named = spans.select(F.col("id").alias(a), F.col("fp").alias(b), F.col("spans").alias(out))
    return keyed.join(small(named), [a, b], "left").drop(a, b)


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with column ``out``: byte spans [from, to) of the sentences to remove, or null."""
    places = with_id(docs, id_col, text_col).mapInArrow(_emit, PLACES)
    return with_spans(docs, spans_by_text(later_places(places)), id_col, text_col, out)


def remove_repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spans: str | None = None) -> DataFrame:
    """``docs`` with repeated sentences cut from the text; with column ``spans`` if it is named."""
    out = spans or fresh(docs, "spans")
    found = repeated_runs(docs, id_col, text_col, out)
    done = found.withColumn(text_col, cut(F.col(text_col).cast("string"), F.col(out)))
    return done if spans else done.drop(out)
