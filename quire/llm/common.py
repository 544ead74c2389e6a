"""Helpers shared by the training-data operators.

Texts are worked on as UTF-8 bytes in numpy. A word is a run of bytes between
ASCII white space (space, tab, line feed, vertical tab, form feed, carriage
return), which is exactly what ``bytes.split()`` gives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

U64 = np.uint64
CHUNK = 1 << 20
#: Rows of a table that may be sent to every executor; larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000
#: Stands for a null id inside operators, so that joins and orderings stay defined.
NULL_ID = -(1 << 63)

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_INV = U64(pow(int(_BASE), -1, 1 << 64))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the rolling base and of its inverse, n of each at least."""
    if not _powers or len(_powers["up"]) < n:
        for name, base in (("up", _BASE), ("down", _INV)):
            step = np.full(max(n, 1 << 12), base, U64)
            step[0] = 1
            _powers[name] = np.multiply.accumulate(step)
    return _powers["up"], _powers["down"]


def word_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of a byte array."""
    inside = np.concatenate(([False], ~_IS_SPACE[buf], [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def _hash_chunk(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = _power(len(buf) + 1)
    prefix = np.zeros(len(buf) + 1, U64)
    np.cumsum(_BYTE[buf] * up[: len(buf)], out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(U64))


def hash_words(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit rolling hash for each word; work memory is bounded by CHUNK
    bytes or the longest word, as the buffer is taken piece by piece."""
    if len(buf) <= CHUNK:
        return _hash_chunk(buf, start, end)
    out, lo = np.empty(len(start), U64), 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + CHUNK, "right")))
        at = start[lo]
        out[lo:hi] = _hash_chunk(buf[at:end[hi - 1]], start[lo:hi] - at, end[lo:hi] - at)
        lo = hi
    return out


class Words:
    """The words of several texts: hashes in text order, and where each text begins.

    ``first[i]:first[i+1]`` are the words of text i; ``start``/``end`` are byte
    offsets into ``buf``, the texts joined by one line feed each."""

    def __init__(self, texts: list[bytes]):
        self.buf = np.frombuffer(b"\n".join(texts), np.uint8)
        size = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.offset = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
        self.start, self.end = word_bounds(self.buf)
        self.hash = hash_words(self.buf, self.start, self.end)
        self.first = np.append(np.searchsorted(self.start, self.offset), len(self.start))

    def owner(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive values (those over a text's end included)."""
    if len(h) < n:
        return np.empty(0, U64)
    up, _ = _power(n)
    out = np.zeros(len(h) - n + 1, U64)
    for i in range(n):
        out += h[i:len(h) - n + 1 + i] * up[i]
    return mix(out + U64(n))


def within(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which runs of n words begin and end in the same text."""
    ok = np.ones(max(0, total - n + 1), bool)
    for end in first[1:-1]:
        ok[max(0, end - n + 1):end] = False
    return ok


def repeated(values: np.ndarray) -> np.ndarray:
    """True where a value occurs more than once."""
    s = np.sort(values)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(twice, values), len(twice) - 1)
    return twice[at] == values


def covered(flags: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of ``total`` words lie in a flagged run of n words."""
    step = np.zeros(total + 1, np.int32)
    at = np.flatnonzero(flags)
    np.add.at(step, at, 1)
    np.subtract.at(step, at + n, 1)
    return np.cumsum(step[:-1]) > 0


def groups(array: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as UTF-8; null as empty) in slices of about ``limit`` bytes, one text at least."""
    texts, size, at = [], 0, 0
    for i, x in enumerate(array.cast(pa.binary()).to_pylist()):
        x = x or b""
        if texts and size + len(x) > limit:
            yield at, texts
            texts, size, at = [], 0, i
        texts.append(x)
        size += len(x) + 1
    if texts:
        yield at, texts


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_columns(id_col: str, text_col: str) -> tuple[Column, Column]:
    """A row's id, never null, and a fingerprint that tells texts under a repeated id apart."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)), F.xxhash64(F.col(text_col))


def with_id(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, text) of every row."""
    who, fp = id_columns(id_col, text_col)
    return df.select(who.alias("id"), fp.alias("fp"), F.col(text_col).cast("string").alias("text"))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if it has at most ``rows`` rows (counted here; so pass
    only a materialised table); else as it is, and Spark joins by shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
