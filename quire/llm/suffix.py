"""Sparse suffix dedup: of all suffixes only those at content-selected minimiser
positions are kept; they are grouped by a hash of what they begin with, and
hashes of the stretches round them stand for sorted texts and extended matches.

Words are runs of non-space bytes, ASCII letters lower-cased. The minimiser of
a stretch of LENGTH words is the position in it whose K-word hash is smallest;
equal stretches have equal minimisers, so two occurrences of a passage of
LENGTH words or more keep a suffix at the same place in it. A kept suffix
carries the hashes of all LENGTH-word stretches that it is the minimiser of:
these are its extensions to the left and right, long enough to count. Suffixes
whose first K words occur once are dropped; the others are sorted by these
words, and among neighbours, stretches that are equal to an earlier one (by
doc_id and place) are marked. Their union is just the words of all repeated
passages of LENGTH words or more, however long, less first occurrences.

Shuffles: one to count the first words of suffixes (partial sums), one by those
words for the suffixes that can have a match. First words found more than HOT
times (a passage that many documents share) are dealt by place and then by stretch
instead, after each task has kept only its own first occurrence of a stretch; so no
task gets more than a bounded share of them.

Nulls, empty texts and texts under LENGTH words have no stretch and stay as
they are. A null doc_id orders before all others. Repeated rows (same id, same
text) are one occurrence and treated alike. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import U64, Words, fresh, groups, mix, ngrams, small, with_id, word_bounds
from quire.llm.decontam import without
from quire.llm.spans import PLACES, gathered, later_places, spans_by_text, with_spans
from quire.session import cut_lineage

LENGTH = 50
K = 8
#: Suffixes with the same first words that one task may take together.
HOT = 500
#: Rows of repeated first words that may be sent to every executor (8 bytes and a flag each).
SENT = 2_000_000
_PLACE = 28  # bits for a position; more words than 2**28 in one slice can't occur


def _smallest(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each run of ``size`` values."""
    step, out = 1, values
    while 2 * step <= size:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    rest = size - step
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def kept_suffixes(texts: list[bytes], length: int = LENGTH, k: int = K) -> tuple[np.ndarray, ...]:
    """(text, first-words hash, first stretch, its number in the text, stretches) of every
    kept suffix, and the hashes of all stretches."""
    w = Words([t.lower() for t in texts])
    total = len(w.hash)
    empty = np.empty(0, np.int64)
    if total < length:
        return empty, empty.view(U64), empty, empty, empty, empty.view(U64)
    stretch = ngrams_long(w.hash, length)
    grams = ngrams(w.hash, k)
    packed = (grams >> U64(_PLACE) << U64(_PLACE)) | np.arange(len(grams), dtype=np.uint64)
    at = (_smallest(packed, length - k + 1) & U64((1 << _PLACE) - 1)).astype(np.int64)
    own = w.owner()
    t = np.flatnonzero(own[: len(stretch)] == own[length - 1:])  # stretches inside one text
    if not len(t):
        return empty, empty.view(U64), empty, empty, empty, stretch
    new = np.concatenate(([True], (at[t][1:] != at[t][:-1]) | (np.diff(t) != 1)))
    head = t[new]
    count = np.diff(np.append(np.flatnonzero(new), len(t)))
    return own[head], grams[at[head]], head, head - w.first[own[head]], count, stretch


def ngrams_long(h: np.ndarray, n: int) -> np.ndarray:
    """As ngrams, by doubling: fewer passes for a long run."""
    out, size = mix(h), 1
    result, done = None, 0
    while True:
        if n & size:
            if result is None:
                result, done = out, size
            else:
                keep = len(out) - done
                result = mix(result[:keep] * U64(3) + out[done:]) if keep > 0 else np.empty(0, U64)
                done += size
        if 2 * size > n:
            return result
        out = mix(out[:-size] * U64(5) + out[size:])
        size *= 2


_SUFFIX = "key long, id long, fp long, lo long, stretches binary"


def _suffixes(stretches: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who, fp = (batch.column(c).to_numpy() for c in ("id", "fp"))
            for at, texts in groups(batch.column("text"), 1 << 19):
                own, key, head, lo, count, stretch = kept_suffixes(texts)
                if not stretches:
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], ["key"])
                    continue
                data = [stretch[a:a + n].tobytes() for a, n in zip(head.tolist(), count.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(who[at + own]), pa.array(fp[at + own]), pa.array(lo), pa.array(data, pa.binary())],
                    ["key", "id", "fp", "lo", "stretches"])
    return run


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """(stretch, id, fp, lo, key) of every stretch of a batch of suffixes."""
    data = batch.column("stretches").to_pylist()
    n = np.fromiter((len(x) // 8 for x in data), np.int64, len(data))
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    who, fp, lo, key = (np.repeat(batch.column(c).to_numpy(), n) for c in ("id", "fp", "lo", "key"))
    return np.frombuffer(b"".join(data), U64), who, fp, lo + step, key


def _marked(parts: list[tuple[np.ndarray, ...]], length: int) -> pa.RecordBatch:
    """Word spans of the stretches that equal an earlier one; neighbours in a text as one span."""
    h, who, fp, lo = (np.concatenate([p[k] for p in parts]) for k in range(4))
    order = np.lexsort((lo, fp, who, h))
    h, who, fp, lo = (x[order] for x in (h, who, fp, lo))
    same = np.concatenate(([False], h[1:] == h[:-1]))
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(h))))
    later = (who != who[head]) | (fp != fp[head]) | (lo != lo[head])
    who, fp, lo = who[later], fp[later], lo[later]
    order = np.lexsort((lo, fp, who))
    who, fp, lo = who[order], fp[order], lo[order]
    cutoff = np.ones(len(lo), bool)
    cutoff[1:] = (who[1:] != who[:-1]) | (fp[1:] != fp[:-1]) | (lo[1:] - lo[:-1] > 1)
    first = np.flatnonzero(cutoff)
    last = np.append(first[1:], len(lo)) - 1 if len(first) else first
    return pa.RecordBatch.from_arrays([pa.array(who[first]), pa.array(fp[first]), pa.array(lo[first]), pa.array(lo[last] + length)],
                                      ["id", "fp", "lo", "hi"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted suffixes: takes whole groups of equal first words together, about 200,000 stretches at a time."""
    held, n = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        edge = int(np.searchsorted(key, key[-1]))  # where the last, perhaps unfinished group begins
        new = held and held[-1][4][-1] != key[0]
        if n >= 200_000 and (edge or new):
            if edge:
                held.append(_flat(batch.slice(0, edge)))
                batch = batch.slice(edge)
            yield _marked(held, LENGTH)
            held, n = [], 0
        held.append(_flat(batch))
        n += len(held[-1][0])
    if held:
        yield _marked(held, LENGTH)


def _by_stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            if batch.num_rows:
                h, who, fp, lo, _ = _flat(batch)
                yield h, who, fp, lo, lo + LENGTH
    return gathered(found())


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with column ``out``: word spans [from, to) of repeated passages less first occurrences, or null."""
    rows = with_id(docs, id_col, text_col)
    counts = rows.select("id", "fp", "text").mapInArrow(_suffixes(False), "key long").groupBy("key").agg(F.count("*").alias("n"))
    known = cut_lineage(counts.filter("n > 1").select("key", (F.col("n") > HOT).alias("hot")))
    suffixes = rows.mapInArrow(_suffixes(True), _SUFFIX).join(small(known, SENT), "key")
    common = suffixes.filter("not hot").drop("hot").repartition("key").sortWithinPartitions("key")
    later = common.mapInArrow(_compare, "id long, fp long, lo long, hi long")
    if known.filter("hot").limit(1).count():
        # dealt out anew, so that no task keeps two Python steps at a time, each in a worker with its own memory
        hot = suffixes.filter("hot").drop("hot").repartition("id", "fp", "lo").mapInArrow(_by_stretch, PLACES)
        later = later.unionByName(later_places(hot))
    return with_spans(docs, spans_by_text(later), id_col, text_col, out)


@F.arrow_udf(T.StringType())
def _without(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Texts without the given spans of words."""
    out = []
    for text, some in zip(texts.cast(pa.binary()).to_pylist(), spans.to_pylist()):
        if text is not None and some:
            start, end = word_bounds(np.frombuffer(text, np.uint8))
            text = without(text, [(int(start[lo]), int(end[hi - 1])) for lo, hi in some])
        out.append(text)
    return pa.array(out, pa.binary()).cast(pa.string())


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spans: str | None = None) -> DataFrame:
    """``docs`` with repeated passages cut from the text; with column ``spans`` if it is named."""
    out = spans or fresh(docs, "spans")
    found = repeated_passages(docs, id_col, text_col, out)
    # not deterministic for Spark only: a filter on the text would else run it a second time, in workers of its own
    done = found.withColumn(text_col, _without.asNondeterministic()(F.col(text_col).cast("string"), F.col(out)))
    return done if spans else done.drop(out)
