"""Benchmark decontamination: a broadcast hash set of normalised test n-grams;
training texts are scanned word window by word window, hits are verified word
for word, and the spans or the documents are removed.

Words: ASCII letters lower-cased, runs of ASCII letters, digits and all
non-ASCII bytes. A window is ``n`` consecutive words of an item; an item of
fewer words, but not none, is one window.

The benchmark is sent to the executors in blocks of at most BLOCK_BYTES of
text, each block built and broadcast on its own, and every block is held
against all documents; so what is broadcast has a fixed bound at any size of
the benchmark. One block is the usual case. The scan is row-local; a shuffle
happens only to bring the hits of several blocks together.

Nulls and empty texts (documents or items) have no words, hit nothing and stay.
Items with a null id hit, but have no id to report. Repeated rows each get
their own result; repeated item ids count once. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import Words, fresh, groups, ngrams, within

WINDOW = 10
BLOCK_BYTES = 4 << 20

#: Separators become spaces, capitals become small letters; so words are what split() gives.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_BITS = 20


class Windows:
    """The windows of a block of items: sorted hashes by length, and the windows themselves."""

    def __init__(self, items: list[tuple[str | None, str | None]], n: int = WINDOW):
        self.ids = sorted({i for i, _ in items if i is not None})
        number = {x: k for k, x in enumerate(self.ids)}
        self.owners: dict[bytes, set[int]] = {}
        by_length: dict[int, set[int]] = {}
        for item, text in items:
            folded = (text or "").encode("utf-8", "replace").translate(_FOLD)
            words = folded.split()
            if not words:
                continue
            size = min(n, len(words))
            grams = ngrams(Words([folded]).hash, size)
            by_length.setdefault(size, set()).update(grams.tolist())
            for k in range(len(words) - size + 1):
                own = self.owners.setdefault(b" ".join(words[k:k + size]), set())
                if item is not None:
                    own.add(number[item])
        self.hashes = {size: np.array(sorted(g), np.uint64) for size, g in sorted(by_length.items())}
        self.maybe = {}
        for size, g in self.hashes.items():
            bits = np.zeros(1 << _BITS, bool)
            bits[(g >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            self.maybe[size] = bits

    def scan(self, texts: list[bytes]) -> Iterator[tuple[int, list[tuple[int, int]], set[int], list[tuple[int, int]]]]:
        """For each text: words, verified word spans, item numbers, byte spans."""
        folded = [t.translate(_FOLD) for t in texts]
        w = Words(folded)
        own, total = w.owner(), len(w.hash)
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        found: list[set[int]] = [set() for _ in texts]
        for size, known in self.hashes.items():
            grams = ngrams(w.hash, size)
            at = np.flatnonzero(self.maybe[size][(grams >> np.uint64(64 - _BITS)).astype(np.int64)])
            if not len(at):
                continue
            place = np.minimum(np.searchsorted(known, grams[at]), len(known) - 1)
            at = at[known[place] == grams[at]]
            at = at[within(w.first, size, total)[at]]
            for k in at.tolist():
                doc = own[k]
                lo, hi = w.start[k] - w.offset[doc], w.end[k + size - 1] - w.offset[doc]
                items = self.owners.get(b" ".join(folded[doc][lo:hi].split()))
                if items is not None:
                    spans[doc].append((k - int(w.first[doc]), k - int(w.first[doc]) + size))
                    found[doc] |= items
        for i in range(len(texts)):
            merged: list[tuple[int, int]] = []
            for lo, hi in sorted(spans[i]):
                if merged and lo <= merged[-1][1]:
                    merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
                else:
                    merged.append((lo, hi))
            base, off = w.first[i], w.offset[i]
            places = [(int(w.start[base + lo] - off), int(w.end[base + hi - 1] - off)) for lo, hi in merged]
            yield int(w.first[i + 1] - base), merged, found[i], places


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[str | None, str | None]]]:
    """The items in blocks of bounded text; a single longer item is a block of its own."""
    block, size = [], 0
    rows = benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    for item, text in rows.toLocalIterator():
        new = len((text or "").encode("utf-8", "replace"))
        if block and size + new > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += new
    yield block  # an empty benchmark is one empty block


_HIT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
                     T.StructField("items", T.ArrayType(T.StringType())), T.StructField("places", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("rest", T.StringType())])
_ARROW = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))),
                    ("items", pa.list_(pa.string())), ("places", pa.list_(pa.list_(pa.int64()))), ("rest", pa.string())])


def _scanner(known, rest: bool):
    @F.arrow_udf(_HIT)
    def scan(texts: pa.Array) -> pa.Array:
        w, out = known.value, []
        for at, some in groups(texts, 1 << 18):
            for k, (n, spans, items, places) in enumerate(w.scan(some)):
                left = None
                if rest and texts[at + k].is_valid:
                    left = (without(some[k], places) if places else some[k]).decode("utf-8", "replace")
                out.append({"n_words": n, "spans": spans, "items": [w.ids[i] for i in sorted(items)], "places": places, "rest": left})
        return pa.array(out, _ARROW)
    return scan.asNondeterministic()  # for Spark only: a filter on its result would else scan a second time, in workers of its own


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", n: int = WINDOW, out: str = "hits", rest: bool = False) -> DataFrame:
    """``docs`` with a column ``out``: n_words, spans (hit words, [from, to) and
    merged), items (ids with occurring windows, sorted), places (the spans as byte
    offsets) and, if ``rest`` is asked for, the text without them."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    cols = []
    df = docs
    for block in _blocks(benchmark, item_col, item_text):
        col = fresh(df, f"block_{len(cols)}")
        known = spark.sparkContext.broadcast(Windows(block, n))
        df = df.withColumn(col, _scanner(known, rest and len(cols) == 0)(text))
        cols.append(col)
    if len(cols) == 1:
        return df.withColumn(out, F.col(cols[0])).drop(cols[0])
    both = lambda f: F.concat(*[F.col(f"{c}.{f}") for c in cols])
    return df.withColumn(out, F.struct(F.col(f"{cols[0]}.n_words"), _merged(both("spans")).alias("spans"),
                                       F.array_sort(F.array_distinct(both("items"))).alias("items"),
                                       _merged(both("places")).alias("places"),
                                       (cut(text, _merged(both("places"))) if rest else F.lit(None)).alias("rest"))).drop(*cols)


@F.arrow_udf(T.ArrayType(T.ArrayType(T.LongType())))
def _merged(spans: pa.Array) -> pa.Array:
    out = []
    for some in spans.to_pylist():
        merged: list[list[int]] = []
        for lo, hi in sorted(some or []):
            if merged and lo <= merged[-1][1]:
                merged[-1][1] = max(hi, merged[-1][1])
            else:
                merged.append([lo, hi])
        out.append(merged)
    return pa.array(out, pa.list_(pa.list_(pa.int64())))


def without(text: bytes, spans: list) -> bytes:
    """A text less the given byte spans; what stood around a span is parted by a line feed."""
    parts, at = [], 0
    for lo, hi in [*spans, (len(text), len(text))]:
        parts.append(text[at:lo].strip(b" \t\r\n"))
        at = hi
    return b"\n".join(p for p in parts if p)


@F.arrow_udf(T.StringType())
def cut(texts: pa.Array, places: pa.Array) -> pa.Array:
    """``without`` for columns; a null text, or one without spans, stays as it is."""
    both = zip(texts.cast(pa.binary()).to_pylist(), places.to_pylist())
    return pa.array([without(t, s) if t is not None and s else t for t, s in both], pa.binary()).cast(pa.string())


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", text_col: str = "text", **named) -> DataFrame:
    """``docs`` without benchmark text, with their columns as they were.

    remove="documents" drops every document with a hit; remove="spans" cuts the hit
    words out and drops a document only if nothing remains of it."""
    out = fresh(docs, "hits")
    names = [F.col(f"`{c}`") for c in docs.columns]
    found = contamination(docs, benchmark, text_col, out=out, rest=remove == "spans", **named)
    hit = F.size(f"{out}.spans") > 0
    if remove == "documents":
        return found.filter(~hit).select(*names)
    return found.withColumn(text_col, F.col(f"{out}.rest")).filter(~hit | (F.length(text_col) > 0)).select(*names)
