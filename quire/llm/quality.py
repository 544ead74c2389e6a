"""Repetition coverage: rolling hashes of several n-gram lengths in numpy,
measuring the characters inside duplicated n-grams and lines of a text.

Row-local: no shuffle, one Arrow function over the text column, memory bounded
by a slice of texts (256 KB) or the longest single text.

Nulls and empty texts have no words, fail the base rule and are not kept.
Repeated rows each get their own result. Other columns are passed through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import Words, covered, fresh, groups, mix, ngrams, repeated, within

#: Share of a text's word characters that may lie inside n-word windows found twice.
NGRAM_LIMITS = {5: 0.40, 7: 0.35, 10: 0.30}
#: Share of lines, and of characters, that may lie in lines equal to an earlier one.
LINE_LIMIT = 0.40
LINE_CHAR_LIMIT = 0.30
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

_LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "dup_line_chars")
_MEASURES = (*_LONGS, *(f"cover_{n}" for n in NGRAM_LIMITS))
_SCHEMA = T.StructType([T.StructField(c, T.LongType() if c in _LONGS else T.DoubleType()) for c in _MEASURES])


def _lines(text: bytes) -> tuple[int, int, int]:
    """Lines with a word; those equal to an earlier one, and their code points."""
    seen, n, dup, chars = set(), 0, 0, 0
    for line in text.split(b"\n"):
        if not line.split(None, 1):
            continue
        n += 1
        if line in seen:
            dup += 1
            chars += len(line.decode("utf-8", "replace"))
        else:
            seen.add(line)
    return n, dup, chars


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """All measures of several texts at once."""
    w, k = Words(texts), len(texts)
    own, total = w.owner(), len(w.hash)
    points = np.concatenate(([0], np.cumsum((w.buf & 0xC0) != 0x80)))
    chars = points[w.end] - points[w.start]
    out = {"n_words": np.diff(w.first), "word_chars": np.bincount(own, chars, k).astype(np.int64),
           "n_symbols": np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts])}
    lines = np.array([_lines(t) for t in texts], np.int64).reshape(k, 3)
    out |= {"n_lines": lines[:, 0], "n_dup_lines": lines[:, 1], "dup_line_chars": lines[:, 2]}
    salt = mix(np.arange(1, k + 1).astype(np.uint64))
    all_chars = np.maximum(out["word_chars"], 1)
    for n in (3, *NGRAM_LIMITS):
        grams, flags = ngrams(w.hash, n), np.zeros(max(0, total - n + 1), bool)
        ok = within(w.first, n, total)
        flags[ok] = repeated(grams[ok] ^ salt[own[: len(grams)][ok]])
        inside = covered(flags, n, total) if total else np.zeros(0, bool)
        if n == 3:
            out["n_repeat_words"] = np.bincount(own[inside], minlength=k)
        else:
            out[f"cover_{n}"] = np.bincount(own[inside], chars[inside], k) / all_chars
    return out


@F.arrow_udf(_SCHEMA)
def _measured(texts: pa.Array) -> pa.Array:
    parts = [measure(some) for _, some in groups(texts, 1 << 18)]
    types = [pa.int64()] * len(_LONGS) + [pa.float64()] * len(NGRAM_LIMITS)
    cols = [pa.array(np.concatenate([p[c] for p in parts]) if parts else [], t) for c, t in zip(_MEASURES, types)]
    return pa.StructArray.from_arrays(cols, _MEASURES)


def quality_measures(docs: DataFrame, text_col: str = "text", out: str = "quality") -> DataFrame:
    """``docs`` with one more column ``out``: a struct of every measure, base_failed and kept."""
    raw = fresh(docs, "measured")
    m = docs.withColumn(raw, _measured(F.col(text_col).cast("string")))
    v = {c: F.col(f"{raw}.{c}") for c in _MEASURES}
    failed = (v["n_words"] < MIN_WORDS) | (100 * v["n_repeat_words"] > MAX_REPEAT_PERCENT * v["n_words"])
    bad = (v["n_dup_lines"] > LINE_LIMIT * v["n_lines"]) | (v["dup_line_chars"] > LINE_CHAR_LIMIT * v["word_chars"])
    for n, most in NGRAM_LIMITS.items():
        bad = bad | (v[f"cover_{n}"] > most)
    struct = F.struct(*[c.alias(k) for k, c in v.items()], failed.alias("base_failed"), (~failed & ~bad).alias("kept"))
    return m.withColumn(out, struct).drop(raw)


def quality_filter(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that the rules keep, with their columns as they were."""
    out = fresh(docs, "quality")
    return quality_measures(docs, text_col, out).filter(f"{out}.kept").drop(out)
