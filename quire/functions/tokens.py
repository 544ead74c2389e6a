"""Tokenizer shared by search, token statistics and extractive summaries.

Tokens are lower-cased maximal runs of Unicode letters, digits and
underscore; every CJK ideograph is a token of its own. The same rule is
applied to query strings on the driver (``regex`` module) and to columns in
the JVM (Java regex), so both sides agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

JAVA_TOKEN = r"\p{IsHan}|[[\p{L}\p{N}_]&&[^\p{IsHan}]]+"
# Same tokens for text without any CJK ideograph, about twice as fast.
JAVA_TOKEN_PLAIN = r"[\p{L}\p{N}_]+"
_PY_TOKEN = regex.compile(r"\p{Han}|[[\p{L}\p{N}_]--\p{Han}]+", regex.V1)


def tokens(text: Column) -> Column:
    """array<string> of tokens of ``text`` (empty array for null)."""
    low = F.lower(text)
    toks = F.when(low.rlike(r"\p{IsHan}"), F.regexp_extract_all(low, F.lit(JAVA_TOKEN), 0)) \
            .otherwise(F.regexp_extract_all(low, F.lit(JAVA_TOKEN_PLAIN), 0))
    return F.coalesce(toks, F.array().cast("array<string>"))


def py_tokens(text: str) -> list[str]:
    return _PY_TOKEN.findall((text or "").lower())


def token_count(text: Column) -> Column:
    return F.size(tokens(text)).cast("long")


#: Kinds of characters; those of tokens are what the JVM's patterns say.
OTHER, WORD, HAN = range(3)
_KINDS: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def char_kinds(spark: SparkSession) -> tuple[np.ndarray, np.ndarray]:
    """The kinds of all code points, as stretches: where each begins, and its kind. HAN is a token by itself."""
    app = spark.sparkContext.applicationId
    if app not in _KINDS:
        char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
        points = spark.range(0x110000).filter((F.col("id") < 0xD800) | (F.col("id") > 0xDFFF))
        kind = F.when(char.rlike(r"\p{IsHan}"), HAN).when(char.rlike(JAVA_TOKEN_PLAIN), WORD).otherwise(OTHER)
        found = points.select(F.col("id").cast("int").alias("id"), kind.cast("int").alias("kind")).filter(F.col("kind") != OTHER).toArrow()
        kinds = np.zeros(0x110000, np.uint8)
        kinds[found["id"].to_numpy()] = found["kind"].to_numpy()
        first = np.flatnonzero(np.diff(kinds, prepend=255))
        _KINDS[app] = (first, kinds[first])
    return _KINDS[app]


def kind_table(stretches: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The kind of each code point, from its stretches."""
    first, kinds = stretches
    return np.repeat(kinds, np.diff(first, append=0x110000))


def cut_tokens(raw: np.ndarray, points: np.ndarray, kinds: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """The tokens of a lower-cased text, given as UTF-8 bytes, code points and their kinds, and the place where each begins."""
    word, han = kinds == WORD, kinds == HAN
    first = word.copy()
    first[1:] &= ~word[:-1]
    first |= han
    kept = word | han
    begin = np.append(np.flatnonzero(first[kept]), np.count_nonzero(kept))
    if len(raw) == len(points):
        data = raw[kept]
    else:
        width = (points > 0x7F).astype(np.uint8) + (points > 0x7FF) + (points > 0xFFFF) + np.uint8(1)
        data = raw[np.repeat(kept, width)]
        begin = np.concatenate([[0], np.cumsum(width[kept], dtype=np.int64)])[begin]
    return pa.StringArray.from_buffers(len(begin) - 1, pa.py_buffer(begin.astype(np.int32)), pa.py_buffer(data)), np.flatnonzero(first)
