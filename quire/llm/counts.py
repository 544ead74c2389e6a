"""Token counts: batch encoding in Arrow functions that return lengths only.

Work is dealt in batches of about BATCH_BYTES, whatever the lengths of texts.
A byte-level tokenizer begins a new pre-token at every space before a
non-space, so texts of any length are split there without a change to their
tokens; each different piece is encoded once per worker and its length kept in
a bounded cache. Other tokenizers give no such boundary and get whole texts.

The tokenizer file is a parameter: ``.json`` for the tokenizers library,
``.model`` for sentencepiece; it must be readable by the executors. Special
strings inside texts are handled as the library does by default; none are
added, nothing is cut or padded.

Row-local, no shuffle. Null text counts as empty. Repeated rows each get their
result. Other columns pass through.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_BYTES = 1 << 20
CACHED = 500_000
LONGEST = 64  # characters of a piece that is kept

_BREAK = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?:\s|$)")


def split_safely(text: str) -> list[str]:
    """A text cut before every space that a non-space follows; all but the first without this space."""
    return _BREAK.split(text) if _ODD.search(text) else text.split(" ")


class Counter:
    """Token counts of one tokenizer file, with a cache by piece."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.splits, self.known = False, {}
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._encode = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer
            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self._encode = lambda texts: [len(x) for x in model.encode_batch(texts, add_special_tokens=False)]
            with open(path, encoding="utf-8") as f:
                data = json.load(f)
            pre = data.get("pre_tokenizer") or {}
            plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"]) for t in data.get("added_tokens", []))
            self.splits = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and plain and not data.get("normalizer")

    def encode(self, texts: list[str]) -> list[int]:
        """Lengths, in calls of bounded size."""
        out, held, size = [], [], 0
        for t in texts:
            held.append(t)
            size += len(t)
            if size >= BATCH_BYTES:
                out += self._encode(held)
                held, size = [], 0
        return out + (self._encode(held) if held else [])

    def counts(self, texts: list[str]) -> list[int]:
        if not self.splits:
            return self.encode(texts)
        if len(self.known) > CACHED:
            self.known.clear()
        parts = [split_safely(t) for t in texts]
        new = list({p for some in parts for p in some[1:] if p not in self.known})
        lengths = dict(zip(new, self.encode([" " + p for p in new])))
        self.known.update((p, n) for p, n in lengths.items() if len(p) <= LONGEST)
        first = self.encode([some[0] for some in parts])
        get, late = self.known.get, lengths.get
        return [n + sum(x if (x := get(p)) is not None else late(p) for p in some[1:]) for n, some in zip(first, parts)]


@lru_cache(maxsize=4)
def counter_of(path: str) -> Counter:
    """One tokenizer, with its cache, per Python worker."""
    return Counter(path)


def _batches(texts: pa.Array) -> Iterator[list[str]]:
    """Texts in lists of about BATCH_BYTES; null as empty."""
    held, size = [], 0
    for t in texts:
        held.append(t.as_py() or "")
        size += len(held[-1])
        if size >= BATCH_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def token_count(text: Column, tokenizer: str) -> Column:
    """Number of tokens of each whole text."""
    @F.arrow_udf(T.LongType())
    def count(texts: pa.Array) -> pa.Array:
        c = counter_of(tokenizer)
        return pa.array([n for some in _batches(texts) for n in c.counts(some)], pa.int64())

    return count(text.cast("string"))
