"""Packing of token sequences into windows by minimum bin slack.

Documents are cut freely into pieces, and pieces fill sequences of at most
WINDOW tokens. A document's full windows are sequences of their own; what is
left, its remainder, is shorter than a window. How many remainders there are of
each length is a table of WINDOW - 1 counts at most, whatever the number of
documents, and the packing is worked out on it (``plan``):

* fill a window: the longest length left is taken, then a bitset of reachable
  sums, grown length by length with their counts, picks the multiset that
  comes closest to the capacity; walking back through the bitsets gives how
  many of each length it takes;
* a slack that stays is filled by a cut: the longest piece left is cut, its
  first part goes into the window, the second is a remainder of its length;
* the same filling is used as often as the counts allow, so the number of
  different fillings depends on the window, not on the number of documents;
* a sequence as long as a power of two needs no padding either: what is left
  when no full window can be filled goes into sequences of 2048, 1024, ...

So no sequence is padded, and nearly every document keeps its remainder whole.

The plan says which ranks of which length go where. Documents are ranked among
those of equal remainder by prefix sums over range partitions (copies of one
document, or a third of all rows, stay spread), and an equi-join on the length
with a condition on the rank gives their places. The plan is broadcast: its rows
are bounded by WINDOW * log2(rows).

Tokens are made once: a first pass keeps each document's count, the CRCs of its
full windows and of its remainder, and the remainder's ids, two bytes each (four
if the vocabulary needs them), which only pieces that were cut read again.

Null text is empty. Repeated rows are documents of their own; null ids too.
Documents of any length are worked on a slice at a time. An empty table gives
no rows. Columns of any names pass through.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.indexing import numbered
from quire.session import cut_lineage

WINDOW = 4096
#: Pieces of text whose ids a worker keeps, some 200 bytes each.
CACHED = 800_000
#: Bytes of a piece that is kept.
LONGEST = 64


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# ---- token ids -----------------------------------------------------------------------------------------------------

# Fixed value: the pre-token pattern of the word-level BPE file; a file with another one is encoded by the library alone.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PRETOKEN = regex.compile(PATTERN)


# Bytes by what the pattern makes of them. White space ends a piece, letters and other characters run on, digits stand alone.
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_KIND[48:58] = _DIGIT
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32
# A word with one of these goes through the whole library: apostrophes, which the pattern looks behind; characters
# that aren't letters between U+00C0 and U+023F, whose composition, lower case or kind the library is to say.
_ODD = np.zeros(256, bool)
_ODD[[*range(28, 32), ord("'"), 0xC2, *range(0xC9, 256)]] = True


class Cache:
    """A bounded dictionary of two generations: what is asked for stays, what isn't goes when the younger one is full."""

    def __init__(self, size: int = CACHED):
        self.size, self.new, self.old = size, {}, {}

    def get(self, key):
        value = self.new.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.new) >= self.size // 2:
            self.old, self.new = self.new, {}
        self.new[key] = value


class Tokens:
    """Ids by the tokenizers library, each different piece of text once while it is kept.

    If the tokenizer drops white space and nothing in it spans white space, a text's ids are those of its
    words. A word of ASCII and Latin letters below U+0240, which are their own composed form, is split and
    lower-cased here, many at once, and the library's model is asked for the ids of each piece; any other
    word goes through the whole library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        self.wide = self.library.get_vocab_size(with_added_tokens=True) > 1 << 16
        steps = (data.get("pre_tokenizer") or {}).get("pretokenizers", [])
        kinds = [x["type"] for x in (data.get("normalizer") or {}).get("normalizers", [])]
        split = steps[0] if steps and steps[0]["type"] == "Split" else {}
        added = data.get("added_tokens", [])
        self.by_word = (kinds == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in steps] == ["Split", "ByteLevel"]
                        and split.get("pattern") == {"Regex": PATTERN} and split.get("behavior") == "Removed" and split.get("invert") is True
                        and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"] and not data["model"].get("unk_token")
                        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or any(c.isspace() for c in t["content"]) for t in added))
        self.odd = _ODD.copy()
        self.odd[[t["content"].encode()[0] for t in added]] = True
        self.is_odd = re.compile(b"[" + b"".join(re.escape(bytes([b])) for b in np.flatnonzero(self.odd).tolist()) + b"]|\xc3[\x97\xb7]")
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letter = dict(zip(plain, map(chr, plain))) | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
        self.letters = {chr(b): c for b, c in letter.items()}
        self.table = str.maketrans(self.letters)
        self.known = Cache()

    def _piece(self, piece: bytes) -> bytes:
        if self.is_odd.search(piece):
            ids = self.library.encode(piece.decode("utf-8", "replace"), add_special_tokens=False).ids
        else:
            parts = [piece] if piece.isascii() else [p.encode() for p in _PRETOKEN.findall(piece.decode("utf-8", "replace").lower())]
            ids = [t.id for p in parts for t in self.library.model.tokenize(p.decode("latin-1").translate(self.table))]
        return array("I", ids).tobytes()

    def _pieces(self, texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """The texts' pieces, lower-cased if not odd, and the number of the first piece of each text and of the end."""
        buf = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        kind = _KIND[buf]
        inside = kind != _SPACE
        before = np.concatenate((np.zeros(1, np.uint8), kind[:-1]))
        first = inside & ((kind != before) | (kind == _DIGIT))
        odd = self.odd[buf]
        odd[1:] |= (buf[:-1] == 0xC3) & ((buf[1:] == 0x97) | (buf[1:] == 0xB7))
        small = _SMALL[buf]
        if odd.any():  # a word with an odd byte is one piece, as it is written
            begins = np.flatnonzero(inside & (before == _SPACE))
            ends = np.flatnonzero(~inside & (before != _SPACE))
            for w in np.unique(np.searchsorted(begins, np.flatnonzero(odd), "right") - 1).tolist():
                lo, hi = begins[w], ends[w]
                small[lo:hi] = buf[lo:hi]
                first[lo + 1:hi] = False
        place = np.cumsum(inside)
        starts = np.flatnonzero(first)
        offsets = np.append(place[starts] - 1, place[-1] if len(place) else 0)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(small[inside])])
        length = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        return pieces, np.searchsorted(starts, np.concatenate(([0], np.cumsum(length))))

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """Token ids of each text."""
        if not self.by_word:
            return [np.array(e.ids, np.uint32) for e in self.library.encode_batch([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)]
        pieces, first = self._pieces(texts)
        coded = pieces.dictionary_encode()
        get, put, made = self.known.get, self.known.put, []
        for piece in coded.dictionary.to_pylist():
            ids = get(piece)
            if ids is None:
                ids = self._piece(piece)
                if len(piece) <= LONGEST:
                    put(piece, ids)
            made.append(ids)
        at = coded.indices.to_numpy()
        size = np.fromiter(map(len, made), np.int64, len(made)) // 4
        flat, start = np.frombuffer(b"".join(made), "<u4"), np.concatenate(([0], np.cumsum(size)))[:-1]
        count = size[at]
        end = np.concatenate(([0], np.cumsum(count)))
        ids = flat[np.repeat(start[at] - end[:-1], count) + np.arange(end[-1])]
        return [ids[end[a]:end[b]] for a, b in zip(first[:-1], first[1:])]


@lru_cache(maxsize=2)
def tokens_of(path: str) -> Tokens:
    """One tokenizer, with its caches, per Python worker."""
    return Tokens(path)


_MEASURED = T.StructType([T.StructField("n", T.LongType()), T.StructField("crcs", T.ArrayType(T.LongType())), T.StructField("tail", T.BinaryType())])


def _slices(texts: pa.Array, limit: int = 1 << 21) -> Iterator[list[tuple[int, bytes]]]:
    """(row, text) in lists of about ``limit`` bytes; a longer text in parts, cut at spaces; null as empty."""
    held, size = [], 0
    for row, t in enumerate(texts):
        data, lo = (t.as_py() or "").encode("utf-8", "replace"), 0
        while True:
            hi = len(data)
            if hi - lo > limit:
                hi = data.rfind(b" ", lo + 1, lo + limit)
                hi = hi if hi > 0 else data.find(b" ", lo + limit)
                hi = hi if hi > 0 else len(data)
            held.append((row, data[lo:hi]))
            size, lo = size + hi - lo, hi
            if size >= limit:
                yield held
                held, size = [], 0
            if lo >= len(data):
                break
    if held:
        yield held


def _documents(made: Tokens, texts: pa.Array) -> Iterator[np.ndarray]:
    """The ids of each whole text."""
    parts, row = [], None
    for some in _slices(texts):
        if not made.by_word:  # a tokenizer that may look over spaces gets whole texts
            break
        for (at, _), ids in zip(some, made.ids([data for _, data in some])):
            if at != row and row is not None:
                yield np.concatenate(parts)
                parts = []
            row = at
            parts.append(ids)
    if row is not None:
        yield np.concatenate(parts)
    if not made.by_word:
        for t in texts:
            yield from made.ids([(t.as_py() or "").encode("utf-8", "replace")])


def measured(tokenizer: str, end_id: int, window: int = WINDOW):
    """Column function of a text: its number of tokens with the closing one, the CRC-32 of each full window
    and of the remainder (ids as four bytes each), and the remainder's ids."""
    @F.arrow_udf(_MEASURED)
    def run(texts: pa.Array) -> pa.Array:
        made, out = tokens_of(tokenizer), []
        for ids in _documents(made, texts):
            ids = np.append(ids, end_id).astype("<u4")
            whole = len(ids) // window
            data = memoryview(ids.tobytes())
            crcs = [zlib.crc32(data[k:k + 4 * window]) for k in range(0, len(data), 4 * window)]
            tail = ids[whole * window:]
            out.append((len(ids), crcs, tail.astype("<u4" if made.wide or end_id >> 16 else "<u2").tobytes()))
        return pa.StructArray.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.list_(pa.int64())),
                                           pa.array([o[2] for o in out], pa.binary())], _MEASURED.names)
    return run


# ---- minimum bin slack ---------------------------------------------------------------------------------------------

def closest(lengths: list[int], counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length (given from the longest) make the largest sum up to ``capacity``."""
    goal, mask = 1 << capacity, (1 << capacity + 1) - 1
    reach, grown = 1, []  # grown: (length, copies, the sums reachable before)
    for length in lengths:
        if length > capacity:
            continue
        left, copies = min(counts[length], capacity // length), 1
        while left:  # copies 1, 2, 4, ...: every number up to the count is a sum of some
            copies = min(copies, left)
            grown.append((length, copies, reach))
            reach |= reach << length * copies & mask
            left, copies = left - copies, copies * 2
        if reach & goal:
            break
    at, used = reach.bit_length() - 1, defaultdict(int)
    for length, copies, before in reversed(grown):
        if not before >> at & 1:
            used[length] += copies
            at -= length * copies
    return dict(used)


def plan(histogram: dict[int, int], window: int = WINDOW) -> tuple[list[tuple], int]:
    """Where remainders go, of whose lengths ``histogram`` has the counts; window is a power of two.

    Rows (length, from, to, start, size, sequence, first, each, offset): of the remainders of a length those of
    ranks from <= k < to give their tokens from ``start`` on, ``size`` of them, as the pieces number j = first + k - from
    of their place; piece j stands in sequence ``sequence`` + j // each at ``offset`` + j % each * size.
    Also returns the number of sequences.
    """
    lots: dict[int, list[tuple[int, int, int, int]]] = {n: [(n, 0, c, 0)] for n, c in histogram.items() if c}
    counts = {n: c for n, c in histogram.items() if c}
    lengths = sorted(counts, reverse=True)
    total, rows, sequence = sum(n * c for n, c in counts.items()), [], 0

    def take(length: int, n: int) -> list[tuple[int, int, int, int]]:
        """The next n pieces of a length, as ranges of ranks of the documents they come from."""
        out = []
        counts[length] -= n
        while n:
            origin, lo, hi, start = lots[length].pop()
            if hi - lo > n:
                lots[length].append((origin, lo + n, hi, start))
                hi = lo + n
            out.append((origin, lo, hi, start))
            n -= hi - lo
        if not counts[length]:
            del counts[length], lots[length]
            lengths.remove(length)
        return out

    def put(lot: list, size: int, base: int, each: int, offset: int) -> None:
        first = 0
        for origin, lo, hi, start in lot:
            rows.append((origin, lo, hi, start, size, base, first, each, offset))
            first += hi - lo

    while total:
        capacity = min(window, 1 << total.bit_length() - 1)
        need = {}
        if lengths[0] <= capacity:
            need[lengths[0]] = 1
            counts[lengths[0]] -= 1
        rest = capacity - sum(need)
        for length, n in closest([x for x in lengths if counts[x]], counts, rest).items():
            need[length] = need.get(length, 0) + n
            rest -= length * n
        if need and lengths[0] in need and lengths[0] <= capacity:
            counts[lengths[0]] += 1
        cut = next((x for x in lengths if counts[x] > need.get(x, 0) and x > rest), None) if rest else None
        often = min([counts[x] // (n + (x == cut)) for x, n in need.items()] + ([counts[cut] // (need.get(cut, 0) + 1)] if cut else []))
        if capacity < window:
            often = 1
        offset = 0
        for length, n in need.items():
            put(take(length, n * often), length, sequence, n, offset)
            offset += length * n
        if cut:
            lot = take(cut, often)
            put(lot, rest, sequence, 1, offset)
            short = cut - rest
            if short not in counts:
                counts[short], lots[short] = 0, []
                lengths.append(short)
                lengths.sort(reverse=True)
            counts[short] += often
            lots[short] += [(origin, lo, hi, start + rest) for origin, lo, hi, start in lot]
        sequence += often
        total -= capacity * often
    return rows, sequence


# ---- Spark ---------------------------------------------------------------------------------------------------------

_PLAN = "left long, lo long, hi long, at long, size long, base long, first long, each long, off long"


def pack(docs: DataFrame, tokenizer: str, end_id: int, text_col: str = "text", window: int = WINDOW, out: str = "piece") -> DataFrame:
    """The other columns of ``docs`` for every piece, and ``out`` (replaced if there is one): a struct of
    start, length, ids_crc32, doc_tokens, sequence_id and offset. A document is its text's ids and ``end_id``."""
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if window & window - 1:
        raise ValueError("the window must be a power of two")
    rest = [c for c in docs.columns if c not in (text_col, out)]
    keep = F.struct(*([F.col(f"`{c}`") for c in rest] or [F.lit(None).alias("none")])).alias("keep")  # their names can't clash from here on
    made = cut_lineage(docs.select(keep, measured(tokenizer, end_id, window)(F.col(text_col).cast("string")).alias("m")))
    made = made.select("keep", "m.*", F.monotonically_increasing_id().alias("row"), (F.col("m.n") % window).alias("left"))
    histogram = {r[0]: r[1] for r in made.groupBy("left").count().collect() if r[0]}  # window - 1 rows at most
    rows, n_mixed = plan(histogram, window)
    slim = made.select("keep", "row", F.col("n").alias("doc_tokens"), "crcs", "left", F.floor(F.col("n") / window).cast("long").alias("full"))
    ranked = cut_lineage(numbered(slim, ["left"], ["row"], "rank", running=("full", "before"))[0])
    wide = F.lit(window).cast("long")
    full = (ranked.filter("full > 0").select("keep", "doc_tokens", "before", F.posexplode(F.slice("crcs", F.lit(1), F.col("full").cast("int"))).alias("j", "ids_crc32"))
            .withColumns({"start": F.col("j") * wide, "length": wide, "sequence_id": F.lit(n_mixed).cast("long") + F.col("before") + F.col("j"),
                          "offset": F.lit(0).cast("long")}).select("keep", *names))
    places = F.broadcast(docs.sparkSession.createDataFrame(rows, _PLAN))
    j = F.col("first") + F.col("rank") - F.col("lo")
    met = (ranked.filter("left > 0").join(places, "left").filter("lo <= rank and rank < hi")
           .select("keep", "row", "doc_tokens", "left", "at", (F.col("full") * window + F.col("at")).alias("start"), F.col("size").alias("length"),
                   F.element_at("crcs", -1).alias("ids_crc32"), (F.col("base") + F.floor(j / F.col("each")).cast("long")).alias("sequence_id"),
                   (F.col("off") + j % F.col("each") * F.col("size")).alias("offset")))
    met = cut_lineage(met)
    whole = met.filter("length = left").select("keep", *names)
    width = F.octet_length("tail") / F.col("left")
    part = F.substring("tail", (F.col("at") * width + 1).cast("int"), (F.col("length") * width).cast("int"))
    cut = met.filter("length < left").join(made.select("row", "tail"), "row").withColumn("ids_crc32", _crc(part, width == 2)).select("keep", *names)
    done = full.unionByName(whole).unionByName(cut)
    return done.select(*[F.col(f"keep.`{c}`").alias(c) for c in rest], F.struct(*names).alias(out))


@F.arrow_udf(T.LongType())
def _crc(ids: pa.Array, short: pa.Array) -> pa.Array:
    return pa.array([zlib.crc32(np.frombuffer(x, "<u2" if s else "<u4").astype("<u4").tobytes()) for x, s in zip(ids.to_pylist(), short.to_pylist())], pa.int64())
