"""BPE encoding and decoding as a bounded-lookahead streaming transducer.

Text is fed in pieces of any size and tokens are emitted once no further text
can change them; memory stays constant, however long the text.

* Between pre-tokens: a space before a non-space always begins a pre-token, so
  all text before the last such space is settled. Pieces between two of them that
  were met before are taken from a bounded cache; all others go through the
  transducer.
* Inside a pre-token: any part of a BPE encoding is the encoding of its own
  bytes. So for every prefix the last token is the one token that ends there and
  stands beside the last token of what is left without a merge across. The
  encoding of any longer text goes through one of the last ``lookahead``
  prefixes, ``lookahead`` being the longest token that the merge list can make;
  tokens that the chains of all these prefixes share are settled. An automaton
  over the tokens gives the ones that end at a byte, the longest first, and a
  table which tokens can be neighbours. Pre-tokens are run through it many in
  step, in numpy; one longer than SHORT bytes is run alone (``Run``), so that it
  needs no more memory however long it is. Both are the same transducer.

Decoding joins token bytes and turns them to text with an incremental decoder,
whose state is an unfinished character (ill-formed bytes give U+FFFD).

The merge list is that of a byte-level BPE file of the ``tokenizers`` format;
its path is a parameter and must be readable by the executors. Row-local, no
shuffle. Null text is encoded as empty. Repeated rows each get their result.
Other columns pass through.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a pre-token that is run through the transducer in step with others; a longer one is run alone, byte by byte.
SHORT = 256
#: Pre-tokens that are run in step times the bytes of the longest one, four bytes each.
LANES = 1 << 20
PIECE = 1 << 18
AHEAD = 1 << 19
#: Pieces of text whose ids a worker keeps, some 200 bytes each, and how many bytes such a piece has at most.
CACHED, KEPT = 100_000, 64
_NONE = 1 << 60

# Fixed value: the pre-token pattern that a byte-level tokenizer file means by "use_regex".
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRETOKEN = regex.compile(PATTERN)
# Bytes that begin no white space: a space before one of them begins a pre-token.
_SOLID = np.ones(256, bool)
_SOLID[[*range(33), 0xC2, 0xE1, 0xE2, 0xE3]] = False
# Bytes by what the pattern makes of them, for ASCII and the letters from U+00C0 to U+023F.
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_KIND[48:58] = _DIGIT
# Bytes of which the pattern itself is asked: apostrophes, which it looks behind, and what is neither ASCII nor such a letter.
_ODD = np.zeros(256, bool)
_ODD[[*range(28, 32), ord("'"), 0xC2, *range(0xC9, 256)]] = True
_IN_DOUBT = re.compile(b"[\x1c-\x1f'\xc2\xc9-\xff]|\xc3[\x97\xb7]")
_CLASS = [(regex.compile(r" ?\p{L}+"), regex.compile(r"\p{L}")), (regex.compile(r" ?\p{N}+"), regex.compile(r"\p{N}")),
          (regex.compile(r" ?[^\s\p{L}\p{N}]+"), regex.compile(r"[^\s\p{L}\p{N}]")), (regex.compile(r"\s+"), regex.compile(r"\s"))]


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level files: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Cache:
    """A bounded dictionary of two generations: what is asked for stays, what isn't goes when the younger one is full."""

    def __init__(self, size: int):
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


class _Table:
    """A fixed map of whole numbers, looked up many at once; ``none`` where there is no entry."""

    def __init__(self, entries: dict[int, int], none: int):
        size = 1 << max(8, (4 * len(entries)).bit_length())
        self.shift, self.none = np.uint64(64 - size.bit_length() + 1), none
        self.key, self.value = np.full(size + 64, -1, np.int64), np.full(size + 64, none, np.int64)
        keys = np.fromiter(entries, np.int64, len(entries))
        for at, k in zip(self._slot(keys).tolist(), keys.tolist()):
            while self.key[at] >= 0:
                at += 1
            self.key[at], self.value[at] = k, entries[k]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        got = self.key[slot]
        out = np.where(got == keys, self.value[slot], self.none)
        left = np.flatnonzero((got != keys) & (got >= 0))
        while len(left):
            slot[left] += 1
            got = self.key[slot[left]]
            hit = got == keys[left]
            out[left[hit]] = self.value[slot[left[hit]]]
            left = left[~hit & (got >= 0)]
        return out


class Merges:
    """A byte-level merge list, and the transducer's tables that follow from it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        letters = _byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        vocab = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.id_of = {raw(t): i for t, i in vocab.items() if t not in self.special}
        self.bytes_of = {i: t for t, i in self.id_of.items()} | {i: t.encode() for t, i in self.special.items()}
        self.byte_ids = [self.id_of[bytes([b])] for b in range(256)]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        #: The longest token that merges make: prefixes further back are no longer in doubt.
        self.lookahead = max(len(self.bytes_of[new]) for _, new in self.pairs.values())
        self._beside: dict[tuple[int | None, int], bool] = {}
        self._split = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.known = Cache(CACHED)
        self._decoding()
        self._transducer()

    def merge(self, data: bytes) -> list[int]:
        """The encoding of a short pre-token: the earliest merge of the list first, from the left."""
        ids, get, none = [self.byte_ids[b] for b in data], self.pairs.get, (1 << 60, -1)
        ranks = [get(p, none) for p in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) is not none:
            k = 0
            while best in ranks[k:]:
                k = ranks.index(best, k)
                ids[k:k + 2] = [best[1]]
                del ranks[k]
                if k < len(ranks):
                    ranks[k] = get((ids[k], ids[k + 1]), none)
                if k:
                    ranks[k - 1] = get((ids[k - 1], ids[k]), none)
        return ids

    def _decoding(self) -> None:
        size = np.zeros(max(self.bytes_of) + 1, np.int64)
        for i, t in self.bytes_of.items():
            size[i] = len(t)
        self.size = size
        self.start = np.concatenate(([0], np.cumsum(size)))[:-1]
        self.flat = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(len(size))), np.uint8)

    def bytes_from(self, ids: np.ndarray) -> bytes:
        """The bytes of tokens, one after the other."""
        size = self.size[ids]
        end = np.cumsum(size)
        return self.flat[np.repeat(self.start[ids] - end + size, size) + np.arange(end[-1] if len(end) else 0)].tobytes()

    def _transducer(self) -> None:
        """Tables by number: the merge list by pair, how each token was made, and an automaton that says
        after every byte which is the longest token that ends there (and for each token the next shorter one)."""
        wide = self.wide = len(self.size) + 1
        self.begin = wide - 1  # stands before the first token
        self._rank = _Table({a * wide + b: r for (a, b), (r, _) in self.pairs.items()}, _NONE)
        self._made, self._left, self._right = np.full(wide, -1, np.int64), np.zeros(wide, np.int64), np.zeros(wide, np.int64)
        for (a, b), (rank, new) in self.pairs.items():
            if self._made[new] >= 0 or max(self._made[a], self._made[b]) >= rank:
                raise ValueError("a merge list in which tokens are made in several ways, or before their parts, is not covered")
            self._made[new], self._left[new], self._right[new] = rank, a, b
        # tokens that can stand in an encoding: single bytes, and what the two parts make when nothing merges first
        usable = {self.byte_ids[b]: bytes([b]) for b in range(256)}
        usable |= {new: self.bytes_of[new] for _, new in self.pairs.values()}
        edges, ends, came = {}, {}, [(0, 0)]  # came: the node before and the byte, for each node
        depth = [0]
        for token, data in usable.items():
            at = 0
            for b in data:
                nxt = edges.get(at * 256 + b)
                if nxt is None:
                    nxt = edges[at * 256 + b] = len(came)
                    came.append((at, b))
                    depth.append(depth[at] + 1)
                at = nxt
            ends[at] = token
        fail, longest = [0] * len(came), [-1] * len(came)
        shorter = np.full(wide, -1, np.int64)
        for at in sorted(range(1, len(came)), key=depth.__getitem__):
            before, b = came[at]
            if before:
                back = fail[before]
                while back and back * 256 + b not in edges:
                    back = fail[back]
                fail[at] = edges.get(back * 256 + b, 0)
            longest[at] = ends.get(at, longest[fail[at]])
            if at in ends:
                shorter[ends[at]] = longest[fail[at]]
        self._edge, self._fail, self._longest, self._shorter = _Table(edges, -1), np.array(fail), np.array(longest), shorter
        self._pair, self._fits = np.full(1 << 18, -1, np.int64), np.zeros(1 << 18, bool)  # pairs that were looked at lately

    def _stand_beside(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether pairs of tokens can be neighbours in an encoding: going back through the merges that made
        them, no two parts that met at the border would have merged before one of them went into its token."""
        ok = np.ones(len(left), bool)
        at = np.arange(len(left))
        a, b = left.copy(), right.copy()
        until_a, until_b = np.full(len(a), _NONE, np.int64), np.full(len(a), _NONE, np.int64)
        while len(at):
            rank = self._rank(a * self.wide + b)
            ok[at[(rank < until_a) & (rank <= until_b) & (rank < _NONE)]] = False
            made_a, made_b = self._made[a], self._made[b]
            go_left = made_a > made_b
            until_a, a = np.where(go_left, made_a, until_a), np.where(go_left, self._right[a], a)
            go_right = ~go_left
            until_b, b = np.where(go_right, made_b, until_b), np.where(go_right, self._left[b], b)
            go_on = ok[at] & ((made_a >= 0) | (made_b >= 0))
            at, a, b, until_a, until_b = at[go_on], a[go_on], b[go_on], until_a[go_on], until_b[go_on]
        return ok

    def _compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """As _stand_beside, from a table of pairs; at the beginning (``begin``) a token needs its own parts to fit."""
        key = left * self.wide + right
        slot = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(46)).astype(np.int64)
        out = self._fits[slot]
        new = np.flatnonzero(self._pair[slot] != key)
        if len(new):
            _, first, back = np.unique(key[new], return_index=True, return_inverse=True)
            some = new[first]
            a, b = left[some], right[some]
            fits = np.ones(len(some), bool)
            inner = np.flatnonzero(a != self.begin)
            fits[inner] = self._stand_beside(a[inner], b[inner])
            outer = np.flatnonzero(a == self.begin)
            fits[outer] = [self.merge(self.bytes_of[t]) == [t] for t in b[outer].tolist()]
            out[new] = fits[back]
            self._pair[slot[some]], self._fits[slot[some]] = key[some], fits
        return out

    def transduce(self, words: list[bytes]) -> list[bytes]:
        """The encodings of pre-tokens, all fed byte by byte in step: after every byte each one's last token is
        the one that ends there and can stand beside the last token of what comes before it. At the end the
        chain of last tokens is the encoding."""
        order = sorted(range(len(words)), key=lambda k: -len(words[k]))
        length = np.array([len(words[k]) for k in order], np.int64)
        data = np.frombuffer(b"".join([words[k] for k in order]), np.uint8).astype(np.int64)
        start = np.concatenate(([0], np.cumsum(length)))[:-1]
        last = np.full((int(length[0]) + 1, len(words)), self.begin, np.int32)
        state = np.zeros(len(words), np.int64)
        for n in range(int(length[0])):
            m = int(np.searchsorted(-length, -n, "left"))  # words that go on
            byte, at = data[start[:m] + n], state[:m]
            nxt = self._edge(at * 256 + byte)
            left = np.flatnonzero(nxt < 0)
            while len(left):
                back = self._fail[at[left]]
                at[left] = back
                nxt[left] = self._edge(back * 256 + byte[left])
                left = left[nxt[left] < 0]  # the root has an edge for every byte
            state[:m] = nxt
            token = self._longest[nxt]
            left = np.arange(m)
            while True:
                fits = self._compatible(last[n + 1 - self.size[token[left]], left].astype(np.int64), token[left])
                left = left[~fits]
                if not len(left):
                    break
                token[left] = self._shorter[token[left]]
                if (token[left] < 0).any():
                    raise ValueError("no encoding: the merge list does not make all its tokens")
            last[n + 1, :m] = token
        own, ids, at, place = [], [], np.arange(len(words)), length.copy()
        while len(at):
            token = last[place[at], at].astype(np.int64)
            own.append(at)
            ids.append(token)
            place[at] -= self.size[token]
            at = at[place[at] > 0]
        own, ids = np.concatenate(own[::-1]), np.concatenate(ids[::-1]).astype("<u4")
        ids = ids[np.argsort(own, kind="stable")].tobytes()
        end = 4 * np.cumsum(np.bincount(own, minlength=len(words)))
        out = [b""] * len(words)
        for k, a, b in zip(order, [0, *end[:-1].tolist()], end.tolist()):
            out[k] = ids[a:b]
        return out

    def beside(self, left: int | None, right: int) -> bool:
        """Whether two tokens can be neighbours in an encoding (left None: right begins it)."""
        known = self._beside.get((left, right))
        if known is None:
            if len(self._beside) > CACHED // 4:
                self._beside.clear()
            want = [right] if left is None else [left, right]
            known = self._beside[left, right] = self.merge(b"".join(self.bytes_of[t] for t in want)) == want
        return known

    def _units(self, texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """The texts cut into pre-tokens (where a character is in doubt, into whole pieces between two
        spaces that surely begin pre-tokens); the number of each text's first unit, and of the end."""
        buf = np.frombuffer(b"".join(texts), np.uint8)
        begin = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))))
        if not len(buf):
            return pa.array([], pa.large_binary()), np.zeros(len(begin), np.int64)
        kind = _KIND[buf]
        first = np.ones(len(buf) + 1, bool)
        first[1:-1] = kind[1:] != kind[:-1]
        inner = np.ones(len(buf), bool)  # bytes with one before them in the same text
        inner[begin[:-1][begin[:-1] < len(buf)]] = False
        # the last white space before something else begins a unit: with what follows if it is a space, else alone
        meets = np.flatnonzero((kind[1:] != _SPACE) & (kind[:-1] == _SPACE) & inner[1:]) + 1
        first[meets - 1] = True
        first[meets] = buf[meets - 1] != 32
        odd = _ODD[buf]
        odd[1:] |= (buf[:-1] == 0xC3) & ((buf[1:] == 0x97) | (buf[1:] == 0xB7))
        first[begin] = True
        if odd.any():
            cut = np.zeros(len(buf) + 1, bool)
            cut[:-2] = (buf[:-1] == 32) & _SOLID[buf[1:]]
            cut[begin] = True
            cut = np.flatnonzero(cut)
            for k in np.unique(np.searchsorted(cut, np.flatnonzero(odd), "right") - 1).tolist():
                first[cut[k] + 1:cut[k + 1]] = False
        offsets = np.flatnonzero(first)
        units = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(buf)])
        return units, np.searchsorted(offsets, begin)

    def _learn(self, units: list[bytes]) -> dict[bytes, bytes]:
        """Ids of units that are not in the cache, four bytes each."""
        out, whole, short = {}, {}, {}
        for u in units:
            words = [w.encode("utf-8", "replace") for w in _PRETOKEN.findall(u.decode("utf-8", "replace"))] if _IN_DOUBT.search(u) else [u]
            if len(words) > 1:
                whole[u] = words
            for w in words:
                ids = self.known.get(w)
                if ids is not None:
                    out[w] = ids
                elif len(w) <= SHORT:
                    short[w] = None
                elif w not in out:
                    run = Run(self)
                    out[w] = np.array([*run.feed(w), *run.finish()], "<u4").tobytes()
        short, k = sorted(short, key=len, reverse=True), 0
        while k < len(short):  # long ones by few, short ones by many
            some = short[k:k + max(1, LANES // (len(short[k]) + 1))]
            out.update(zip(some, self.transduce(some)))
            k += len(some)
        for u, words in whole.items():
            out[u] = b"".join([out[w] for w in words])
        for u, ids in out.items():
            if len(u) <= KEPT:
                self.known.put(u, ids)
        return out

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of texts without special tokens that begin and end between pre-tokens."""
        units, first = self._units(texts)
        coded = units.dictionary_encode()
        names = coded.dictionary.to_pylist()
        made = list(map(self.known.get, names))
        new = [k for k, ids in enumerate(made) if ids is None]
        found = self._learn([names[k] for k in new])
        for k in new:
            made[k] = found[names[k]]
        at = coded.indices.to_numpy()
        size = np.fromiter(map(len, made), np.int64, len(made)) // 4
        flat, start = np.frombuffer(b"".join(made), "<u4"), np.concatenate(([0], np.cumsum(size)))[:-1]
        count = size[at]
        end = np.concatenate(([0], np.cumsum(count)))
        ids = flat[np.repeat(start[at] - end[:-1], count) + np.arange(end[-1])]
        where = end[first]
        return [ids[a:b] for a, b in zip(where[:-1], where[1:])]

    def settled(self, text: str) -> bytes:
        """Ids of one text without special tokens that begins and ends between pre-tokens."""
        return self.ids([text.encode("utf-8", "replace")])[0].tobytes()


class Run:
    """The inside of one pre-token of any length, fed as bytes."""

    def __init__(self, merges: Merges):
        self.m, self.before = merges, None  # the last token emitted
        self.data, self.last = bytearray(), []  # bytes not emitted; the last token of each prefix of them

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        for b in data:
            self.data.append(b)
            n = len(self.data)
            for size in range(1, min(n, self.m.lookahead) + 1):
                token = self.m.id_of.get(bytes(self.data[n - size:]))
                if token is not None and self.m.beside(self.last[n - size - 1] if n > size else self.before, token):
                    self.last.append(token)
                    break
            else:
                raise ValueError("no encoding: the merge list does not make all its tokens")
            if n >= 8 * self.m.lookahead:
                out += self._emit()
        return out

    def _back(self, n: int) -> int:
        return n - len(self.m.bytes_of[self.last[n - 1]])

    def _chain(self, n: int) -> list[int]:
        out = []
        while n > 0:
            out.append(self.last[n - 1])
            n = self._back(n)
        return out[::-1]

    def _emit(self) -> list[int]:
        """What the chains of all prefixes within the lookahead share."""
        n = len(self.data)
        ends = set(range(n - self.m.lookahead + 1, n + 1))
        while len(ends) > 1:
            far = max(ends)
            ends.remove(far)
            ends.add(self._back(far))
        at = ends.pop()
        out = self._chain(at)
        if out:
            self.before = out[-1]
            del self.data[:at], self.last[:at]
        return out

    def finish(self) -> list[int]:
        out = self._chain(len(self.data))
        self.data, self.last, self.before = bytearray(), [], None
        return out


class Encoder:
    """Streaming encoder of one text; ids come as little-endian unsigned 32-bit integers."""

    def __init__(self, merges: Merges):
        self.m, self.tail = merges, ""
        self.run: Run | None = None  # a pre-token that is too long to wait for
        self.kind = None

    def feed(self, text: str) -> bytes:
        """Text without special tokens (see encode); returns the ids that are settled by it."""
        out = self._go_on(text) if self.run else None
        if out is not None:
            done, text = out
            if self.run:
                return done
        else:
            done = b""
        self.tail += text
        if len(self.tail) <= 4 * SHORT:
            return done
        cut = self.tail.rfind(" ", 0, len(self.tail) - 1)
        while cut > 0 and self.tail[cut + 1].isspace():
            cut = self.tail.rfind(" ", 0, cut)
        if cut > 0:
            done += self.m.settled(self.tail[:cut])
            self.tail = self.tail[cut:]
        if len(self.tail) > 4 * SHORT:
            last = None
            for last in _PRETOKEN.finditer(self.tail):
                pass
            done += self.m.settled(self.tail[:last.start()])
            self.tail = self.tail[last.start():]
            if len(self.tail) > 2 * SHORT:
                self.kind = next(one for whole, one in _CLASS if whole.fullmatch(self.tail))
                self.run, text, self.tail = Run(self.m), self.tail, ""
                more, rest = self._go_on(text)
                done += more
                assert not rest
        return done

    def _go_on(self, text: str) -> tuple[bytes, str]:
        """Continues the long pre-token; the ids settled, and the text after its end.
        Of white space the last character waits in the tail: it may belong to the next word."""
        space = self.kind is _CLASS[3][1]
        text, self.tail = self.tail + text, ""
        end = 1 if text[:1] == " " and not self.run.last and self.run.before is None else 0
        while end < len(text) and self.kind.match(text[end]):
            end += 1
        if end < len(text):
            rest = text[end:]
            if space and end:
                end, rest = end - 1, text[end - 1:]
            ids = [*self.run.feed(text[:end].encode("utf-8", "replace")), *self.run.finish()]
            self.run = None
            return np.array(ids, "<u4").tobytes(), rest
        if space:
            end, self.tail = end - 1, text[-1:]
        return np.array(self.run.feed(text[:end].encode("utf-8", "replace")), "<u4").tobytes(), ""

    def finish(self) -> bytes:
        done = b""
        if self.run:
            ids = [*self.run.feed(self.tail.encode("utf-8", "replace")), *self.run.finish()]
            done = np.array(ids, "<u4").tobytes()
        elif self.tail:
            done = self.m.settled(self.tail)
        self.run, self.tail = None, ""
        return done


def encode(merges: Merges, text: str, piece: int = PIECE) -> Iterator[bytes]:
    """Ids of a text, in parts. Special tokens standing in the text are found first, as the format demands."""
    at, parts = 0, []
    if any(s in text for s in merges.special):
        for m in merges._split.finditer(text):
            parts += [(at, m.start(), None), (0, 0, merges.special[m.group()])]
            at = m.end()
    for lo, hi, special in [*parts, (at, len(text), None)]:
        if special is not None:
            yield np.array([special], "<u4").tobytes()
        elif hi - lo <= piece:
            if hi > lo:
                yield merges.settled(text[lo:hi])
        else:
            encoder = Encoder(merges)
            for k in range(lo, hi, piece):
                yield encoder.feed(text[k:min(k + piece, hi)])
            yield encoder.finish()


class Decoder:
    """Streaming decoder: ids in, text out; holds an unfinished character at most."""

    def __init__(self, merges: Merges):
        self.m = merges
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: bytes) -> str:
        return self.state.decode(self.m.bytes_from(np.frombuffer(ids, "<u4")))

    def finish(self) -> str:
        return self.state.decode(b"", True)


@lru_cache(maxsize=4)
def merges_of(path: str) -> Merges:
    """One merge list, with its caches, per Python worker."""
    pa.default_memory_pool().release_unused()  # a worker may come from another stage
    return Merges(path)


def _encoded(m: Merges, texts: pa.Array) -> Iterator[Iterable[bytes]]:
    """For each text its ids in parts. Texts are worked on together, some half a million characters ahead;
    one that is longer than PIECE, or holds a special token, is streamed by itself."""
    held, size = [], 0

    def done() -> Iterator[Iterable[bytes]]:
        alone = [len(t) > PIECE or any(x in t for x in m.special) for t in held]
        ids = iter(m.ids([t.encode("utf-8", "replace") for t, a in zip(held, alone) if not a]) if not all(alone) else [])
        for t, a in zip(held, alone):
            yield encode(m, t) if a else (next(ids).tobytes(),)

    for t in texts:
        held.append(t.as_py() or "")
        size += len(held[-1])
        if size >= AHEAD:
            yield from done()
            held, size = [], 0
    yield from done()


_DIGEST = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                        T.StructField("decoded_sha256", T.StringType())])


def token_digests(docs: DataFrame, tokenizer: str, text_col: str = "text", out: str = "tokens", with_ids: bool = False) -> DataFrame:
    """``docs`` with ``out`` (replaced if there is one): a struct of n_tokens, ids_sha256 (of the ids as four bytes
    each), decoded_sha256 (of the text that the ids give back) and, if asked for, the ids."""
    kind = T.StructType([*_DIGEST, T.StructField("ids", T.ArrayType(T.IntegerType()))]) if with_ids else _DIGEST

    @F.arrow_udf(kind)
    def digest(texts: pa.Array) -> pa.Array:
        m, out, kept = merges_of(tokenizer), [], []
        for parts in _encoded(m, texts):
            n, ids_hash, text_hash, decoder, own = 0, hashlib.sha256(), hashlib.sha256(), Decoder(m), []
            for ids in parts:
                n += len(ids) // 4
                ids_hash.update(ids)
                text_hash.update(decoder.feed(ids).encode())
                if with_ids:
                    own.append(ids)
            text_hash.update(decoder.finish().encode())
            out.append((n, ids_hash.hexdigest(), text_hash.hexdigest()))
            kept.append(np.frombuffer(b"".join(own), "<i4"))
        columns = [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string()))]
        return pa.StructArray.from_arrays([*columns, *([pa.array(kept, pa.list_(pa.int32()))] if with_ids else [])], kind.names)

    return docs.withColumn(out, digest(F.col(text_col).cast("string")))


def encode_column(docs: DataFrame, tokenizer: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with column ``out``: the token ids of the text (null: none)."""
    @F.arrow_udf(T.ArrayType(T.LongType()))
    def ids(texts: pa.Array) -> pa.Array:
        m = merges_of(tokenizer)
        return pa.array([np.frombuffer(b"".join(parts), "<u4").astype(np.int64) for parts in _encoded(m, texts)], pa.list_(pa.int64()))

    return docs.withColumn(out, ids(F.col(text_col).cast("string")))


def decode_column(docs: DataFrame, tokenizer: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with column ``out``: the text of the token ids (null: empty)."""
    @F.arrow_udf(T.StringType())
    def text(ids: pa.Array) -> pa.Array:
        m, done = merges_of(tokenizer), []
        for some in ids.to_pylist():
            d = Decoder(m)
            done.append(d.feed(np.array(some or [], "<u4").tobytes()) + d.finish())
        return pa.array(done, pa.string())

    return docs.withColumn(out, text(F.col(ids_col).cast("array<bigint>")))
