"""Packing: ids against the tokenizers library, the plan against exhaustive search, pieces against the documents."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import packing

SCHEMA = "doc_id long, text string"
ODD = ["", " ", "a", "Don't STOP, 12 34!", "Größe ÉTÉ İstanbul", "ΣΑΣ Σ σς", "日本語 テキスト", "é å ﬁ Å", "a b c　d\u0085e", "<|endoftext|> x<|startoftext|>y",
       "<|endof text|>", "tab\tnew\nline  two", "​ zero", "😀👍🏽 ok", "ŉ ǆ ǅ ß ẞ", "x" * 300, "'s 't'll", "1234567890", "\x00\x01", "ab " * 3000, "ʼn ɐ ɏ"]


def place(rows):
    """(length, rank) to its pieces, and sequence to its pieces, of a plan."""
    pieces, sequences = {}, {}
    for length, lo, hi, at, size, base, first, each, off in rows:
        for k in range(lo, hi):
            j = first + k - lo
            pieces.setdefault((length, k), []).append((at, size))
            sequences.setdefault(base + j // each, []).append((off + j % each * size, size))
    return pieces, sequences


def gapless(parts):
    end = 0
    for at, size in sorted(parts):
        assert at == end and size > 0
        end += size
    return end


@pytest.mark.parametrize("window,seed", [(w, s) for w in (4, 16, 128) for s in range(25)])
def test_plan_places_every_token_once_and_pads_nothing(window, seed):
    rng = random.Random(seed)
    histogram = {rng.randrange(1, window): rng.choice((1, 2, 7, 300)) for _ in range(rng.randrange(0, 12))}
    rows, n = packing.plan(histogram, window)
    pieces, sequences = place(rows)
    assert set(pieces) == {(x, k) for x, c in histogram.items() for k in range(c)} and sorted(sequences) == list(range(n))
    assert all(gapless(parts) == x for (x, _), parts in pieces.items())
    sizes = [gapless(parts) for parts in sequences.values()]
    assert all(x <= window and not x & x - 1 for x in sizes) and sum(x < window for x in sizes) < window.bit_length()


def test_plan_grows_with_the_window_only():
    small, large = ({n: c for n in range(1, 256)} for c in (10, 100_000))
    assert len(packing.plan(large, 256)[0]) < 3 * len(packing.plan(small, 256)[0])


def test_closest_against_all_subsets():
    rng = random.Random(8)
    for _ in range(150):
        counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(rng.randrange(1, 5))}
        lengths, capacity = sorted(counts, reverse=True), rng.randrange(1, 60)
        sums = {sum(n * x for n, x in zip(take, lengths)) for take in itertools.product(*[range(counts[x] + 1) for x in lengths])}
        used = packing.closest(lengths, counts, capacity)
        assert sum(n * x for x, n in used.items()) == max(s for s in sums if s <= capacity)
        assert all(n <= counts[x] for x, n in used.items())


def test_ids_as_the_library_gives_them():
    made = packing.Tokens(packing.default_tokenizer())
    assert made.by_word
    rng = random.Random(2)
    texts = ODD + [" ".join(rng.choice(ODD) for _ in range(rng.randrange(1, 9))) for _ in range(300)] + ["".join(chr(rng.randrange(32, 0x2FF)) for _ in range(60)) for _ in range(300)]
    want = [e.ids for e in made.library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # the second time from the caches
        assert [x.tolist() for x in made.ids([t.encode() for t in texts])] == want


def test_other_tokenizers_are_encoded_whole():
    import public_tokenizers
    made = packing.Tokens(public_tokenizers.path("byte_bpe_50k.json"))
    assert not made.by_word
    assert made.ids([b"two words", b""])[0].tolist() == made.library.encode("two words", add_special_tokens=False).ids


def corpus():
    rng = random.Random(12)
    rows = [(i, " ".join(rng.choice(["the", "cat", "Runs", "über", "x1", "?"]) for _ in range(rng.choice((0, 3, 40, 700, 6000))))) for i in range(60)]
    rows += [(100 + i, "same text " * 30) for i in range(200)]  # a hot remainder
    rows += [(None, "no id"), (None, None), (7, None), (8, ""), (9, "twice"), (9, "twice")] + [(300 + i, t) for i, t in enumerate(ODD)]
    return rows


@pytest.mark.parametrize("window", [4096, 64])
def test_pack_against_the_library(spark, window):
    rows = corpus()
    names = ("tail", "n", "keep", "row", "lo", "rank", "base", "offset", "left")
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("mine") for c in names}).repartition(6)
    got = packing.pack(df, packing.default_tokenizer(), 2, window=window)
    assert got.columns == ["doc_id", *names, "piece"]
    assert got.filter(F.least(*[F.col(c) == "mine" for c in names])).count() == got.count()
    got = got.select("doc_id", "piece.*").collect()
    library = packing.tokens_of(packing.default_tokenizer()).library
    docs = {}
    for i, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        docs.setdefault((i, len(ids)), []).append(ids)
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(docs)
    for key, parts in pieces.items():
        assert sum(p[1] for p in parts) == key[1] * len(docs[key])
        for start, length, crc in parts:
            assert any(crc == zlib.crc32(ids[start:start + length].tobytes()) for ids in docs[key])
        if len(docs[key]) == 1:
            assert gapless([p[:2] for p in parts]) == key[1]
    sizes = [gapless(parts) for parts in sequences.values()]
    assert sorted(sequences) == list(range(len(sizes))) and all(x <= window and not x & x - 1 for x in sizes)
    assert sum(x < window for x in sizes) < window.bit_length()


def test_pack_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert packing.pack(none, packing.default_tokenizer(), 2).count() == 0
