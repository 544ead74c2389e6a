"""Each operator on small tables: nulls, empty and long texts, ties, repeated rows,
empty tables, and columns that clash with the operators' own names."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import bpe, chat, counts, decontam, extract, jaccard, langid, quality, spans, suffix

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").translate(LOW))


def sentence(rng, n=12):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)).capitalize() + "."


def corpus(seed=1):
    """Documents with copies, near copies, shared passages, a hot group, odd rows."""
    rng = random.Random(seed)
    passage = " ".join(sentence(rng) for _ in range(6))
    base = " ".join(sentence(rng) for _ in range(10))
    rows = []
    for i in range(60):
        text = " ".join(sentence(rng) for _ in range(rng.randint(1, 25)))
        if i % 4 == 0:
            text = text + "\n" + passage + "\n" + sentence(rng)
        if i % 3 == 0:  # a third of all rows: copies and near copies of one text
            w = base.split(" ")
            for _ in range(rng.choice((0, 0, 1, 2, 6))):
                w[rng.randrange(len(w))] = "changed" + str(rng.randrange(5))
            text = " ".join(w)
        rows.append((i, text, "en", "s", len(text)))
    rows += [(100, None, None, None, None), (101, "", "en", "s", 0), (102, " \n\t ", "en", "s", 4), (103, "one", "en", "s", 3), (104, "One", "en", "s", 3),
             (105, "word " * 30000, "en", "s", 150000), (None, rows[0][1], "en", "s", 1), (5, rows[5][1], "en", "s", 1), (5, rows[5][1], "en", "s", 1),
             (106, passage.upper() + " " + passage, "en", "s", 2), (107, "é" * 500 + " " + passage, None, "s", 2)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df):
    from pyspark.sql import functions as F
    names = ("id", "fp", "key", "lo", "hi", "spans", "quality", "hits", "measured", "block_0", "n", "sig", "comp", "row", "d_", "language")
    return df.withColumns({n: F.lit("mine") for n in names})


def test_quality_against_plain_python(docs, empty):
    got = {(r.doc_id, r.text): r.q for r in quality.quality_measures(docs, out="q").collect()}
    assert len(got) > 60
    for (_, text), q in got.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        grams = collections.Counter(zip(w, w[1:], w[2:]))
        inside = {k for i in range(len(w) - 2) if grams[w[i], w[i + 1], w[i + 2]] > 1 for k in (i, i + 1, i + 2)}
        assert (q.n_words, q.word_chars, q.n_repeat_words) == (len(w), sum(map(len, w)), len(inside))
        assert q.base_failed == (len(w) < 50 or 100 * len(inside) > 50 * len(w))
        assert not (q.base_failed and q.kept)
        for n in quality.NGRAM_LIMITS:
            g = collections.Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
            cover = {k for i in range(len(w) - n + 1) if g[tuple(w[i:i + n])] > 1 for k in range(i, i + n)}
            assert abs(q[f"cover_{n}"] - sum(len(w[k]) for k in cover) / max(1, sum(map(len, w)))) < 1e-9
    assert quality.quality_measures(empty).count() == 0
    kept = quality.quality_filter(clashing(docs))
    assert kept.columns == clashing(docs).columns and kept.filter("quality = 'mine'").count() == sum(q.kept for q in quality_rows(docs))


def quality_rows(docs):
    return [r.q for r in quality.quality_measures(docs, out="q").collect()]


def components(rows, n, percent):
    sets = []
    for _, text, *_ in rows:
        w = words(text)
        sets.append(frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    up = jaccard.Forest(len(rows))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * len(a | sets[j]):
                up.join(i, j)
    least = {}
    for i, r in enumerate(rows):
        k = jaccard.NULL_ID if r[0] is None else r[0]
        least[up.find(i)] = min(least.get(up.find(i), 1 << 62), k)
    return sorted((jaccard.NULL_ID if r[0] is None else r[0], len(sets[i]), least[up.find(i)]) for i, r in enumerate(rows))


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_jaccard_components(docs, empty, n, percent):
    got = sorted((r.id, r.n_shingles, r.component) for r in jaccard.jaccard_components(docs, percent=percent, n=n).collect())
    assert got == components(corpus(), n, percent)
    assert jaccard.jaccard_components(empty).count() == 0


def test_jaccard_keeps_one_of_a_group(docs):
    kept = jaccard.near_duplicates_kept(clashing(docs), percent=80, n=5)
    assert kept.columns == clashing(docs).columns
    want = [(i, t) for (i, t, *_), (k, _, c) in zip(sorted(corpus(), key=lambda r: (jaccard.NULL_ID if r[0] is None else r[0], r[1] or "")),
                                                  components(sorted(corpus(), key=lambda r: (jaccard.NULL_ID if r[0] is None else r[0], r[1] or "")), 5, 80)) if k == c]
    assert kept.count() == len(want)


def test_one_survivor_a_group_under_null_and_equal_ids(spark):
    rng = random.Random(3)
    texts = [" ".join(sentence(rng) for _ in range(8)) for _ in range(4)]
    near = lambda t, k: t + f" tail{k}."
    rows = [(i, near(texts[g], k), "en", "s", k) for g, i in ((0, None), (1, None), (2, 7)) for k in (0, 1, 1, 2, 2)]
    rows += [(7, texts[3], "en", "s", 1), (None, "", "en", "s", 0), (None, "", "en", "s", 0), (9, near(texts[2], 0), "en", "s", 0)]
    docs = clashing(spark.createDataFrame(rows, SCHEMA).repartition(4))
    kept = jaccard.near_duplicates_kept(docs, percent=80, n=5, repeats=False)
    assert kept.columns == docs.columns
    group = lambda t: next((g for g, x in enumerate(texts) if t.startswith(x)), -1)
    assert sorted((group(r.text), r.doc_id is None) for r in kept.collect()) == [(-1, True), (-1, True), (0, True), (1, True), (2, False), (3, False)]
    kept = [(group(r.text), r.doc_id, r.text) for r in jaccard.near_duplicates_kept(docs, percent=80, n=5).collect()]
    assert [sum(g == x for x, *_ in kept) for g in (0, 1, 3)] == [1, 1, 1] and len({x for x in kept if x[0] == 2}) == 1


@pytest.mark.parametrize("cell,tile", [(3, 4), (2048, 2048)])
def test_jaccard_large_cells_and_many_tiles(docs, monkeypatch, cell, tile):
    monkeypatch.setattr(jaccard, "TILE_DOCS", tile)
    got = sorted((r.id, r.n_shingles, r.component) for r in jaccard.jaccard_components(docs).collect())
    assert got == components(corpus(), 3, 90)


def test_members_of_large_cells_over_many_batches():
    import pyarrow as pa
    rng = np.random.default_rng(1)
    key = np.sort(rng.integers(0, 40, 30000))
    sig = rng.integers(0, 5000, 30000)
    order = np.lexsort((sig, key))
    key, sig = key[order], sig[order]
    batches = [pa.RecordBatch.from_arrays([pa.array(key[i:i + 700]), pa.array(sig[i:i + 700])], ["key", "sig"]) for i in range(0, 30000, 700)]
    old, jaccard.CELL = jaccard.CELL, 500
    try:
        out = list(jaccard._members(iter(batches)))
    finally:
        jaccard.CELL = old
    groups = collections.defaultdict(set)
    for b in out:
        for c, s, h in zip(*(b.column(x).to_pylist() for x in ("cell", "sig", "head"))):
            groups[("cell", c) if c else ("head", h)].add(s)
    want = {frozenset(sig[key == k].tolist()) for k in range(40)}
    small = {frozenset(v) for (kind, _), v in groups.items() if kind == "cell"}
    assert small == {w for w in want if 1 < len(w) <= 500}
    for w in want:
        if len(w) > 500:
            assert w <= groups["head", min(w)]


def test_bands_miss_nothing():
    """Any two sets that link share a cell, also where many shingles fall in few groups."""
    rng = np.random.default_rng(3)
    for percent in (80, 90):
        bands = jaccard.Bands(percent)
        for n in (*range(4, 60), 150, 700):
            for _ in range(6):
                a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
                d = next(d for d in range(len(a), -1, -1) if 100 * (len(a) - d) >= percent * len(a))
                drop = rng.integers(0, d + 1)
                b = a[np.sort(rng.permutation(len(a))[: len(a) - drop])]
                if len(a) >= bands.least and len(b) >= bands.least:
                    assert set(jaccard.cell_keys(a, bands).tolist()) & set(jaccard.cell_keys(b, bands).tolist())


def test_cells_of_many_shingles_miss_nothing_and_part_unrelated_texts():
    """Linking sets that differ on both sides share a cell; sets with one shingle in common don't."""
    rng = np.random.default_rng(5)
    some = lambda n: np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
    met = 0
    for percent in (80, 90):
        bands = jaccard.Bands(percent)
        for n in (*range(bands.least, 60), 94, 141, 210, 211, 700):
            for _ in range(4):
                base, mine, other = some(n), some(n), some(n)
                one = rng.integers(0, n + 1)  # of what may differ, so much on one side
                d = next(d for d in range(n, -1, -1) if 100 * (n - min(d, one)) >= percent * (n + max(0, d - one)))
                a, b = base, np.union1d(base[min(d, one):], other[: max(0, d - one)])
                assert 100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b))
                if len(b) >= bands.least:
                    assert set(jaccard.cell_keys(a, bands).tolist()) & set(jaccard.cell_keys(b, bands).tolist())
        for _ in range(1500):
            a, b = some(150), some(160)
            b[7] = a[5]
            met += bool(set(jaccard.cell_keys(a, bands).tolist()) & set(jaccard.cell_keys(b, bands).tolist()))
    assert met == 0


def benchmark_rows(rows):
    return [("b1", rows[1][1][:150]), ("b2", None), ("b3", ""), ("b4", "one"), (None, rows[2][1][:90]), ("b1", rows[1][1][:150]), ("b5", "never seen words")]


def test_decontamination_against_plain_python(spark, docs, empty, monkeypatch):
    rows = corpus()
    bench = spark.createDataFrame(benchmark_rows(rows), "item_id string, text string")
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = collections.defaultdict(set)
    for item, text in benchmark_rows(rows):
        w = words(text, pattern)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k:k + n])] |= {item} - {None}
    want = []
    for i, text, *_ in rows:
        w, hit, items = words(text, pattern), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    items |= windows[tuple(w[k:k + n])]
        want.append((i or -1, len(w), len(hit), sorted(items)))
    for block in (decontam.BLOCK_BYTES, 100):  # one block, and several
        monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
        found = decontam.contamination(docs, bench, out="h").collect()
        assert sorted((r.doc_id or -1, r.h.n_words, sum(b - a for a, b in r.h.spans), list(r.h.items)) for r in found) == sorted(want)
    clean = decontam.decontaminate(clashing(docs), bench)
    assert clean.columns == clashing(docs).columns
    assert all(not r.h.spans for r in decontam.contamination(clean, bench, out="h").select("h").collect())
    assert decontam.decontaminate(docs, bench, "documents").count() == sum(not w[2] for w in want)
    assert decontam.decontaminate(docs, bench.limit(0)).count() == docs.count()
    assert decontam.contamination(empty, bench).count() == 0


def later_words(rows, n):
    """Words of n-word stretches that occur earlier, by (id, text)."""
    first, out = {}, {}
    texts = sorted({(suffix_id(r[0]), r[1] or "") for r in rows})
    for who, text in texts:
        w = words(text)
        for k in range(len(w) - n + 1):
            first.setdefault(tuple(w[k:k + n]), (who, text, k))
    for who, text in texts:
        w, hit = words(text), set()
        for k in range(len(w) - n + 1):
            if first[tuple(w[k:k + n])] != (who, text, k):
                hit |= set(range(k, k + n))
        out[who, text] = hit
    return out


def suffix_id(i):
    return jaccard.NULL_ID if i is None else i


def test_no_task_of_suffix_dedup_keeps_two_python_steps(docs, monkeypatch):
    monkeypatch.setattr(suffix, "HOT", 2)
    seen, later = [], suffix.later_places
    monkeypatch.setattr(suffix, "later_places", lambda hot: seen.append(hot) or later(hot))
    suffix.remove_repeated_passages(docs)
    plan = seen[0]._jdf.queryExecution().sparkPlan().toString()
    nodes = re.findall(r"MapInArrow|Exchange hashpartitioning", plan)
    assert nodes == ["MapInArrow", "Exchange hashpartitioning", "MapInArrow"]


@pytest.mark.parametrize("hot", [2, 500])
def test_suffix_dedup_against_all_stretches(docs, empty, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT", hot)
    want = later_words(corpus(), suffix.LENGTH)
    got = suffix.repeated_passages(docs, out="spans").collect()
    assert len(got) == len(corpus())
    for r in got:
        hit = {k for a, b in r.spans or [] for k in range(a, b)}
        assert hit == want[suffix_id(r.doc_id), r.text or ""]
    assert suffix.remove_repeated_passages(empty).count() == 0
    done = suffix.remove_repeated_passages(clashing(docs))
    assert done.columns == clashing(docs).columns and done.count() == len(corpus())


def test_sentence_dedup(docs, empty):
    rng = random.Random(1)
    passage = [sentence(rng) for _ in range(6)]
    done = spans.remove_repeated_runs(clashing(docs))
    assert done.columns == clashing(docs).columns
    texts = [r.text for r in done.select("text").collect()]
    assert len(texts) == len(corpus())
    for s in passage:  # each sentence of the shared passage is left in one text (a run into which other words reach is another sentence)
        assert len({t for t in texts if s.lower() in (t or "").lower() and "ééé" not in t}) == 1
    unshared = {r[1] for r in corpus() if r[1] and r[0] is not None and r[0] < 60 and r[0] % 3 and r[0] % 4}
    assert unshared <= set(texts)  # clean documents stay as they are
    assert spans.remove_repeated_runs(empty).count() == 0


def test_bpe_round_trip_and_streaming(docs, empty):
    path = bpe.default_tokenizer()
    from tokenizers import Tokenizer
    library, merges, rng = Tokenizer.from_file(path), bpe.Merges(path), random.Random(2)
    texts = [r[1] or "" for r in corpus()] + ["", " ", "a" * 5000, " " * 3000 + "x", "é" * 2000, "<|endoftext|> a<|endoftext|>", "don't  stop\n\n now"]
    texts += ["".join(rng.choice("abc '.,  \n\t1é中🙂<|") for _ in range(rng.randint(0, 300))) for _ in range(100)]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        for piece in (bpe.PIECE, 700):
            parts = list(bpe.encode(merges, text, piece))
            assert np.frombuffer(b"".join(parts), "<u4").tolist() == want
        back = bpe.Decoder(merges)
        assert "".join(map(back.feed, parts)) + back.finish() == library.decode(want, skip_special_tokens=False) == text
    clash = clashing(docs).withColumns({c: docs.source for c in ("n_tokens", "ids_sha256", "ids")})
    found = bpe.token_digests(clash, path, with_ids=True)
    assert found.columns == [*clash.columns, "tokens"]
    got = found.collect()
    assert len(got) == len(corpus()) and all(r.n_tokens == r.source and r.n == "mine" for r in got)
    for r in got:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert (r.tokens.n_tokens, r.tokens.ids) == (len(ids), ids)
        assert r.tokens.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.tokens.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    ids = bpe.decode_column(bpe.encode_column(docs, path), path)
    assert ids.filter("decoded <> coalesce(text, '')").count() == 0
    assert bpe.token_digests(empty, path).count() == 0


def test_bpe_transducer_against_merging():
    """Every pre-token, short or long, in step or alone, against the plain rule: the earliest merge first."""
    merges, rng = bpe.merges_of(bpe.default_tokenizer()), random.Random(5)
    words = ["".join(rng.choice(s) for _ in range(rng.randint(1, n))).encode() for s, n in
             (("ab", 12), ("aeiorstn", 30), ("é中🙂a", 20), ("=-", 90), ("0123", 40), (" etaoin", 25)) for _ in range(300)]
    words += [bytes([b]) for b in range(256)] + [merges.bytes_of[i] for i in rng.sample(sorted(merges.id_of.values()), 3000)]
    words = list(dict.fromkeys(words))
    want = [np.array(merges.merge(w), "<u4").tobytes() for w in words]
    assert merges.transduce(words) == want
    for w, ids in zip(words[::29], want[::29]):
        run = bpe.Run(merges)
        assert np.array([*run.feed(w), *run.finish()], "<u4").tobytes() == ids
    left, right = (np.array(rng.choices(sorted(merges._left.nonzero()[0].tolist()), k=2000)) for _ in range(2))
    assert merges._stand_beside(left, right).tolist() == [merges.merge(merges.bytes_of[a] + merges.bytes_of[b]) == [a, b] for a, b in zip(left.tolist(), right.tolist())]


def test_bpe_caches_change_nothing(monkeypatch):
    path = bpe.default_tokenizer()
    texts = [(t or "").encode() for _, t, *_ in corpus()] + ["a'll b'x  c\n\nd\t e 12é× ÷ ÆǅßĿ　x\u00a0y\u1680z\x1cq".encode(), b"", b" ", b"\n", b" \n x", b"x \n"]
    want = [x.tolist() for x in bpe.Merges(path).ids(texts)]
    monkeypatch.setattr(bpe, "CACHED", 16)
    monkeypatch.setattr(bpe, "LANES", 90)
    small = bpe.Merges(path)
    assert [x.tolist() for x in small.ids(texts)] == want and len(small.known.new) + len(small.known.old) <= 16
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(path)
    assert want == [library.encode(t.decode(), add_special_tokens=False).ids for t in texts]


def test_token_counts(docs, empty):
    from pyspark.sql import functions as F
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer
    texts = {r[1] for r in corpus() if r[1]}
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"):
        path = public_tokenizers.path(name)
        if name.endswith("json"):
            library = Tokenizer.from_file(path)
            want = {t: len(library.encode(t, add_special_tokens=False).ids) for t in texts}
        else:
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            want = {t: len(model.encode(t)) for t in texts}
        got = docs.select("text", counts.token_count(F.col("text"), path).alias("n")).collect()
        assert all(r.n == (want[r.text] if r.text else 0) for r in got)
        assert empty.select(counts.token_count(F.col("text"), path)).count() == 0


def test_network_gradients():
    net, rng = langid.Network(["a", "b", "c"], hidden=3), np.random.default_rng(0)
    for d in (net.ahead, net.back):
        d.x, d.u = d.x.astype(float), d.u.astype(float)
    net.v, net.c = net.v.astype(float), net.c.astype(float)
    x, mask, y = rng.integers(97, 102, (6, 4)).astype(np.uint8), np.ones((6, 4)), np.array([0, 1, 2, 1])
    _, grads = net.gradients(x, mask, y)
    for value, g in zip(net.parameters(), grads):
        at = tuple(np.argwhere(np.abs(g) > 1e-6)[0])
        value[at] += 1e-5
        up, _ = net.gradients(x, mask, y)
        value[at] -= 2e-5
        down, _ = net.gradients(x, mask, y)
        value[at] += 1e-5
        assert abs((up - down) / 2e-5 - g[at]) < 1e-6


def test_language_id(spark, empty):
    rng = random.Random(4)
    make = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(30))
    rows = [(i, make("abcde" if i % 2 else "vwxyz"), "x" if i % 2 else "y", "s", 1) for i in range(120)]
    rows += [(900, None, "x", "s", 1), (901, "12 .. 34", "x", "s", 1), (902, "", None, "s", 1), (903, make("abcde") * 40, None, "s", 1), (None, make("vwxyz"), None, "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    net = langid.train(docs, ~langid.held_out())
    got = {r.doc_id: r.language for r in langid.predict(clashing(docs).drop("language"), net).collect()}
    assert all(got[i].lang_pred == ("x" if i % 2 else "y") and 0 <= got[i].score <= 1 for i in range(120))
    assert [got[i].lang_pred for i in (900, 901, 902, 903, None)] == ["und", "und", "und", "x", "y"]
    assert langid.train(empty, ~langid.held_out()) is None
    assert {r.language.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}


def test_language_sample_is_bounded(spark, monkeypatch):
    """Repeated rows count once, texts of one id each for itself, null ids like others."""
    seen = {}

    def fit(self, crops, labels):
        for crop, label in zip(crops, labels):
            seen.setdefault(self.labels[int(label)], []).append(crop)
    monkeypatch.setattr(langid.Network, "fit", fit)
    word = lambda i: f"{i:05d} word " * 3
    rows = [(7, word(0), "x", "s", 1)] * 300 + [(7, word(i), "x", "s", 1) for i in range(1, 40)]
    rows += [(None, word(i), "y", "s", 1) for i in range(3)] * 50
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    langid.train(docs, F.lit(True), per_language=10)
    assert len(seen["x"]) == len(set(seen["x"])) == 10
    assert sorted(seen["y"]) == sorted(word(i).encode()[:langid.WINDOW] for i in range(3))


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("lang IS NOT NULL AND length(text) > 60")
    net = langid.train(docs, ~langid.held_out())
    got = langid.predict(docs.filter(langid.held_out()), net).select("lang", "language.lang_pred").collect()
    assert len(got) > 30 and sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)


PAGE = """<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><header><p>Site name and the motto of it</p></header>
<nav><ul><li><a href="/">Home</a></li></ul></nav>%s<footer>&copy; all of it</footer></body></html>"""


def test_extraction():
    body = "<h1>Title &amp; more</h1><p>One <b>two</b>\n three.<p>Short.<div class='advert'>Buy the thing</div><form>Name</form><section id=comments><p>I like it</p></section>"
    assert extract.main_text(PAGE % f"<article>{body}</article>") == "Title & more\nOne two three.\nShort."
    long = "The cat sat on the mat and it was the best of all the cats that we have seen in the town."
    plain = f"<div><h2>Head</h2><p>{long}</p><p>Yes.</p><p>{long}</p></div><div class=sidebar>{long}</div><p><a href=x>{long}</a></p>"
    assert extract.main_text(PAGE % plain) == f"Head\n{long}\nYes.\n{long}"
    assert [extract.main_text(x) for x in (None, "", "<p", "<!-- x", "<script>", "&lt;")] == ["", "", "", "", "", ""]
    assert extract.main_text("<article>" + "<div>" * 5000 + "<p>deep words</p>") == "deep words"


@pytest.mark.parametrize("wrapped", [
    "<div class='has-sidebar'><main><article>%s</article></main></div>", "<div class=content-sidebar-wrap><article>%s</article></div>",
    "<div id='sidebar'><main>%s</main></div>", "<div class='with-header'><article>%s</article></div>",
    "<article class='post comments-open category-search'>%s</article>", "<form action=/><div id=all><article>%s</article></div></form>",
    "<form action=/><div id=all>%s</div></form>", "<div class='widget'><article>%s</article></div>", "<main><form>%s</form></main>"])
def test_wrappers_lose_no_article(wrapped):
    text = "The cat sat on the mat and it was the best of all the cats that we have seen in the town."
    body = f"<p>{text}</p><p>{text} {text}</p><p>{text}</p>"
    rest = "<nav><a href=x>Home</a> and more</nav><div class='ad'>Buy the thing that we have</div><div class='cookie-notice'>We use cookies on this site</div>"
    assert extract.main_text(PAGE % (rest + wrapped % body)) == f"{text}\n{text} {text}\n{text}"


def test_named_boilerplate_still_goes():
    text = "The cat sat on the mat and it was the best of all the cats that we have seen in the town."
    comments = f"<section class=comments><article><p>{text}</p></article><article><p>{text}</p></article></section>"
    for page in (f"<article><p>{text}</p>{comments}</article>", f"<article><p>{text}</p></article><aside><article><p>{text}</p></article></aside>",
                 f"<article><p>{text}</p></article><form><article>{text}</article></form>",
                 f"<article><p>{text}</p><div class='ad-banner'>{text} {text}</div><div id=newsletterSignup>{text}</div></article>"):
        assert extract.main_text(PAGE % page) == text


def test_marked_articles_lose_lists_of_links_only():
    text = "The cat sat on the mat and it was the best of all the cats that we have seen in the town."
    plain = "Subscribe now! Newsletter, special offers, premium access, exclusive deals, free trial, buy tickets online today"
    food = "200 g flour, 100 g butter, 2 eggs, 1 pinch salt, 50 ml milk, vanilla, cinnamon, nutmeg, sugar, raisins, almonds, walnuts, honey"
    cast = "Anna Berg Maria Holm Peter Lund Karl Ek Nils Strand Eva Falk Jan Blom Ida Norr Tom Ask Ulf Sten"
    links = "<a href=x>Football results yesterday</a> Latest scores, tables, fixtures, highlights, interviews"
    page = f"<article><h1>Title</h1><p>{text}</p><p>{text}</p><div>{links}</div><p>{text}</p></article>"
    assert extract.main_text(PAGE % page) == f"Title\n{text}\n{text}\n{text}"
    # no links, no reason: lists before the first and after the last paragraph, names, any language
    for inside in (f"<p>{plain}</p><p>{plain}</p>", f"<p>{text}</p><table><tr><td>{plain}</td></tr></table><p>{text}</p>", f"<p>{plain}</p>",
                   f"<p>{food}</p><p>{text}</p>", f"<p>{text}</p><p>{cast}</p>", f"<h1>Cake</h1><p>{food}</p><h2>Method</h2><p>{text}</p>"):
        assert len(extract.main_text(PAGE % f"<article>{inside}</article>").split("\n")) == sum(inside.count(x) for x in ("<p>", "<td>", "<h1>", "<h2>"))
    one = "<p><a href=x>The whole of this paragraph of the article is a link to the source</a></p>"
    assert extract.main_text(PAGE % f"<article><p>{text}</p>{one}<p>{text}</p></article>").count("\n") == 2
    many = "<ul>" + "".join(f"<li><a href=x>More of the news of the day {k}</a></li>" for k in range(4)) + "</ul>"
    assert extract.main_text(PAGE % f"<article><p>{text}</p>{many}</article>") == text


@pytest.mark.parametrize("inside", [
    "<div class='ad-slot-1'>%s</div>", "<div class='user-comment' id='comment-12'><p>%s</p></div>", "<div class='related-posts'><p>%s</p></div>",
    "<p hidden>%s</p>", "<p style='display: none'>%s</p>", "<h2 aria-hidden=true>%s</h2>", "<button>%s</button>", "<div id=comments-list>%s</div>"])
def test_boilerplate_inside_articles(inside):
    text = "The cat sat on the mat and it was the best of all the cats that we have seen in the town."
    assert extract.main_text(PAGE % f"<article><p>{text}</p>{inside % text}<p>{text}</p></article>") == f"{text}\n{text}"


def test_what_only_looks_like_boilerplate():
    text = "The cat sat on the mat and it was the best of all the cats that we have seen in the town."
    assert extract.main_text(PAGE % f"<article><p>Press <button>Go</button> to <label>Name</label> go on.</p><p>{text}</p></article>") == f"Press to go on.\n{text}"
    lead = f"<article><header><h1>Title</h1><p>By A. Writer</p><p>{text}</p></header><p>{text}</p></article>"
    assert extract.main_text(PAGE % lead) == f"Title\n{text}\n{text}"
    for name in ("post-header-1x", "price-list", "content", "story-body", "css-ad1x"):
        assert extract.main_text(PAGE % f"<article><div class='{name}'><p>{text}</p></div></article>") == text
    short = "<div><p>It rained.</p><p>We stayed in.</p><p>Then it was over.</p></div>"
    assert extract.main_text(PAGE.replace("Site name and the motto of it", "Site") % short) == "It rained.\nWe stayed in.\nThen it was over."


def test_given_pages_keep_every_article_block(spark):
    """The given pages mark their article by its tag: what stands there in a paragraph or heading comes out, in order, and nothing else."""
    import html as entities
    import os
    if not os.path.isdir("/root/testdata/sf0.01"):
        pytest.skip("driver data not present")
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in pages.withColumn("got", extract.extracted(pages.html)).collect():
        article = re.search(r"<article[^>]*>(.*)</article>", r.html or "", re.S)
        blocks = re.split(r"</?(?:p|h\d|div|ul|ol|li|table|tr|td|blockquote|section|aside|form|nav|footer)\b[^>]*>", re.sub(r"<!--.*?-->|<(script|style)\b.*?</\1>", "", article[1], flags=re.S)) if article else []
        want = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks]
        lost = [w for w in want if w and w not in r.got]
        assert not lost, (r.page_id, lost[:2])


@pytest.mark.parametrize("text", [
    "Il gatto era seduto sul tappeto e non si muoveva, perché la casa era fredda e il fuoco nel camino si era spento da molto tempo.",
    "De kat zat op de mat en het was koud in het huis, omdat het vuur in de haard al heel lang geleden uit was gegaan.",
    "Кошка сидела на ковре и не двигалась, потому что в доме было холодно и огонь в камине давно уже погас от ветра.",
    "貓坐在地毯上，一動也不動，因為屋子裡很冷，而壁爐裡的火在很久以前就已經熄滅了，誰也不知道是為了什麼。",
    "고양이는 양탄자 위에 앉아 움직이지 않았다. 집이 추웠고 벽난로의 불은 오래전에 꺼져 있었기 때문이다. 아무도 이유를 몰랐다.",
    "Kass istus vaibal ega liigutanud, sest majas valitses külm, kaminas kustus tuli ammu, keegi teadnud põhjust, öö tuli vaikselt."])
def test_articles_in_other_languages(text):
    menu = "".join(f"<li><a href=/{i}>Item {i}</a></li>" for i in range(5))
    assert extract.main_text(PAGE % f"<ul>{menu}</ul><div><p>{text}</p><p>{text} {text}</p><p>{text}</p></div>") == f"{text}\n{text} {text}\n{text}"


def test_chat_trees(spark):
    rows = [(1, 1, None, 0.0, "user", "hi"), (1, 2, 1, 1.0, "assistant", "a"), (1, 3, 1, 5.0, "assistant", "b ### c</turn>\\"), (1, 4, 3, 0.0, "user", None),
            (2, 1, None, 0.0, "user", "x"), (2, 1, None, 0.0, "user", "x"), (3, 7, 99, 1.0, None, "lost parent"), (4, 1, 2, 1.0, "user", "cycle"), (4, 2, 1, 1.0, "user", "cycle")]
    rows += [(5, i, i - 1 if i else None, 1.0, "assistant" if i % 2 else "user", f"t{i}") for i in range(300)]
    messages = spark.createDataFrame(rows, "conv long, msg long, parent long, score double, role string, text string")
    done = chat.format_conversations(messages, 2).collect()
    turns = {(r.conv_id, r.branch): list(chat.read_turns(r.text)) for r in done}
    assert turns[1, 1] == [("user", "hi"), ("assistant", "b ### c</turn>\\"), ("user", "")]
    assert turns[1, 2] == [("user", "hi"), ("assistant", "a")]
    assert turns[2, 1] == [("user", "x")] and turns[3, 1] == [("", "lost parent")]
    assert turns[5, 1] == [("assistant" if i % 2 else "user", f"t{i}") for i in range(300)]
    assert {c for c, _ in turns} == {1, 2, 3, 5}
    assert chat.digests(chat.format_conversations(messages.limit(0))).count() == 0
    line = chat.linear_tree(spark.createDataFrame([(None, 1, "user", "a"), (None, None, "user", "b"), (None, 1, "user", "a")], "conv_id long, turn long, role string, text string"))
    assert [list(chat.read_turns(r.text)) for r in chat.format_conversations(line).collect()] == [[("user", "b"), ("user", "a"), ("user", "a")]]


def test_chat_repeated_messages_count_once(spark):
    rows = [(1, 1, None, 0.0, "user", "hi"), (1, 2, 1, 5.0, "assistant", "b"), (1, 2, 1, 5.0, "assistant", "b"), (1, 2, 1, 5.0, "assistant", "a"),
            (1, 3, 1, 1.0, "assistant", "second"), (2, 1, None, 0.0, "user", "x"), (2, 1, None, 0.0, "user", "x")]
    rows += [(3, i, i - 1 if i else None, 1.0, "user", f"t{i}") for i in range(20) for _ in range(3)]
    messages = spark.createDataFrame(rows, "conv long, msg long, parent long, score double, role string, text string")
    done = chat.format_conversations(messages, 2).collect()
    assert sorted((r.conv_id, r.branch) for r in done) == [(1, 1), (1, 2), (2, 1), (3, 1)]
    turns = {(r.conv_id, r.branch): [x for _, x in chat.read_turns(r.text)] for r in done}
    assert turns == {(1, 1): ["hi", "a"], (1, 2): ["hi", "second"], (2, 1): ["x"], (3, 1): [f"t{i}" for i in range(20)]}
    assert chat.best_paths(messages, 2).count() == 2 + 2 + 1 + 20


@pytest.mark.parametrize("text", ["", "\\", "### ", "</turn>", "#\\## </turn>\\\\", "<|endoftext|>", "\\### Assistant: </turn> ok", "a: b\n"])
def test_escape_is_undone(text):
    formatted, a, b = chat.format_turn(text, text)
    assert list(chat.read_turns(formatted)) == [(text, text)]
    assert chat.unescape(formatted[a:b]) == text
    assert not any(c in formatted[a:b] for c in chat.CONTROL)


def test_chat_parts(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART", 50)
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"conv": [1] * 20 + [2], "rank": [1] * 21, "role": ["assistant"] * 21, "text": [f"text {i}" for i in range(21)]})
    parts = [r for b in chat._format(iter([batch])) for r in b.to_pylist()]
    assert len(parts) > 5 and [r["part"] for r in parts if r["conv_id"] == 1] == list(range(len(parts) - 1))
    back = [chat.unescape(r["text"][s["start"]:s["end"]]) for r in parts for s in r["loss"]]
    assert back == [f"text {i}" for i in range(21)]


def test_tile_links_across_tiles():
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 1 << 62, 100).astype(np.uint64))
    sets = [np.sort(np.concatenate((rng.permutation(base)[: 100 - k], rng.integers(0, 1 << 62, k).astype(np.uint64)))) for k in (0, 1, 2, 3, 30, 60)]
    up = jaccard.Forest(6)
    for x, y in jaccard.tile_links(sets[:3], sets[3:], 90):
        up.join(x, y)
    for part in (sets[:3], sets[3:]):
        for x, y in jaccard.tile_links(part, None, 90):
            up.join(x + (0 if part is not sets[3:] and len(part) and part[0] is sets[0] else 3), y + (0 if part[0] is sets[0] else 3))
    assert [up.find(i) for i in range(6)] == [0, 0, 0, 0, 4, 5]
