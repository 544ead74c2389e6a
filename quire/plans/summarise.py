"""Extractive summaries of bounded length (K6), scored by TF-IDF over the whole text.

A sentence scores the mean weight of its tokens: how often a token stands in its
own text, times how rare it is in the corpus (``token_weights``: one aggregate
over all texts). All sentences of a text are scored, wherever they stand, and
``sentence_order`` gives their places from the best to the worst. What is made
of that order is a form: sentences taken best first while they fit a number of
characters, or the best few, each put back in the order of the text.

Plan. The texts are hash-partitioned by key once. A task cuts them into tokens by
chunks of a few MB: numbers stand for the tokens, and only a chunk's different tokens,
each once, go to meet their weights. Those that stand in more than a thousandth of all
texts come from a table of bounded size (a thousand times the mean number of
different tokens of a text, whatever the corpus), which is broadcast. Only the others,
slim rows (chunk, token, place), meet their weights in an equi-join. So a token that
every text has makes no hot key, and no shuffle carries a row for each token of a
text. The weights come back to their chunk, where all scores are sums over arrays.

Weights are whole numbers, so that a score does not depend on the order of a sum.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.tokens import char_kinds, cut_tokens, kind_table
from quire.session import cut_lineage, spread

# What ends a sentence (full-width signs too), and the default character budget.
SENTENCE = r"[^.!?。！？\n]+[.!?。！？]*"
BUDGET = 200
_SENTENCE = re.compile(SENTENCE)
#: Token weights (some 50 bytes each) that may be sent to every executor.
BROADCAST_ROWS = 500_000


def sentence_array(text: Column) -> Column:
    """array<string> of the sentences of a text, trimmed, without empty ones."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(SENTENCE), 0)
    return F.filter(F.transform(found, lambda s: F.trim(s)), lambda s: s != "")


def sentence_list(text: str | None) -> list[str]:
    """``sentence_array`` in Python, where it takes a tenth of the time."""
    return [s for s in (m.strip(" ") for m in _SENTENCE.findall(text or "")) if s]


def token_weights(corpus: DataFrame, text_col: str) -> DataFrame:
    """(token, weight, common) over a corpus: weight = 1 + 1000 ln((texts + 1) / (texts with the token + 1)), rounded;
    common: the token is in more than a thousandth of the texts. Materialised; a token that is not in it weighs ``unseen``."""
    n = corpus.count()
    low = spread(corpus.select(text_col)).select(F.lower(F.col(text_col)).alias("low")).filter("low IS NOT NULL")
    seen = low.mapInArrow(_texts_with(char_kinds(corpus.sparkSession)), "token string, texts long").groupBy("token").agg(F.sum("texts").alias("texts"))
    table = seen.select("token", _weight(F.lit(n), F.col("texts")).alias("weight"), (F.col("texts") * 1000 > n).alias("common"))
    return cut_lineage(table.withColumn("unseen", _weight(F.lit(n), F.lit(0))))


def _weight(n: Column, texts: Column) -> Column:
    return F.round(F.log((n + 1).cast("double") / (texts + 1).cast("double")) * 1000).cast("long") + 1


def _by_key(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, text), dealt out by key; the plans of scores and summaries share it."""
    return df.select(F.col(key).alias("key"), F.col(text_col).alias("text")).repartition("key")


def sentence_order(df: DataFrame, key: str, text_col: str, weights: DataFrame | None = None) -> DataFrame:
    """(key, order): the places of each text's sentences, best score first, ties in the text's order.
    Without weights every token weighs the same. Texts of one key count as one, place by place; texts
    without a sentence are left out."""
    kinds = char_kinds(df.sparkSession)
    text = F.col("text")
    # a final sigma depends on what follows, so its sentence is lower-cased by itself
    alone = F.transform(F.regexp_extract_all(text, F.lit(SENTENCE), 0), F.lower)
    low = F.when(F.contains(text, F.lit("Σ")), F.array_join(alone, "\n")).otherwise(F.lower(text))
    texts = _by_key(df, key, text_col).groupBy("key").agg(F.sort_array(F.collect_list(low)).alias("texts"))
    if weights is None:
        order = F.arrow_udf(_even_order(kinds), T.ArrayType(T.IntegerType())).asNondeterministic()  # so that the filter does not run it again
        return texts.select("key", order("texts").alias("order")).filter(F.size("order") > 0).withColumnRenamed("key", key)
    kind = texts.schema["key"].dataType.simpleString()
    # sorted by key, so that a task that runs again makes the same chunks; both readers take all columns, so that they share the exchange
    chunks = texts.sortWithinPartitions("key").mapInArrow(_chunked(kinds), f"chunk long, keys array<{kind}>, {_STATE}").repartition("chunk")
    where = chunks.mapInArrow(_tokens_of, "key long, token string, places array<int>")
    found = [w.select(F.col("key").alias("chunk"), (F.shiftleft(F.col("places")[0].cast("long"), 32) + weight).alias("answer")) for w, weight in _weighed(where, weights)]
    answers = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    answers = answers.groupBy("chunk").agg(F.collect_list("answer").alias("answers"))
    return chunks.join(answers, "chunk", "left").mapInArrow(_chunk_orders(key), T.StructType([
        T.StructField(key, texts.schema["key"].dataType), T.StructField("order", T.ArrayType(T.IntegerType()))]))


#: Bytes of texts in a chunk, whose tokens meet their weights once.
CHUNK = 4 << 20
#: A chunk's tokens, each once, a line each; its texts' numbers of sentences; the sentences' numbers of tokens; and the
#: places in ``tokens`` of all tokens, in two parts, since most are low.
_STATE = "tokens string, sentences array<int>, lengths array<int>, low binary, high binary"


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to chunks."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= CHUNK:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _cut(texts: list[pa.StringArray], table: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """The tokens of lower-cased texts, the sentence of each token, the text of each sentence (as ``sentence_array``
    has them). Batch by batch: what is made of single characters takes many times the room of the text."""
    tokens, sentences, text, rows, n = [pa.array([], pa.string())], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0, 0
    for batch in texts:
        some, sentence, of = _cut_batch(batch, table)
        tokens.append(some)
        sentences.append(sentence + n)
        text.append(of + rows)
        rows += len(batch)
        n += len(of)
    return pa.concat_arrays(tokens).dictionary_encode(), np.concatenate(sentences), np.concatenate(text)


def _cut_batch(texts: pa.StringArray, table: np.ndarray) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    whole = "\n".join([*texts.to_pylist(), ""])
    raw, points = np.frombuffer(whole.encode(), np.uint8), np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    inside = ~np.isin(points, _ENDS) if len(raw) != len(points) else ~_ASCII_ENDS[points]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first = np.flatnonzero(first)
    if not len(first):
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    after = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    kept = np.logical_or.reduceat(inside & (points != 32), first) | (points[after] != 10)
    tokens, begin = cut_tokens(raw, points, table[points])
    sentence = (np.cumsum(kept) - 1)[np.searchsorted(first, begin, "right") - 1]
    ends = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    return tokens, sentence, np.searchsorted(ends, first[kept], "right")


_ENDS = np.array([ord(c) for c in ".!?。！？\n"], np.uint32)
_ASCII_ENDS = np.isin(np.arange(128), _ENDS)


def _texts_with(kinds: tuple[np.ndarray, np.ndarray]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(token, number of texts that have it) by chunk."""
        table = kind_table(kinds)
        for t in _gathered(batches):
            tokens, sentence, text = _cut(t["low"].chunks, table)
            n = len(tokens.dictionary)
            pairs = _distinct(text[sentence] * n + tokens.indices.to_numpy())
            texts = np.bincount(pairs % n, minlength=n) if n else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([tokens.dictionary, pa.array(texts, pa.int64())], ["token", "texts"])
    return run


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _placed(texts: list[pa.ListArray], table: np.ndarray) -> tuple[pa.StringArray, np.ndarray, np.ndarray, np.ndarray]:
    """The tokens of rows of texts, each once; the tokens' places among them, by row and place of the sentence; the
    sentences' numbers of tokens; the rows' numbers of sentences. Texts of one row share their places."""
    counts = np.concatenate([pc.list_value_length(b).to_numpy(zero_copy_only=False) for b in texts])
    row = np.repeat(np.arange(len(counts)), counts)
    tokens, sentence, text = _cut([pc.list_flatten(b) for b in texts], table)
    place = np.arange(len(text)) - np.searchsorted(text, np.arange(len(row)))[text]
    sentences = np.zeros(len(counts), np.int64)
    np.maximum.at(sentences, row[text], place + 1)
    at = ((np.cumsum(sentences) - sentences)[row[text]] + place)[sentence]
    codes = tokens.indices.to_numpy()
    if counts.max(initial=0) > 1:
        codes = codes[np.argsort(at, kind="stable")]
    return tokens.dictionary, codes, np.bincount(at, minlength=sentences.sum()), sentences


def _ordered(codes: np.ndarray, lengths: np.ndarray, sentences: np.ndarray, weights: np.ndarray) -> pa.ListArray:
    """Each row's places, best mean value first; a token's value is its weight times how often the row has it."""
    row = np.repeat(np.arange(len(sentences)), sentences)
    _, pair, times = np.unique(np.repeat(row, lengths) * len(weights) + codes, return_inverse=True, return_counts=True)
    sums = np.append(0, np.cumsum(times[pair] * weights[codes]))
    ends = np.cumsum(lengths)
    total = (sums[ends] - sums[ends - lengths]).astype(np.float64)
    score = np.divide(total, lengths, out=np.zeros(len(total)), where=lengths > 0)
    begin = np.append(0, np.cumsum(sentences))
    place = np.arange(len(row)) - begin[row]
    return pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(place[np.lexsort((place, -score, row))], pa.int32()))


def _even_order(kinds: tuple[np.ndarray, np.ndarray]) -> Callable:
    def run(texts: pa.Array) -> pa.Array:
        tokens, codes, lengths, sentences = _placed([texts], kind_table(kinds))
        return _ordered(codes, lengths, sentences, np.ones(len(tokens), np.int64))
    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return run


def _chunked(kinds: tuple[np.ndarray, np.ndarray]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, task = kind_table(kinds), TaskContext.get().partitionId() << 32
        for k, t in enumerate(_gathered(batches)):
            tokens, codes, lengths, sentences = _placed(t["texts"].chunks, table)
            some = sentences > 0  # a text without a sentence has no order
            keys = t["key"].combine_chunks().filter(pa.array(some))
            one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
            lines = pc.binary_join(one(tokens), "\n")
            # an id of what is in it: were a chunk ever made otherwise the second time, its answers would be missing, not wrong
            mark = hashlib.blake2b(lines[0].as_buffer(), digest_size=8, salt=(task + k).to_bytes(8, "little")).digest()
            yield pa.RecordBatch.from_arrays([pa.array([int.from_bytes(mark, "little", signed=True)], pa.int64()), one(keys), lines, one(pa.array(sentences[some], pa.int32())), one(pa.array(lengths, pa.int32())),
                                              pa.array([codes.astype(np.uint16).tobytes()]), pa.array([(codes >> 16).astype(np.uint16).tobytes()])],
                                             ["chunk", "keys", "tokens", "sentences", "lengths", "low", "high"])
    return run


def _tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, token, its place in the chunk), a row for each of a chunk's tokens."""
    for b in batches:
        for k, chunk in enumerate(b["chunk"].to_pylist()):
            tokens = _lines(b["tokens"][k:k + 1])
            for at in range(0, len(tokens), ROWS):
                some = tokens[at:at + ROWS]
                n = len(some)
                places = pa.ListArray.from_arrays(pa.array(np.arange(n + 1), pa.int32()), pa.array(np.arange(at, at + n), pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, chunk), pa.int64()), some, places], ["key", "token", "places"])


def _lines(text: pa.StringArray) -> pa.StringArray:
    """The lines of one text; none of an empty one."""
    return pc.list_flatten(pc.split_pattern(text, "\n")) if text[0].as_py() else pa.array([], pa.string())


#: Rows of a batch.
ROWS = 50_000


def _chunk_orders(key: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(len(b)):
                keys, sentences, lengths, answers = (b[c][k].values for c in ("keys", "sentences", "lengths", "answers"))
                tokens = _lines(b["tokens"][k:k + 1])
                codes = np.frombuffer(b["low"][k].as_buffer(), np.uint16).astype(np.int64) + (np.frombuffer(b["high"][k].as_buffer(), np.uint16).astype(np.int64) << 16)
                answers = answers.to_numpy() if answers is not None else np.zeros(0, np.int64)
                if len(answers) != len(tokens):
                    raise ValueError(f"{len(answers)} weights for {len(tokens)} tokens")
                weights = np.zeros(len(tokens), np.int64)
                weights[answers >> 32] = answers & 0xFFFFFFFF
                yield pa.RecordBatch.from_arrays([keys, _ordered(codes, lengths.to_numpy().astype(np.int64), sentences.to_numpy().astype(np.int64), weights)], [key, "order"])
    return run


def _weighed(where: DataFrame, weights: DataFrame) -> list[tuple[DataFrame, Column]]:
    """``where`` in one or two parts, each with the column that says the tokens' weights: the first lies as
    ``where`` does, the second, of rare tokens, has been dealt out by token."""
    one = weights.select("unseen").first()  # the same in every row
    unseen = F.lit(one.unseen if one else 1)
    if weights.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return [(where.join(F.broadcast(weights.select("token", "weight")), "token", "left"), F.coalesce(F.col("weight"), unseen))]
    common = F.broadcast(weights.filter("common").select("token", "weight"))
    rare = weights.filter("not common").select("token", "weight")
    here = where.join(common, "token", "left")
    others = where.filter("token IS NOT NULL").join(common, "token", "left_anti").join(rare, "token", "left")
    return [(here.filter("weight IS NOT NULL OR token IS NULL"), F.col("weight")), (others, F.coalesce(F.col("weight"), unseen))]


def in_budget(sentences: list[str], order: Iterable[int], budget: int) -> list[int]:
    """Places, in the text's order, of the best sentences that fit ``budget`` characters, a space between two;
    the first that does not fit ends it, but the best one is always there."""
    places, used = [], -1
    for place in order:
        found = sentences[place] if place < len(sentences) else None  # one key may have texts of different lengths
        used += len(found or "") + 1
        if places and (found is None or used > budget):
            break
        places.append(place)
        if found is None:  # no length is known from here on
            break
    return sorted(places)


def extractive_summary(df: DataFrame, key: str, text_col: str, budget: int = BUDGET, weights: DataFrame | None = None) -> DataFrame:
    """(key, summary, n_sentences) of every text that has a sentence."""
    df = df.filter(F.col(key).isNotNull())
    docs = _by_key(df, key, text_col).withColumnRenamed("key", key)
    summary = F.arrow_udf(_summaries(budget), T.StructType([T.StructField("summary", T.StringType()), T.StructField("n_sentences", T.LongType())]))
    picked = docs.join(sentence_order(df, key, text_col, weights), key).select(key, summary("text", "order").alias("_p"))
    return picked.select(key, "_p.summary", "_p.n_sentences")


def _summaries(budget: int) -> Callable:
    def run(texts: pa.Array, orders: pa.Array) -> pa.Array:
        out = []
        for text, order in zip(texts, orders, strict=True):
            found = sentence_list(text.as_py())
            places = in_budget(found, (k.as_py() for k in order.values), budget)
            out.append((" ".join(found[k] for k in places if k < len(found))[:budget], len(places)))
        return pa.StructArray.from_arrays([pa.array([s for s, _ in out], pa.string()), pa.array([n for _, n in out], pa.int64())], ["summary", "n_sentences"])
    run.__annotations__ = {"texts": pa.Array, "orders": pa.Array, "return": pa.Array}
    return run
