"""One dictionary of names for all texts: annotation (C10) and the names found in
a text (C11). The list of a single row is ``functions.text.annotate_names``.

The rule is that of one pass over a text: at each place the longest listed name
that begins there counts, and the pass goes on behind it. Names are literal.

A dictionary may have any size. One of up to ``block_bytes`` of names and notes
goes to the workers as one automaton: one pass without a shuffle or a cut. Of a
larger one, every chunk of rows (about CHUNK_BYTES of text) gets the names whose
first WINDOW characters occur in it: a chunk's different windows of these lengths
meet the names in a join, and the names found travel to the chunk's rows, ahead
of them. A text is moved once and searched once, whatever the dictionary's size,
and no worker holds more than the names of one chunk.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.session import cut_lineage

BLOCK_BYTES = 4 << 20
CHUNK_BYTES = 16 << 20
#: Characters of a name by which it is looked up, and how many different windows a worker holds.
WINDOW, HELD = 16, 500_000
_ready: dict[str, object] = {}          # the automaton of the block at hand, one for each worker


def name_dictionary(entries: DataFrame) -> DataFrame:
    """(name, note) of rows (name, orig, title): one row a name, empty and null names
    left out. Of entries with the same name the smallest (orig, title) counts, nulls
    first; the note is ``（orig，title）``, or ``（title）`` without an orig."""
    named = entries.filter(F.coalesce(F.col("name"), F.lit("")) != "")
    one = named.groupBy("name").agg(F.min(F.struct("orig", "title")).alias("e"))
    orig = F.coalesce(F.col("e.orig"), F.lit(""))
    return one.select("name", F.concat(F.lit("（"), F.when(orig != "", F.concat(orig, F.lit("，"))).otherwise(F.lit("")),
                                       F.coalesce(F.col("e.title"), F.lit("")), F.lit("）")).alias("note"))


def _built(names):
    import ahocorasick
    made = ahocorasick.Automaton()
    for name, note in names:
        made.add_word(name, (len(name), note))
    if len(made):
        made.make_automaton()
    return made


def _automaton(block):
    if _ready.get("block") != block.id:
        _ready.update(block=block.id, automaton=_built(block.names.value))
    return _ready["automaton"]


class _Block:
    """A broadcast block of names, known to the workers by an id of its own."""

    def __init__(self, names, key: str):
        self.names, self.id = names, key


def _hits(automaton, text: str | None) -> list[tuple[int, int, str]]:
    """(at, size, note) in order of place, the longest name for each place."""
    best = {}
    if text and len(automaton):
        for end, (size, note) in automaton.iter(text):
            at = end + 1 - size
            if at not in best or best[at][0] < size:
                best[at] = (size, note)
    return [(at, *best[at]) for at in sorted(best)]


def _annotated(text, hits):
    if not text:
        return text
    parts, last = [], 0
    for at, size, note in hits:
        if at >= last:
            parts += [text[last:at + size], note]
            last = at + size
    return "".join([*parts, text[last:]])


def _names(text, hits):
    if text is None:
        return None
    found, last = set(), 0
    for at, size, _ in hits:
        if at >= last:
            last = at + size
            found.add(text[at:last])
    return sorted(found)


def _meet(block: _Block, make, kind: T.DataType, arrow: pa.DataType):
    """``make(text, hits)`` of every text."""
    def run(texts: pa.Array) -> pa.Array:
        automaton = _automaton(block)
        return pa.array([make(text, _hits(automaton, text)) for text in texts.to_pylist()], arrow)
    return F.arrow_udf(run, kind)


def _windows(lengths: list[int], letters: str):
    """(chunk, part): the different parts of these lengths, in letters of names only, of each chunk's texts;
    now and then one of them again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(f"[{re.escape(letters)}]{{{lengths[0]},}}")
        chunk, seen, parts = None, set(), set()

        def done() -> Iterator[pa.RecordBatch]:
            some = list(parts)
            for k in range(0, len(some), 50_000):
                own = pa.array(some[k:k + 50_000], pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(own), pa.int64()), own], ["chunk", "part"])
            seen.clear()
            parts.clear()

        for batch in batches:
            for mine, text in zip(batch.column("chunk").to_pylist(), batch.column("text").to_pylist()):
                if mine != chunk:
                    yield from done()
                    chunk = mine
                for found in runs.finditer(text or ""):
                    word = found[0]
                    if len(word) <= 64:
                        if word in seen:
                            continue
                        seen.add(word)
                    for size in lengths:
                        for at in range(0, len(word) - size + 1, HELD):  # a stretch of any length by pieces
                            parts.update([word[k:k + size] for k in range(at, min(at + HELD, len(word) - size + 1))])
                            if len(parts) >= HELD:
                                yield from done()
        yield from done()
    return run


def _search(make, arrow: pa.DataType, names: list[str]):
    """``make(text, hits)`` of rows that are sorted by chunk, each chunk's names first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, automaton = None, [], None
        for batch in batches:
            texts, rows, out = batch.column("text").to_pylist(), [], []
            some = zip(batch.column("chunk").to_pylist(), batch.column("name").to_pylist(), batch.column("note").to_pylist())
            for k, (mine, name, note) in enumerate(some):
                if mine != chunk:
                    chunk, held, automaton = mine, [], None
                if name is not None:
                    held.append((name, note))
                    continue
                if automaton is None:
                    automaton, held = _built(held), []
                rows.append(k)
                out.append(make(texts[k], _hits(automaton, texts[k])))
            if rows:
                whole = batch.column("row").take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*whole.flatten(), pa.array(out, arrow)], names)
    return run


def _by_chunks(df: DataFrame, text: Column, names: DataFrame, out_col: str, make, kind: T.DataType,
               arrow: pa.DataType) -> DataFrame:
    df = df.drop(out_col) if out_col in df.columns else df
    row, chunk, part = F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.col("chunk"), F.substring("name", 1, WINDOW)
    # numbers hold only for rows that stay as they are
    rows = cut_lineage(df.select(row.alias("row"), text.cast("string").alias("text"), F.monotonically_increasing_id().alias("at")))
    n, size = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    rows = rows.withColumn("chunk", F.expr(f"at div {max(1, n * CHUNK_BYTES // max(1, size or 0))}"))
    lengths = sorted(r[0] for r in names.select(F.length(part)).distinct().collect())  # WINDOW of them at most
    letters = "".join(sorted(r[0] for r in names.select(F.explode(F.split("name", ""))).distinct().collect()))
    met = (rows.select("chunk", "text").mapInArrow(_windows(lengths, letters), "chunk long, part string")
           .join(names.withColumn("part", part), "part").select("chunk", "name", "note").distinct())
    none = F.lit(None).cast("string")
    both = (met.withColumn("row", F.lit(None).cast(rows.schema["row"].dataType)).withColumn("text", none)
            .unionByName(rows.drop("at").withColumn("name", none).withColumn("note", none)))
    dealt = both.repartition("chunk").sortWithinPartitions(chunk, F.col("name").isNull())
    return dealt.select("chunk", "name", "note", "text", "row").mapInArrow(
        _search(make, arrow, [*df.columns, out_col]), T.StructType([*df.schema, T.StructField(out_col, kind)]))


def _over_names(df: DataFrame, text: Column, names: DataFrame, out_col: str, make, kind: T.DataType,
                arrow: pa.DataType, block_bytes: int) -> DataFrame:
    names = cut_lineage(names.select("name", "note"))
    size = names.agg(F.sum(F.octet_length("name") + F.octet_length("note"))).first()[0] or 0
    if size > block_bytes:
        return _by_chunks(df, text, names, out_col, make, kind, arrow)
    shared = df.sparkSession.sparkContext.broadcast([(r["name"], r["note"]) for r in names.toLocalIterator()])
    return df.withColumn(out_col, _meet(_Block(shared, uuid.uuid4().hex), make, kind, arrow)(text))


def annotate_all(df: DataFrame, text_col: str, names: DataFrame, out_col: str = "annotated",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``df`` with ``out_col``: the text with the note of every name of ``names``
    (name, note; see ``name_dictionary``) behind it. A null text stays null, an empty
    one empty; without names the text is as it was."""
    return _over_names(df, F.col(text_col), names, out_col, _annotated, T.StringType(), pa.string(), block_bytes)


def names_found(df: DataFrame, text_col: str, names: DataFrame, out_col: str = "names",
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``df`` with ``out_col``: the different names that one pass takes, sorted by code
    point; null for a null text."""
    return _over_names(df, F.col(text_col), names, out_col, _names, T.ArrayType(T.StringType()),
                        pa.list_(pa.string()), block_bytes)
