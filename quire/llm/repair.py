"""Conversation structure repair by depth-first branch-and-bound.

Roles of a repaired conversation begin ``s?`` and go on ``(ua)+`` (role initials;
system, user, assistant), or the conversation is empty. Each row is kept (K,
cost 0), given the role user or assistant (R, 3) or deleted (D, 4); rows with an
empty text and one of these roles may be inserted anywhere (I, 3). A row that
stays although truncated costs 3 more. The cheapest edits are taken; among
these, those whose letters in order are least. A row's first fault counts: blank
(only white space; must go), duplicate (role and text seen earlier; must go),
truncated (its last character that is no white space is none of ``.!?``).

Search (``search``). A node is (rows done, state); the state is what stands last:
nothing, s, u or a. An explicit stack holds prefixes of edits. A prefix is given
up if its cost and the suffix lower bound of its node (the cheapest edits of the
rows left if the conversation might end anywhere) exceed the incumbent, if they
equal it and the letters so far are greater, or if its node's dominance table
has a prefix of no greater (cost, letters): the letters fix the state, so what
follows is the same for both. When the stack is empty the incumbent is optimal.

Scale. Rows are ranked by prefix sums over range partitions. A conversation is
cut into segments of SEGMENT rows that are searched apart, for every state
before and after; inserts belong to the row behind them. The segments are put
together by cost and by the order of letters (``chosen``), FAN of them in a
group at most, in as many levels as it takes; so no task gets a whole
conversation, however long, but for its last step: letters and digest of one
conversation are one row, and the digest is taken over its rows as a stream.

Rows are ordered by turn (null first), role and text. Null roles and texts are
taken as one space. A null conversation id is a conversation. Repeated rows are
rows of their own (so duplicates). An empty table gives no rows. Columns beside
conv_id, turn, role and text do not pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.indexing import numbered
from quire.session import cut_lineage

#: Rows that one search takes, and segments that are put together in one group.
SEGMENT, FAN = 512, 1024
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPACE = " \t\n\x0b\f\r"

START, SYSTEM, USER, ASSISTANT, END = range(5)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # of an inserted or renamed row
_KEPT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}


def lower_bounds(rows: str) -> list[tuple[int, int, int, int]]:
    """For each suffix and state the cost of its cheapest edits, if it may end in any state.

    ``rows`` has a letter for each row: x must go, s u a o (other) by role, capital if truncated."""
    out = [(0, 0, 0, 0)]
    for c in reversed(rows):
        after = out[-1]
        cost = [DELETE + after[s] for s in range(4)]
        if c != "x":
            more = TRUNCATED if c.isupper() else 0
            for s in range(4):
                cost[s] = min(cost[s], REROLE + more + after[_NEXT[s]])
                if (kept := _KEPT.get((c.lower(), s))) is not None:
                    cost[s] = min(cost[s], KEEP + more + after[kept])
        out.append(tuple(min(cost[s], INSERT + cost[_NEXT[s]]) for s in range(4)))
    return out[::-1]


def search(rows: str, start: int = START, end: int = END) -> tuple[int, str] | None:
    """The least (cost, letters) that lead from state ``start`` to ``end``; END stands for a
    conversation's end. Unless it is END nothing is inserted behind the last row. None: no way."""
    bound, seen, best = lower_bounds(rows), {}, None
    stack = [(0, start, 0, "")]
    while stack:
        at, state, cost, letters = stack.pop()
        low = cost + bound[at][state]
        if best is not None and (low > best[0] or low == best[0] and letters > best[1][:len(letters)]):
            continue
        table = seen.get((at, state))
        if table is not None and table <= (cost, letters):
            continue
        seen[at, state] = (cost, letters)
        if at == len(rows):
            if state == end or end == END and state in (START, ASSISTANT):
                best = (cost, letters) if best is None else min(best, (cost, letters))
            elif end == END:
                stack.append((at, _NEXT[state], cost + INSERT, letters + "I"))
            continue
        c = rows[at]
        nodes = [(at + 1, state, cost + DELETE, letters + "D"), (at, _NEXT[state], cost + INSERT, letters + "I")]
        if c != "x":
            more = cost + (TRUNCATED if c.isupper() else 0)
            if (kept := _KEPT.get((c.lower(), state))) is not None:
                nodes.append((at + 1, kept, more + KEEP, letters + "K"))
            nodes.append((at + 1, _NEXT[state], more + REROLE, letters + "R"))
        nodes.sort(key=lambda n: (n[2] + bound[n[0]][n[1]], n[3]), reverse=True)  # the most promising is popped first
        stack += nodes
    return best


@lru_cache(maxsize=50_000)
def options(rows: str, first: bool, last: bool) -> list[tuple[int, int, int, str, int]]:
    """Every (start, end, cost, letters, order) of a segment; ``order`` ranks the letters of one start."""
    out = []
    for start in (START,) if first else (START, SYSTEM, USER, ASSISTANT):
        ways = [(e, *found) for e in ((END,) if last else (START, SYSTEM, USER, ASSISTANT)) if (found := search(rows, start, e)) is not None]
        order = {letters: k for k, letters in enumerate(sorted(w[2] for w in ways))}
        out += [(start, e, cost, letters, order[letters]) for e, cost, letters in ways]
    return out


def per_row(rows: str, letters: str, start: int) -> list[str]:
    """What becomes of each row of a segment: inserted rows as u or a, then the row itself
    (= kept, U or A renamed, - deleted); a last entry holds what is inserted behind the last row."""
    out, held, state = [], "", start
    for x in letters:
        if x == "K":
            state = _KEPT[rows[len(out)].lower(), state]
        elif x != "D":
            state = _NEXT[state]
        if x == "I":
            held += _ROLE[state][0]
        else:
            out.append(held + {"K": "=", "D": "-", "R": _ROLE.get(state, "")[:1].upper()}[x])
            held = ""
    return [*out, held]


_OPTIONS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("cost", T.LongType()),
                                     T.StructField("letters", T.StringType()), T.StructField("order", T.IntegerType())]))
_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("letters", pa.string()), ("order", pa.int32())]))


@F.arrow_udf(_OPTIONS)
def _options(rows: pa.Array, first: pa.Array, last: pa.Array) -> pa.Array:
    names = ("start", "end", "cost", "letters", "order")
    return pa.array([[dict(zip(names, o)) for o in options(*x)] for x in zip(rows.to_pylist(), first.to_pylist(), last.to_pylist())], _ARROW)


def put_together(segments: list[list[dict]], start: int) -> dict[int, tuple[int, tuple, list]]:
    """From state ``start`` through segments in order: by end state the least (cost, order of letters) and the (start, end) of each."""
    ways = {start: (0, (), [])}
    for some in segments:
        reached: dict[int, tuple[int, tuple, list]] = {}
        for o in some:
            if (before := ways.get(o["start"])) is None:
                continue
            cost, order = before[0] + o["cost"], (*before[1], o["order"])
            known = reached.get(o["end"])
            if known is None or (cost, order) < known[:2]:
                reached[o["end"]] = (cost, order, [*before[2], (o["start"], o["end"])])
        ways = reached
    return ways


def _whole(segments: pd.DataFrame) -> pd.DataFrame:
    """A group of segments as one: its options."""
    some, out = list(segments.sort_values("seg")["options"]), []
    for start in sorted({o["start"] for o in some[0]}):
        ways = put_together(some, start)
        order = {w[1]: k for k, w in enumerate(sorted(ways.values(), key=lambda w: w[1]))}
        out += [{"start": start, "end": e, "cost": w[0], "letters": None, "order": order[w[1]]} for e, w in ways.items()]
    return pd.DataFrame({"conv": segments["conv"].iloc[:1], "seg": segments["block"].iloc[:1].to_numpy(), "options": [out]})


def _parts(segments: pd.DataFrame) -> pd.DataFrame:
    """The (start, end) of each segment of a group, those of the whole group being given."""
    segments = segments.sort_values("seg")
    start, end = int(segments["start"].iloc[0]), int(segments["end"].iloc[0])
    way = put_together(list(segments["options"]), start)[end][2]
    return pd.DataFrame({"conv": segments["conv"].to_numpy(), "seg": segments["seg"].to_numpy(),
                         "start": [w[0] for w in way], "end": [w[1] for w in way]})


def chosen(segments: DataFrame) -> DataFrame:
    """(conv, seg, start, end) of the best way through each conversation; ``segments`` has (conv, seg, options)."""
    ends = "conv long, seg long, start int, end int"
    grouped = segments.withColumn("block", F.floor(F.col("seg") / FAN).cast("long"))
    if (segments.agg(F.max("seg")).first()[0] or 0) < FAN:
        whole = grouped.select("conv", F.lit(0).cast("long").alias("block"), F.lit(START).alias("start"), F.lit(END).alias("end")).distinct()
    else:
        above = grouped.groupBy("conv", "block").applyInPandas(_whole, T.StructType([T.StructField("conv", T.LongType()), T.StructField("seg", T.LongType()),
                                                                                     T.StructField("options", _OPTIONS)]))
        whole = chosen(cut_lineage(above)).withColumnRenamed("seg", "block")
    return grouped.join(whole, ["conv", "block"]).groupBy("conv", "block").applyInPandas(_parts, ends)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _per_row(rows: pa.Array, letters: pa.Array, start: pa.Array) -> pa.Array:
    return pa.array([per_row(*x) for x in zip(rows.to_pylist(), letters.to_pylist(), start.to_pylist())], pa.list_(pa.string()))


def _flagged(rows: DataFrame) -> DataFrame:
    """(conv, pos, turn, first letter of role, blank, duplicate, truncated) of every row."""
    role, text = F.col("role"), F.col("text")
    key = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    # the first of equal rows by a partial aggregate; joined back on the row, not on what may repeat
    firsts = rows.select("conv", "pos", key.alias("key")).groupBy("conv", "key").agg(F.min("pos").alias("pos")).select("conv", "pos", F.lit(True).alias("fresh"))
    body = F.rtrim(text, F.lit(SPACE))
    ends = F.substring(body, -1, 1).isin(".", "!", "?")
    slim = rows.select("conv", "pos", "turn", F.substring(role, 1, 1).alias("letter"), (body == "").alias("blank"), (~ends).alias("open"))
    found = slim.join(firsts, ["conv", "pos"], "left")
    duplicate = ~F.col("blank") & F.col("fresh").isNull()
    return found.select("conv", "pos", "turn", "letter", "blank", duplicate.alias("duplicate"), (~F.col("blank") & ~duplicate & F.col("open")).alias("truncated"))


def _segments(flagged: DataFrame, size: int) -> DataFrame:
    """(conv, seg, rows, illegal, options); a segment's neighbours come along to tell what stands beside it."""
    letter = F.when(F.col("letter").isin("s", "u", "a"), F.col("letter")).otherwise("o")
    code = F.when(F.col("blank") | F.col("duplicate"), "x").when(F.col("truncated"), F.upper(letter)).otherwise(letter)
    seg, place = F.floor(F.col("pos") / size).cast("long"), F.col("pos") % size
    goes = F.array_compact(F.array(seg, F.when(place == size - 1, seg + 1), F.when((place == 0) & (seg > 0), seg - 1)))
    some = (flagged.select("conv", "pos", letter.alias("letter"), code.alias("code"), F.explode(goes).alias("seg"))
            .groupBy("conv", "seg").agg(F.sort_array(F.collect_list(F.struct("pos", "letter", "code"))).alias("all")))
    mine = F.filter("all", lambda r: F.floor(r["pos"] / size) == F.col("seg"))
    letters = F.array_join(F.transform(F.filter("all", lambda r: r["pos"] < (F.col("seg") + 1) * size), lambda r: r["letter"]), "")
    # of each pair of neighbours the second counts in its segment; looks ahead so that pairs may share a letter
    legal = F.regexp_count(letters, F.lit("s(?=u)|u(?=a)|a(?=u)"))
    some = (some.withColumn("mine", mine).filter(F.size("mine") > 0)
            .select("conv", "seg", F.array_join(F.transform("mine", lambda r: r["code"]), "").alias("rows"),
                    (F.length(letters) - 1 - legal).cast("long").alias("illegal"),
                    (F.element_at("all", -1)["pos"] < (F.col("seg") + 1) * size).alias("last")))
    return some.withColumn("options", _options("rows", F.col("seg") == 0, F.col("last")))


def repair(rows: DataFrame, live: Column | None = None, size: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """Of rows (conv_id, turn, role, text) the conversations and the rows of the repaired ones.

    Conversations: conv_id, conv (a number), gaps, blank, duplicate, truncated, illegal, cost, audit.
    Repaired rows: conv, pos, nth (their order), role, text. A row for which ``live`` is false only
    tells that its conversation is there."""
    given = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), (F.lit(True) if live is None else F.coalesce(live, F.lit(False))).alias("live"))
    ranked, _ = numbered(given, ["conv_id"], [F.desc("live"), F.col("turn").asc_nulls_first(), "role", "text"], "pos", "conv")
    ranked = cut_lineage(ranked)
    kept = ranked.filter("live")
    flagged = cut_lineage(_flagged(kept))
    counts = flagged.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).alias("gaps"),
        *[F.count(F.when(F.col(c), 1)).alias(c) for c in ("blank", "duplicate", "truncated")])
    segments = cut_lineage(_segments(flagged, size))
    alone = (F.col("seg") == 0) & F.col("last")
    one = segments.filter(alone).select("conv", "seg", "rows", "illegal", F.col("options")[0].alias("o"))
    long = segments.filter(~alone)
    slim = long.select("conv", "seg", F.transform("options", lambda o: o.withField("letters", F.lit(None).cast("string"))).alias("options"))
    # whether there are conversations of several segments is one bit for the driver; without them this step has nothing to do
    if not long.limit(1).isEmpty():
        way = long.join(chosen(cut_lineage(slim)), ["conv", "seg"])
        one = one.unionByName(way.select("conv", "seg", "rows", "illegal", F.filter("options", lambda o: (o["start"] == F.col("start")) & (o["end"] == F.col("end")))[0].alias("o")))
    done = cut_lineage(one.select("conv", "seg", "rows", "illegal", "o.start", "o.cost", "o.letters"))
    audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", "letters"))), lambda x: x["letters"]), "")
    sums = done.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), audit.alias("audit"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    conversations = (ranked.filter("pos = 0").select("conv_id", "conv").join(counts, "conv", "left").join(sums, "conv", "left")
                     .select("conv_id", "conv", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                             F.coalesce("audit", F.lit("")).alias("audit")))
    edits = (done.select("conv", "seg", F.posexplode(_per_row("rows", "letters", "start")).alias("k", "edit"))
             .filter("edit <> '-' and edit <> ''").select("conv", (F.col("seg") * size + F.col("k")).alias("pos"), "edit"))
    # a row's edits are one letter for each row that comes of it
    out = (edits.join(kept.select("conv", "pos", "role", "text"), ["conv", "pos"], "left")
           .select("*", F.posexplode(F.split("edit", "")).alias("nth", "x")).filter("x not in ('-', '')"))
    named = F.when(F.lower("x") == "u", "user").when(F.lower("x") == "a", "assistant").otherwise(F.col("role"))
    repaired = out.select("conv", "pos", "nth", named.alias("role"), F.when(F.col("x").isin("u", "a"), "").otherwise(F.col("text")).alias("text"))
    return conversations, repaired


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of each conversation's lines, joined by line feeds; one conversation is open at a time."""
    conv, digest = None, None
    for b in batches:
        out = []
        for c, line in zip(b.column("conv").to_pylist(), b.column("line").to_pylist()):
            if c != conv:
                if digest:
                    out.append((conv, digest.hexdigest()))
                conv, digest = c, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(line.encode("utf-8", "replace"))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string())], ["conv", "digest"])
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([digest.hexdigest()], pa.string())], ["conv", "digest"])


def with_digest(conversations: DataFrame, repaired: DataFrame, out: str = "repaired_sha256") -> DataFrame:
    """Conversations with the digest of their repaired rows, written ``role:text`` and joined by line feeds."""
    lines = repaired.select("conv", "pos", "nth", F.concat("role", F.lit(":"), "text").alias("line"))
    found = lines.repartition("conv").sortWithinPartitions("conv", "pos", "nth").select("conv", "line").mapInArrow(_digests, "conv long, digest string")
    return conversations.join(found, "conv", "left").withColumn(out, F.coalesce("digest", F.sha2(F.lit(""), 256))).drop("digest", "conv")
