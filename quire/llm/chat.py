"""Chat formatting from reply trees: iterative self-joins enumerate root-to-leaf
paths, branches are ranked by score, and each chosen path is formatted as one
conversation.

A message is (conv, msg, parent, score, role, text); its parent is a message of
the same conversation, or null for a root. The joins double the distance each
time: round k knows for every message its ancestor 2**k steps up and the score
on the way, so a tree of depth d needs log2(d) rounds. A leaf's branch scores
the sum of its path; the ``branches`` best of each conversation are kept (ties:
the smaller leaf id first), and only then are their paths written out, again by
doubling. Every table of a round is checkpointed to the shared folder.

Template: ``### <role>: <text></turn>`` and a line feed for each turn. In texts
and roles every backslash is doubled, and each control string (a turn's mark or
end, the special strings of common tokenizers) gets a backslash after its first
character, in roles each colon too; so no control string stands inside a text
and the escape is undone by dropping one backslash of each. The loss mask covers
just the escaped assistant texts.

Formatting streams over rows sorted by conversation and place. A conversation
comes in parts of whole turns of about PART characters (one part, usually), so
a giant conversation needs no giant row.

Defined results: null text or role is empty; null conversation ids are one
conversation, NULL_ID; a message whose parent does not exist is a root;
messages on a cycle have no root and are left out; repeated (conv, msg) rows
count once, the one with the smallest role and text (then parent and score).
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm.common import NULL_ID
from quire.session import cut_lineage

PART = 1 << 20
START, END = "### ", "</turn>"
#: What may not stand in a text as it is.
CONTROL = (START, END, "<|endoftext|>", "<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]")

_CONTROL = re.compile("|".join(map(re.escape, (*CONTROL, "\\"))))
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): (.*?)</turn>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its text begins and ends in it."""
    head = START + escape(role).replace(":", "\\:") + ": "
    body = escape(text)
    return head + body + END + "\n", len(head), len(head) + len(body)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of formatted text."""
    for m in _TURN.finditer(formatted):
        yield unescape(m[1]), unescape(m[2])


def linear_tree(rows: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Messages of plain conversations: each turn replies to the one before it (ties by
    role, then text); null turns come first."""
    order = W.partitionBy("conv").orderBy("turn", "role", "text")
    plain = rows.select(F.coalesce(F.col(conv).cast("long"), F.lit(NULL_ID)).alias("conv"), F.col(turn).alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    msg = plain.withColumn("msg", F.row_number().over(order).cast("long"))
    return msg.select("conv", "msg", F.when(F.col("msg") > 1, F.col("msg") - 1).alias("parent"), F.lit(1.0).alias("score"), "role", "text")


def one_each(messages: DataFrame) -> DataFrame:
    """One row for each (conv, msg): the smallest role and text, null as empty."""
    told = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "parent", "score")
    return messages.groupBy("conv", "msg").agg(F.min(told).alias("m")).select("conv", "msg", "m.parent", "m.score", "m.role", "m.text")


def best_paths(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """(conv, leaf, rank, msg, up): the messages of each chosen path, ``up`` steps above its leaf."""
    messages = one_each(messages)
    nodes = messages.select("conv", "msg", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = nodes.select("conv", F.col("msg").alias("parent"))
    linked = nodes.join(known.withColumn("has", F.lit(True)), ["conv", "parent"], "left")
    nodes = cut_lineage(linked.select("conv", "msg", F.when(F.col("has"), F.col("parent")).alias("parent"), "score"))
    replied = nodes.filter("parent is not null").select("conv", F.col("parent").alias("msg")).distinct()
    leaves = nodes.join(replied, ["conv", "msg"], "left_anti").select("conv", F.col("msg").alias("leaf"), "score")

    # the ancestor 2**k steps up, for k = 0, 1, ...; and for leaves the sum of all scores above
    jumps = [nodes.filter("parent is not null").select("conv", "msg", F.col("parent").alias("above"))]
    step = nodes.select("conv", "msg", F.col("parent").alias("above"), F.col("score").alias("way"))
    total, moving = nodes.count(), step.filter("above is not null").count()
    while moving and 1 << (len(jumps) - 1) <= total:  # only a cycle goes on for longer
        far = step.select("conv", F.col("msg").alias("above"), F.col("above").alias("next"), F.col("way").alias("more"))
        going = step.filter("above is not null").join(far, ["conv", "above"])  # who has come to a root is left alone
        further = going.select("conv", "msg", F.col("next").alias("above"), (F.col("way") + F.col("more")).alias("way"))
        step = cut_lineage(step.filter("above is null").unionByName(further))
        jump = step.filter("above is not null").select("conv", "msg", "above")
        moving = jump.count()
        if moving:
            jumps.append(jump)
    scored = leaves.select("conv", F.col("leaf").alias("msg")).join(step.filter("above is null").select("conv", "msg", "way"), ["conv", "msg"])
    order = W.partitionBy("conv").orderBy(F.desc("way"), "msg")
    ranked = scored.withColumn("rank", F.row_number().over(order))
    chosen = ranked if branches is None else ranked.filter(F.col("rank") <= branches)

    paths = cut_lineage(chosen.select("conv", F.col("msg").alias("leaf"), "rank", "msg", F.lit(0).cast("long").alias("up")))
    for k, jump in reversed(list(enumerate(jumps))):
        higher = paths.join(jump, ["conv", "msg"]).select("conv", "leaf", "rank", F.col("above").alias("msg"), (F.col("up") + (1 << k)).alias("up"))
        paths = cut_lineage(paths.unionByName(higher))
    return paths


_PARTS = "conv_id long, branch long, part long, turns long, text string, loss array<struct<start:int,end:int>>"
_PARTS_ARROW = pa.schema([("conv_id", pa.int64()), ("branch", pa.int64()), ("part", pa.int64()), ("turns", pa.int64()), ("text", pa.string()),
                          ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    who, part, turns, texts, loss, size = None, 0, 0, [], [], 0
    done: list[dict] = []

    def close() -> None:
        nonlocal part, turns, size
        if turns:
            done.append({"conv_id": who[0], "branch": who[1], "part": part, "turns": turns, "text": "".join(texts), "loss": list(loss)})
            part, turns, size = part + 1, 0, 0
            texts.clear()
            loss.clear()

    for batch in batches:
        for conv, branch, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "rank", "role", "text"))):
            if (conv, branch) != who:
                close()
                who, part = (conv, branch), 0
            turn, a, b = format_turn(role, text)
            if role == "assistant":
                loss.append({"start": size + a, "end": size + b})
            texts.append(turn)
            size, turns = size + len(turn), turns + 1
            if size >= PART:
                close()
        if done:
            yield pa.RecordBatch.from_pylist(done, _PARTS_ARROW)
            done = []
    close()
    if done:
        yield pa.RecordBatch.from_pylist(done, _PARTS_ARROW)


def format_conversations(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """(conv_id, branch, part, turns, text, loss): each chosen path of a tree as one
    conversation; loss are the places of assistant texts in ``text``. The parts of a
    conversation are in one partition, in order."""
    paths = best_paths(messages, branches)
    bodies = one_each(messages).select("conv", "msg", "role", "text")
    rows = paths.select("conv", "msg", "rank", "up").distinct().join(bodies, ["conv", "msg"])
    dealt = rows.repartition("conv", "rank").sortWithinPartitions("conv", "rank", F.desc("up"))
    return dealt.select("conv", F.col("rank").cast("long").alias("rank"), "role", "text").mapInArrow(_format, _PARTS)


_DIGEST = "conv_id long, branch long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_DIGEST_NAMES = [f.split()[0] for f in _DIGEST.split(", ")]


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    who, state, done = None, None, []

    def close() -> None:
        if who is not None:
            n, turns, chars, masked, size = state
            done.append((*who, n, turns.hexdigest(), chars, masked.hexdigest(), size))

    for batch in batches:
        for conv, branch, text, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "branch", "text", "loss"))):
            if (conv, branch) != who:
                close()
                who, state = (conv, branch), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, body in read_turns(text):
                state[0] += 1
                state[1].update(f"{role}\n{body}\n".encode("utf-8", "replace"))
            for span in loss:
                body = unescape(text[span["start"]:span["end"]])
                state[2] += len(body)
                state[3].update(body.encode("utf-8", "replace"))
            state[4] += len(text)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], _DIGEST_NAMES)
            done = []
    close()
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], _DIGEST_NAMES)


def digests(formatted: DataFrame) -> DataFrame:
    """What the output of format_conversations says when it is read back."""
    return formatted.select("conv_id", "branch", "text", "loss").mapInArrow(_read_back, _DIGEST)
