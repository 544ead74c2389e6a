"""Text enrichment re-aimed as table jobs.

Model calls are an injected ``completer`` (M1): a function from a pandas batch
(columns key, task, prompt) to the same batch plus ``response``. It runs in
``mapInPandas`` over the prompt table, so calls are spread over tasks and
batched by Arrow (batches are capped by rows and by
``spark.sql.execution.arrow.maxBytesPerBatch``, so long articles do not
make huge batches); rows of a failing batch are retried one by one, and rows that still fail keep
``status``/``error`` instead of stopping the job. The built-in completers
are deterministic so results can be checked.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.tokens import py_tokens
from quire.plans.summarise import SENTENCE, sentence_order

# The four per-article tasks and their length limits.
ARTICLE_TASKS = [
    ("what_happen_50", "In at most 50 characters, state what happened.", 50),
    ("what_happen_200", "In 150 to 200 characters, summarise what happened.", 200),
    ("key_facts", "List at most 5 key facts, each at most 100 characters.", 500),
    ("stance", "Describe the position of each party mentioned.", 500),
]
# The three per-topic tasks.
TOPIC_TASKS = [
    ("normal", "Write an abstract of the topic from these article notes."),
    ("timeline", "Build a dated timeline of events from these article notes."),
    ("stance", "Merge the positions of each party across these article notes."),
]

# The labels of an article's notes in a group prompt.
NOTE_LABELS = [("事件摘要: ", "what_happen_200"), ("關鍵事件: ", "key_facts"), ("立場文: ", "stance")]

Completer = Callable[[pd.DataFrame], pd.DataFrame]


# The form of each task's answer: characters in all, or items of so
# many characters (of sentences that name a speaker, for stances).
FORMS = {"what_happen_50": ("chars", 50), "what_happen_200": ("chars", 200), "key_facts": ("items", 100),
         "stance": ("spoken", 100), "normal": ("chars", 200), "timeline": ("items", 100),
         "ver1": ("chars", 200), "ver2": ("items", 100)}
MAX_ITEMS = 5
_SENTENCE = re.compile(SENTENCE)


def _own_order(found: list[str]) -> list[int]:
    """Sentences by the mean number of times their tokens stand in the text, for texts that come without an order."""
    each = [py_tokens(s) for s in found]
    times = Counter(t for some in each for t in some)
    score = [sum(times[t] for t in some) / len(some) if some else 0.0 for some in each]
    return sorted(range(len(found)), key=lambda k: (-score[k], k))


def answer(task: str, text: str, order: Iterable[int] | None = None) -> str:
    """The built-in extractive answer (K6) to a task, from the whole text: its best sentences in the
    task's form, put back in the text's order. ``order`` has their places from the best on."""
    form, size = FORMS.get(task, ("chars", 200))
    found = [s for s in (m.strip(" ") for m in _SENTENCE.findall(text)) if s]
    order = [int(k) for k in order] if order is not None else _own_order(found)
    if form == "chars":
        picked, used = [], -1
        for k in order:
            used += len(found[k]) + 1
            if picked and used > size:
                break
            picked.append(k)
        return " ".join(found[k] for k in sorted(picked))[:size]
    if form == "spoken":
        order = [k for k in order if any(c in found[k] for c in (":", "：", '"'))]
    return "\n".join(found[k][:size] for k in sorted(order[:MAX_ITEMS]))


def extractive_completer(batch: pd.DataFrame) -> pd.DataFrame:
    """A stand-in for a model that takes its answers from the prompt's text; column ``order``, if
    there, has the places of the text's sentences from the best on (``summarise.sentence_order``)."""
    parts = [(p or "").split("\n\n", 1)[-1] for p in batch["prompt"]]
    orders = batch["order"] if "order" in batch else [None] * len(batch)
    return batch.assign(response=[answer(t, x, o) for t, x, o in zip(batch["task"], parts, orders)])


def with_order(df: DataFrame, key: str, text_col: str, weights: DataFrame) -> DataFrame:
    """``df`` with column ``order`` of its texts' sentences, scored with a corpus's token weights; ``key`` is unique."""
    return df.drop("order").join(sentence_order(df, key, text_col, weights), key, "left").withColumn(
        "order", F.coalesce("order", F.array().cast("array<int>")))


def task_prompts(df: DataFrame, key: str, text_col: str,
                 tasks: list[tuple] | None = None) -> DataFrame:
    """One row per (key, task): instruction + blank line + text (K1).
    The task list is a literal array exploded per row, not a join. A column
    ``order`` (see ``with_order``) goes along."""
    tasks = tasks or ARTICLE_TASKS
    arr = F.array(*[F.struct(F.lit(t[0]).alias("task"), F.lit(t[1]).alias("instruction")) for t in tasks])
    order = ["order"] if "order" in df.columns else []
    return (df.select(key, *order, F.col(text_col).alias("_text"), F.explode(arr).alias("t"))
              .select(key, *order, F.col("t.task").alias("task"),
                      F.concat(F.col("t.instruction"), F.lit("\n\n"), F.coalesce(F.col("_text"), F.lit("")))
                      .alias("prompt")))


def complete(prompts: DataFrame, key: str, completer: Completer = extractive_completer,
             retries: int = 3, backoff: float = 0.5) -> DataFrame:
    """Run the completer over the prompt table (K4): (key, task, prompt,
    response, status, error). When a batch fails its rows are called one by one,
    each retried with exponential backoff; what still fails keeps its error."""
    given = [key, "task", "prompt", *(["order"] if "order" in prompts.columns else [])]
    key_type = prompts.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, task string, prompt string, response string, status string, error string"

    def run(batches):
        for b in batches:
            b = b[given]
            try:
                parts = [completer(b).assign(status="ok", error=None)]
            except Exception:  # one bad row must not cost its neighbours: each row on its own
                parts = [alone(b.iloc[i:i + 1]) for i in range(len(b))]
            for res in parts:
                yield res[[key, "task", "prompt", "response", "status", "error"]]

    def alone(row):
        last = None
        for attempt in range(retries):
            try:
                return completer(row).assign(status="ok", error=None)
            except Exception as e:  # keep going; record the failure
                last = e
                time.sleep(backoff * (2 ** attempt))
        return row.assign(response=None, status="error", error=repr(last))
    return prompts.select(*given).mapInPandas(run, schema)


def responses_to_columns(done: DataFrame, key: str, tasks: list[str]) -> DataFrame:
    """One column per task (K5): pivot with the task list given, so the
    planner needs no extra pass to find the values; ``status`` is ok if all
    tasks are, and ``error`` holds the distinct errors."""
    wide = [F.max(F.when(F.col("task") == t, F.col("response"))).alias(t) for t in tasks]
    status = F.when(F.max(F.col("status") != "ok"), "error").otherwise("ok").alias("status")
    return done.groupBy(key).agg(*wide, status, F.array_join(F.array_sort(F.collect_set("error")), "; ").alias("error"))


def ordered_concat(df: DataFrame, group: list[str], order: list[Column | str], value: Column,
                   sep: str, name: str) -> DataFrame:
    """Rows of a group folded into one string in a stated order.
    ``sort_array`` over (order..., value) structs gives the order; this is a
    per-group result, so its size is that of the group's text."""
    s = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order], value.alias("_v"))
    return df.groupBy(*group).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(s)), lambda x: x["_v"]), sep).alias(name))


# A date written in full, the sign between a party and its words, parties left out of stance tables.
FULL_DATE = r"(?U)(\d{4})年(\d{1,2})月(\d{1,2})日"
PARTY_LINE = r"^([^：]+)：(.+)$"
LEFT_OUT = ["新聞媒體", "網友", "居民"]


def dated_events(df: DataFrame, key: str, text_col: str, order: list[str]) -> DataFrame:
    """(key, day, place..., event): the sentences of a text that name a full date."""
    parts = F.filter(F.transform(F.split(F.col(text_col), r"[。\n]", -1), lambda x: F.trim(x)), lambda x: x != "")
    each = df.select(key, *order, F.posexplode(parts).alias("place", "event"))
    digits = lambda n: F.translate(F.regexp_extract("event", FULL_DATE, n), "０１２３４５６７８９", "0123456789")
    day = F.try_to_date(F.concat_ws("-", digits(1), digits(2), digits(3)), "yyyy-M-d")
    return each.withColumn("day", day).filter(F.col("day").isNotNull())


def timeline(df: DataFrame, key: str, text_col: str, order: list[str]) -> DataFrame:
    """(key, day, events): dated events merged per day."""
    return ordered_concat(dated_events(df, key, text_col, order), [key, "day"], [*order, "place"], F.col("event"), " ", "events")


def stances(df: DataFrame, key: str, text_col: str, order: list[str], left_out: list[str] | None = None) -> DataFrame:
    """(key, party, statements): lines ``party：words`` merged per party, less the parties left out."""
    each = df.select(key, *order, F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("place", "line"))
    said = each.select(key, *order, "place", F.trim(F.regexp_extract("line", PARTY_LINE, 1)).alias("party"),
                       F.trim(F.regexp_extract("line", PARTY_LINE, 2)).alias("words"))
    kept = said.filter((F.col("party") != "") & ~F.col("party").isin(LEFT_OUT if left_out is None else left_out))
    return ordered_concat(kept, [key, "party"], [*order, "place"], F.col("words"), " ", "statements")


def article_notes(df: DataFrame, key: str, text_col: str, completer: Completer = extractive_completer) -> DataFrame:
    """(key, notes): what a group prompt says of an article: summary, key facts and stances (K2).
    A column ``order`` goes along to the completer."""
    tasks = [t for t in ARTICLE_TASKS if t[0] != "what_happen_50"]
    wide = responses_to_columns(complete(task_prompts(df, key, text_col, tasks), key, completer), key, [t[0] for t in tasks])
    labelled = [F.concat(F.lit(label), F.coalesce(F.col(c), F.lit(""))) for label, c in NOTE_LABELS]
    return wide.select(key, F.array_join(F.array(*labelled), "\n").alias("notes"))


def fenced(label: Column, body: Column) -> Column:
    """A labelled, fenced block of text used inside topic prompts (K3)."""
    return F.concat(F.lit("### "), label, F.lit("\n```\n"), F.coalesce(body, F.lit("")), F.lit("\n```"))
