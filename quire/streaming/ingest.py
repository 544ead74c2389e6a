"""Incremental settled ingest (L1, G5) with keyed state.

Each run reads the new files of a landing directory. A key qualifies once it has
a settled hit (older than ``now - minutes``) and was not selected before; all
hits of a qualifying key are then selected, once.

Spark's stateful processing keeps the state of each key in its state store: the
hits that wait, when the first of them settles, and whether the key is done.
Keys are handled by the bucket, whose timer is set for the first such moment of
its keys, so neither history nor a table of done keys is read again, and a run
costs what its new files and its waiting and released keys cost.

Time is what the caller says (``now``), never the clock: every run lands a tick,
a row that carries ``now`` as event time, and only ticks move the watermark. Rows
themselves have no event time, so none is ever late. When the watermark has
passed ``now``, the timers up to it fire, also in a run without a new file.

Every micro-batch writes a folder of its own (``batch=<id>``, with a file even if
nothing was selected), so a batch that is replayed after a failure replaces its
own output, and an empty result can still be read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from quire.sources.scans import SETTLE_MINUTES

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows travel through the state as JSON, with all digits of their times.
#: (to_json writes no line feed, so hits can be told apart by it.)
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

#: Keys are dealt by hash into this many buckets, each a group of its own: Python is called for a bucket, not for
#: a key. The state is kept by bucket, so the number must not change while a state lives.
BUCKETS = 512
#: Released hits that leave Python at a time.
ROWS = 10_000


class Settling(StatefulProcessor):
    """One bucket of keys: a key's hits wait until the first of them is settled; afterwards the key is done.

    Input columns: pid (the key), hit (one line of text, null in a tick) and due (when the hit is
    settled, in milliseconds). Output: the key and its hits. A bucket has one timer, for the earliest of
    its waiting keys; only keys that have new hits or are due are looked up."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.keys = handle.getMapState("keys", "pid string", "done boolean, parts int")
        self.hits = handle.getMapState("hits", "pid string, part int", "hits string")
        self.first = handle.getMapState("first", "pid string", "due bigint")  # of keys that wait for a time
        self.timer = handle.getValueState("timer", "due bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, seen, dues = timerValues.getCurrentWatermarkInMs(), {}, {}
        for some in rows:
            some, new = some[some["hit"].notna()], {}
            for pid, hit, due in zip(some["pid"], some["hit"], some["due"]):
                if pid not in seen:
                    seen[pid] = self.keys.getValue((pid,)) or (False, 0)
                if seen[pid][0]:
                    continue
                new.setdefault(pid, []).append(hit)
                if due == due and due is not None:
                    dues[pid] = min(int(due), dues.get(pid, int(due)))
            for pid, hits in new.items():
                parts = seen[pid][1]
                self.hits.updateValue((pid, parts), ("\n".join(hits),))
                seen[pid] = (False, parts + 1)
                self.keys.updateValue((pid,), seen[pid])
        ready, next_due = [], None
        for pid, due in dues.items():
            if due <= now:
                ready.append((pid, seen[pid][1]))
            elif (before := self.first.getValue((pid,))) is None or due < before[0]:
                self.first.updateValue((pid,), (due,))
                next_due = due if next_due is None else min(due, next_due)
        self._wake(next_due)
        yield from self._release(ready)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        self.timer.clear()
        ready, next_due = [], None
        for (pid,), (due,) in self.first.iterator():
            if due <= now:
                ready.append(pid)
            else:
                next_due = due if next_due is None else min(due, next_due)
        self._wake(next_due)
        yield from self._release((pid, self.keys.getValue((pid,))[1]) for pid in ready)

    def _wake(self, due: int | None) -> None:
        """Sets the bucket's timer to ``due`` unless an earlier one is set."""
        if due is None:
            return
        if self.timer.exists():
            if self.timer.get()[0] <= due:
                return
            self.handle.deleteTimer(self.timer.get()[0])
        self.timer.update((due,))
        self.handle.registerTimer(due)

    def _release(self, ready: Iterable[tuple[str, int]]) -> Iterator[pd.DataFrame]:
        """The hits of keys, each with its number of parts, some ROWS at a time."""
        pids, out = [], []
        for pid, parts in ready:
            for part in range(parts):
                hits = self.hits.getValue((pid, part))[0].split("\n")
                self.hits.removeKey((pid, part))
                pids += [pid] * len(hits)
                out += hits
                if len(out) >= ROWS:
                    yield pd.DataFrame({"pid": pids, "hit": out})
                    pids, out = [], []
            self.first.removeKey((pid,))
            self.keys.updateValue((pid,), (True, 0))
        if out:
            yield pd.DataFrame({"pid": pids, "hit": out})

    def close(self) -> None:
        pass


def run_settled_ingest(spark: SparkSession, landing: str, schema: T.StructType, state: str, key_expr: Column,
                       ts_col: str, now, minutes: int = SETTLE_MINUTES) -> None:
    """One availableNow run over ``landing``; state lives under ``state``. The key comes out as column
    pid (in place of one of that name). A null key is never selected, nor is one without a time."""
    at = F.lit(now).cast("timestamp_ntz")
    tick = spark.range(1).select(F.to_timestamp_ltz(at.cast("string")).alias("clock"))
    tick.write.mode("overwrite").parquet(f"{state}/clock/run={uuid.uuid4().hex}")
    pid = key_expr.cast("string")
    # settled means ts < now - minutes; the watermark is in milliseconds and passes what it reaches
    due = F.unix_millis(F.to_timestamp_ltz(F.col(ts_col).cast("timestamp_ntz").cast("string"))) + F.lit(minutes * 60_000 + 1)
    rows = spark.readStream.schema(schema).parquet(landing).select(
        pid.alias("pid"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in schema.names]), {**_JSON, "ignoreNullFields": "true"}).alias("hit"),
        due.alias("due"), F.lit(None).cast("timestamp").alias("clock")).filter("pid is not null")
    ticks = spark.readStream.schema("clock timestamp, run string").parquet(f"{state}/clock").select(
        F.lit("\0").alias("pid"), F.lit(None).cast("string").alias("hit"), F.lit(None).cast("long").alias("due"), "clock")
    bucket = F.when(F.col("hit").isNull(), -1).otherwise(F.pmod(F.xxhash64("pid"), F.lit(BUCKETS)).cast("int"))
    released = (rows.unionByName(ticks).withColumn("bucket", bucket).withWatermark("clock", "0 seconds").groupBy("bucket")
                .transformWithStateInPandas(Settling(), "pid string, hit string", "append", "eventTime"))
    rest = [F.col(f"r.`{c}`") for c in schema.names if c != "pid"]
    found = released.select(F.from_json("hit", schema, _JSON).alias("r"), "pid").select(*rest, "pid", at.alias("run_at"))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{state}/selected/batch={batch_id}")

    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)  # the store that keeps lists and timers
    try:
        query = (found.writeStream.foreachBatch(on_batch).trigger(availableNow=True)
                 .option("checkpointLocation", f"{state}/_checkpoint").start())
        query.awaitTermination()
    finally:
        spark.conf.set(_PROVIDER, before)


def selected(spark: SparkSession, state: str) -> DataFrame:
    """All selected hits; ``batch`` numbers the runs that selected any, from 0, and ``run_at`` is the ``now`` of the run."""
    rows = spark.read.parquet(f"{state}/selected").drop("batch")
    # one row for each run, so the window is small
    runs = rows.select("run_at").distinct().withColumn("batch", (F.row_number().over(Window.orderBy("run_at")) - 1).cast("int"))
    return rows.join(F.broadcast(runs), "run_at")
