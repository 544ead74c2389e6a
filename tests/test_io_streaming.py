"""Landed JSON, requests, sinks and the streaming jobs."""

import datetime as dt
import json
import os
import uuid

from pyspark.sql import functions as F

from quire.schemas import TOPIC_JSON_SCHEMA
from quire.session import checkpoint_dir
from quire.sources import sinks
from quire.sources.html import headline_ids, list_items
from quire.sources.json_docs import flatten_topics, read_json, topic_counts, validate_requests
from quire.streaming.ingest import run_settled_ingest, selected


def scratch(spark, name):
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def test_topic_json_flatten(spark):
    path = scratch(spark, "topics")
    os.makedirs(path)
    docs = [{"tno": 4604, "ResultData": {"Items": [
                {"Id": "202410150001", "CreateTime": "2024/10/15 09:00", "HeadLine": "h1"},
                {"Id": "202410150002", "CreateTime": "2024/10/15 10:00", "HeadLine": "h2"}]}},
            {"tno": 7, "ResultData": {}}]
    with open(os.path.join(path, "t.json"), "w", encoding="utf-8") as f:
        f.write("\n".join(json.dumps(d, ensure_ascii=False) for d in docs))
    df = read_json(spark, path, TOPIC_JSON_SCHEMA)
    items, bad = flatten_topics(df)
    assert sorted(r.pid for r in items.collect()) == ["202410150001", "202410150002"]
    assert [(r.tno, r.reason) for r in bad.collect()] == [(7, "missing ResultData.Items")]
    assert {r.tno: r.article_num for r in topic_counts(df).collect()} == {4604: 2, 7: 0}


def test_requests_valid_and_quarantine(spark):
    good = '{"content":["甲","乙"],"entity_list":{},"name_list":[]}'
    missing = '{"content":["甲"],"entity_list":{}}'
    df = spark.createDataFrame([(1, good), (2, missing), (3, "{not json")], "id int, body string")
    valid, bad = validate_requests(df, "body", ["id"])
    assert [(r.id, r.text) for r in valid.collect()] == [(1, "甲乙")]
    reasons = {r.id: r.reason for r in bad.collect()}
    assert reasons[2] == "missing: name_list" and reasons[3] == "malformed json"


def test_list_items_and_headline_ids(spark):
    html = ('<ul><li><a href="/news/aipl/202410150001.aspx">One</a></li>'
            '<li><a href="/list/x.aspx">Two</a></li></ul><a href="/news/ait/202410150002.aspx">z</a>')
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert [(r.pos, r.url, r.title) for r in list_items(pages).collect()] == [
        (0, "/news/aipl/202410150001.aspx", "One"), (1, "/list/x.aspx", "Two")]
    assert sorted(r.pid for r in headline_ids(pages).collect()) == ["202410150001", "202410150002"]


def test_sheet_edits(spark):
    sheet = spark.createDataFrame([(2, "a", "x"), (3, "b", "y"), (4, "", None)], "row_num int, name string, seg string")
    assert sinks.last_non_blank_row(sheet, ["name", "seg"]).first().last_row == 3
    cleared = sinks.clear_range(sheet, 3, None, ["seg"]).orderBy("row_num").collect()
    assert [r.seg for r in cleared] == ["x", None, None]
    up = sinks.update_cell(sheet, "row_num", 2, "name", lambda c: F.upper(c)).orderBy("row_num").first()
    assert up.name == "A"
    src = spark.createDataFrame([(0, 10), (1, 11), (2, 12)], "_src_row int, n int")
    out = sinks.column_mapped_write(sheet, src, ["count"], start_row=3).orderBy("row_num").collect()
    assert [(r.row_num, r["count"]) for r in out] == [(2, None), (3, "10"), (4, "11"), (5, "12")]
    assert sinks.cell(sheet, 3, "name").first().value == "b"


def test_create_with_suffix_and_append(spark):
    base = scratch(spark, "tbl")
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    assert sinks.create_with_suffix(spark, df, base) == base
    assert sinks.create_with_suffix(spark, df, base) == base + "_1"
    sinks.append(spark, df.select("v", "id"), base + "_1")
    assert spark.read.parquet(base + "_1").count() == 2


def test_streaming_ingest_runs_and_replays(spark):
    base = scratch(spark, "ingest")
    schema = "pid string, ts timestamp_ntz"
    t = dt.datetime(2024, 1, 1, 8, 0)
    first = spark.createDataFrame([("a", t), ("b", t + dt.timedelta(hours=3, minutes=50))], schema)
    first.write.mode("append").parquet(f"{base}/landing")
    now1 = t + dt.timedelta(hours=4)           # b is not settled yet
    run_settled_ingest(spark, f"{base}/landing", first.schema, f"{base}/state", F.col("pid"), "ts", now1)
    assert sorted(r.pid for r in selected(spark, f"{base}/state").collect()) == ["a"]
    # nothing new: a second run adds no batch and no rows
    run_settled_ingest(spark, f"{base}/landing", first.schema, f"{base}/state", F.col("pid"), "ts", now1)
    assert selected(spark, f"{base}/state").count() == 1
    second = spark.createDataFrame([("a", t + dt.timedelta(hours=5)), ("c", t + dt.timedelta(hours=5))], schema)
    second.write.mode("append").parquet(f"{base}/landing")
    now2 = t + dt.timedelta(hours=8)
    run_settled_ingest(spark, f"{base}/landing", first.schema, f"{base}/state", F.col("pid"), "ts", now2)
    got = sorted((r.pid, r.batch) for r in selected(spark, f"{base}/state").collect())
    assert got == [("a", 0), ("b", 1), ("c", 1)]


def test_streaming_ingest_keeps_every_value_and_releases_without_a_file(spark):
    base = scratch(spark, "ingest")
    schema = "event_id long, ts timestamp_ntz, value double, props map<string,string>, tags array<int>, who string"
    t = dt.datetime(2024, 1, 1, 8, 0, 0, 123456)
    rows = [(1, t, 0.1, {"a": "b"}, [1, None], "k"), (2, t + dt.timedelta(minutes=50), None, None, None, "k"), (3, t, 1e300, {}, [], None),
            (4, None, 2.0, None, None, "l")]
    df = spark.createDataFrame(rows, schema)
    df.write.parquet(f"{base}/landing")
    run = lambda now: run_settled_ingest(spark, f"{base}/landing", df.schema, f"{base}/state", F.col("who"), "ts", now)
    run(t + dt.timedelta(minutes=30))  # settled is older than, not as old as
    assert selected(spark, f"{base}/state").count() == 0  # nothing selected can be read
    run(t + dt.timedelta(minutes=30, milliseconds=1))  # no new file
    got = sorted(tuple(r) for r in selected(spark, f"{base}/state").select(*df.columns).collect())
    assert got == rows[:2]  # all hits of the key; no null key; no key without a time
    df.filter("event_id = 2").write.mode("append").parquet(f"{base}/landing")
    run(t + dt.timedelta(days=1))
    assert selected(spark, f"{base}/state").count() == 2  # a key that is done stays done


def test_streaming_ingest_of_hits_older_than_the_last_run(spark):
    base = scratch(spark, "ingest")
    t = dt.datetime(2024, 1, 1, 8, 0)
    df = spark.createDataFrame([("a", t)], "pid string, ts timestamp_ntz")
    for k, (name, now) in enumerate((("a", t + dt.timedelta(hours=9)), ("b", t + dt.timedelta(hours=9)), ("c", t + dt.timedelta(hours=8)))):
        df.withColumn("pid", F.lit(name)).write.mode("append").parquet(f"{base}/landing")
        run_settled_ingest(spark, f"{base}/landing", df.schema, f"{base}/state", F.col("pid"), "ts", now)
        assert selected(spark, f"{base}/state").count() == k + 1


def test_request_stream_with_one_empty_side(spark):
    from quire.streaming.requests import run_request_stream
    base = scratch(spark, "requests")
    df = spark.createDataFrame([(1, "{not json")], "id int, body string")
    df.write.parquet(f"{base}/landing")
    run_request_stream(spark, f"{base}/landing", df.schema, f"{base}/state", "body", ["id"])
    assert spark.read.parquet(f"{base}/state/valid").count() == 0 and spark.read.parquet(f"{base}/state/quarantine").count() == 1


class _Handle:
    """State of one group in dictionaries."""

    def __init__(self):
        self.timers, self.calls = [], 0
        self.registerTimer, self.deleteTimer = self.timers.append, self.timers.remove

    def getMapState(self, *_):
        return _Map()

    def getValueState(self, *_):
        return _Value()


class _Map(dict):
    getValue, removeKey = dict.get, lambda self, key: self.pop(key, None)
    updateValue, iterator = dict.__setitem__, lambda self: iter(list(self.items()))


class _Value:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


def test_settling_takes_many_keys_in_one_call():
    import pandas as pd
    from pyspark.sql.streaming.stateful_processor import TimerValues
    from quire.streaming.ingest import Settling
    one, handle = Settling(), _Handle()
    one.init(handle)
    rows = lambda *r: pd.DataFrame(r, columns=["pid", "hit", "due"])
    out = lambda frames: sorted(tuple(r) for f in frames for r in f.itertuples(index=False))
    # the batches of one call: b waits, c has no time, a's second hit comes in the second batch
    first = iter([rows(("a", "a1", 10), ("b", "b1", 30), ("c", "c1", None)), rows(("a", "a2", 40), (None, None, None))])
    assert out(one.handleInputRows((3,), first, TimerValues(0, 0))) == [] and handle.timers == [10]
    assert out(one.handleExpiredTimer((3,), TimerValues(0, 20), None)) == [("a", "a1"), ("a", "a2")] and handle.timers[-1] == 30
    # a is done, d is due at once, b's earlier hit moves the timer
    again = iter([rows(("a", "a3", 5), ("d", "d1", 15)), rows(("b", "b2", 25), ("d", "d2", 99))])
    assert out(one.handleInputRows((3,), again, TimerValues(0, 20))) == [("d", "d1"), ("d", "d2")] and handle.timers[-1] == 25
    assert out(one.handleExpiredTimer((3,), TimerValues(0, 25), None)) == [("b", "b1"), ("b", "b2")]
    assert list(one.keys) == [("a",), ("b",), ("c",), ("d",)] and list(one.hits) == [("c", 0)] and not one.first


def test_streaming_ingest_deals_keys_into_few_groups(spark):
    base = scratch(spark, "ingest")
    t = dt.datetime(2024, 1, 1, 8, 0)
    df = spark.range(3000).select((F.col("id") % 1000).cast("string").alias("pid"), F.lit("a\nb").alias("v"), "id",
                                  (F.lit(t).cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, 0, id)")).alias("ts"))
    df.write.parquet(f"{base}/landing")
    for minutes in (40, 90):
        run_settled_ingest(spark, f"{base}/landing", df.schema, f"{base}/state", F.col("pid"), "ts", t + dt.timedelta(minutes=minutes))
    got = {(r.pid, r.id, r.v, r.batch) for r in selected(spark, f"{base}/state").collect()}
    assert got == {(str(i % 1000), i, "a\nb", 0 if i % 1000 < 600 else 1) for i in range(3000)}
