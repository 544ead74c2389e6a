"""Cases from review: any list length, ties, full-width digits, broken rows, round trips."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.functions.keywords import in_keywords, keyword_count, keyword_tag, trend_match_count
from quire.functions.text import annotate_names, clean_article, entity_words, name_entries


def one(spark, expr, **cols):
    row = {k: v for k, v in cols.items()}
    schema = ", ".join(f"{k} string" for k in row)
    return spark.createDataFrame([tuple(row.values())], schema).select(expr.alias("x")).first()[0]


def test_keyword_lists_of_any_length(spark):
    text = "台積電在 New York，台積電 the the"
    few = ["台積電", "New York", "the"]
    many = few + [f"absent{i}" for i in range(5000)]
    for kws in (few, many):
        assert one(spark, keyword_count(F.col("t"), kws), t=text) == 5
        assert one(spark, in_keywords(F.col("t"), F.col("t"), kws), t=text) == 15
        assert one(spark, keyword_tag(F.col("t"), kws), t=text) == "New York|the|台積電"
        assert one(spark, trend_match_count(F.col("t"), kws), t=text) == 3


def test_entity_classes(spark):
    kept = ["ORG", "GPE", "DATE", "PERSON", "EVENT", "FAC", "WORK_OF_ART", "LAW", "LOC"]
    rows = [[(f"e{i:02d}", c) for i, c in enumerate([*kept, "NORP", "PRODUCT", "CARDINAL"])]]
    df = spark.createDataFrame([(r,) for r in rows], "e array<struct<text:string,type:string>>")
    assert df.select(entity_words(F.col("e"))).first()[0] == " ".join(f"e{i:02d}" for i in range(9))


def test_short_name_inside_a_longer_one(spark):
    df = spark.createDataFrame([("王小明見王小", ["王小|乙", "王小明|甲"])], "t string, n array<string>")
    assert df.select(annotate_names(F.col("t"), name_entries(F.col("n")))).first()[0] == "王小明（甲）見王小（乙）"


def test_character_references_and_attributes(spark):
    html = '<a title="a>b">it&#8217;s &#x4E2D; &hellip; &amp;lt;</a>'
    assert one(spark, clean_article(F.col("t")), t=html) == "it’s 中 … &lt;"


def test_full_width_days(spark):
    from quire.functions.dates import resolve_day_mentions, story_date
    df = spark.createDataFrame([(dt.datetime(2024, 10, 15, 13, 7), "（台北１４日電）另於１６日與１１月２日")], "ts timestamp_ntz, t string")
    story = story_date(F.col("ts"), F.col("t"), "v2")
    got = df.select(story.alias("s"), resolve_day_mentions(F.col("t"), F.col("ts")).alias("r")).first()
    assert got.s == dt.datetime(2024, 10, 14, 13, 7)
    assert got.r == "（台北１４日（2024年10月14日）電）另於１６日（2024年10月16日）與１１月２日（2024年11月02日）"


def test_tsv_keeps_texts(spark, tmp_path):
    from quire.sources.sinks import read_tsv, write_tsv
    rows = [(1, "two\nlines"), (2, "  outer blanks  "), (3, 'a "quote" and\ttab'), (4, "\\ back")]
    df = spark.createDataFrame(rows, "id long, t string")
    write_tsv(df, str(tmp_path / "t"))
    assert sorted(map(tuple, read_tsv(spark, str(tmp_path / "t"), df.schema).collect())) == rows


def test_request_content(spark):
    from quire.sources.json_docs import validate_requests
    body = '{"content": %s, "entity_list": {}, "name_list": []}'
    rows = [(1, body % '["甲", "乙"]'), (2, body % '"[one]"'), (3, body % "null"), (4, body % "7"), (5, "no json"), (6, body % "[]")]
    valid, bad = validate_requests(spark.createDataFrame(rows, "id long, body string"), "body", ["id"])
    assert {r.id: r.text for r in valid.collect()} == {1: "甲乙", 2: "[one]", 6: ""}
    assert {r.id for r in bad.collect()} == {3, 4, 5}


def test_scores_of_repeated_ids(spark):
    from quire.operators.scoring import position_score
    rows = [("a", 1), ("a", 2), ("a", 2), ("b", 3)]
    got = position_score(spark.createDataFrame(rows, "pid string, dt long")).collect()
    assert sorted(r.position for r in got) == [0, 1, 2, 3]


@pytest.mark.parametrize("blocks", [1, 3])
def test_equal_neighbours_by_id(spark, blocks):
    from quire.operators.pairs import cosine_topk
    rows = [(i, [1.0, 0.0]) for i in range(2, 8)] + [(1, [1.0, 0.0])]
    got = cosine_topk(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", 2, blocks=blocks).collect()
    assert sorted(r.b for r in got if r.a == 1) == [2, 3]
    assert sorted(r.b for r in got if r.a == 5) == [1, 2]


def test_edges_of_large_norms(spark):
    from quire.operators.pairs import range_edges
    rng = np.random.default_rng(1)
    base = rng.normal(size=(100, 16)) * 1e6
    step = rng.normal(size=(100, 16))
    near = base + 0.9 * step / np.linalg.norm(step, axis=1)[:, None]
    rows = [(i, list(map(float, v))) for i, v in enumerate(np.concatenate((base, near)))]
    got = {(r.a, r.b) for r in range_edges(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", 1.0).collect()}
    assert got == {(i, i + 100) for i in range(100)}


def test_one_failing_row_leaves_its_neighbours(spark):
    from quire.plans.enrich import complete, responses_to_columns

    def completer(batch):
        if (batch["prompt"] == "bad").any():
            raise ValueError("no")
        return batch.assign(response=batch["prompt"] + "!")

    df = spark.createDataFrame([(1, "x", "p"), (2, "x", "bad"), (3, "x", "q")], "id long, task string, prompt string").coalesce(1)
    wide = responses_to_columns(complete(df, "id", completer, retries=1, backoff=0), "id", ["x"])
    got = {r.id: (r.x, r.status, r.error) for r in wide.collect()}
    assert got == {1: ("p!", "ok", ""), 2: (None, "error", "ValueError('no')"), 3: ("q!", "ok", "")}


def test_summary_stays_in_its_budget(spark):
    from quire.plans.summarise import extractive_summary
    df = spark.createDataFrame([(1, "word " * 200 + ". Short one.")], "id long, t string")
    assert all(len(r.summary) <= 50 for r in extractive_summary(df, "id", "t", 50).collect())


def test_settled_rows_come_out_without_new_files(spark, tmp_path):
    from quire.streaming.ingest import run_settled_ingest, selected
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 10, 0)), (2, dt.datetime(2024, 1, 1, 12, 0))], "id long, ts timestamp_ntz")
    df.write.parquet(str(tmp_path / "landing"))
    run = lambda now: run_settled_ingest(spark, str(tmp_path / "landing"), df.schema, str(tmp_path / "state"), F.col("id").cast("string"), "ts", now)
    run("2024-01-01 11:00:00")
    assert [r.id for r in selected(spark, str(tmp_path / "state")).collect()] == [1]
    for _ in range(2):  # the second call replaces the first one's output
        run("2024-01-01 13:00:00")
        assert sorted(r.id for r in selected(spark, str(tmp_path / "state")).collect()) == [1, 2]


def test_all_rows_of_a_date_range(spark):
    from quire.sources.scans import date_range_scan
    df = spark.range(1500).select(F.lit(dt.datetime(2024, 1, 3)).alias("ts"), "id")
    assert date_range_scan(df, "ts", "2024-01-03", "2024-01-04", ["id"]).count() == 1500
    assert date_range_scan(df, "ts", "2024-01-03", "2024-01-04", ["id"], limit=10).count() == 10


def test_session_leaves_the_cluster_its_say():
    from quire.session import options
    assert not {"spark.master", "spark.sql.shuffle.partitions", "spark.driver.memory"} & set(options())
    assert options("local[2]", shuffle_partitions=3)["spark.sql.shuffle.partitions"] == "3"


def test_backslash_in_a_wildcard(spark):
    from quire.operators.predicates import wildcard
    df = spark.createDataFrame([("a\\b",), ("a%b",), ("axb",)], "t string")
    assert [r.t for r in df.filter(wildcard("t", "a\\?")).collect()] == ["a\\b"]
    assert [r.t for r in df.filter(wildcard("t", "a%*")).collect()] == ["a%b"]


def test_absent_columns_get_defaults(spark):
    from quire.sources.tables import article_columns
    got = article_columns(spark.createDataFrame([("p", None)], "pid string, h1 string")).first()
    assert (got.pid, got.h1, got.focus, got.category, got.embeddings) == ("p", "", 0, "", None)


def test_answers_keep_their_limits():
    from quire.plans.enrich import answer
    text = "First one is here. " + "long " * 100 + ". He said: no. " + "A. " * 10
    assert len(answer("what_happen_50", text)) <= 50 and len(answer("what_happen_200", text)) <= 200
    assert answer("stance", text) == "He said: no."
    items = answer("key_facts", text).split("\n")
    assert len(items) == 5 and all(len(x) <= 100 for x in items)
    assert answer("ver1", "") == ""


def test_dates_and_parties_from_text(spark):
    from quire.plans.enrich import stances, timeline
    df = spark.createDataFrame([(1, 1, "2024年1月5日甲。無日。２０２４年１月４日乙\n2024年1月5日丙。2024年13月5日丁"),
                                (1, 2, "部長：不行\n網友：好\n部長：再看\n沒有說話者")], "k long, o long, t string")
    got = {str(r.day): r.events for r in timeline(df, "k", "t", ["o"]).collect()}
    assert got == {"2024-01-04": "２０２４年１月４日乙", "2024-01-05": "2024年1月5日甲 2024年1月5日丙"}
    assert [(r.party, r.statements) for r in stances(df, "k", "t", ["o"]).collect()] == [("部長", "不行 再看")]
