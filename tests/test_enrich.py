"""Batched completion: retries, error status, pivot."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quire.plans.enrich import complete, extractive_completer, responses_to_columns, task_prompts


def test_prompts_complete_and_pivot(spark):
    df = spark.createDataFrame([(1, "text one"), (2, "text two")], "id long, body string")
    p = task_prompts(df, "id", "body", [("a", "Do A."), ("b", "Do B.")])
    assert p.count() == 4
    wide = responses_to_columns(complete(p, "id"), "id", ["a", "b"]).orderBy("id").collect()
    assert (wide[0]["a"], wide[0]["status"], wide[0]["error"]) == ("text one", "ok", "")


def test_failing_completer_keeps_rows_with_status(spark):
    df = spark.createDataFrame([(1, "x")], "id long, body string")
    p = task_prompts(df, "id", "body", [("a", "Do A.")])

    def broken(batch: pd.DataFrame) -> pd.DataFrame:
        raise RuntimeError("rate limited")
    rows = complete(p, "id", broken, retries=2, backoff=0.0).collect()
    assert [(r.status, r.response) for r in rows] == [("error", None)]
    assert "rate limited" in rows[0].error
    ok = complete(p, "id", extractive_completer).filter(F.col("status") == "ok").count()
    assert ok == 1


def test_the_best_sentence_may_be_the_last_one(spark):
    """Sentences are scored over the whole text, against a corpus, and full-width stops end them."""
    from quire.plans.enrich import ARTICLE_TASKS, with_order
    from quire.plans.summarise import extractive_summary, token_weights
    dull = "the of and. " * 20
    rows = [(1, dull + "Zebras orbit Jupiter."), (2, "他說：的。" + "的的。" * 8 + "火星人登陸台北！"), (3, None), (4, ""), (5, " \n "), (6, "?!"),
            *[(10 + k, "the of and 的 說 他 so on.") for k in range(40)]]
    df = spark.createDataFrame(rows, "id long, body string").repartition(4)
    weights = token_weights(df, "body")
    done = complete(task_prompts(with_order(df, "id", "body", weights), "id", "body"), "id")
    got = {r.id: r for r in responses_to_columns(done, "id", [t[0] for t in ARTICLE_TASKS]).collect()}
    assert len(got) == len(rows)
    assert "Zebras orbit Jupiter." in got[1].what_happen_50 and got[1].key_facts.endswith("Zebras orbit Jupiter.")
    assert "火星人登陸台北！" in got[2].what_happen_50 and got[2].stance == "他說：的。"
    assert all(got[k].what_happen_200 == "" for k in (3, 4, 5, 6))
    short = {r.id: r.summary for r in extractive_summary(df, "id", "body", 21, weights).collect()}
    assert short[1] == "Zebras orbit Jupiter." and 3 not in short


@pytest.mark.parametrize("broadcast", [500_000, 10])
def test_order_against_plain_scores(spark, monkeypatch, broadcast):
    monkeypatch.setattr("quire.plans.summarise.BROADCAST_ROWS", broadcast)
    import math
    import random

    from quire.functions.tokens import py_tokens
    from quire.plans.summarise import sentence_order, token_weights
    rng = random.Random(4)
    words = ["the"] * 30 + ["of"] * 9 + [f"w{k}" for k in range(300)]
    texts = {k: "".join(" ".join(rng.choice([*words, f"r{rng.randrange(100000)}"] if rng.random() < 0.5 else [f"r{rng.randrange(100000)}"]) for _ in range(rng.randint(0, 9))) + rng.choice(".!。\n") for _ in range(rng.randint(1, 30))) for k in range(1100)}
    df = spark.createDataFrame(list(texts.items()), "id long, t string")
    weights = token_weights(df, "t")
    assert weights.filter("common").count() > 0 and weights.filter("not common").count() > 0
    seen = {}
    for t in texts.values():
        for x in set(py_tokens(t)):
            seen[x] = seen.get(x, 0) + 1
    weigh = {x: round(1000 * math.log((len(texts) + 1) / (n + 1))) + 1 for x, n in seen.items()}
    got = {r.id: r.order for r in sentence_order(df, "id", "t", weights).collect()}
    import re
    for k, t in texts.items():
        found = [s for s in (m.strip(" ") for m in re.findall(r"[^.!?。！？\n]+[.!?。！？]*", t)) if s]
        own = py_tokens(" ".join(found))
        score = [sum(own.count(x) * weigh[x] for x in py_tokens(s)) / len(py_tokens(s)) if py_tokens(s) else 0.0 for s in found]
        assert got.get(k, []) == sorted(range(len(found)), key=lambda i: (-score[i], i))


def test_only_rare_tokens_are_dealt_out_by_token(spark, monkeypatch):
    from quire.plans import summarise
    monkeypatch.setattr(summarise, "BROADCAST_ROWS", 1)
    where = spark.createDataFrame([(1, "the", [0]), (1, "odd", [1]), (2, "the", [0, 1]), (2, None, [2]), (2, "new", [3])], "key long, token string, places array<int>")
    weights = spark.createDataFrame([("the", 1, True, 9), ("odd", 5, False, 9)], "token string, weight long, common boolean, unseen long")
    (here, _), (others, weight) = summarise._weighed(where, weights)
    assert sorted((r.key, r.token or "") for r in here.collect()) == [(1, "the"), (2, ""), (2, "the")]
    assert sorted(others.select("token", weight.alias("w")).collect()) == [("new", 9), ("odd", 5)]


def test_a_chunk_sends_each_token_once(spark, monkeypatch):
    """Not a row for each token of each text: these are what weighing took its time for."""
    from quire.plans import summarise
    df = spark.createDataFrame([(k, f"the cat sat. a dog {'ran' if k % 2 else 'lay'}!") for k in range(600)], "id long, t string")
    weights, seen, weighed = summarise.token_weights(df, "t"), [], summarise._weighed
    monkeypatch.setattr(summarise, "_weighed", lambda where, w: seen.append(where.count()) or weighed(where, w))
    assert summarise.sentence_order(df, "id", "t", weights).count() == 600
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert 0 < sum(seen) <= 7 * partitions < 600 * 6


def test_texts_are_cut_as_the_jvm_cuts_them(spark):
    import random

    import pyarrow as pa

    from quire.functions.tokens import char_kinds, kind_table, tokens
    from quire.plans.summarise import _cut, sentence_array, sentence_list
    rng = random.Random(8)
    parts = [*"abΣσßİŉé々〇⺀漢字火１Ⅷ²٣𠀀𝒜😀_ \t\u3000\xa0\u200b\u0301\x00\r", *".!?。！？\n" * 2, "  ", "the", "of"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for k in range(300)]
    df = spark.createDataFrame(rows, "id long, t string")
    got = sorted(df.select("id", "t", F.lower("t").alias("low"), sentence_array(F.col("t")).alias("s"),
                           F.transform(sentence_array(F.lower("t")), tokens).alias("tokens")).collect())
    found, sentence, text = _cut([pa.array([r.low for r in got[:150]]), pa.array([r.low for r in got[150:]])], kind_table(char_kinds(spark)))
    cut = [[] for _ in text]
    for s, token in zip(sentence, found.to_pylist()):
        cut[s].append(token)
    for k, r in enumerate(got):
        assert [c for c, of in zip(cut, text) if of == k] == r.tokens and sentence_list(r.t) == r.s


def test_repeated_and_null_keys_and_a_final_sigma(spark):
    from quire.plans.summarise import extractive_summary, sentence_order, token_weights
    rows = [(1, "aa bb. cc"), (1, "aa. dd ee!"), (2, None), (2, "ΟΔΟΣ.Σ x.  . ΟΔΟΣ y"), (None, "zz. zz"), (3, "..."), (4, "same here. odd"), (4, "same here. odd")]
    df = spark.createDataFrame(rows + [(9, "οδος of. σ of.")] * 9, "id long, t string")
    weights = token_weights(df, "t")
    got = {r.id: r.order for r in sentence_order(df, "id", "t", weights).collect()}
    assert {k: sorted(v) for k, v in got.items()} == {1: [0, 1], 2: [0, 1, 2, 3], None: [0, 1], 4: [0, 1], 9: list(range(2))}
    assert got[2] == [3, 1, 0, 2]
    assert sorted(r.id for r in extractive_summary(df, "id", "t", 200, weights).collect() if r.id < 9) == [1, 1, 2, 2, 4, 4]


def test_scored_clusters_leave_texts_behind(spark):
    from quire.plans.catalog import _scored_clusters, _slim_articles, _with_texts
    sf = "/root/testdata/sf0.001"
    slim = _slim_articles(spark, sf)
    assert not {"h1", "article", "text"} & set(slim.columns)
    assert not {"h1", "article", "text"} & set(_scored_clusters(spark, sf, 1.1).columns)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = _with_texts(spark, sf, slim.filter("doc_id % 7 = 0")).select("doc_id", "article", "h1").collect()
    assert got and all(r.article == texts[r.doc_id] and r.h1 == r.article.split("\n")[0] for r in got)
