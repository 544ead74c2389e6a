"""The shared name dictionary against one regex pass over each text."""

import re

import numpy as np
import pytest

from quire.operators.names import annotate_all, name_dictionary, names_found
from quire.plans.topic import person_name_pass


def one_pass(text, notes):
    if not text or not notes:
        return text
    names = re.compile("|".join(map(re.escape, sorted(notes, key=len, reverse=True))))
    return names.sub(lambda m: m[0] + notes[m[0]], text)


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_dictionary_equals_one_pass(spark, block_bytes):
    rng = np.random.default_rng(4)
    letters = list("ab王é𠮷.")

    def word(n):
        return "".join(rng.choice(letters, n))
    notes = {word(int(n)): f"（{i}）" for i, n in enumerate(rng.integers(1, 9, 60))}
    texts = [word(int(n)) for n in rng.integers(0, 400, 40)] + ["", None, "no name", word(20000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    names = spark.createDataFrame(list(notes.items()), "name string, note string")
    got = {r.id: r.annotated for r in annotate_all(docs, "text", names, block_bytes=block_bytes).collect()}
    assert got == {i: one_pass(t, notes) for i, t in enumerate(texts)}
    found = {r.id: r.names for r in names_found(docs, "text", names, block_bytes=block_bytes).collect()}
    alternatives = re.compile("|".join(map(re.escape, sorted(notes, key=len, reverse=True))))
    assert found == {i: None if t is None else sorted(set(alternatives.findall(t))) for i, t in enumerate(texts)}


def test_dictionary_entries(spark):
    entries = spark.createDataFrame(
        [("王小明", "Ming", "甲"), ("王小明", None, "乙"), ("王小", "", "丙"), ("", "x", "y"), (None, "x", "y"), ("李", None, None)],
        "name string, orig string, title string")
    assert {r["name"]: r.note for r in name_dictionary(entries).collect()} == {"王小明": "（乙）", "王小": "（丙）", "李": "（）"}
    docs = spark.createDataFrame([("王小明見王小李",)], "text string")
    assert annotate_all(docs, "text", name_dictionary(entries)).first().annotated == "王小明（乙）見王小（丙）李（）"
    empty = name_dictionary(entries.filter("false"))
    assert annotate_all(docs, "text", empty).first().annotated == "王小明見王小李"
    assert annotate_all(docs.filter("false"), "text", empty).count() == 0


def test_name_pass_uses_all_lists(spark):
    docs = spark.createDataFrame([(1, "Ann met Bob", "['Bob|Robert|chair']"), (2, "Bob met Ann Lee", "Ann|aide\nAnn Lee|head"),
                                  (3, None, None), (4, "Cy", "")], "id int, text string, names string")
    got = {r.id: (r.annotated, r.n_names) for r in person_name_pass(docs, "text", "names").collect()}
    assert got == {1: ("Ann（aide） met Bob（Robert，chair）", 1), 2: ("Bob（Robert，chair） met Ann Lee（head）", 2),
                   3: (None, 0), 4: ("Cy", 0)}


def test_a_large_dictionary_meets_every_text_once(spark, monkeypatch):
    from quire.operators import names as module
    monkeypatch.setattr(module, "CHUNK_BYTES", 4000)
    cuts, cut = [], module.cut_lineage
    monkeypatch.setattr(module, "cut_lineage", lambda df: cuts.append(df.columns) or cut(df))
    rng = np.random.default_rng(5)

    def word(n):
        return "".join(rng.choice(list("ab é𠮷"), n))
    notes = {word(int(n)): f"（{i}）" for i, n in enumerate(rng.integers(1, 40, 300))}
    listed = list(notes)
    texts = [word(int(n)) + listed[int(n) % len(listed)] + "|" + word(30) for n in rng.integers(0, 900, 60)] * 2 + ["", None, "|"]
    docs = spark.createDataFrame([(i % 50, t) for i, t in enumerate(texts)], "id int, text string")  # ids repeat
    got = annotate_all(docs, "text", spark.createDataFrame(list(notes.items()), "name string, note string"), block_bytes=100)
    assert sorted(((r.id, r.text, r.annotated) for r in got.collect()), key=str) == sorted(((i % 50, t, one_pass(t, notes)) for i, t in enumerate(texts)), key=str)
    assert len(cuts) == 2  # the names and the rows, however many names there are
