"""Merkle manifest against a plain tree."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quire.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def written(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for k, i in enumerate(at):
            j = i ^ 1
            paths[k].append(("", "") if j >= len(level) else (level[j], "") if j < i else ("", level[j]))
            at[k] = i // 2
        level = [H(*level[i:i + 2]) for i in range(0, len(level), 2)]
    return level[0], paths


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0], H(*[written(r[k]) for k in (0, 3, 2, 4, 1)])))
    langs = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    made = [tree([h for _, h in sorted(groups[k], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for k in langs]
    root, up = tree([m[0] for m in made])
    out = []
    for lang, (sub, paths), rest in zip(langs, made, up):
        ordered = sorted(groups[lang], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        out += [(i, h, sub, root, p + rest) for (i, h), p in zip(ordered, paths)]
    return out


def manifest(df):
    leaf = merkle.leaf_hash(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    return merkle.manifest(df.select("doc_id", "lang", leaf.alias("leaf"), *[c for c in df.columns if c not in SCHEMA.replace(",", "").split()]), "lang", ["doc_id"]).select("*", "proof.*")


def corpus(n=700):
    rng = random.Random(6)
    langs = ["en"] * 6 + ["de", None, "é", "Z", ""] + [f"l{k}" for k in range(70)]  # more trees than one band of the tree over all
    rows = [(i, rng.choice(["a text", "", None, "x" * 50000 if i % 97 == 0 else "é ü"]), rng.choice(langs), rng.choice(["s", None, "1:s"]), rng.choice([None, i])) for i in range(n)]
    return rows + [(None, "no id", "en", "s", 1), (7, "twice", "en", "s", 1), (7, "twice", "en", "s", 1), (7, "other", "en", "s", 1)] + [(10 ** 6 + i, "hot", "hot", "s", i) for i in range(300)]


def test_manifest_against_a_plain_tree(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("mine") for c in ("tree", "rank", "digest", "level", "lo", "tree_", "n", "depth")}).repartition(5)
    got = manifest(df).collect()
    assert {r.tree for r in got} == {"mine"}
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, [tuple(s) for s in r.path]) for r in got) == sorted((str(i), *rest) for i, *rest in expected(rows))


@pytest.mark.parametrize("n", [1, 2, 3, 64, 65, 129])
def test_sizes_round_a_band(spark, n):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(n)]
    got = manifest(spark.createDataFrame(rows, SCHEMA)).withColumn("f", merkle.fold(F.col("leaf"), F.col("path"))).withColumn("p", merkle.proof_digest(F.col("path"))).collect()
    want = {i: (sub, root, path) for i, _, sub, root, path in expected(rows)}
    assert len(got) == n
    for r in got:
        sub, root, path = want[r.doc_id]
        assert (r.subroot, r.root, r.f, [tuple(s) for s in r.path], r.p) == (sub, root, root, path, H(*[a + b for a, b in path]))


def test_a_changed_value_breaks_only_its_own_proof(spark):
    df = spark.createDataFrame([(i, f"t{i}", "en" if i % 3 else "de", "s", i) for i in range(100)], SCHEMA)
    changed = merkle.leaf_hash(F.col("doc_id"), F.lit("s"), F.col("lang"), F.col("doc_id") + F.when(F.col("doc_id") == 42, 1).otherwise(0), F.concat(F.lit("t"), F.col("doc_id")))
    got = manifest(df).withColumn("ok", merkle.fold(changed, F.col("path")) == F.col("root")).collect()
    assert {r.doc_id for r in got if not r.ok} == {42}


def test_empty_and_clashing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert manifest(none).count() == 0
    one = spark.createDataFrame([(1, "t", "en", "s", 1)], SCHEMA).withColumns({c: F.lit("mine") for c in ("proof", "leaf_", "path", "subroot")})
    got = merkle.manifest(one.withColumn("leaf", merkle.leaf_hash(F.col("text"))), "lang", ["doc_id"]).first()
    assert (got.path, got.subroot, got.proof.path, got.proof.subroot) == ("mine", "mine", [], got.leaf)
