"""Full-text, vector and hybrid search.

Relevance is BM25 with k1 = 1.2, b = 0.75 (Robertson & Zaragoza, 2009):
idf = ln(1 + (N - n + 0.5) / (n + 0.5)), tf_norm = tf (k1 + 1) /
(tf + k1 (1 - b + b dl / avgdl)), exact token counts. Corpus statistics
(N, average length, document frequency of each query term) come from one
aggregate over the searched table; only those few numbers reach the driver.
The scoring pass is then a per-row expression (array functions over the
row's tokens, no explode, no shuffle) followed by a top-k that Spark plans as
``TakeOrderedAndProject`` (a bounded heap per partition, then a merge).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.tokens import py_tokens, tokens
from quire.operators.predicates import compile_filters
from quire.session import cut_lineage

# BM25 parameters and the default result size.
K1 = 1.2
B = 0.75
RECALL_SIZE = 10


@dataclass
class CorpusStats:
    n: int
    avgdl: dict = field(default_factory=dict)       # field -> average token count
    dfreq: dict = field(default_factory=dict)       # (field, token) -> document count
    value_count: dict = field(default_factory=dict)  # (field, value) -> rows with field == value
    matched: dict = field(default_factory=dict)      # field -> rows containing any query token

    def idf(self, n_t: int) -> float:
        return math.log(1.0 + (self.n - n_t + 0.5) / (n_t + 0.5))


def corpus_stats(df: DataFrame, text_terms: dict[str, list[str]] | None = None,
                 exact_values: dict[str, list] | None = None,
                 count_any: dict[str, list[str]] | None = None) -> CorpusStats:
    """One aggregate pass: N, avgdl per text field, document frequency per
    (field, token) and row counts per (keyword field, value)."""
    text_terms = {f: sorted(set(ts)) for f, ts in (text_terms or {}).items()}
    exact_values = exact_values or {}
    proj = [F.lit(1).alias("_one")]
    for f in text_terms:
        proj.append(tokens(F.col(f)).alias(f"_tok_{f}"))
    for f in exact_values:
        proj.append(F.col(f).alias(f"_val_{f}"))
    p = df.select(*proj)
    aggs, keys = [F.count(F.lit(1)).alias("n")], []
    for f, ts in text_terms.items():
        tok = F.col(f"_tok_{f}")
        aggs.append(F.avg(F.size(tok)).alias(f"avgdl_{f}"))
        for i, t in enumerate(ts):
            aggs.append(F.sum(F.when(F.array_contains(tok, t), 1).otherwise(0)).alias(f"df_{f}_{i}"))
            keys.append(("df", f, t, f"df_{f}_{i}"))
    for f, ts in (count_any or {}).items():
        q = F.array(*[F.lit(t) for t in ts]) if ts else F.array().cast("array<string>")
        aggs.append(F.sum(F.when(F.arrays_overlap(F.col(f"_tok_{f}"), q), 1).otherwise(0)).alias(f"any_{f}"))
        keys.append(("any", f, None, f"any_{f}"))
    for f, vals in exact_values.items():
        for i, v in enumerate(vals):
            aggs.append(F.sum(F.when(F.col(f"_val_{f}") == F.lit(v), 1).otherwise(0)).alias(f"vc_{f}_{i}"))
            keys.append(("vc", f, v, f"vc_{f}_{i}"))
    row = p.agg(*aggs).first().asDict()
    st = CorpusStats(n=row["n"] or 0)
    for f in text_terms:
        st.avgdl[f] = row[f"avgdl_{f}"] or 0.0
    for kind, f, t, name in keys:
        if kind == "any":
            st.matched[f] = row[name] or 0
        else:
            (st.dfreq if kind == "df" else st.value_count)[(f, t)] = row[name] or 0
    return st


def _equals(t: str):
    return lambda x: x == F.lit(t)


def bm25(field_name: str, terms: list[str], stats: CorpusStats, boost: float = 1.0,
         tok: Column | None = None) -> Column:
    """Sum over distinct query tokens of idf * tf_norm for one text field.

    Pass ``tok`` = a column already holding the field's tokens (see
    ``with_tokens``): higher-order functions are evaluated outside codegen,
    so a token expression inside them would be recomputed for every term."""
    tok = tok if tok is not None else tokens(F.col(field_name))
    dl = F.size(tok).cast("double")
    avgdl = stats.avgdl.get(field_name) or 1.0
    total = F.lit(0.0)
    for t in sorted(set(terms)):
        idf = stats.idf(stats.dfreq.get((field_name, t), 0))
        # occurrences of t = length minus length without t (codegen'd, no lambda)
        tf = (F.size(tok) - F.size(F.array_remove(tok, F.lit(t)))).cast("double")
        norm = tf * F.lit(K1 + 1) / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * dl / F.lit(avgdl)))
        total = total + F.lit(idf * boost) * norm
    return total


def tok_col(field_name: str) -> str:
    return f"_tok_{field_name}"


def with_tokens(df: DataFrame, fields) -> DataFrame:
    """Project each field's tokens once into ``_tok_<field>``; the optimizer
    keeps this projection separate because the column is used many times."""
    return df.select("*", *[tokens(F.col(f)).alias(tok_col(f)) for f in sorted(set(fields))])


def top_k(df: DataFrame, score: str, id_col: str, k: int = RECALL_SIZE,
          keep: Column | None = None) -> DataFrame:
    """Highest scores first, ties by id (F1, F3, F5); planned as TakeOrderedAndProject.

    ``keep`` (a row condition) is applied *after* the limit by ordering kept
    rows first: this is exact, and it stops the optimizer from pushing a
    token-based condition below the projection that tokenizes each row once."""
    if keep is None:
        return df.orderBy(F.desc(score), F.asc(id_col)).limit(k)
    flagged = df.withColumn("_keep", F.coalesce(keep, F.lit(False)))
    return (flagged.orderBy(F.desc("_keep"), F.desc(score), F.asc(id_col)).limit(k)
                   .filter(F.col("_keep")).drop("_keep"))


def match_search(df: DataFrame, id_col: str, field_name: str, query: str,
                 k: int = RECALL_SIZE) -> tuple[DataFrame, int]:
    """Full-text match (H1). Returns (top-k hits, total hit count D6).

    One tokenising pass writes a slim table of (id, length, frequency of each
    query term); corpus figures, scores and the top-k come from it, and only the
    k hits are joined back to their rows. A row matches when it has a query term."""
    q = sorted(set(py_tokens(query)))
    terms = [f"tf{i}" for i in range(len(q))]
    tok = F.col(tok_col(field_name))
    slim = cut_lineage(with_tokens(df.select(id_col, field_name), [field_name]).select(
        id_col, F.greatest(F.size(tok), F.lit(0)).cast("double").alias("dl"),
        *[F.coalesce(F.size(tok) - F.size(F.array_remove(tok, F.lit(t))), F.lit(0)).alias(c) for t, c in zip(q, terms)]))
    any_term = reduce(lambda a, b: a | b, [F.col(c) > 0 for c in terms], F.lit(False))
    st = slim.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"), F.count_if(any_term).alias("total"),
                  *[F.count_if(F.col(c) > 0).alias(c) for c in terms]).first()
    score, avgdl = F.lit(0.0), st["avgdl"] or 1.0
    for c in terms:
        idf = math.log(1 + (st["n"] - st[c] + 0.5) / (st[c] + 0.5))
        tf = F.col(c).cast("double")
        score = score + F.lit(idf) * (tf * F.lit(K1 + 1) / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("dl") / F.lit(avgdl))))
    top = slim.filter(any_term).select(id_col, score.alias("score")).orderBy(F.desc("score"), F.asc(id_col)).limit(k)
    return df.join(F.broadcast(top), id_col).orderBy(F.desc("score"), F.asc(id_col)), st["total"]


def term_score(field_name: str, value, stats: CorpusStats) -> Column:
    """Score of an exact-value clause on a keyword field: idf of the value."""
    return F.lit(stats.idf(stats.value_count.get((field_name, value), 0)))


def term_search(df: DataFrame, id_col: str, field_name: str, value, k: int = RECALL_SIZE) -> DataFrame:
    """Exact-value search (H2): every hit scores the value's idf."""
    st = corpus_stats(df, exact_values={field_name: [value]})
    hits = df.filter(F.col(field_name) == F.lit(value)).withColumn("score", term_score(field_name, value, st))
    return top_k(hits, "score", id_col, k)


# ---- vectors (I20: no built-in vector functions, so array HOFs) ---------------

def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(F.transform(a, lambda x: x * x), F.lit(0.0), lambda acc, x: acc + x))


def cosine_to(vec: Column, query: list[float]) -> Column:
    """Cosine similarity of each row's vector with one literal query vector."""
    v = vec.cast("array<double>")
    q = F.array(*[F.lit(float(x)) for x in query])
    qn = math.sqrt(sum(float(x) * float(x) for x in query))
    return dot(v, q) / (norm(v) * F.lit(qn))


def _usable(vec: Column) -> Column:
    v = vec.cast("array<double>")
    return v.isNotNull() & (F.size(v) > 0) & (norm(v) > 0)


def query_vector(df: DataFrame, vec_col: str, where: Column) -> list[float]:
    """Fetch one stored vector (bounded by its dimension) to use as a query."""
    row = df.filter(where).select(F.col(vec_col).cast("array<double>")).first()
    if row is None:
        raise ValueError("query vector not found")
    return list(row[0])


def vector_search(df: DataFrame, id_col: str, vec_col: str, query: list[float],
                  k: int = RECALL_SIZE) -> DataFrame:
    """Score = cosine + 1 (H3); rows without a usable vector are skipped."""
    scored = df.filter(_usable(F.col(vec_col))).withColumn(
        "score", cosine_to(F.col(vec_col), query) + F.lit(1.0))
    return top_k(scored, "score", id_col, k)


def vector_term_search(df: DataFrame, id_col: str, vec_col: str, query: list[float],
                       field_name: str, value, k: int = RECALL_SIZE) -> DataFrame:
    """Both clauses required and both score (H4): idf(value) + cosine + 1."""
    st = corpus_stats(df, exact_values={field_name: [value]})
    scored = (df.filter(_usable(F.col(vec_col)) & (F.col(field_name) == F.lit(value)))
                .withColumn("score", term_score(field_name, value, st)
                            + cosine_to(F.col(vec_col), query) + F.lit(1.0)))
    return top_k(scored, "score", id_col, k)


def filtered_vector_search(df: DataFrame, id_col: str, vec_col: str, query: list[float],
                           filters: list[dict], k: int = RECALL_SIZE) -> DataFrame:
    """Filters only select rows; the score is cosine + 1 (H5)."""
    column_only = [s for s in filters if s["type"] not in ("match", "match_phrase")]
    token_based = [s for s in filters if s["type"] in ("match", "match_phrase")]
    toks = {s["field"]: tok_col(s["field"]) for s in token_based}
    base = with_tokens(df.filter(_usable(F.col(vec_col)) & compile_filters(column_only)), toks)
    scored = base.withColumn("score", cosine_to(F.col(vec_col), query) + F.lit(1.0))
    keep = compile_filters(token_based, toks) if token_based else None
    return top_k(scored, "score", id_col, k, keep=keep).drop(*toks.values())


def weighted_search(df: DataFrame, id_col: str, vec_col: str, query: list[float],
                    keyword_fields: list[dict] | None = None, filters: list[dict] | None = None,
                    k: int = RECALL_SIZE) -> DataFrame:
    """Hybrid ranking (H6): required filters (term scores idf, match scores
    BM25, range scores 1.0) + cosine + 1 + sum of weight * BM25 of each
    optional keyword (rows matching no keyword still rank)."""
    filters = filters or []
    keyword_fields = keyword_fields or []
    text_terms: dict[str, list[str]] = {}
    exact: dict[str, list] = {}
    for spec in keyword_fields:
        for kw in spec["keywords"]:
            text_terms.setdefault(spec["field"], []).extend(py_tokens(kw))
    for spec in filters:
        if spec["type"] == "match":
            text_terms.setdefault(spec["field"], []).extend(py_tokens(spec["value"]))
        elif spec["type"] == "term":
            exact.setdefault(spec["field"], []).append(spec["value"])
        elif spec["type"] != "range":
            raise ValueError(f"unsupported filter type {spec['type']!r}")
    st = corpus_stats(df, text_terms, exact)
    toks = {f: tok_col(f) for f in text_terms}
    pred = _usable(F.col(vec_col))          # column-only conditions: pushed to the scan
    keep = F.lit(True)                      # token conditions: applied after the top-k
    score = cosine_to(F.col(vec_col), query) + F.lit(1.0)
    for spec in filters:
        f, v = spec["field"], spec["value"]
        if spec["type"] == "term":
            pred = pred & (F.col(f) == F.lit(v))
            score = score + term_score(f, v, st)
        elif spec["type"] == "match":
            keep = keep & compile_filters([spec], toks)
            score = score + bm25(f, py_tokens(v), st, tok=F.col(toks[f]))
        else:
            pred = pred & compile_filters([spec])
            score = score + F.lit(1.0)
    for spec in keyword_fields:
        w = float(spec.get("weight", 1.0))
        for kw in spec["keywords"]:
            score = score + bm25(spec["field"], py_tokens(kw), st, boost=w, tok=F.col(toks[spec["field"]]))
    base = with_tokens(df.filter(pred), toks)
    return top_k(base.withColumn("score", score), "score", id_col, k, keep=keep).drop(*toks.values())
