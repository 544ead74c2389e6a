"""Keyword scoring and tagging."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lists up to this length become one expression for each keyword; longer ones
# are one array literal that a lambda runs over, with the same results.
UNROLLED = 64


def clean_keywords(keywords: Iterable[str]) -> list[str]:
    """Drop empty entries (a trailing separator would otherwise match everywhere)."""
    return [k for k in keywords if k]


def _literals(keywords: list[str]) -> Column:
    return F.array(*[F.lit(k) for k in keywords])


def split_editor_keywords(cell: str, sep: str = "：") -> list[str]:
    """An editor cell holds items separated by a full-width colon; a cell
    without the separator is one keyword (not one keyword per character)."""
    return clean_keywords(cell.split(sep)) if cell else []


def keyword_count(text: Column, keywords: Iterable[str]) -> Column:
    """Number of non-overlapping regex matches of all keywords in ``text``
    (C4, I9): the small keyword list is inlined, so no join is planned."""
    kws = clean_keywords(keywords)
    if not kws:
        return F.lit(0).cast("long")
    if len(kws) > UNROLLED:
        return F.aggregate(_literals(kws), F.lit(0).cast("long"),
                           lambda n, k: n + F.coalesce(F.regexp_count(text, k), F.lit(0)))
    terms = [F.coalesce(F.regexp_count(text, F.lit(k)), F.lit(0)).cast("long") for k in kws]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def in_keywords(h1: Column, text: Column, keywords: Iterable[str]) -> Column:
    """Keyword score: matches in the headline count twice, in the text once."""
    return keyword_count(h1, keywords) * 2 + keyword_count(text, keywords)


def keyword_tag(text: Column, keywords: Iterable[str], sep: str = "|") -> Column:
    """Matching keywords in code-point order, joined by ``sep``."""
    kws = clean_keywords(keywords)
    if not kws:
        return F.lit("")
    if len(kws) > UNROLLED:
        hits = F.filter(_literals(kws), lambda k: F.coalesce(F.rlike(text, k), F.lit(False)))
    else:
        hits = F.array_compact(F.array(*[F.when(text.rlike(k), F.lit(k)) for k in kws]))
    return F.array_join(F.array_sort(hits), sep)


def trend_match_count(text: Column, terms: Iterable[str]) -> Column:
    """How many trend terms occur (as regex) in ``text``."""
    kws = clean_keywords(terms)
    if not kws:
        return F.lit(0).cast("long")
    return F.size(F.filter(_literals(kws), lambda k: F.coalesce(F.rlike(text, k), F.lit(False)))).cast("long")


def keywords_in_text(text: Column, keywords: Column) -> Column:
    """Entity keywords (an array column) that occur in the text (C11)."""
    return F.filter(keywords, lambda k: (k != "") & text.contains(k))


def trend_terms(trends, start, title_col: str = "title", related_col: str = "related",
                dt_col: str = "dt", sep: str = ", "):
    """Trend table -> distinct terms since ``start`` (A21): each title and
    every item of its related list (the related items are kept, Q18)."""
    recent = trends.filter(F.col(dt_col) >= F.lit(start))
    titles = recent.select(F.col(title_col).alias("term"))
    related = recent.select(F.explode(F.split(F.col(related_col), sep, -1)).alias("term"))
    return titles.unionByName(related).filter(F.col("term") != "").distinct()


def token_hits(docs, key: str, text_col: str, keywords):
    """(key, keyword, hits): how often each whole lower-cased token of a keyword
    table occurs in each text. This is token equality, not the regex matching of
    ``keyword_count``. A text's tokens are counted before the join, so a frequent
    token comes once for each document that has it, and the join can split it."""
    from quire.functions.tokens import tokens
    toks = docs.select(key, F.explode(tokens(F.col(text_col))).alias("keyword"))
    counted = toks.groupBy(key, "keyword").agg(F.count(F.lit(1)).alias("hits"))
    kw = keywords.select(F.lower(F.col(keywords.columns[0])).alias("keyword")).distinct()
    return counted.join(kw, "keyword").select(key, "keyword", "hits")
