"""Filter specs -> Column predicates (B3-B9, B7 composition).

A spec is a list of ``{"type", "field", "value"}``. ``term`` (scalar or
list), ``range`` ({gte, gt, lte, lt}), ``exists``, ``prefix`` and
``wildcard`` are required (AND); ``match`` / ``match_phrase`` (scalar or
list, one alternative per value) are alternatives of which at least one must
hold when any is given. Unknown types raise ``ValueError``.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.tokens import py_tokens, tokens

RANGE_OPS = {"gte": "__ge__", "gt": "__gt__", "lte": "__le__", "lt": "__lt__"}


def term(field: str, value: Any) -> Column:
    if isinstance(value, (list, tuple, set)):
        return F.col(field).isin(list(value))
    return F.col(field) == F.lit(value)


def _field_tokens(field: str, tok_cols: dict | None) -> Column:
    return F.col(tok_cols[field]) if tok_cols and field in tok_cols else tokens(F.col(field))


def match(field: str, text: str, tok_cols: dict | None = None) -> Column:
    """Any analysed token of ``text`` occurs in the field (OR semantics)."""
    q = py_tokens(text)
    if not q:
        return F.lit(False)
    return F.arrays_overlap(_field_tokens(field, tok_cols), F.array(*[F.lit(t) for t in q]))


def match_phrase(field: str, text: str, tok_cols: dict | None = None) -> Column:
    """The analysed tokens of ``text`` occur consecutively in the field.
    Tokens never contain spaces, so a space-delimited join is exact."""
    q = py_tokens(text)
    if not q:
        return F.lit(False)
    joined = F.concat(F.lit(" "), F.array_join(_field_tokens(field, tok_cols), " "), F.lit(" "))
    return joined.contains(" " + " ".join(q) + " ")


def range_(field: str, bounds: dict) -> Column:
    """``{gte, gt, lte, lt}`` bounds on any field, AND-ed."""
    parts = []
    for op, v in bounds.items():
        if op not in RANGE_OPS:
            raise ValueError(f"unsupported range bound {op!r}")
        parts.append(getattr(F.col(field), RANGE_OPS[op])(F.lit(v)))
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def wildcard(field: str, pattern: str) -> Column:
    like = pattern.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_").replace("*", "%").replace("?", "_")
    return F.col(field).like(like)


def _one(kind: str, field: str, value: Any) -> Column:
    if kind == "term" or kind == "terms":
        return term(field, value)
    if kind == "range":
        return range_(field, value)
    if kind == "exists":
        return F.col(field).isNotNull()
    if kind == "prefix":
        return F.col(field).startswith(value)
    if kind == "wildcard":
        return wildcard(field, value)
    raise ValueError(f"unsupported filter type {kind!r}")


def compile_filters(filters: list[dict] | None, tok_cols: dict | None = None) -> Column:
    """must = AND of required specs; should = OR of match / match_phrase specs.
    ``tok_cols`` maps a field to a column already holding its tokens."""
    must, should = [], []
    for spec in filters or []:
        kind, field, value = spec["type"], spec["field"], spec["value"]
        if kind in ("match", "match_phrase"):
            fn = match if kind == "match" else match_phrase
            values = value if isinstance(value, (list, tuple)) else [value]
            should.extend(fn(field, v, tok_cols) for v in values)
        else:
            must.append(_one(kind, field, value))
    # no coalesce wrapper: a filter already drops null, and plain
    # comparisons / IN lists are what the parquet scan can push down
    if not must and not should:
        return F.lit(True)
    parts = list(must)
    if should:
        parts.append(reduce(lambda a, b: a | b, should))
    return reduce(lambda a, b: a & b, parts)


def adhoc(df, condition: str):
    """Caller-supplied SQL condition (B9), parsed by Spark's own SQL parser."""
    return df.filter(F.expr(condition))
