"""The Python query surface: build queries from fields, literals, text matches and score functions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from ..errors import InvalidArgument
from .ir import MAX_ARITY, Aggregate, DenseVector, Expr, Matrix, Query, Score, SparseVector, Text, _wrap, field_, literal

__all__ = ["select", "filter", "group_by", "field", "literal", "match", "match_tokens", "should", "not_", "all", "any", "min", "max", "abs", "fn", "agg", "DenseVector", "SparseVector", "Matrix"]

field = field_


def select(*names: str | Mapping[str, Any], **named: Any) -> Query:
    return Query().select(*names, **named)


def filter(expr: Expr | Text) -> Query:  # noqa: A001
    return Query().filter(expr)


def group_by(keys: Mapping[str, Any] | Iterable[str], aggs: Mapping[str, Aggregate]) -> Query:
    return Query().group_by(keys, aggs)


def match(text: str, field: str | None = None, weight: float = 1.0, all: bool = False) -> Text:  # noqa: A002
    """Keep documents with any (or all) of the text's terms, and score them."""
    return Text("terms", text=text, field=field, weight=weight, all=all)


def match_tokens(tokens: Iterable[str | tuple[str, float]], field: str | None = None, all: bool = False) -> Text:  # noqa: A002
    """As ``match``, with the terms given, each with a weight if wanted."""
    return Text("terms", tokens=tuple(t if isinstance(t, tuple) else (t, 1.0) for t in tokens), field=field, all=all)


def should(text: str, field: str | None = None, weight: float = 1.0) -> Text:
    """Score documents that have the terms, keep all."""
    return Text("terms", text=text, field=field, weight=weight, gate=False)


def not_(expr: Expr) -> Expr:
    return _wrap(expr).not_()


def _nary(op: str, exprs: Iterable[Expr]) -> Expr:
    args = tuple(map(_wrap, exprs))
    if not args or len(args) > MAX_ARITY:
        raise InvalidArgument(f"{op} takes 1 to {MAX_ARITY} expressions")
    return Expr(op, args)


def all(exprs: Iterable[Expr]) -> Expr:  # noqa: A001
    return _nary("all", exprs)


def any(exprs: Iterable[Expr]) -> Expr:  # noqa: A001
    return _nary("any", exprs)


def min(left: Any, right: Any) -> Expr:  # noqa: A001
    return _wrap(left).min(right)


def max(left: Any, right: Any) -> Expr:  # noqa: A001
    return _wrap(left).max(right)


def abs(expr: Any) -> Expr:  # noqa: A001
    return _wrap(expr).abs()


class fn:
    """Score functions, for select."""

    @staticmethod
    def bm25_score(b: float | None = None, k1: float | None = None) -> Score:
        if (b is None) != (k1 is None):
            raise InvalidArgument("bm25_score takes b and k1 or neither")
        if b is not None and not 0 <= b <= 1:
            raise InvalidArgument("bm25_score: b must be in [0, 1]")
        if k1 is not None and k1 < 0:
            raise InvalidArgument("bm25_score: k1 must be >= 0")
        return Score("bm25_score", options=() if b is None else (("b", float(b)), ("k1", float(k1))))

    @staticmethod
    def vector_distance(field: str, query: Any, skip_refine: bool = False) -> Score:
        if isinstance(query, Mapping):
            query = SparseVector.of(query)
        elif not isinstance(query, (SparseVector, DenseVector)):
            query = DenseVector(tuple(query))
        return Score("vector_distance", field, query, (("skip_refine", skip_refine),))

    @staticmethod
    def multi_vector_distance(field: str, query: Any, candidates: int | None = None) -> Score:
        return Score("multi_vector_distance", field, query if isinstance(query, Matrix) else Matrix.of(query), (("candidates", candidates),))

    @staticmethod
    def semantic_similarity(field: str, query: str) -> Score:
        return Score("semantic_similarity", field, query)


class agg:
    """Aggregates, for group_by."""

    @staticmethod
    def count(field: str | None = None) -> Aggregate:
        return Aggregate("count", field)

    @staticmethod
    def sum(field: str) -> Aggregate:
        return Aggregate("sum", field)

    @staticmethod
    def min(field: str) -> Aggregate:
        return Aggregate("min", field)

    @staticmethod
    def max(field: str) -> Aggregate:
        return Aggregate("max", field)

    @staticmethod
    def avg(field: str) -> Aggregate:
        return Aggregate("avg", field)
