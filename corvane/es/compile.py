"""Query clauses to a gate and a score.

A clause compiles to a boolean expression that keeps documents and a list of score parts: text terms (scored by BM25),
similarity functions, and constants that count where a condition holds.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from ..errors import InvalidArgument, Unsupported
from ..plans import builder as b
from ..plans.ir import Expr, Score, Text
from ..plans.schema import Schema

TRUE = b.literal(True)


@dataclass
class Clause:
    gate: Expr
    texts: list[tuple[Text, Expr | None]] = field(default_factory=list)
    functions: list[tuple[Score, float]] = field(default_factory=list)
    constants: list[tuple[float, Expr | None]] = field(default_factory=list)

    def scaled(self, factor: float) -> "Clause":
        if factor == 1.0:
            return self
        return Clause(self.gate, [(t.boost(factor), c) for t, c in self.texts], [(s, w * factor) for s, w in self.functions], [(v * factor, c) for v, c in self.constants])


def field_name(name: str) -> str:
    return name.removesuffix(".keyword")


def _check(body: Mapping[str, Any], allowed: set[str], what: str) -> None:
    if extra := set(body) - allowed:
        raise InvalidArgument(f"{what}: unknown {', '.join(sorted(extra))}")


def _one(body: Any, what: str) -> tuple[str, Any]:
    if not isinstance(body, Mapping) or len(body) != 1:
        raise InvalidArgument(f"{what} takes one field")
    return next(iter(body.items()))


def _boost(v: Any) -> float:
    if isinstance(v, bool) or not isinstance(v, (int, float)) or v < 0:
        raise InvalidArgument("boost must be a number of 0 or more")
    return float(v)


def all_of(exprs: list[Expr]) -> Expr:
    return reduce(lambda x, y: x & y, exprs) if exprs else TRUE


def any_of(exprs: list[Expr]) -> Expr:
    return reduce(lambda x, y: x | y, exprs) if exprs else b.literal(False)


class Compiler:
    def __init__(self, schema: Schema):
        self.schema = schema

    def _index(self, name: str):
        return self.schema.index(name)

    def _scored(self, name: str, text: str, every: bool, boost: float) -> Clause:
        """BM25 over a keyword field; the terms are a should, the gate a plain predicate."""
        gate = b.field(name).match_all(text) if every else b.field(name).match_any(text)
        return Clause(gate, texts=[(b.should(text, name, boost), None)])

    def compile(self, q: Mapping[str, Any], scoring: bool = True) -> Clause:
        kind, body = _one(q, "a query")
        made = getattr(self, f"_{kind}", None)
        if made is None:
            raise Unsupported(f"query `{kind}`")
        return made(body, scoring) if kind in ("bool", "semantic") else made(body)

    def _match_all(self, body: Mapping[str, Any]) -> Clause:
        _check(body, {"boost"}, "match_all")
        return Clause(TRUE, constants=[(_boost(body.get("boost", 1.0)), None)])

    def _match(self, body: Any) -> Clause:
        name, v = _one(body, "match")
        v = v if isinstance(v, Mapping) else {"query": v}
        _check(v, {"query", "operator", "boost"}, "match")
        operator = str(v.get("operator", "or")).lower()
        if operator not in ("or", "and"):
            raise InvalidArgument("match: operator is or or and")
        return self._scored(field_name(name), str(v["query"]), operator == "and", _boost(v.get("boost", 1.0)))

    def _multi_match(self, body: Mapping[str, Any]) -> Clause:
        _check(body, {"query", "fields", "operator", "boost", "type"}, "multi_match")
        if not body.get("fields"):
            raise InvalidArgument("multi_match needs fields")
        parts = []
        for spec in body["fields"]:
            name, _, weight = spec.partition("^")
            parts.append(self._scored(field_name(name), str(body["query"]), str(body.get("operator", "or")).lower() == "and", float(weight or 1.0) * _boost(body.get("boost", 1.0))))
        return Clause(any_of([p.gate for p in parts]), [t for p in parts for t in p.texts])

    def _term(self, body: Any) -> Clause:
        name, v = _one(body, "term")
        v = v if isinstance(v, Mapping) else {"value": v}
        _check(v, {"value", "boost"}, "term")
        name, value, boost = field_name(name), v["value"], _boost(v.get("boost", 1.0))
        index = self._index(name)
        if index and index.kind == "keyword" and isinstance(value, str):
            if index.exact:
                return Clause(b.field(name).eq(value), texts=[(b.should(value, name, boost), None)])
            return self._scored(name, value, False, boost)
        gate = b.field(name).eq(value)
        return Clause(gate, constants=[(boost, gate)])

    def _terms(self, body: Mapping[str, Any]) -> Clause:
        body = dict(body)
        boost = _boost(body.pop("boost", 1.0))
        name, values = _one(body, "terms")
        if not isinstance(values, list):
            raise InvalidArgument("terms takes a list")
        gate = b.field(field_name(name)).in_(values)
        return Clause(gate, constants=[(boost, gate)])

    def _ids(self, body: Mapping[str, Any]) -> Clause:
        _check(body, {"values", "boost"}, "ids")
        gate = b.field("_id").in_([str(v) for v in body["values"]])
        return Clause(gate, constants=[(_boost(body.get("boost", 1.0)), gate)])

    def _prefix(self, body: Any) -> Clause:
        name, v = _one(body, "prefix")
        v = v if isinstance(v, Mapping) else {"value": v}
        _check(v, {"value", "boost"}, "prefix")
        gate = b.field(field_name(name)).starts_with(v["value"])
        return Clause(gate, constants=[(_boost(v.get("boost", 1.0)), gate)])

    def _regexp(self, body: Any) -> Clause:
        name, v = _one(body, "regexp")
        v = v if isinstance(v, Mapping) else {"value": v}
        _check(v, {"value", "boost", "case_insensitive"}, "regexp")
        gate = b.field(field_name(name)).regexp_match(v["value"], "i" if v.get("case_insensitive") else "")
        return Clause(gate, constants=[(_boost(v.get("boost", 1.0)), gate)])

    def _range(self, body: Any) -> Clause:
        name, v = _one(body, "range")
        _check(v, {"gt", "gte", "lt", "lte", "boost"}, "range")
        e = b.field(field_name(name))
        parts = [getattr(e, op)(v[op]) for op in ("gte", "gt", "lte", "lt") if v.get(op) is not None]
        gate = all_of(parts) if parts else e.is_not_null()
        return Clause(gate, constants=[(_boost(v.get("boost", 1.0)), gate)])

    def _exists(self, body: Mapping[str, Any]) -> Clause:
        _check(body, {"field", "boost"}, "exists")
        gate = b.field(field_name(body["field"])).is_not_null()
        return Clause(gate, constants=[(_boost(body.get("boost", 1.0)), gate)])

    def _semantic(self, body: Mapping[str, Any], scoring: bool) -> Clause:
        _check(body, {"field", "query", "boost"}, "semantic")
        if not scoring:
            raise Unsupported("semantic in filter or must_not")
        if not body.get("query"):
            raise InvalidArgument("semantic: the query is empty")
        return Clause(TRUE, functions=[(b.fn.semantic_similarity(field_name(body["field"]), body["query"]), _boost(body.get("boost", 1.0)))])

    def _bool(self, body: Mapping[str, Any], scoring: bool) -> Clause:
        _check(body, {"must", "filter", "should", "must_not", "boost", "minimum_should_match"}, "bool")
        if body.get("minimum_should_match") not in (None, 0, 1, "0", "1"):
            raise Unsupported("minimum_should_match above 1")
        many = lambda k: [body[k]] if isinstance(body.get(k), Mapping) else list(body.get(k) or ())
        must = [self.compile(q, scoring) for q in many("must")]
        filters = [self.compile(q, False) for q in many("filter")]
        should = [self.compile(q, scoring) for q in many("should")]
        nots = [self.compile(q, False) for q in many("must_not")]
        gates = [c.gate for c in must + filters]
        needs_should = body.get("minimum_should_match") in (1, "1") or not (must or filters)
        if should and needs_should:
            gates.append(any_of([c.gate for c in should]))
        if nots:
            gates.append(any_of([c.gate for c in nots]).not_())
        out = Clause(all_of(gates))
        for c in must:
            out.texts += c.texts
            out.functions += c.functions
            out.constants += c.constants
        for c in should:
            out.texts += c.texts
            out.functions += c.functions
            out.constants += [(v, cond if cond is not None else c.gate) for v, cond in c.constants]
        return out.scaled(_boost(body.get("boost", 1.0)))

