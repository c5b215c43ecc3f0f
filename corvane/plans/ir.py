"""The one plan representation that the builder, SQL and JSON front ends share.

A query is an immutable list of stages over expressions of four kinds: logical (scalars and predicates), text (gates that
also score), score functions and aggregates. Nothing here touches Spark.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from ..errors import InvalidArgument

MAX_DEPTH = 16
MAX_ARITY = 32
MAX_SORT_KEYS = 8

DATE_PARTS = ("year", "month", "week", "day", "day_of_year", "day_of_week", "hour", "minute", "second", "millisecond")
UNITS_MS = {"ms": 1, "s": 1000, "min": 60_000, "h": 3_600_000, "day": 86_400_000, "week": 604_800_000}
_UNIT_NAMES = {
    "millisecond": "ms", "milliseconds": "ms", "sec": "s", "second": "s", "seconds": "s", "minute": "min", "minutes": "min",
    "hour": "h", "hours": "h", "d": "day", "days": "day", "w": "week", "weeks": "week",
}


def unit_name(unit: str) -> str:
    name = _UNIT_NAMES.get(unit.lower(), unit.lower())
    if name not in UNITS_MS:
        raise InvalidArgument(f"elapsed: unknown unit `{unit}`")
    return name


@dataclass(frozen=True)
class SparseVector:
    """Sparse values by index."""

    values: tuple[tuple[int, float], ...]
    kind: str = "f32"

    @classmethod
    def of(cls, values: Mapping[int, float], kind: str = "f32") -> "SparseVector":
        return cls(tuple(sorted((int(i), float(v)) for i, v in values.items())), kind)


@dataclass(frozen=True)
class DenseVector:
    """A typed dense vector literal."""

    values: tuple[float, ...]
    kind: str = "f32"


@dataclass(frozen=True)
class Matrix:
    """Rows of equal length."""

    rows: tuple[tuple[float, ...], ...]
    kind: str = "f32"

    @classmethod
    def of(cls, rows: Iterable[Iterable[float]], kind: str = "f32") -> "Matrix":
        out = tuple(tuple(float(x) for x in r) for r in rows)
        if not out or not out[0] or len({len(r) for r in out}) != 1:
            raise InvalidArgument("a matrix needs rows of one length")
        return cls(out, kind)


@dataclass(frozen=True)
class Int:
    """An integer literal of a fixed width, such as u32, whose arithmetic is checked at that width."""

    value: int
    width: str


def _wrap(value: Any) -> "Expr":
    if isinstance(value, Expr):
        return value
    if isinstance(value, (Score, Aggregate, Text)):
        raise InvalidArgument("only logical expressions can be combined; select a score under a name first")
    return Expr("literal", (value,))


class Expr:
    """A logical expression: an operator and its arguments."""

    __slots__ = ("op", "args")

    def __init__(self, op: str, args: tuple = ()):
        self.op, self.args = op, args

    def same(self, other: object) -> bool:
        """Whether both are the same tree (``==`` builds an expression)."""
        return repr(self) == repr(other)

    def __repr__(self) -> str:
        return f"{self.op}({', '.join(map(repr, self.args))})"

    def __bool__(self) -> bool:
        raise TypeError("an expression has no truth value; use & and |")

    __hash__ = object.__hash__

    def _with(self, op: str, *others: Any) -> "Expr":
        return Expr(op, (self, *map(_wrap, others)))

    # unary
    def not_(self):
        return self._with("not")

    def is_null(self):
        return self._with("is_null")

    def is_not_null(self):
        return self._with("is_not_null")

    def abs(self):
        return self._with("abs")

    def ln(self):
        return self._with("ln")

    def exp(self):
        return self._with("exp")

    def sqrt(self):
        return self._with("sqrt")

    def square(self):
        return self._with("square")

    # binary
    def add(self, other):
        return self._with("add", other)

    def sub(self, other):
        return self._with("sub", other)

    def mul(self, other):
        return self._with("mul", other)

    def div(self, other):
        return self._with("div", other)

    def eq(self, other):
        return self._with("eq", other)

    def ne(self, other):
        return self._with("neq", other)

    def lt(self, other):
        return self._with("lt", other)

    def lte(self, other):
        return self._with("lte", other)

    def gt(self, other):
        return self._with("gt", other)

    def gte(self, other):
        return self._with("gte", other)

    def and_(self, other):
        return self._with("and", other)

    def or_(self, other):
        return self._with("or", other)

    def starts_with(self, other):
        return self._with("starts_with", other)

    def contains(self, other):
        return self._with("contains", other)

    def in_(self, other):
        return self._with("in", other if isinstance(other, Expr) else list(other) if not isinstance(other, str) else other)

    def match_all(self, other):
        return self._with("match_all", other)

    def match_any(self, other):
        return self._with("match_any", other)

    def coalesce(self, other):
        return self._with("coalesce", other)

    def min(self, other):
        return self._with("min", other)

    def max(self, other):
        return self._with("max", other)

    def date_part(self, part: str):
        if part not in DATE_PARTS:
            raise InvalidArgument(f"date_part: unknown part `{part}`")
        return Expr("date_part", (self, part))

    def choose(self, x, y):
        return self._with("choose", x, y)

    def boost(self, condition, factor):
        return self.mul(_wrap(condition).choose(factor, 1))

    def regexp_match(self, pattern: str, flags: str = ""):
        return Expr("regexp_match", (self, pattern, flags or ""))

    def elapsed(self, end, unit: str):
        return Expr("elapsed", (self, _wrap(end), unit_name(unit)))

    def saturate(self, mid: float, exp: float = 1.0):
        """1 - 2^-((x / mid)^exp): 0 at 0, one half at ``mid``."""
        return Expr("saturate", (self, float(mid), float(exp)))

    def decay(self, mid: float, exp: float = 1.0):
        """2^-((x / mid)^exp): 1 at 0, one half at ``mid``."""
        return Expr("decay", (self, float(mid), float(exp)))

    # operators
    __invert__ = not_
    __add__, __sub__, __mul__, __truediv__ = add, sub, mul, div
    __eq__, __ne__, __lt__, __le__, __gt__, __ge__ = eq, ne, lt, lte, gt, gte
    __and__, __or__ = and_, or_

    def __radd__(self, other):
        return _wrap(other).add(self)

    def __rsub__(self, other):
        return _wrap(other).sub(self)

    def __rmul__(self, other):
        return _wrap(other).mul(self)

    def __rtruediv__(self, other):
        return _wrap(other).div(self)

    def __rand__(self, other):
        return _wrap(other).and_(self)

    def __ror__(self, other):
        return _wrap(other).or_(self)

    def __neg__(self):
        return _wrap(0).sub(self)

    def __abs__(self):
        return self.abs()


def fields_of(e: Expr) -> set[str]:
    if e.op == "field":
        return {e.args[0]}
    return {f for a in e.args if isinstance(a, Expr) for f in fields_of(a)}


@dataclass(frozen=True)
class Text:
    """A text expression: terms of a field, or a conjunction or disjunction of such."""

    op: str  # terms, and, or
    args: tuple["Text", ...] = ()
    text: str | None = None
    tokens: tuple[tuple[str, float], ...] | None = None
    field: str | None = None
    weight: float = 1.0
    all: bool = False
    gate: bool = True

    def and_(self, other: "Text") -> "Text":
        return Text("and", (self, other))

    def or_(self, other: "Text") -> "Text":
        return Text("or", (self, other))

    __and__, __or__ = and_, or_

    def boost(self, factor: float) -> "Text":
        if self.op != "terms":
            return replace(self, args=tuple(a.boost(factor) for a in self.args))
        return replace(self, weight=self.weight * factor, tokens=self.tokens and tuple((t, w * factor) for t, w in self.tokens))

    def depth(self) -> int:
        return 1 + max((a.depth() for a in self.args), default=0)

    def leaves(self) -> list["Text"]:
        return [self] if self.op == "terms" else [x for a in self.args for x in a.leaves()]

    def __bool__(self) -> bool:
        raise TypeError("a text expression has no truth value; use & and |")


@dataclass(frozen=True)
class Score:
    """A scoring function; only in select."""

    kind: str  # vector_distance, bm25_score, semantic_similarity, multi_vector_distance
    field: str | None = None
    query: Any = None
    options: tuple[tuple[str, Any], ...] = ()

    def option(self, name: str, default: Any = None) -> Any:
        return dict(self.options).get(name, default)

    def skip_refine(self, on: bool = True) -> "Score":
        """Accepted; scores are exact either way."""
        return replace(self, options=(*self.options, ("skip_refine", on)))

    def with_smve(self, field: str, query: "SparseVector | Mapping[int, float]") -> "Score":
        """Candidates of a multi-vector distance by a sparse field."""
        if self.kind != "multi_vector_distance":
            raise InvalidArgument("with_smve goes with multi_vector_distance")
        vector = query if isinstance(query, SparseVector) else SparseVector.of(query)
        return replace(self, options=(*self.options, ("smve", (field, vector))))


@dataclass(frozen=True)
class Aggregate:
    kind: str  # count, sum, min, max, avg
    field: str | None = None


@dataclass(frozen=True)
class Stage:
    kind: str
    value: Any = None


@dataclass(frozen=True)
class Query:
    """A list of stages; each method adds one."""

    stages: tuple[Stage, ...] = field(default_factory=tuple)

    def _add(self, kind: str, value: Any = None) -> "Query":
        return Query((*self.stages, Stage(kind, value)))

    def select(self, *names: str | Mapping[str, Any], **named: Any) -> "Query":
        items: dict[str, Any] = {}
        for n in names:
            if isinstance(n, Mapping):
                items |= n
            else:
                items[n] = Expr("field", (n,))
        items |= named
        return self._add("select", tuple((k, v if isinstance(v, Score) else _wrap(v)) for k, v in items.items()))

    def filter(self, expr: "Expr | Text") -> "Query":
        if isinstance(expr, Text):
            return self._add("filter_text", expr)
        return self._add("filter", _wrap(expr))

    def sort(self, key: Any, asc: bool = False) -> "Query":
        keys = key if isinstance(key, (list, tuple)) else [(key, asc)]
        pairs = [k if isinstance(k, (list, tuple)) else (k, asc) for k in keys]
        return self._add("sort", tuple((_wrap(e), o if isinstance(o, bool) else str(o).lower() == "asc") for e, o in pairs))

    def topk(self, key: Any, k: int, asc: bool = False) -> "Query":
        return self.sort(key, asc).limit(k)

    def limit(self, k: int) -> "Query":
        return self._add("limit", k)

    def offset(self, n: int) -> "Query":
        return self._add("offset", n)

    def count(self) -> "Query":
        return self._add("count")

    def group_by(self, keys: Mapping[str, Any] | Iterable[str], aggs: Mapping[str, Aggregate]) -> "Query":
        named = keys if isinstance(keys, Mapping) else {k: Expr("field", (k,)) for k in keys}
        return self._add("group_by", (tuple((k, _wrap(v)) for k, v in named.items()), tuple(aggs.items())))

    def fetch(self, fields: Iterable[str]) -> "Query":
        return self._add("fetch", tuple(fields))

    def texts(self) -> list[Text]:
        return [s.value for s in self.stages if s.kind == "filter_text"]


def field_(name: str) -> Expr:
    return Expr("field", (name,))


def literal(value: Any, width: str | None = None) -> Expr:
    return Expr("literal", (Int(value, width) if width else value,))


def check(query: Query, *, every_row: bool = False) -> None:
    """The rules on stages that need no schema; with ``every_row`` a sort may stand without a limit."""

    def depth(e: Expr) -> int:
        if e.op in ("all", "any") and len(e.args) > MAX_ARITY:
            raise InvalidArgument(f"{e.op}: more than {MAX_ARITY} arguments")
        below = max((depth(a) for a in e.args if isinstance(a, Expr)), default=0)
        out = below + (e.op in ("and", "or"))
        if out > MAX_DEPTH:
            raise InvalidArgument("Invalid query: expression is too deep")
        return out

    limits = offsets = sorts = 0
    counted = limited = False
    selected: set[str] = set()
    for s in query.stages:
        if counted and s.kind != "filter":
            raise InvalidArgument(f"count must be the last stage, not followed by {s.kind}")
        if s.kind == "select":
            for name, e in s.value:
                selected.add(name)
                if isinstance(e, Expr):
                    depth(e)
        elif s.kind == "filter":
            depth(s.value)
        elif s.kind == "filter_text":
            if s.value.depth() > MAX_DEPTH:
                raise InvalidArgument("Invalid query: text expression is too deep")
        elif s.kind == "sort":
            sorts += 1
            if sorts > 1:
                raise InvalidArgument("a query has one sort at most")
            if not 1 <= len(s.value) <= MAX_SORT_KEYS:
                raise InvalidArgument(f"sort takes 1 to {MAX_SORT_KEYS} keys")
        elif s.kind == "limit":
            limits += 1
            limited = True
            if not isinstance(s.value, int) or s.value <= 0:
                raise InvalidArgument("Limit k must be > 0")
            if limits > 1:
                raise InvalidArgument("a query has one limit at most")
        elif s.kind == "offset":
            offsets += 1
            if s.value < 0 or offsets > 1:
                raise InvalidArgument("a query has one offset at most, of 0 or more")
        elif s.kind == "count":
            if limited:
                raise InvalidArgument("count cannot follow limit")
            counted = True
        elif s.kind == "group_by":
            keys, aggs = s.value
            if not keys:
                raise InvalidArgument("group_by needs a key")
            if not aggs:
                raise InvalidArgument("group_by needs an aggregate")
            for _, e in keys:
                depth(e)
        elif s.kind == "fetch" and (both := selected & set(s.value)):
            raise InvalidArgument(f"fetch overlaps select: {', '.join(sorted(both))}")
    if sorts and not limits and not every_row:
        raise InvalidArgument("sort must be followed by limit")


def timestamp_ms(value: dt.datetime) -> int:
    """Epoch milliseconds of an aware datetime; finer parts are cut off."""
    if value.tzinfo is None:
        raise InvalidArgument("a timestamp needs a time zone")
    delta = value - dt.datetime(1970, 1, 1, tzinfo=dt.UTC)
    return (delta.days * 86_400_000_000 + delta.seconds * 1_000_000 + delta.microseconds) // 1000
