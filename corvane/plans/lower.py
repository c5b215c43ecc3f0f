"""Lowering of queries to DataFrames.

Each stage becomes the DataFrame operation of its name, so Catalyst sees plain projections, filters, aggregates and
top-k sorts over the scan: filters and columns reach Parquet, a sort with a limit is one TakeOrderedAndProject.
Text filters are bound first, over the whole query, because a score may be selected before the filter it scores.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidArgument
from ..functions import text as text_functions
from ..functions import vector as vector_functions
from .ir import UNITS_MS, Aggregate, DenseVector, Expr, Int, Matrix, Query, Score, SparseVector, Text, check, fields_of, timestamp_ms
from .schema import Schema

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMBERS = (*_INTS, T.FloatType, T.DoubleType, T.DecimalType)
_TIMES = (T.TimestampType, T.TimestampNTZType)
_WIDTHS = {"u8": (0, 2**8 - 1), "u32": (0, 2**32 - 1), "i32": (-(2**31), 2**31 - 1)}


@dataclass
class Source:
    """Rows with an ``_id``, the schema that says what is indexed, and a place to keep text statistics of this snapshot."""

    df: DataFrame
    schema: Schema = field(default_factory=Schema)
    encoder: Callable[[Column, str], Column] | None = None
    statistics: dict[str, tuple[int, float, dict[str, int]]] = field(default_factory=dict)
    widths: dict[str, str] = field(default_factory=dict)


def _is(kind: T.DataType, *kinds: type) -> bool:
    return isinstance(kind, kinds)


class Lowering:
    """One query over one source."""

    def __init__(self, source: Source, query: Query, *, every_row: bool = False):
        check(query, every_row=every_row)
        self.source, self.query = source, query
        self.df = source.df
        self.base = set(self.df.columns)
        self.outputs: list[str] = []
        self.grouped = False
        self.limited: int | None = None
        self.skip = 0
        self.order: list[Column] = []
        self.matched: DataFrame | None = None
        self._types: dict[str, T.DataType] = {}

    # names and types

    def type_of(self, c: Column) -> T.DataType:
        return self.df.select(c.alias("x")).schema[0].dataType

    def column(self, name: str) -> Column | None:
        """A column, a path into a struct or variant, or None if there is nothing of that name."""
        if name in self.df.columns:
            return F.col(f"`{name}`")
        head, _, path = name.partition(".")
        if path and head in self.df.columns:
            kind = self.df.schema[head].dataType
            c = F.col(f"`{head}`")
            while path and _is(kind, T.StructType):
                part, _, rest = path.partition(".")
                if path in kind.fieldNames():
                    part, rest = path, ""
                if part not in kind.fieldNames():
                    return None
                c, kind, path = c.getField(part), kind[part].dataType, rest
            if not path:
                return c
            if _is(kind, T.VariantType):
                return F.try_variant_get(c, "$." + path, "variant")
            return None
        if "_extra" in self.df.columns and not self.grouped and name not in ("_id", "_extra"):
            return F.try_variant_get("_extra", f"$['{name}']" if "." not in name else "$." + name, "variant")
        return None

    # expressions

    def expr(self, e: Expr) -> Column:
        return getattr(self, f"_{e.op}", None)(e) if hasattr(self, f"_{e.op}") else self._simple(e)

    def predicate(self, e: Expr) -> Column:
        c = self.expr(e)
        kind = self.type_of(c)
        if _is(kind, T.VariantType):
            return F.coalesce(F.try_variant_get(c, "$", "boolean"), F.lit(False))
        if not _is(kind, T.BooleanType, T.NullType):
            raise InvalidArgument("filter must be a boolean expression")
        return c

    def _field(self, e: Expr) -> Column:
        index = self.source.schema.index(e.args[0])
        c = self.column(e.args[0])
        if index and index.kind in ("vector", "multi_vector"):
            raise InvalidArgument(f"the indexed vector `{e.args[0]}` cannot be used as a value")
        return F.lit(None) if c is None else c

    def _literal(self, e: Expr) -> Column:
        return literal_column(e.args[0])

    def _width(self, e: Expr) -> str | None:
        if e.op == "literal" and isinstance(e.args[0], Int):
            return e.args[0].width
        if e.op == "field":
            return self.source.widths.get(e.args[0])
        if e.op in ("add", "sub", "mul", "div"):
            a, b = (self._width(x) for x in e.args)
            return a if a == b else None
        return None

    def _literal_width(self, e: Expr) -> str | None:
        widths = {self._width(x) for x in e.args if x.op == "literal"}
        return widths.pop() if len(widths) == 1 and any(x.op == "field" for x in e.args) else None

    def _operands(self, e: Expr) -> list[Column]:
        """Operand columns; a variant takes the type of the other side."""
        cols = [self.expr(a) for a in e.args if isinstance(a, Expr)]
        kinds = [self.type_of(c) for c in cols]
        if any(_is(k, T.VariantType) for k in kinds):
            other = next((k for k in kinds if not _is(k, T.VariantType, T.NullType)), T.DoubleType())
            cols = [variant_as(c, other) if _is(k, T.VariantType) else c for c, k in zip(cols, kinds, strict=True)]
        if any(_is(k, *_TIMES) for k in kinds) and any(_is(k, *_NUMBERS) for k in kinds):
            cols = [millis(c) if _is(k, *_TIMES) else c for c, k in zip(cols, kinds, strict=True)]
        return cols

    def _simple(self, e: Expr) -> Column:
        op = e.op
        if op in ("and", "or", "all", "any"):
            cols = [self.predicate(a) for a in e.args]
            out = cols[0]
            for c in cols[1:]:
                out = out & c if op in ("and", "all") else out | c
            return out
        cols = self._operands(e)
        a = cols[0]
        if op == "not":
            return ~F.coalesce(self.predicate(e.args[0]), F.lit(False))
        if op == "is_null":
            return a.isNull() if not _is(self.type_of(self.expr(e.args[0])), T.VariantType) else self._absent(e.args[0])
        if op == "is_not_null":
            return a.isNotNull() if not _is(self.type_of(self.expr(e.args[0])), T.VariantType) else ~self._absent(e.args[0])
        if op in ("ln", "exp", "sqrt"):
            single = _is(self.type_of(a), T.FloatType, *_INTS)
            x = a.cast("double")
            if op == "ln":
                out = F.when(x > 0, F.ln(x)).when(x == 0, F.lit(float("-inf"))).when(x < 0, F.lit(float("nan")))
            else:
                out = F.exp(x) if op == "exp" else F.sqrt(x)
            return out.cast("float") if single else out
        if op == "abs":
            return F.abs(a)
        if op == "square":
            return a * a
        if op in ("saturate", "decay"):
            mid, power = e.args[1:]
            fall = F.pow(F.lit(2.0), -F.pow(a.cast("double") / F.lit(mid), F.lit(power)))
            return fall if op == "decay" else F.lit(1.0) - fall
        b = cols[1] if len(cols) > 1 else None
        if op in ("add", "sub", "mul", "div"):
            kinds = [self.type_of(c) for c in cols]
            if op == "div":
                whole = all(_is(k, *_INTS) for k in kinds)
                out = F.call_function("div", a, b) if whole else a / b
            else:
                out = a + b if op == "add" else a - b if op == "sub" else a * b
            if width := self._width(e):
                lo, hi = _WIDTHS.get(width, (-(2**63), 2**63 - 1))
                out = F.when((out >= lo) & (out <= hi), out).when(out.isNotNull(), F.raise_error(F.lit(f"{width} overflow in {op}")).cast("long"))
            elif (width := self._literal_width(e)) in _WIDTHS and all(_is(k, *_INTS) for k in kinds):
                # a field's value has the literal's width if it fits in it, and then so must the result
                lo, hi = _WIDTHS[width]
                fit = (F.least(a, b) >= lo) & (F.greatest(a, b) <= hi)
                out = F.when(fit & ((out < lo) | (out > hi)), F.raise_error(F.lit(f"{width} overflow in {op}")).cast("long")).otherwise(out)
            return out
        if op in ("eq", "neq", "lt", "lte", "gt", "gte"):
            if not self._comparable(cols):
                return F.lit(op == "neq")
            return {"eq": a == b, "neq": a != b, "lt": a < b, "lte": a <= b, "gt": a > b, "gte": a >= b}[op]
        if op == "coalesce":
            return F.coalesce(a, b)
        if op in ("min", "max"):
            return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b) if op == "min" else F.greatest(a, b))
        raise InvalidArgument(f"unknown operator `{op}`")

    def _comparable(self, cols: list[Column]) -> bool:
        a, b = (self.type_of(c) for c in cols)
        groups = [_NUMBERS, (T.StringType,), (T.BooleanType,), (T.BinaryType,), (*_TIMES, T.DateType), (T.ArrayType,), (T.StructType,)]
        return _is(a, T.NullType) or _is(b, T.NullType) or any(_is(a, *g) and _is(b, *g) for g in groups)

    def _absent(self, e: Expr) -> Column:
        c = self.expr(e)
        return c.isNull() | F.is_variant_null(c)

    def _choose(self, e: Expr) -> Column:
        x, y = self._operands(Expr("pair", e.args[1:]))
        return F.when(self.predicate(e.args[0]), x).otherwise(y)

    def _date_part(self, e: Expr) -> Column:
        c = self.expr(e.args[0])
        kind = self.type_of(c)
        if _is(kind, *_INTS):
            c = F.timestamp_millis(c)
        elif _is(kind, T.VariantType):
            c = F.timestamp_millis(F.try_variant_get(c, "$", "bigint"))
        part = e.args[1]
        plain = {"year": F.year, "month": F.month, "week": F.weekofyear, "day": F.dayofmonth, "day_of_year": F.dayofyear, "day_of_week": F.weekday, "hour": F.hour, "minute": F.minute, "second": F.second}
        if part == "millisecond":
            return F.pmod(millis(c), F.lit(1000)).cast("int")
        return plain[part](c)

    def _elapsed(self, e: Expr) -> Column:
        ms = []
        for x in e.args[:2]:
            c = self.expr(x)
            kind = self.type_of(c)
            ms.append(millis(c) if _is(kind, *_TIMES) else F.try_variant_get(c, "$", "bigint") if _is(kind, T.VariantType) else c)
        return F.call_function("div", ms[1] - ms[0], F.lit(UNITS_MS[e.args[2]]).cast("long"))

    def _regexp_match(self, e: Expr) -> Column:
        c = self._as_text(self.expr(e.args[0]))
        pattern = java_pattern(e.args[1], e.args[2])
        try:
            self.df.sparkSession._jvm.java.util.regex.Pattern.compile(pattern)
        except IllegalArgumentException as fault:
            raise InvalidArgument(f"regexp: {fault}") from None
        return F.lit(False) if c is None else c.rlike(pattern)

    def _as_text(self, c: Column) -> Column | None:
        kind = self.type_of(c)
        if _is(kind, T.VariantType):
            return F.when(F.schema_of_variant(c) == "STRING", F.try_variant_get(c, "$", "string"))
        return c if _is(kind, T.StringType, T.NullType) else None

    def _starts_with(self, e: Expr) -> Column:
        a, b = self.expr(e.args[0]), self.expr(e.args[1])
        ka, kb = self.type_of(a), self.type_of(b)
        if _is(kb, T.VariantType):
            b, kb = self._as_text(b), T.StringType()
        if not _is(kb, T.StringType):
            return F.lit(False)
        if _is(ka, T.StringType):
            return F.startswith(a, b)
        if _is(ka, T.ArrayType) and _is(ka.elementType, T.StringType):
            return F.exists(a, lambda x: F.startswith(x, b))
        if _is(ka, T.VariantType):
            return F.coalesce(F.startswith(self._as_text(a), b), F.exists(F.try_variant_get(a, "$", "array<string>"), lambda x: F.startswith(x, b)) & F.schema_of_variant(a).startswith("ARRAY<STRING"), F.lit(False))
        return F.lit(False)

    def _contains(self, e: Expr) -> Column:
        return self._holds(self.expr(e.args[0]), self.expr(e.args[1]))

    def _in(self, e: Expr) -> Column:
        item, box = e.args
        if box.op == "literal" and isinstance(box.args[0], (list, tuple)):
            values = [v for v in box.args[0] if v is not None]
            c = self.expr(item)
            kind = self.type_of(c)
            if _is(kind, T.VariantType):
                out = F.lit(False)
                for v in values:
                    out = out | F.coalesce(variant_as(c, self.type_of(literal_column(v))) == literal_column(v), F.lit(False))
                return out
            fit = [v for v in values if self._comparable([c, literal_column(v)])]
            return c.isin(fit) if fit else F.lit(False)
        return self._holds(self.expr(box), self.expr(item))

    def _holds(self, box: Column, item: Column) -> Column:
        """Substring of a text or member of a list; other types: false."""
        kb, ki = self.type_of(box), self.type_of(item)
        if _is(ki, T.VariantType):
            item, ki = self._as_text(item), T.StringType()
        if _is(kb, T.StringType):
            return F.contains(box, item) if _is(ki, T.StringType) else F.lit(False)
        if _is(kb, T.ArrayType):
            element = kb.elementType
            if _is(element, *_NUMBERS) and _is(ki, *_NUMBERS):
                return F.exists(box, lambda x: x.cast("double") == item.cast("double"))
            return F.array_contains(box, item) if type(element) is type(ki) else F.lit(False)
        if _is(kb, T.VariantType):
            name = F.schema_of_variant(box)
            if _is(ki, T.StringType):
                whole = F.when(name == "STRING", F.contains(F.try_variant_get(box, "$", "string"), item))
                member = F.when(name.startswith("ARRAY<STRING"), F.array_contains(F.try_variant_get(box, "$", "array<string>"), item))
                return F.coalesce(whole, member, F.lit(False))
            if _is(ki, *_NUMBERS):
                numeric = name.rlike(r"^ARRAY<(BIGINT|DOUBLE|FLOAT|DECIMAL.*)>$")
                return F.coalesce(F.when(numeric, F.array_contains(F.try_variant_get(box, "$", "array<double>"), item.cast("double"))), F.lit(False))
        return F.lit(False)

    # text

    def _tokens(self, name: str) -> text_functions.TokenField:
        """Tokens of a field: an exact field is one token, a list's elements are tokens as they are."""
        index = self.source.schema.index(name)
        if index is None or index.kind not in ("keyword", "semantic"):
            raise InvalidArgument(f"Invalid query: field `{name}` has no keyword index")
        listed = _is(self.source.df.schema[name].dataType, T.ArrayType)
        return text_functions.TokenField(F.col(f"`{name}`"), "list" if listed else "whole" if index.exact else "text")

    def _terms(self, name: str, text: str) -> list[str]:
        index = self.source.schema.index(name)
        whole = index is not None and index.exact or _is(self.source.df.schema[name].dataType, T.ArrayType)
        return [text] if whole else text_functions.analyze(text)

    def _match_logical(self, e: Expr, every: bool) -> Column:
        target, query = e.args
        if target.op != "field":
            raise InvalidArgument("match_all and match_any take a field")
        name = target.args[0]
        toks, value = self._tokens(name), query.args[0] if query.op == "literal" else None
        if isinstance(value, str):
            terms = self._terms(name, value)
        elif isinstance(value, (list, tuple)):
            terms = list(value)
        else:
            raise InvalidArgument("match_all and match_any take a text or a list of tokens")
        if not terms:
            return F.lit(False)
        return toks.every(terms) if every else toks.some(terms)

    def _match_all(self, e: Expr) -> Column:
        return self._match_logical(e, True)

    def _match_any(self, e: Expr) -> Column:
        return self._match_logical(e, False)

    def _leaf_terms(self, leaf: Text) -> list[tuple[str, list[tuple[str, float]]]]:
        """Fields of a text leaf with their weighted terms."""
        names = [leaf.field] if leaf.field else self.source.schema.keyword_fields()
        if not names:
            raise InvalidArgument("Invalid query: there is no field with a keyword index")
        return [(n, list(leaf.tokens) if leaf.tokens is not None else [(t, leaf.weight) for t in self._terms(n, leaf.text or "")]) for n in names]

    def _gate(self, t: Text) -> Column:
        if t.op != "terms":
            cols = [self._gate(a) for a in t.args]
            return cols[0] & cols[1] if t.op == "and" else cols[0] | cols[1]
        if not t.gate:
            return F.lit(True)
        out = F.lit(False)
        for name, terms in self._leaf_terms(t):
            if terms:
                toks, asked = self._tokens(name), [w for w, _ in terms]
                out = out | (toks.every(asked) if t.all else toks.some(asked))
        return out

    def _text_statistics(self, wanted: dict[str, set[str]]) -> dict[str, tuple[int, float, dict[str, int]]]:
        """Documents, average length and document frequencies by field, over the whole collection; one scan for all that is new."""
        known, todo = self.source.statistics, {}
        for name, terms in wanted.items():
            have = known.get(name, (0, 0.0, {}))[2]
            new = sorted(terms - set(have))
            if new or name not in known:
                todo[name] = new
        if todo:
            aggs = []
            for k, (name, terms) in enumerate(todo.items()):
                toks = self._tokens(name)
                aggs += [F.count(toks.column).alias(f"n{k}"), F.avg(toks.length().cast("double")).alias(f"a{k}")]
                aggs += [F.sum(toks.has(t).cast("long")).alias(f"d{k}_{i}") for i, t in enumerate(terms)]
            row = self.source.df.agg(*aggs).first()
            for k, (name, terms) in enumerate(todo.items()):
                old = known.get(name, (0, 0.0, {}))[2]
                known[name] = (row[f"n{k}"], row[f"a{k}"] or 0.0, old | {t: row[f"d{k}_{i}"] or 0 for i, t in enumerate(terms)})
        return known

    def _bm25(self, texts: list[Text], b: float, k1: float) -> Column:
        leaves = [(name, terms) for t in texts for leaf in t.leaves() for name, terms in self._leaf_terms(leaf)]
        wanted: dict[str, set[str]] = {}
        for name, terms in leaves:
            wanted.setdefault(name, set()).update(t for t, _ in terms)
        stats = self._text_statistics(wanted)
        score = F.lit(0.0)
        for name, terms in leaves:
            toks = self._tokens(name)
            n, average, df = stats[name]
            length = F.coalesce(toks.length(), F.lit(0))
            for term, weight in terms:
                score = score + text_functions.bm25_term(toks.frequency(term), length, weight, text_functions.idf(n, df.get(term, 0)), average, b, k1)
        return score.cast("float")

    # scores

    def score(self, s: Score) -> Column:
        if s.kind == "bm25_score":
            texts = self.query.texts()
            if not texts:
                raise InvalidArgument("Invalid query: Query must have at least one text filter to compute bm25 scores")
            return self._bm25(texts, s.option("b", text_functions.B), s.option("k1", text_functions.K1))
        index = self.source.schema.index(s.field)
        if s.kind == "semantic_similarity":
            if index is None or index.kind != "semantic":
                raise InvalidArgument(f"Invalid query: field `{s.field}` has no semantic index")
            encode = self.source.encoder or (lambda c, q: text_functions.hashed_similarity(text_functions.tokens(c), text_functions.analyze(q)))
            return encode(F.col(f"`{s.field}`"), s.query).cast("float")
        spec = self.source.schema.fields.get(s.field)
        c = F.col(f"`{s.field}`")
        if s.kind == "vector_distance":
            if index is None or index.kind != "vector":
                raise InvalidArgument(f"Invalid query: field `{s.field}` has no vector index")
            if isinstance(s.query, SparseVector) != spec.type.endswith("sparse_vector"):
                raise InvalidArgument(f"Invalid query: the query's type doesn't fit `{s.field}`")
            if isinstance(s.query, SparseVector):
                return vector_functions.sparse_dot(c, s.query.values).cast("float")
            if len(s.query.values) != spec.dim:
                raise InvalidArgument(f"Invalid query: `{s.field}` has dimension {spec.dim}, the query {len(s.query.values)}")
            return vector_functions.vector_distance(c, s.query.values, index.metric).cast("float")
        if index is None or index.kind != "multi_vector":
            raise InvalidArgument(f"Invalid query: field `{s.field}` has no multi-vector index")
        if not isinstance(s.query, Matrix) or s.query.kind != spec.element and s.query.kind != "f32" or len(s.query.rows[0]) != spec.dim:
            raise InvalidArgument(f"Invalid query: the query matrix doesn't fit `{s.field}`")
        sim = vector_functions.max_sim(c, s.query.rows)
        if smve := s.option("smve"):
            name, query = smve
            sparse = self.source.schema.fields.get(name)
            if sparse is None or not sparse.type.endswith("sparse_vector"):
                raise InvalidArgument(f"Invalid query: `{name}` is no sparse vector")
            sim = F.when(F.col(f"`{name}`").isNotNull(), sim)
        return sim.cast("float")

    # stages

    def run(self) -> DataFrame:
        stages = self.query.stages
        fetched: tuple[str, ...] = ()
        for t in self.query.texts():
            for leaf in t.leaves():
                self._leaf_terms(leaf) and [self._tokens(n) for n, _ in self._leaf_terms(leaf)]
        for s in stages:
            if s.kind == "select":
                new = {}
                for name, e in s.value:
                    if isinstance(e, Score):
                        new[name] = self.score(e)
                    elif e.op == "field" and self.column(e.args[0]) is None:
                        continue  # a field that exists nowhere is left out
                    elif e.op == "field" and e.args[0] == name and name in self.df.columns:
                        self._field(e)
                        self.outputs += [name] if name not in self.outputs else []
                        continue
                    else:
                        new[name] = self.expr(e)
                    if name not in self.outputs:
                        self.outputs.append(name)
                if new:
                    self.df = self.df.withColumns(new)
            elif s.kind == "filter":
                self.df = self.df.filter(self.predicate(s.value))
            elif s.kind == "filter_text":
                self.df = self.df.filter(self._gate(s.value))
            elif s.kind == "sort":
                self._sort(s.value)
            elif s.kind == "limit":
                self.limited = s.value
            elif s.kind == "offset":
                self.skip = s.value
            elif s.kind == "count":
                self.df = self.df.agg(F.count(F.lit(1)).alias("_count"))
                self.grouped, self.outputs = True, ["_count"]
            elif s.kind == "group_by":
                self._group(*s.value)
            elif s.kind == "fetch":
                fetched = s.value
        df = self.df
        self.matched = df if self.order else None
        if self.skip and self.limited is None:
            raise InvalidArgument("offset needs a limit")
        if self.order:
            df = df.orderBy(*self.order)
        if self.skip:
            df = df.offset(self.skip)
        if self.limited is not None:
            df = df.limit(self.limited)
        if fetched:
            self.df = df
            names = [c for c in self.source.df.columns if c != "_id"] if "*" in fetched else list(fetched)
            df = df.withColumns({n: c for n in names if (c := self.column(n)) is not None and n not in df.columns})
            self.outputs += [n for n in names if n in df.columns and n not in self.outputs]
        if self.grouped:
            return df.select(*[f"`{c}`" for c in self.outputs])
        out = [c for c in self.outputs if c != "_id"]
        return df.select("_id", *[output_column(df, c) for c in out]) if out else df.select("_id")

    def _sort(self, keys: tuple) -> None:
        cols = []
        for e, asc in keys:
            if not any(f in self.df.columns or self.column(f) is not None and (("_extra" not in self.df.columns) or self._ever(f)) for f in fields_of(e)) and fields_of(e):
                if self.df.isEmpty():
                    continue
                raise InvalidArgument(f"Invalid query: cannot sort on unknown field `{sorted(fields_of(e))[0]}`")
            c = self.expr(e)
            if _is(self.type_of(c), T.VariantType):
                c = self._sortable_variant(c)
            elif _is(self.type_of(c), T.ArrayType, T.StructType, T.MapType):
                raise InvalidArgument("Invalid query: values of this type cannot be sorted")
            cols.append((c, asc))
        if cols:
            some = cols[0][0].isNotNull()
            for c, _ in cols[1:]:
                some = some | c.isNotNull()
            self.df = self.df.filter(some)
        self.order = [c.asc_nulls_last() if asc else c.desc_nulls_last() for c, asc in cols]
        ties = ["_id"] if "_id" in self.df.columns else [c for c in self.outputs if not _is(self.df.schema[c].dataType, T.MapType, T.VariantType)]
        self.order += [F.col(f"`{c}`").asc_nulls_last() for c in ties]

    def _ever(self, name: str) -> bool:
        return not self.df.filter(self.column(name).isNotNull()).isEmpty()

    def _sortable_variant(self, c: Column) -> Column:
        """A union can be sorted if all its values are numbers, or all are texts."""
        kinds = {r[0] for r in self.df.filter(c.isNotNull() & ~F.is_variant_null(c)).select(F.regexp_replace(F.schema_of_variant(c), r"\(.*", "")).distinct().limit(8).collect()}
        if kinds <= {"BIGINT", "DOUBLE", "FLOAT", "DECIMAL"}:
            return F.try_variant_get(c, "$", "double")
        if kinds == {"STRING"}:
            return F.try_variant_get(c, "$", "string")
        raise InvalidArgument("Invalid query: cannot sort a field of mixed types")

    def _group(self, keys: tuple, aggs: tuple) -> None:
        named = []
        for name, e in keys:
            c = self.expr(e)
            named.append((F.to_json(c) if _is(self.type_of(c), T.VariantType) else c).alias(name))
        cols = [self._aggregate(a).alias(name) for name, a in aggs]
        self.df = self.df.groupBy(*named).agg(*cols)
        self.grouped, self.outputs = True, [n for n, _ in keys] + [n for n, _ in aggs]

    def _aggregate(self, a: Aggregate) -> Column:
        if a.field is None:
            return F.count(F.lit(1))
        c = self.column(a.field)
        c = F.lit(None).cast("long") if c is None else c
        if _is(self.type_of(c), T.VariantType):
            c = F.count(c) if a.kind == "count" else F.try_variant_get(c, "$", "double")
            if a.kind == "count":
                return c
        return {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg}[a.kind](c)


def output_column(df: DataFrame, name: str) -> Column:
    """As the service returns it: timestamps are epoch milliseconds."""
    c = F.col(f"`{name}`")
    return millis(c).alias(name) if isinstance(df.schema[name].dataType, _TIMES) else c


def millis(c: Column) -> Column:
    """Epoch milliseconds of a timestamp; one without a zone is UTC, as sessions of this engine are."""
    return F.unix_millis(c.cast("timestamp"))


def literal_column(v: Any) -> Column:
    if isinstance(v, Int):
        return F.lit(v.value).cast("long")
    if isinstance(v, bool) or v is None or isinstance(v, (str, float)):
        return F.lit(v)
    if isinstance(v, int):
        return F.lit(v).cast("long") if -(2**63) <= v < 2**63 else F.lit(v).cast("decimal(20,0)")
    if isinstance(v, (bytes, bytearray)):
        return F.lit(bytes(v))
    if isinstance(v, dt.datetime):
        return F.timestamp_millis(F.lit(timestamp_ms(v)).cast("long"))
    if isinstance(v, (list, tuple)):
        if any(isinstance(x, float) for x in v):
            v = [float(x) if isinstance(x, (int, float)) else x for x in v]
        return F.array(*[literal_column(x) for x in v])
    if isinstance(v, dict):
        return F.struct(*[literal_column(x).alias(k) for k, x in v.items()])
    if isinstance(v, DenseVector):
        return F.array(*[F.lit(float(x)) for x in v.values])
    raise InvalidArgument(f"a {type(v).__name__} cannot be a literal here")


def variant_as(c: Column, kind: T.DataType) -> Column:
    """The variant's value if it has the kind (numbers of any width are one kind), else null."""
    name = F.schema_of_variant(c)
    if isinstance(kind, _NUMBERS):
        return F.when(name.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"), F.try_variant_get(c, "$", "double"))
    if isinstance(kind, T.StringType):
        return F.when(name == "STRING", F.try_variant_get(c, "$", "string"))
    if isinstance(kind, T.BooleanType):
        return F.when(name == "BOOLEAN", F.try_variant_get(c, "$", "boolean"))
    return F.try_variant_get(c, "$", kind.simpleString())


#: POSIX classes as members of a class.
_POSIX = {
    "alnum": "0-9A-Za-z", "alpha": "A-Za-z", "ascii": r"\x00-\x7F", "blank": r"\t ", "cntrl": r"\x00-\x1F\x7F", "digit": "0-9", "graph": "!-~", "lower": "a-z", "print": " -~",
    "punct": r"!-/:-@\[-`{-~", "space": r"\t\n\x0B\f\r ", "upper": "A-Z", "word": "0-9A-Za-z_", "xdigit": "0-9A-Fa-f",
}


def java_pattern(pattern: str, flags: str) -> str:
    """A pattern of a linear-time engine, with its flags (i, m, s, x, u), as a Java pattern.

    Classes, word boundaries and case are Unicode's, only a newline ends a line, and ``$`` is the very end unless lines are
    anchored. What such an engine lacks (back references, look-around, atomic and possessive forms) is refused. Escapes
    and classes are read as such: ``[*+]`` and ``C\\++`` hold no possessive form. Groups lose their names, as nothing refers to them.
    """
    if bad := set(flags) - set("imsxu"):
        raise InvalidArgument(f"regexp: unknown flags {''.join(sorted(bad))}")
    refuse = InvalidArgument("regexp: back references, look-around and possessive forms are not supported")
    lines = "m" in flags or re.search(r"\(\?[a-z]*m", pattern) is not None
    out, at, n, depth, repeated = [], 0, len(pattern), 0, False
    while at < n:
        c, was, repeated = pattern[at], repeated, False
        if c == "\\":
            if at + 1 == n:
                raise InvalidArgument("regexp: a pattern cannot end with a backslash")
            if not depth and (pattern[at + 1] in "123456789k"):
                raise refuse
            out.append(pattern[at : at + 2])
            at += 2
            continue
        if c == "[":
            if depth and (m := re.match(r"\[:(\^?)([a-z]+):\]", pattern[at:])):
                if m[2] not in _POSIX:
                    raise InvalidArgument(f"regexp: unknown class {m[2]}")
                out.append(f"[^{_POSIX[m[2]]}]" if m[1] else _POSIX[m[2]])
                at += len(m[0])
                continue
            depth += 1
            out.append(c)
            at += 1
            if pattern[at : at + 1] == "^":
                out.append("^")
                at += 1
            if pattern[at : at + 1] == "]":  # the first one is a member
                out.append("\\]")
                at += 1
            continue
        if depth:
            depth -= c == "]"
            out.append(c)
        elif c == "(" and pattern[at : at + 2] == "(?":
            m = re.match(r"\(\?(?:P?<([A-Za-z_]\w*)>|([a-zA-Z]*)(?:-([a-zA-Z]+))?([:)]))", pattern[at:])
            if m is None:
                raise refuse
            if m[1]:
                out.append("(")
            else:
                if bad := set(m[2] + (m[3] or "")) - set("imsxu") or "u" in (m[3] or ""):
                    raise InvalidArgument("regexp: unknown inline flags")
                off = f"-{m[3]}" if m[3] else ""
                out.append(f"(?{m[2].replace('u', '')}{off}{m[4]}")
            at += len(m[0])
            continue
        elif c in "*+?" or c == "}":
            if c == "+" and was:
                raise refuse
            out.append(c)
            repeated = True
        else:
            out.append("\\z" if c == "$" and not lines else c)
        at += 1
    return f"(?dUu{''.join(sorted(set(flags) - {'u'}))})" + "".join(out)


def run(source: Source, query: Query, *, every_row: bool = False) -> DataFrame:
    """The result; with ``every_row`` a sort without a limit returns all rows that have a key."""
    return Lowering(source, query, every_row=every_row).run()


def run_with_matched(source: Source, query: Query) -> tuple[DataFrame, Callable[[], int | None]]:
    """The result, and how many rows passed the filters: a number for sorted queries, None for a bare limit."""
    low = Lowering(source, query)
    out = low.run()
    return out, lambda: None if low.matched is None else low.matched.count()
