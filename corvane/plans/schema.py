"""Collection schemas: field types, indexes and the rules on them."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

from ..errors import SchemaError

MAX_DENSE_DIM, MAX_MATRIX_DIM = 16_384, 1_024
MAX_STRUCT_DEPTH = 16

_VECTOR = re.compile(r"(f32|f16|f8|u8|i8|binary)_vector")
_SPARSE = re.compile(r"(f32|f16|f8|u8|i8)_sparse_vector")
SPARSE_TYPE = T.StructType([T.StructField("indices", T.ArrayType(T.LongType())), T.StructField("values", T.ArrayType(T.FloatType()))])


@dataclass(frozen=True)
class Index:
    """keyword (text or exact), vector (with a metric), multi_vector, semantic or ngram."""

    kind: str
    metric: str | None = None
    exact: bool = False
    options: tuple[tuple[str, Any], ...] = ()


@dataclass(frozen=True)
class FieldSpec:
    """text, integer, float, boolean, bytes, timestamp, list, ``*_vector``, ``*_sparse_vector``, matrix or struct."""

    type: str
    dim: int | None = None
    element: str | None = None
    fields: tuple[tuple[str, "FieldSpec"], ...] = ()
    is_required: bool = False
    index: Index | None = None

    def required(self) -> "FieldSpec":
        return FieldSpec(self.type, self.dim, self.element, self.fields, True, self.index)

    def indexed(self, index: Index) -> "FieldSpec":
        return FieldSpec(self.type, self.dim, self.element, self.fields, self.is_required, index)

    def spark_type(self) -> T.DataType:
        simple = {"text": T.StringType(), "integer": T.LongType(), "float": T.DoubleType(), "boolean": T.BooleanType(), "bytes": T.BinaryType(), "timestamp": T.TimestampType()}
        if self.type in simple:
            return simple[self.type]
        if self.type == "list":
            return T.ArrayType(simple[self.element])
        if _SPARSE.fullmatch(self.type):
            return SPARSE_TYPE
        if m := _VECTOR.fullmatch(self.type):
            return T.ArrayType(T.ShortType() if m[1] in ("u8", "i8", "binary") else T.FloatType())
        if self.type == "matrix":
            return T.ArrayType(T.ArrayType(T.FloatType()))
        if self.type == "struct":
            return T.StructType([T.StructField(n, f.spark_type()) for n, f in self.fields])
        raise SchemaError([f"unknown type `{self.type}`"])


def text() -> FieldSpec:
    return FieldSpec("text")


def integer() -> FieldSpec:
    return FieldSpec("integer")


def float_() -> FieldSpec:
    return FieldSpec("float")


def boolean() -> FieldSpec:
    return FieldSpec("boolean")


def bytes_() -> FieldSpec:
    return FieldSpec("bytes")


def timestamp() -> FieldSpec:
    return FieldSpec("timestamp")


def list_(element: str) -> FieldSpec:
    return FieldSpec("list", element=element)


def vector(dim: int, kind: str = "f32") -> FieldSpec:
    return FieldSpec(f"{kind}_vector", dim=dim)


def sparse_vector(kind: str = "f32") -> FieldSpec:
    return FieldSpec(f"{kind}_sparse_vector")


def matrix(dim: int, kind: str = "f32") -> FieldSpec:
    return FieldSpec("matrix", dim=dim, element=kind)


def struct(fields: Mapping[str, FieldSpec]) -> FieldSpec:
    return FieldSpec("struct", fields=tuple(fields.items()))


def keyword_index(exact: bool = False) -> Index:
    return Index("keyword", exact=exact)


def vector_index(metric: str) -> Index:
    return Index("vector", metric=metric)


def multi_vector_index(metric: str = "maxsim", quantization: str | None = None, width: int | None = None, top_k: int | None = None) -> Index:
    return Index("multi_vector", metric=metric, options=(("quantization", quantization), ("width", width), ("top_k", top_k)))


def semantic_index() -> Index:
    return Index("semantic")


def ngram_index() -> Index:
    """Accepted; answers don't depend on it."""
    return Index("ngram")


def problems(fields: Mapping[str, FieldSpec], inner: str = "", depth: int = 0) -> list[str]:
    """All that is wrong with a schema."""
    out: list[str] = []
    for name, f in fields.items():
        full = f"{inner}.{name}" if inner else name
        if not name or len(name) > 512:
            out.append(f"`{full}`: a field name needs 1 to 512 characters")
        if not inner and name.startswith("_"):
            out.append(f"`{full}`: names starting with `_` are reserved")
        if inner and "." in name:
            out.append(f"`{full}`: dots are reserved inside structs")
        if not inner and "." in name and name.split(".")[0] in fields:
            out.append(f"`{full}` collides with the struct `{name.split('.')[0]}`")
        is_dense, is_sparse = bool(_VECTOR.fullmatch(f.type)), bool(_SPARSE.fullmatch(f.type))
        if is_dense and not (f.dim and 0 < f.dim <= MAX_DENSE_DIM):
            out.append(f"`{full}`: a vector's dimension must be 1 to {MAX_DENSE_DIM}")
        if f.type == "matrix" and not (f.dim and 0 < f.dim <= MAX_MATRIX_DIM):
            out.append(f"`{full}`: a matrix's dimension must be 1 to {MAX_MATRIX_DIM}")
        if f.type == "list" and f.element not in ("text", "integer", "float"):
            out.append(f"`{full}`: lists hold text, integer or float")
        if f.type == "struct":
            if depth >= MAX_STRUCT_DEPTH:
                out.append(f"`{full}`: structs nest too deep")
            else:
                out += problems(dict(f.fields), full, depth + 1)
        if f.index and inner:
            out.append(f"`{full}`: fields inside structs have no index")
        elif f.index:
            kind, metric = f.index.kind, f.index.metric
            allowed = {"keyword": f.type == "text" or f.type == "list" and f.element == "text", "vector": is_dense or is_sparse, "multi_vector": f.type == "matrix", "semantic": f.type == "text", "ngram": f.type == "text"}
            if not allowed.get(kind, False):
                out.append(f"`{full}`: a {kind} index doesn't go with {f.type}")
            elif kind == "keyword" and f.index.exact and f.type != "text":
                out.append(f"`{full}`: an exact keyword index needs text")
            elif kind == "vector":
                metrics = ("dot_product",) if is_sparse else ("hamming",) if f.type == "binary_vector" else ("cosine", "euclidean", "dot_product")
                if metric not in metrics:
                    out.append(f"`{full}`: the metric of {f.type} must be {' or '.join(metrics)}")
            elif kind == "multi_vector" and metric != "maxsim":
                out.append(f"`{full}`: the metric of a multi-vector index is maxsim")
    return out


@dataclass(frozen=True)
class Schema:
    """Declared fields of a collection; others are stored and returned, but not indexed."""

    fields: Mapping[str, FieldSpec] = field(default_factory=dict)

    def check(self) -> None:
        if found := problems(self.fields):
            raise SchemaError(found)

    def index(self, name: str) -> Index | None:
        f = self.fields.get(name)
        return f.index if f else None

    def keyword_fields(self) -> list[str]:
        """Fields that a match without a field looks at."""
        return [n for n, f in self.fields.items() if f.index and f.index.kind in ("keyword", "semantic")]
