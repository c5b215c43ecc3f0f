"""Mappings to schemas and back, and the capabilities of fields."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from ..errors import InvalidArgument, Unsupported
from ..plans import schema as sc

_METRICS = {"cosine": "cosine", "dot_product": "dot_product", "l2_norm": "euclidean", "max_inner_product": "dot_product", "hamming": "hamming"}
_NUMBERS = {"long": "integer", "integer": "integer", "short": "integer", "byte": "integer", "float": "float", "double": "float", "half_float": "float"}


def from_mapping(mapping: Mapping[str, Any]) -> dict[str, sc.FieldSpec]:
    """A schema from ``{"properties": {...}}``."""
    out = {}
    for name, p in mapping.get("properties", {}).items():
        kind = p.get("type", "object" if "properties" in p else None)
        if kind == "text":
            out[name] = sc.text().indexed(sc.keyword_index())
        elif kind == "keyword":
            out[name] = sc.text().indexed(sc.keyword_index(exact=True))
        elif kind == "semantic_text":
            out[name] = sc.text().indexed(sc.semantic_index())
        elif kind in _NUMBERS:
            out[name] = sc.FieldSpec(_NUMBERS[kind])
        elif kind == "boolean":
            out[name] = sc.boolean()
        elif kind == "binary":
            out[name] = sc.bytes_()
        elif kind == "date":
            out[name] = sc.timestamp()
        elif kind == "dense_vector":
            element = p.get("element_type", "float")
            if element == "bit":
                if int(p["dims"]) % 8:
                    raise InvalidArgument(f"`{name}`: dims of bit vectors are multiples of 8")
                out[name] = sc.vector(int(p["dims"]) // 8, "binary").indexed(sc.vector_index("hamming"))
            else:
                out[name] = sc.vector(int(p["dims"]), {"float": "f32", "byte": "i8"}[element]).indexed(sc.vector_index(_METRICS[p.get("similarity", "cosine")]))
        elif kind == "rank_vectors":
            out[name] = sc.matrix(int(p["dims"])).indexed(sc.multi_vector_index())
        elif kind == "sparse_vector":
            out[name] = sc.sparse_vector().indexed(sc.vector_index("dot_product"))
        elif kind == "object":
            out[name] = sc.struct({k: sc.FieldSpec(f.type, f.dim, f.element, f.fields) for k, f in from_mapping(p).items()})
        else:
            raise Unsupported(f"mapping type `{kind}`")
    return out


def to_mapping(fields: Mapping[str, sc.FieldSpec]) -> dict[str, Any]:
    """The mapping of a schema."""
    out: dict[str, Any] = {}
    for name, f in fields.items():
        if f.type == "text":
            kind = "semantic_text" if f.index and f.index.kind == "semantic" else "keyword" if f.index and f.index.exact else "text"
            out[name] = {"type": kind}
        elif f.type == "struct":
            out[name] = to_mapping(dict(f.fields))
        elif f.type == "matrix":
            out[name] = {"type": "rank_vectors", "dims": f.dim}
        elif f.type == "binary_vector":
            out[name] = {"type": "dense_vector", "dims": f.dim * 8, "element_type": "bit"}
        elif f.type.endswith("sparse_vector"):
            out[name] = {"type": "sparse_vector"}
        elif f.type.endswith("_vector"):
            out[name] = {"type": "dense_vector", "dims": f.dim, "element_type": "byte" if f.type in ("i8_vector", "u8_vector") else "float"}
        else:
            out[name] = {"type": {"integer": "long", "float": "double", "boolean": "boolean", "bytes": "binary", "timestamp": "date", "list": "keyword"}[f.type]}
    return {"properties": out}


def field_caps(fields: Mapping[str, sc.FieldSpec]) -> dict[str, Any]:
    """Whether each field can be searched and aggregated."""
    out = {}
    for name, p in to_mapping(fields)["properties"].items():
        kind = p.get("type", "object")
        out[name] = {kind: {"type": kind, "searchable": kind != "binary", "aggregatable": kind not in ("text", "semantic_text", "dense_vector", "rank_vectors", "sparse_vector", "object")}}
    return {"fields": out}


def resolve(names: list[str], pattern: str) -> list[str]:
    """Collections that a comma-separated list of names with wildcards means."""
    import fnmatch

    return [n for n in names if any(fnmatch.fnmatchcase(n, p) for p in pattern.split(","))]
