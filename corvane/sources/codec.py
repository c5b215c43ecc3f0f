"""Documents as Python values: to and from rows, and from JSON with its typing rules."""

from __future__ import annotations

import base64
import datetime as dt
import json
import math
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Row
from pyspark.sql.types import VariantVal

from ..errors import SchemaError
from ..plans.ir import DenseVector, Int, Matrix, SparseVector, timestamp_ms
from ..plans.schema import _SPARSE, _VECTOR, FieldSpec, Schema

MAX_DOCUMENT_BYTES = 200_000


def from_json(value: Any) -> Any:
    """JSON as document values: an object of numeric keys is a sparse vector, an array of number arrays a matrix, [] a float list."""
    if isinstance(value, dict):
        if value and all(k.isdigit() for k in value) and all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in value.values()):
            return SparseVector.of({int(k): v for k, v in value.items()})
        return {k: from_json(v) for k, v in value.items()}
    if isinstance(value, list):
        if value and all(isinstance(r, list) and r and all(isinstance(x, (int, float)) and not isinstance(x, bool) for x in r) for r in value) and len({len(r) for r in value}) == 1:
            return Matrix.of(value)
        if any(isinstance(x, float) for x in value) and all(isinstance(x, (int, float)) and not isinstance(x, bool) for x in value):
            return [float(x) for x in value]
        return [from_json(x) for x in value]
    return value


def e4m3(x: float) -> float:
    """The nearest 8-bit float with 4 exponent and 3 mantissa bits; beyond 448 it saturates."""
    if x == 0 or math.isnan(x):
        return x
    a = min(abs(x), 448.0)
    step = 2.0 ** (max(math.frexp(a)[1] - 1, -6) - 3)
    return math.copysign(min(round(a / step) * step, 448.0), x)


def _narrow(kind: str, x: float) -> float:
    if kind == "f8":
        return e4m3(x)
    if kind == "f16":
        import struct

        return struct.unpack("<e", struct.pack("<e", x))[0]
    return float(x)


def _encode(spec: FieldSpec, v: Any, name: str, wrong: list[str]) -> Any:
    """A declared field's value as Spark takes it; what doesn't fit goes to ``wrong``."""
    if v is None:
        return None
    if isinstance(v, Int):
        v = v.value
    kind = spec.type
    number = isinstance(v, (int, float)) and not isinstance(v, bool)
    if kind == "text" and isinstance(v, str) or kind == "boolean" and isinstance(v, bool) or kind == "bytes" and isinstance(v, (bytes, bytearray)):
        return bytearray(v) if kind == "bytes" else v
    if kind == "integer" and number and not isinstance(v, float):
        return v
    if kind == "float" and number:
        return float(v)
    if kind == "timestamp":
        if isinstance(v, dt.datetime) and v.tzinfo is not None:
            return dt.datetime(1970, 1, 1, tzinfo=dt.UTC) + dt.timedelta(milliseconds=timestamp_ms(v))
        if number and not isinstance(v, float):
            return dt.datetime(1970, 1, 1, tzinfo=dt.UTC) + dt.timedelta(milliseconds=v)
    if kind == "list" and isinstance(v, (list, tuple)):
        inner = FieldSpec({"text": "text", "integer": "integer", "float": "float"}[spec.element])
        return [_encode(inner, x, name, wrong) for x in v]
    if kind == "struct" and isinstance(v, Mapping):
        for extra in set(v) - {n for n, _ in spec.fields}:
            wrong.append(f"`{name}.{extra}` is not in the struct")
        return Row(**{n: _encode(f, v.get(n), f"{name}.{n}", wrong) for n, f in spec.fields})
    if m := _SPARSE.fullmatch(kind):
        if isinstance(v, Mapping):
            v = SparseVector.of(v)
        if isinstance(v, SparseVector):
            return Row(indices=[i for i, _ in v.values], values=[_narrow(m[1], x) for _, x in v.values])
    elif m := _VECTOR.fullmatch(kind):
        values = v.values if isinstance(v, DenseVector) else v
        if isinstance(values, (list, tuple, bytes, bytearray)):
            if len(values) != spec.dim:
                wrong.append(f"`{name}`: dimension {len(values)}, expected {spec.dim}")
                return None
            return [int(x) for x in values] if m[1] in ("u8", "i8", "binary") else [_narrow(m[1], x) for x in values]
    elif kind == "matrix":
        rows = v.rows if isinstance(v, Matrix) else v
        if isinstance(rows, (list, tuple)) and all(len(r) == spec.dim for r in rows):
            return [[_narrow(spec.element, x) for x in r] for r in rows]
    wrong.append(f"`{name}`: {type(v).__name__} doesn't fit {kind}")
    return None


def _plain(v: Any) -> Any:
    """An undeclared value as JSON."""
    if isinstance(v, (bytes, bytearray)):
        return {"$bytes": base64.b64encode(bytes(v)).decode()}
    if isinstance(v, dt.datetime):
        return timestamp_ms(v)
    if isinstance(v, SparseVector):
        return {"$sparse": [list(p) for p in v.values]}
    if isinstance(v, DenseVector):
        return list(v.values)
    if isinstance(v, Matrix):
        return [list(r) for r in v.rows]
    if isinstance(v, Int):
        return v.value
    if isinstance(v, Mapping):
        return {k: _plain(x) for k, x in v.items()}
    if isinstance(v, (list, tuple)):
        return [_plain(x) for x in v]
    return v


def _revive(v: Any) -> Any:
    if isinstance(v, dict):
        if set(v) == {"$bytes"}:
            return base64.b64decode(v["$bytes"])
        if set(v) == {"$sparse"}:
            return SparseVector.of({i: x for i, x in v["$sparse"]})
        return {k: _revive(x) for k, x in v.items()}
    return [_revive(x) for x in v] if isinstance(v, list) else v


def encode(schema: Schema, docs: list[Mapping[str, Any]], *, whole: bool = True) -> list[tuple[str, dict[str, Any], str]]:
    """(_id, declared values, JSON of the others) of each document; all problems in one error."""
    wrong: list[str] = []
    out = []
    for k, doc in enumerate(docs):
        doc_id = doc.get("_id")
        if not isinstance(doc_id, str) or not doc_id:
            wrong.append(f"document {k}: `_id` must be a non-empty string")
            continue
        mine: list[str] = []
        for name in doc:
            if not isinstance(name, str) or not name or name.startswith("_") and name != "_id":
                mine.append(f"field name `{name}` is reserved or empty")
        known = {n: _encode(f, doc.get(n), n, mine) for n, f in schema.fields.items()}
        if whole:
            mine += [f"`{n}` is required" for n, f in schema.fields.items() if f.is_required and doc.get(n) is None]
        rest = json.dumps({n: _plain(v) for n, v in doc.items() if n not in schema.fields and n != "_id" and v is not None})
        if len(rest) + sum(len(str(v)) for v in known.values() if v is not None) > MAX_DOCUMENT_BYTES:
            mine.append(f"larger than {MAX_DOCUMENT_BYTES} bytes")
        wrong += [f"document `{doc_id}`: {x}" for x in mine]
        out.append((doc_id, known, rest))
    if wrong:
        raise SchemaError(wrong)
    return out


def _decode(v: Any) -> Any:
    if isinstance(v, Row):
        d = v.asDict()
        if set(d) == {"indices", "values"}:
            return SparseVector.of(dict(zip(d["indices"], d["values"], strict=True)))
        return {k: _decode(x) for k, x in d.items() if x is not None}
    if isinstance(v, VariantVal):
        return _revive(v.toPython())
    if isinstance(v, bytearray):
        return bytes(v)
    if isinstance(v, dt.datetime):
        return timestamp_ms(v if v.tzinfo else v.replace(tzinfo=dt.UTC))
    return [_decode(x) for x in v] if isinstance(v, list) else v


def decode(row: Row) -> dict[str, Any]:
    """A row as a document; fields without a value are left out."""
    out = {}
    for name, v in row.asDict(recursive=False).items():
        if name in ("_lsn", "_deleted") or v is None:
            continue
        if name == "_extra":
            out |= _decode(v)
        else:
            out[name] = _decode(v)
    return out
