"""Exact vector scores as column expressions: no Python workers, nulls give null."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _array(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(v: Column, q: Column) -> Column:
    return _total(F.zip_with(v, q, lambda a, b: a.cast("double") * b.cast("double")))


def squared_l2(v: Column, q: Column) -> Column:
    return _total(F.zip_with(v, q, lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double"))))


def norm(v: Column) -> Column:
    return F.sqrt(_total(F.transform(v, lambda a: a.cast("double") * a.cast("double"))))


def cosine(v: Column, query: Sequence[float]) -> Column:
    length = sum(float(x) ** 2 for x in query) ** 0.5
    below = norm(v) * F.lit(length)
    return F.when(below > 0, dot(v, _array(query)) / below).when(v.isNotNull(), F.lit(0.0))


def hamming(v: Column, query: Sequence[int]) -> Column:
    """Differing bits of two byte vectors (bytes as integers of either sign)."""
    q = F.array(*[F.lit(int(x) & 255) for x in query])
    return F.aggregate(F.zip_with(v, q, lambda a, b: F.bit_count(a.cast("int").bitwiseAND(F.lit(255)).bitwiseXOR(b))), F.lit(0), lambda acc, x: acc + x).cast("double")


def sparse_dot(v: Column, query: Iterable[tuple[int, float]]) -> Column:
    """Sum over shared indices of a struct of indices and values."""
    pairs = list(query)
    if not pairs:
        return F.when(v.isNotNull(), F.lit(0.0))
    q = F.map_from_arrays(F.array(*[F.lit(int(i)).cast("long") for i, _ in pairs]), _array([x for _, x in pairs]))
    return _total(F.zip_with(v["indices"], v["values"], lambda i, x: F.coalesce(F.try_element_at(q, i.cast("long")) * x.cast("double"), F.lit(0.0))))


def max_sim(rows: Column, query: Iterable[Sequence[float]]) -> Column:
    """Sum over query rows of the largest dot product with a row of the document."""
    def best(q: Sequence[float]) -> Column:
        return F.array_max(F.transform(rows, lambda d: dot(d, _array(q))))

    score = F.lit(0.0)
    for q in query:
        score = score + best(q)
    return F.when(F.size(rows) > 0, score)


def vector_distance(v: Column, query: Sequence[float], metric: str) -> Column:
    if metric == "euclidean":
        return squared_l2(v, _array(query))
    if metric == "cosine":
        return cosine(v, query)
    if metric == "dot_product":
        return dot(v, _array(query))
    return hamming(v, [int(x) for x in query])
