"""Text analysis and BM25 as column expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the common English stop word list of 33 words.
STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with"
).split()

K1, B = 1.2, 0.75


def analyze(text: str) -> list[str]:
    """Terms of a query text: lower case, split on all but letters and digits, without stop words."""
    return [t for t in re.split(r"[^\w]+|_", text.lower()) if t and t not in STOP_WORDS]


def tokens(text: Column) -> Column:
    """The same of a text column; null gives null."""
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    parts = F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1)
    return F.filter(parts, lambda t: (t != "") & ~F.array_contains(stop, t))


class TokenField:
    """Tokens of an indexed field, asked for by term; null holds none.

    A text is never cut into an array: a term's occurrences are matches of the term with no letter or digit on
    either side, and the length is the matches of a word that isn't a stop word. So a term costs one pass over the text
    in generated code, whatever else is asked. A pattern starts with the term, which Java finds by skipping.
    """

    def __init__(self, column: Column, kind: str = "text"):
        self.column, self.kind = column, kind  # text, whole (the value is one token) or list (its elements are)
        self._low = F.lower(column) if kind == "text" else column

    def _pattern(self, term: str) -> str | None:
        if term in STOP_WORDS or not term or any(not (c.isalpha() or c.isnumeric() or unicodedata.category(c)[0] in "LN") for c in term) or term != term.lower():
            return None  # no token looks so
        return rf"{term}(?![\p{{L}}\p{{N}}])(?<![\p{{L}}\p{{N}}]{term})"

    def frequency(self, term: str) -> Column:
        if self.kind == "whole":
            return F.coalesce((self.column == F.lit(term)).cast("int"), F.lit(0))
        if self.kind == "list":
            return F.coalesce(F.size(F.filter(self.column, lambda t: t == F.lit(term))), F.lit(0))
        pattern = self._pattern(term)
        return F.lit(0) if pattern is None else F.coalesce(F.regexp_count(self._low, F.lit(pattern)), F.lit(0))

    def has(self, term: str) -> Column:
        if self.kind == "whole":
            return F.coalesce(self.column == F.lit(term), F.lit(False))
        if self.kind == "list":
            return F.coalesce(F.array_contains(self.column, F.lit(term)), F.lit(False))
        pattern = self._pattern(term)
        return F.lit(False) if pattern is None else F.coalesce(self._low.rlike(pattern), F.lit(False))

    def every(self, terms: Iterable[str]) -> Column:
        return reduce(lambda x, y: x & y, [self.has(t) for t in dict.fromkeys(terms)])

    def some(self, terms: Iterable[str]) -> Column:
        return reduce(lambda x, y: x | y, [self.has(t) for t in dict.fromkeys(terms)])

    def length(self) -> Column:
        """Number of tokens; null for null."""
        if self.kind == "whole":
            return F.when(self.column.isNotNull(), F.lit(1))
        if self.kind == "list":
            return F.when(self.column.isNotNull(), F.size(self.column))
        return F.regexp_count(self._low, F.lit(rf"(?<![\p{{L}}\p{{N}}])(?!(?:{'|'.join(STOP_WORDS)})(?![\p{{L}}\p{{N}}]))[\p{{L}}\p{{N}}]++"))


def idf(n_docs: float, doc_frequency: float) -> Column:
    return F.log(F.lit(1.0) + (F.lit(float(n_docs)) - doc_frequency + 0.5) / (F.lit(float(doc_frequency)) + 0.5))


def bm25_term(tf: Column, length: Column, weight: float, idf_: Column, average: float, b: float = B, k1: float = K1) -> Column:
    """One term's part; 0 where the term is absent. Each operand is always evaluated, so generated code shares them."""
    below = tf + F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * length / F.lit(average if average > 0 else 1.0))
    return F.coalesce(F.try_divide(F.lit(float(weight)) * idf_ * tf * F.lit(k1 + 1.0), below), F.lit(0.0))


def hashed_similarity(toks: Column, query: list[str], buckets: int = 1 << 16) -> Column:
    """Cosine of the sets of hashed terms: the built-in stand-in for an embedding model (no claim to be one)."""
    hashed = lambda a: F.array_distinct(F.transform(a, lambda t: F.pmod(F.xxhash64(t), F.lit(buckets))))
    d, q = hashed(toks), hashed(F.array(*[F.lit(t) for t in query]) if query else F.array().cast("array<string>"))
    below = F.sqrt(F.size(d).cast("double") * F.size(q))
    return F.when(toks.isNotNull(), F.when(below > 0, F.size(F.array_intersect(d, q)) / below).otherwise(F.lit(0.0)))
