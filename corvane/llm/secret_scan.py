"""Secrets in texts: named patterns, and random strings found by their token efficiency.

A byte-pair vocabulary learnt on ordinary text spends few tokens on words and many on random characters. A run of
key-like characters that gets few characters per token is so a random string. Known digests and identifiers
look random too, and are left out first: hex runs as long as a common digest, UUIDs, numbers and dates, and names
of three or more short parts joined by punctuation, each of them a word with at most a short number.

A run has 16 characters at least. Letters in one case alone, which may be a long word, need 20 and a lower ratio.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .piece_cache import tokenizer_path

#: In the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Holds every match of the patterns above but the first, and every candidate of the method.
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_=.-]{16,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: Hex digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
_DIGEST_DIGITS = {32, 40, 56, 64, 96, 128}
_ALL_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_JOINER = re.compile(r"[+/_=-]+")
#: A part of a joined name: a word in one case or capitalised with at most a short number, or a number.
_PART = re.compile(r"([A-Z]?[a-z]+|[A-Z]+)([0-9]{1,4}[a-z]?)?|[0-9]{1,8}")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Characters of a run at least, and of a run of letters in one case.
MIN_LENGTH, MIN_WORD = 16, 20
#: What a run of letters in one case is allowed of the ratio.
WORD_SHARE = 0.95


def known(run: str) -> bool:
    """Whether a run is a digest, a number or an identifier."""
    if _ALL_HEX.fullmatch(run) and len(run) in _DIGEST_DIGITS or _UUID.fullmatch(run):
        return True
    parts = [x for x in _JOINER.split(run) if x]
    if all(x.isdigit() for x in parts):
        return True
    return len(parts) >= 3 and len(run) <= 12 * len(parts) and all(map(_PART.fullmatch, parts))


class Scanner:
    """``scan(text)`` gives (start, kind, end) with kind as an index of KINDS, in order; positions are code points."""

    def __init__(self, ranks_path: str, max_ratio: float):
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.max_ratio = max_ratio

    def ratio(self, run: str) -> float:
        """Characters per token."""
        return len(run) / max(1, len(self._encoding.encode_ordinary(run)))

    def random(self, run: str) -> bool:
        """Whether a run of key-like characters is a random string."""
        if _WORD.fullmatch(run):
            return len(run) >= MIN_WORD and self.ratio(run) <= self.max_ratio * WORD_SHARE
        return len(run) >= MIN_LENGTH and not known(run) and self.ratio(run) <= self.max_ratio

    def scan(self, text: str) -> list[tuple[int, int, int]]:
        found = []
        low = text.encode("utf-8", "surrogatepass").lower()
        if b"passw" in low or b"secret" in low or b"token" in low or b"api" in low:
            found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
        for m in _RUN.finditer(text):
            run, at = m[0], m.start()
            if "AKIA" in run:
                found += [(at + x.start(), 1, at + x.end()) for x in _ACCESS.finditer(run) if len(x[0]) >= 20]
            found += [(at + x.start(), 2, at + x.end()) for x in _HEX.finditer(run)]
            found += [(at + x.start(), 3, at + x.end()) for x in _CANDIDATE.finditer(run) if self.random(x[0])]
        return sorted(found)


_scanners: dict[tuple, Scanner] = {}


def scanner(ranks_path: str, max_ratio: float) -> Scanner:
    key = (ranks_path, max_ratio)
    if key not in _scanners:
        _scanners[key] = Scanner(*key)
    return _scanners[key]


def _span_lists(path: str, max_ratio: float, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(path, max_ratio).scan
        kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
        for batch in batches:
            spans = [[{"start": a, "kind": KINDS[k], "end": b} for a, k, b in scan(text)] for text in common.texts_of(batch.column(text_at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, kind)], [*batch.schema.names, "spans"])

    return run


def find_secrets(docs: DataFrame, *, text: str = "text", max_ratio: float = 2.0, ranks: str | None = None, into: str = "spans") -> DataFrame:
    """All columns and ``into``: an array of (start, kind, end) in code points, end exclusive, by start, then kind.

    Kinds are assign, access, hex (the patterns) and random (the method: at most ``max_ratio`` characters per token).
    Null or empty text: no spans. Repeated rows and nulls elsewhere pass through. Empty table: no rows.
    A column named ``into`` is an error; others may have any name.
    """
    if into.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"there is a column {into} already")
    path = ranks or tokenizer_path("byte_bpe_50k.tiktoken")
    (t,) = common.hidden(docs, "secret_text")
    rows = docs.withColumn(t, F.col(text).cast("string"))
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("end", T.LongType())]))
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = rows.toDF(*names, "t")
    schema = T.StructType([*rows.schema.fields, T.StructField("spans", span)])
    out = common.arrow_map(rows, _span_lists(path, max_ratio, len(names)), schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)], F.col("spans").alias(into))


def masked(text: str, spans: list[tuple[int, int, int]], mask: str = "[secret]") -> str:
    """The text with each span replaced, overlapping ones as one; in one pass."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def _masked_texts(path: str, max_ratio: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(path, max_ratio).scan
        for batch in batches:
            at = batch.num_columns - 1
            out = [t and masked(t, scan(t)) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(out, pa.string())], batch.schema.names)

    return run


def redact(docs: DataFrame, *, text: str = "text", max_ratio: float = 2.0, ranks: str | None = None) -> DataFrame:
    """The documents with each secret (overlapping spans as one) replaced by ``[secret]``; all rows and columns stay.

    Null text stays null, empty stays empty. Repeated rows and nulls elsewhere pass through, clashing names don't matter.
    Very long texts: whole, in one worker, in time in proportion to them. Empty table: no rows.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.withColumn(*common.hidden(docs, "secret_text"), F.col(f"`{text}`").cast("string")).toDF(*names, "t")
    at = docs.columns.index(text)
    rows = rows.drop(names[at])
    out = common.arrow_map(rows, _masked_texts(ranks or tokenizer_path("byte_bpe_50k.tiktoken"), max_ratio), rows.schema)
    return out.select(*[(F.col("t").cast(docs.schema[i].dataType) if i == at else F.col(n)).alias(docs.columns[i]) for i, n in enumerate(names)])


def secrets(spark: SparkSession, docs: DataFrame, *, max_ratio: float = 2.0) -> DataFrame:
    """A row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans (text), n_random.

    Null or empty text: no spans. Null doc_id and repeated rows: a row each. Spans of different kinds may overlap; ties of
    start go by kind as listed. Very long texts: read whole, in one worker. Empty table: no rows. Other columns are ignored.
    """
    rows = find_secrets(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), max_ratio=max_ratio).select("doc_id", "spans")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    say = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return rows.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), F.sha2(say(base), 256).alias("base_sha256"), say(F.col("spans")).alias("spans"), count("random").alias("n_random"))
