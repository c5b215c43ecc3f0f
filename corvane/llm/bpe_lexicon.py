"""Byte-pair encoding by a minimal acyclic transducer of frequent words, and exact merges for all others.

The words of all documents (a word is what stands between two starts of white space, with the white space before
it) are counted in Spark; the most frequent are encoded once and compiled into a minimal acyclic automaton in which
words share prefixes and suffixes. Its arcs carry numbers that add up to a word's rank, which points to the word's ids.
The file is a header and flat arrays, handed to every executor and memory-mapped, so workers of a machine
share its pages. A batch's words walk the automaton together, one byte a step. Words that it lacks are
split by the tokenizer's own pattern and merged pair by pair in order of rank, as the tokenizer does.

The lexicon only saves time: its bound doesn't change the result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import struct
import tempfile
import uuid
from array import array
from collections import ChainMap, Counter
from collections.abc import Iterable, Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .piece_cache import _KEEPING, _ODD, _PLAIN, Generations, tokenizer_path

_MAGIC = b"CVLEX001"
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_HEADER = struct.Struct("<8s6Q")  # magic; states, arcs, words, ids, two spare


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merger:
    """Exact byte-level BPE of a tokenizers file: its pattern, vocabulary, merges and added tokens."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or not pre["use_regex"] or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE without a normalizer is asked for")
        letters, vocab = byte_letters(), model["vocab"]
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.bytes_of: dict[int, bytes] = {i: bytes(letters[c] for c in token) for token, i in vocab.items()}
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.bytes_of |= {i: c.encode() for c, i in self.added.items()}
        self.first = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: list[int] = []  # by rank: the id of the merged pair
        for rank, (a, b) in enumerate(pairs):
            self.ranks[vocab[a], vocab[b]] = rank
            self.made.append(vocab[a + b])
        self._merged = Generations(150_000)
        self._decimals: dict[int, bytes] = {}
        self._slots: tuple[int, np.ndarray, np.ndarray] | None = None
        self._whole = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    def segments(self, text: str) -> Iterator[str | int]:
        """Texts between added tokens, and these tokens' ids."""
        at = 0
        for m in self._whole.finditer(text) if self._whole else ():
            if m.start() > at:
                yield text[at : m.start()]
            yield self.added[m[0]]
            at = m.end()
        if at < len(text):
            yield text[at:]

    def merge(self, token: str) -> list[int]:
        """Ids of one match of the pattern: merges by least rank, leftmost first."""
        ids = [self.first[b] for b in token.encode("utf-8")]
        if len(ids) > 40:
            return self._merge_long(ids)
        rank_of, made, none = self.ranks.get, self.made, len(self.made)
        ranks = [rank_of(pair, none) for pair in zip(ids, ids[1:])]  # of each id and the next
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            ids[at : at + 2] = [made[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of((ids[at - 1], ids[at]), none)
            if at < len(ranks):
                ranks[at] = rank_of((ids[at], ids[at + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and links, for long tokens."""
        n, ranks, made = len(ids), self.ranks, self.made
        after, before, alive = [*range(1, n), -1], [-1, *range(n - 1)], [True] * n
        heap = [(rank, i, ids[i], ids[i + 1]) for i in range(n - 1) if (rank := ranks.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i] = made[rank]
            alive[j] = False
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (rank := ranks.get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (rank, x, ids[x], ids[y]))
        return [x for x, live in zip(ids, alive, strict=True) if live]

    def _ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of pairs, ``none`` for those that don't merge, from a table with open addressing."""
        if self._slots is None:
            keys = np.array([x << 32 | y for x, y in self.ranks], dtype=np.int64)
            bits = max(4, (4 * len(keys)).bit_length())
            slots, values = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, len(self.made), dtype=np.int64)
            left = np.arange(len(keys))
            at = (keys.astype(np.uint64) * _SPREAD >> np.uint64(64 - bits)).astype(np.int64)
            while len(left):
                free = slots[at[left]] < 0
                slots[at[left[free]]] = keys[left[free]]  # of several for one slot, one gets it
                own = slots[at[left]] == keys[left]
                values[at[left[own]]] = left[own]
                left = left[~own]
                at[left] = (at[left] + 1) & ((1 << bits) - 1)
            self._slots = (bits, slots, values)
        bits, slots, values = self._slots
        keys = a << 32 | b
        at = (keys.astype(np.uint64) * _SPREAD >> np.uint64(64 - bits)).astype(np.int64)
        found = slots[at]
        out = np.where(found == keys, values[at], len(self.made))
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << bits) - 1)
            found = slots[at[open_]]
            out[open_] = np.where(found == keys[open_], values[at[open_]], len(self.made))
            open_ = open_[(found != keys[open_]) & (found >= 0)]
        return out

    def merge_many(self, tokens: list[str]) -> list[bytes]:
        """The same for many short tokens at once, as packed 32-bit ids: each round merges one pair in every token that has one."""
        raw = [t.encode("utf-8") for t in tokens]
        lengths = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        none, made = len(self.made), np.array(self.made, dtype=np.int64)
        ids = np.array(self.first, dtype=np.int64)[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        own = np.repeat(np.arange(len(raw)), lengths)
        ranks = np.full(len(ids), none, dtype=np.int64)  # of each id and the next
        inner = np.flatnonzero(own[1:] == own[:-1])
        ranks[inner] = self._ranks_of(ids[inner], ids[inner + 1])
        over_own, over_ids = [], []
        while len(ids):
            new = np.ones(len(own), dtype=bool)
            new[1:] = own[1:] != own[:-1]
            starts = np.flatnonzero(new)
            least = np.repeat(np.minimum.reduceat(ranks, starts), np.diff(np.append(starts, len(own))))
            over = least == none
            if over.any():
                over_own.append(own[over])
                over_ids.append(ids[over])
                ids, own, ranks, least = ids[~over], own[~over], ranks[~over], least[~over]
                if not len(ids):
                    break
            hit = np.flatnonzero(ranks == least)
            at = hit[np.append(True, own[hit[1:]] != own[hit[:-1]])]  # the leftmost of each token
            ids[at] = made[ranks[at]]
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            ids, own, ranks = ids[keep], own[keep], ranks[keep]
            at = at - np.arange(len(at))
            for left in (at[at + 1 < len(ids)], at[at > 0] - 1):
                same = own[left] == own[left + 1]
                ranks[left] = np.where(same, self._ranks_of(ids[left], ids[left + 1]), none)
            if len(at) and at[-1] == len(ids) - 1:
                ranks[-1] = none
        own, ids = np.concatenate([np.empty(0, np.int64), *over_own]), np.concatenate([np.empty(0, np.int64), *over_ids])
        order = np.argsort(own, kind="stable")
        packed = ids[order].astype("<i4").tobytes()
        ends = (4 * np.cumsum(np.bincount(own, minlength=len(raw)))).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def words(self, texts: list[str]) -> list[bytes]:
        """Packed ids of texts without added tokens; short matches of the pattern are kept for the next text that has them."""
        parts = [(t,) if _PLAIN.fullmatch(t) else self.pattern.findall(t) for t in texts]
        known, out = self._merged, {}
        todo = []
        for token in {x for p in parts for x in p}:
            ids = known.get(token) or known.known(token)
            if ids is not None:
                out[token] = ids
            elif len(token) > 40:
                out[token] = array("i", self.merge(token)).tobytes()
            else:
                todo.append(token)
        for token, ids in zip(todo, self.merge_many(todo), strict=True):
            out[token] = ids
            known.keep(token, ids)
        return [out[p[0]] if len(p) == 1 else b"".join(map(out.__getitem__, p)) for p in parts]

    def word(self, text: str) -> list[int]:
        return array("i", self.words([text])[0]).tolist()

    def decimals(self) -> dict[int, bytes]:
        """Each id in decimal."""
        if not self._decimals:
            self._decimals = {i: str(i).encode() for i in self.bytes_of}
        return self._decimals

    def text(self, ids: Iterable[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def words_of(text: str) -> list[str]:
    """The text cut where no token can cross; whole if it has white space that patterns may see differently."""
    return [text] if _ODD.search(text) else _KEEPING.findall(text)


def compile_lexicon(words: Iterable[str], merger: Merger, path: str) -> None:
    """Write the automaton of the words with their ids.

    Words are added in byte order; a branch that no later word can extend is replaced by an equal one that has
    been seen (same finality, same arcs), which leaves the minimal automaton. An arc's number is how many words
    its state accepts before those through the arc, so the numbers along a word add up to its rank.
    """
    keys = sorted({w.encode("utf-8") for w in words} - {b""})
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    register: dict[tuple, int] = {}
    branch = [0]  # states of the last word

    def settle(depth: int, last: bytes) -> None:
        while len(branch) - 1 > depth:
            state = branch.pop()
            sign = (final[state], *arcs[state].items())
            arcs[branch[-1]][last[len(branch) - 1]] = register.setdefault(sign, state)

    last = b""
    for key in keys:
        depth = len(os.path.commonprefix([key, last]))
        settle(depth, last)
        for b in key[depth:]:
            arcs.append({})
            final.append(False)
            arcs[branch[-1]][b] = len(arcs) - 1
            branch.append(len(arcs) - 1)
        final[branch[-1]] = True
        last = key
    settle(0, last)

    # number states from the root, and the words below each
    order, place = [0], {0: 0}
    for state in order:
        for to in arcs[state].values():
            if to not in place:
                place[to] = len(order)
                order.append(to)
    below: dict[int, int] = {}
    stack = [0]
    while stack:
        state = stack[-1]
        todo = [t for t in arcs[state].values() if t not in below]
        if todo:
            stack += todo
        else:
            below[state] = final[state] + sum(below[t] for t in arcs[state].values())
            stack.pop()
    codes, targets, numbers = [], [], []
    for state in order:
        n = int(final[state])
        for b, to in sorted(arcs[state].items()):
            codes.append(place[state] << 8 | b)
            targets.append(place[to])
            numbers.append(n)
            n += below[to]
    ids, ends = [], [0]
    for packed in merger.words([key.decode("utf-8") for key in keys]):
        ids += array("i", packed)
        ends.append(len(ids))
    with open(path, "wb") as f:
        f.write(_HEADER.pack(_MAGIC, len(order), len(codes), len(keys), len(ids), 0, 0))
        for values, kind in ((codes, "<i8"), (targets, "<i4"), (numbers, "<i4"), (ends, "<i4"), (ids, "<i4"), ([final[s] for s in order], "u1")):
            f.write(np.array(values, dtype=kind).tobytes())


class Lexicon:
    """The compiled file, memory-mapped."""

    def __init__(self, path: str):
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        magic, self.states, arcs, self.words, ids, _, _ = _HEADER.unpack(raw[: _HEADER.size].tobytes())
        if magic != _MAGIC:
            raise ValueError(f"{path} is no lexicon")
        at = _HEADER.size

        def part(n: int, kind: str) -> np.ndarray:
            nonlocal at
            size = n * np.dtype(kind).itemsize
            at += size
            return raw[at - size : at].view(kind)

        self._codes, self._targets, self._numbers = part(arcs, "<i8"), part(arcs, "<i4"), part(arcs, "<i4")
        self._ends, self._ids, self._final = part(self.words + 1, "<i4"), part(ids, "<i4"), part(self.states, "u1")
        self._bytes = self._ids.view(np.uint8)

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """Each word's rank, -1 if it isn't here; all words walk together."""
        n = len(words)
        rank = np.full(n, -1, dtype=np.int64)
        if not n or not len(self._codes):
            return rank
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
        text = np.frombuffer(b"".join(words), dtype=np.uint8)
        start = np.cumsum(lengths) - lengths
        live, state, number = np.flatnonzero(lengths > 0), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        step = 0
        while len(live):
            code = state[live] << 8 | text[start[live] + step]
            at = np.minimum(np.searchsorted(self._codes, code), len(self._codes) - 1)
            found = self._codes[at] == code
            live, at = live[found], at[found]
            state[live] = self._targets[at]
            number[live] += self._numbers[at]
            step += 1
            done = lengths[live] == step
            over = live[done]
            accepted = over[self._final[state[over]] == 1]
            rank[accepted] = number[accepted]
            live = live[~done]
        return rank

    def ids(self, rank: int) -> np.ndarray:
        return self._ids[self._ends[rank] : self._ends[rank + 1]]

    def packed(self, rank: int) -> bytes:
        return self._bytes[4 * self._ends[rank] : 4 * self._ends[rank + 1]].tobytes()


class Codec:
    """Encodes and decodes whole texts; a bounded memo keeps the words seen last."""

    def __init__(self, merger: Merger, lexicon: Lexicon | None, limit: int = 400_000):
        self.merger, self.lexicon, self.limit = merger, lexicon, limit
        self._memo: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        if len(self._memo) > self.limit:  # the words of a batch stay until it is done
            self._memo, self._old = {}, self._memo
        memo, old = self._memo, self._old
        parts = [[x if isinstance(x, int) else words_of(x) for x in self.merger.segments(t)] for t in texts]
        new: set[str] = set()
        for p in parts:
            for x in p:
                if not isinstance(x, int):
                    new.update(filterfalse(memo.__contains__, x))
        if old:
            again = [w for w in new if w in old]
            memo.update(zip(again, map(old.__getitem__, again)))
            new.difference_update(again)
        words, long = [w for w in new if len(w) <= 64], [w for w in new if len(w) > 64]
        ranks = self.lexicon.ranks([w.encode("utf-8") for w in words]).tolist() if self.lexicon else [-1] * len(words)
        unseen = [w for w, rank in zip(words, ranks, strict=True) if rank < 0]
        memo.update((w, self.lexicon.packed(rank)) for w, rank in zip(words, ranks, strict=True) if rank >= 0)
        memo.update(zip(unseen, self.merger.words(unseen), strict=True))
        if long:  # not kept
            memo = ChainMap(dict(zip(long, self.merger.words(long), strict=True)), memo)
        out = []
        for p in parts:
            out.append(np.frombuffer(b"".join(array("i", [x]).tobytes() if isinstance(x, int) else b"".join(map(memo.__getitem__, x)) for x in p), dtype="<i4"))
        return out

    def decode(self, ids: Iterable[int]) -> str:
        return self.merger.text(ids)


_codecs: dict[tuple, Codec] = {}
_mergers: dict[str, Merger] = {}


def merger(path: str) -> Merger:
    """One for each tokenizer in a Python worker; the last few stay."""
    if path not in _mergers:
        while len(_mergers) >= 2:
            _mergers.pop(next(iter(_mergers)))
        _mergers[path] = Merger(path)
    return _mergers[path]


def codec(path: str, file: str | None) -> Codec:
    """One for each tokenizer and lexicon in a Python worker."""
    if (path, file) not in _codecs:
        _codecs.clear()
        _codecs[path, file] = Codec(merger(path), Lexicon(SparkFiles.get(file)) if file else None)
    return _codecs[path, file]


def frequent(counts: Counter[str], most: int) -> None:
    """Bring a summary of counts down to ``most`` words: each loses the largest count that is left out.

    So a word's count is too low by at most what was taken from it, which is at most the words seen divided by ``most``.
    """
    if len(counts) > most:
        cut = sorted(counts.values(), reverse=True)[most]
        for word in [w for w, n in counts.items() if n <= cut]:
            del counts[word]
        for word in counts:
            counts[word] -= cut


def _word_counts(most: int):
    """A bounded summary of a task's words; words seen once are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in common.texts_of(batch.column(0)):
                counts.update(words_of(text))
            if len(counts) > 4 * most:
                frequent(counts, most)
        frequent(counts, most)
        kept = [(w, n) for w, n in counts.items() if n > 1 and len(w) <= 48]
        yield pa.record_batch([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

    return run


def build_lexicon(spark: SparkSession, docs: DataFrame, *, tokenizer: str, text: str = "text", words: int = 50_000) -> str | None:
    """Count words of all documents, compile the most frequent ones of up to 48 characters, and hand the file to all executors.

    Each task sends a summary of at most twice ``words``, however much text it has read. Which words are in the lexicon
    changes the time that encoding takes, and no result.
    """
    counted = common.arrow_map(docs.select(F.col(f"`{text}`").cast("string").alias("text")), _word_counts(2 * words), "word string, n long")
    top = counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(words)
    found = top.select("word").toArrow().column(0).to_pylist()
    if not found:
        return None
    name = f"corvane-lexicon-{uuid.uuid4().hex}"
    path = os.path.join(tempfile.mkdtemp(prefix="corvane-"), name)
    compile_lexicon(found, Merger(tokenizer), path)
    spark.sparkContext.addFile(path)
    return name


def _encoded(path: str, file: str | None, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, file)
        for batch in batches:
            ids = c.encode_batch(common.texts_of(batch.column(text_at)))
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = pa.array(np.concatenate(ids) if ids else np.empty(0, dtype=np.int32), pa.int32())
            yield pa.record_batch([*batch.columns[:text_at], pa.ListArray.from_arrays(pa.array(ends), flat)], [*batch.schema.names[:text_at], "ids"])

    return run


def encode(spark: SparkSession, docs: DataFrame, *, tokenizer: str | None = None, words: int = 50_000) -> DataFrame:
    """doc_id and ids (array of int) of each document's whole text, without special tokens added.

    Null or empty text: no ids. Added tokens in a text are single ids, as the tokenizers library has it. Null doc_id and
    repeated rows pass through. Ties of rank merge leftmost first. Very long texts: read whole, by one worker; a word
    of any length merges in time near to its length. Empty table: no rows. Other columns are ignored, whatever their names.
    """
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    file = build_lexicon(spark, docs, tokenizer=path, words=words)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return common.arrow_map(rows, _encoded(path, file, 1), "doc_id long, ids array<int>")


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_text = merger(path).text
        for batch in batches:
            lists = batch.column(1)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False).tolist(), np.cumsum([0, *lists.value_lengths().fill_null(0).to_pylist()]).tolist()
            texts = [to_text(flat[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return run


def decode(encoded: DataFrame, *, tokenizer: str | None = None) -> DataFrame:
    """doc_id, ids and decoded: the text of the ids, special tokens included. Null ids: the empty text."""
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    return common.arrow_map(encoded.select("doc_id", "ids"), _decoded(path), "doc_id long, ids array<int>, decoded string")


def _round_trips(path: str, file: str | None):
    """Encoded and decoded again by one worker; ids and texts leave it as digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, file)
        said = c.merger.decimals()
        for batch in batches:
            counts, of_ids, of_texts = [], [], []
            with common.no_cycles():
                for ids in c.encode_batch(common.texts_of(batch.column(1))):
                    ids = ids.tolist()
                    counts.append(len(ids))
                    of_ids.append(hashlib.sha256(b",".join(map(said.__getitem__, ids))).hexdigest())
                    of_texts.append(hashlib.sha256(c.decode(ids).encode("utf-8")).hexdigest())
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def round_trip(spark: SparkSession, docs: DataFrame, *, tokenizer: str | None = None, words: int = 50_000) -> DataFrame:
    """A row per document: doc_id, n_tokens, ids_sha256, decoded_sha256. Awkward rows: as ``encode`` states."""
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    file = build_lexicon(spark, docs, tokenizer=path, words=words)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return common.arrow_map(rows, _round_trips(path, file), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
