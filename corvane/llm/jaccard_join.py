"""Exact Jaccard self-join of word shingle sets by rare-first prefix filtering, down to connected components.

The order of shingles is the same for all sets: by the number of sets that hold a shingle, rare ones first, then by hash.
Two sets of n and m shingles that are similar enough share a shingle among the first ``n - ceil(t n) + 1`` of the one and the
like of the other. A shingle that no other set holds joins nothing, so a set whose prefix is made of such shingles is done.

1. Screen. Frequencies are counted for the shingles of one hashed range (a share of ``2 (1 - t)`` of all values); that
   range in the order (frequency, hash) with all others behind it is an order, too. What has a prefix of unique shingles
   by it links with nothing. Only the rest, the suspects, goes on; equal texts go on as one node.
2. Frequencies of all shingles of the nodes give the rare-first order. A node keeps its shared shingles in that order: what is
   unique counts for its size but cannot be common to two sets. Nodes with a prefix of unique shingles are done.
3. The prefixes are joined. Let a pair meet at its first common shingle, at places i and j: nothing before it is common, so
   at most ``min(n - i, m - j)`` shingles are (positional filter), and what follows in both differs at least in as many
   shingles as the parities of its counts in 256 classes do (suffix filter; a word for 64 classes is on each posting).
   The pair passes there if it links, so a pair that fails at a posting may be dropped at that posting.
4. First each node meets the leader of each of its lists: the one with the least place, that is with the fewest
   shingles of its own, which in a group of near copies is the nearest to the text they were made from.
5. In lists that still span several components, nodes outside a list's largest component meet nodes of other components,
   if any size in the list leaves their place possible. In a group of near copies only a few are left to do so: a
   text with too many shingles of its own fails by place. Pairs seen in step 4 aren't tested again.

A frequency is counted by partitions of hash ranges; texts are sent there in blocks, each distinct shingle of a block once,
so the most common shingle costs a partition one entry for each block. Nothing is broadcast or sent to the driver.
Shingles are compared as 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

_U = np.uint64
#: Shingles of a block of the screen and of a block of whole sets, where a task has so many.
_BLOCK, _SET_BLOCK = 1 << 20, 1 << 18
_MANY = np.uint32(0xFFFFFFFF)
_CLASSES = 256

# odd multipliers for positions in a word and words in a shingle, and a value for each byte: any fixed random numbers do
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_PLACE = _rng.integers(0, 2**62, 16, dtype=np.uint64) * _U(2) + _U(1)
_BASE = _U(int(_rng.integers(0, 2**60)) * 8 + 5)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class Shingler:
    """Sorted distinct 64-bit hashes of the ``width``-word windows of a text, A-Z lower-cased."""

    def __init__(self, width: int):
        self.width = width
        self._powers = np.ones(1, dtype=np.uint64)
        self._inverses = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._powers) < n:
            n = max(n, 2 * len(self._powers), 1 << 16)
            step = np.full(n, _BASE)
            step[0] = 1
            self._powers = np.multiply.accumulate(step)
            step[1:] = _U(_inverse(int(_BASE)))
            self._inverses = np.multiply.accumulate(step)

    def words(self, text: str) -> np.ndarray:
        """A hash of each word: a polynomial over its bytes, from running sums over the text."""
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
        space = (raw == 32) | ((raw >= 9) & (raw <= 13))
        edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if not len(start):
            return np.empty(0, dtype=np.uint64)
        self._grow(len(raw) + 1)
        run = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[raw] * self._powers[: len(raw)], out=run[1:])
        return _mix((run[end] - run[start]) * self._inverses[start] + (end - start).astype(np.uint64))

    def shingles(self, text: str) -> np.ndarray:
        w = self.words(text)
        k = min(self.width, len(w))
        if not k:
            return w
        h = np.full(len(w) - k + 1, _U(k))
        for i in range(k):
            h = h + w[i : len(w) - k + 1 + i] * _PLACE[i]
        return np.unique(_mix(h))


def _least(n: int | np.ndarray, percent: int) -> int | np.ndarray:
    """ceil(n * percent / 100)"""
    return (n * percent + 99) // 100


def _prefix(n: np.ndarray, percent: int) -> np.ndarray:
    """Length of the prefix of sets of n shingles."""
    return np.where(n > 0, n - _least(n, percent) + 1, 0)


def _join(arrays: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.empty(0, dtype=dtype)


def _lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _by_part(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the hashes by partition, and where each partition starts in it."""
    part = ((hashes & _U(0xFFFFFFFF)) * _U(parts) >> _U(32)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


_SCREEN = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("margins", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32())), ("hashes", pa.binary()), ("places", pa.binary())])


def _screen_rows(width: int, percent: int, parts: int):
    """A block's header (ids, sizes, and how many shingles each may share before it is a suspect), and its shingles by partition.

    A shingle on several texts of the block is shared: it is sent once, marked, and taken off these texts' margins here.
    """
    cut = _U((1 << 64) * min(max(2 * (100 - percent), 5), 100) // 100 - 1)

    def flush(block: int, ids: list, sizes: list, sets: list) -> pa.RecordBatch:
        counts = np.array([len(s) for s in sets], dtype=np.int64)
        hashes, places = _join(sets, np.uint64), np.repeat(np.arange(len(sets), dtype=np.uint32), counts)
        order = np.argsort(hashes, kind="stable")
        hashes, places = hashes[order], places[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = hashes[1:] != hashes[:-1]
        many = ~new
        many[:-1] |= ~new[1:]
        n = np.array(sizes, dtype=np.int64)
        margins = counts - np.bincount(places[many], minlength=len(sets)) - _prefix(n, percent)
        places = np.where(many, _MANY, places)[new]
        hashes = hashes[new]
        order, starts = _by_part(hashes, parts)
        hashes, places = hashes[order], places[order].astype("<u4")
        full = np.flatnonzero(np.diff(starts))
        none = [None] * len(full)
        return pa.record_batch(
            [
                pa.array([block % parts, *full], pa.int32()),
                pa.array([block] * (len(full) + 1), pa.int64()),
                pa.array([ids, *none], pa.list_(pa.int64())),
                pa.array([margins, *none], pa.list_(pa.int32())),
                pa.array([n, *none], pa.list_(pa.int32())),
                pa.array([None, *(hashes[starts[p] : starts[p + 1]].tobytes() for p in full)], pa.binary()),
                pa.array([None, *(places[starts[p] : starts[p + 1]].tobytes() for p in full)], pa.binary()),
            ],
            schema=_SCREEN,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, block, held = Shingler(width), TaskContext.get().partitionId() << 32, 0
        ids, sizes, sets = [], [], []
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), common.texts_of(batch.column(1)), strict=True):
                h = shingler.shingles(text)
                ids.append(i)
                sizes.append(len(h))
                sets.append(h[: np.searchsorted(h, cut, side="right")].copy())
                held += len(sets[-1]) + 1
                if held >= _BLOCK:
                    yield flush(block, ids, sizes, sets)
                    block, held = block + 1, 0
                    ids, sizes, sets = [], [], []
        if ids:
            yield flush(block, ids, sizes, sets)

    return run


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of equal values start in sorted values, and the run of each."""
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1


def _screen_replies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Headers as they are, and for each block the places of its shingles that other blocks have too."""
    names = ["block", "ids", "margins", "sizes", "places"]
    blocks, hashes, places = [], [], []
    for batch in batches:
        header = pa.array([x.is_valid for x in batch.column(2)], pa.bool_()) if batch.num_rows else None
        if header is not None and any(header.to_pylist()):
            own = batch.filter(header)
            yield pa.RecordBatch.from_arrays([own.column(1), own.column(2), own.column(3), own.column(4), pa.nulls(own.num_rows, pa.binary())], names)
        for block, h, at in zip(batch.column(1).to_pylist(), batch.column(5).to_pylist(), batch.column(6).to_pylist(), strict=True):
            if h is not None:
                hashes.append(np.frombuffer(h, dtype="<u8"))
                places.append(np.frombuffer(at, dtype="<u4"))
                blocks.append(block)
    if not blocks:
        return
    source = np.repeat(np.arange(len(blocks)), [len(h) for h in hashes])
    h, at = np.concatenate(hashes), np.concatenate(places)
    del hashes, places
    order = np.argsort(h, kind="stable")
    h, at, source = h[order], at[order], source[order]
    starts, run = _runs(h)
    shared = (np.diff(np.append(starts, len(h))) > 1)[run] & (at != _MANY)
    marked = np.zeros(len(starts), dtype=bool)
    marked[run[at == _MANY]] = True
    shared |= marked[run] & (at != _MANY)
    at, source = at[shared], source[shared]
    order = np.argsort(source, kind="stable")
    at, source = at[order], source[order]
    ends = np.searchsorted(source, np.arange(len(blocks) + 1))
    full = np.flatnonzero(np.diff(ends))
    none = pa.nulls(len(full), pa.list_(pa.int32()))
    yield pa.RecordBatch.from_arrays([pa.array([blocks[i] for i in full], pa.int64()), pa.nulls(len(full), pa.list_(pa.int64())), none, none, pa.array([at[ends[i] : ends[i + 1]].tobytes() for i in full], pa.binary())], names)


def _screened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text: its size and whether it is a suspect."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, sizes = batch.column(0)[i].values, batch.column(2)[i].values
            margins = batch.column(1)[i].values.to_numpy().astype(np.int64)
            for places in batch.column(3)[i].as_py():
                margins -= np.bincount(np.frombuffer(places, dtype="<u4"), minlength=len(margins))
            yield pa.RecordBatch.from_arrays([ids, sizes, pa.array(margins < 0)], ["doc_id", "n", "suspect"])


def _set_blocks(width: int):
    """Whole sets in blocks: nodes, their sizes, and their shingles one set after the other."""
    names = ["block", "nodes", "sizes", "items"]

    def flush(block: int, nodes: list, sets: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([nodes], pa.list_(pa.int64())), pa.array([[len(s) for s in sets]], pa.list_(pa.int32())), pa.array([_join(sets, np.uint64).astype("<u8").tobytes()], pa.binary())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, block, held = Shingler(width), TaskContext.get().partitionId() << 32, 0
        nodes, sets = [], []
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), common.texts_of(batch.column(1)), strict=True):
                nodes.append(node)
                sets.append(shingler.shingles(text))
                held += len(sets[-1]) + 1
                if held >= _SET_BLOCK:
                    yield flush(block, nodes, sets)
                    block, held = block + 1, 0
                    nodes, sets = [], []
        if nodes:
            yield flush(block, nodes, sets)

    return run


def _distinct_rows(parts: int):
    """The distinct shingles of a block and their counts in it, by partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, items in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                hashes, counts = np.unique(np.frombuffer(items.as_buffer(), dtype="<u8"), return_counts=True)
                order, starts = _by_part(hashes, parts)
                hashes, counts = hashes[order], counts[order].astype("<u4")
                full = np.flatnonzero(np.diff(starts))
                at = [(starts[p], starts[p + 1]) for p in full]
                yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([block] * len(full), pa.int64()), pa.array([hashes[a:b].tobytes() for a, b in at], pa.binary()), pa.array([counts[a:b].tobytes() for a, b in at], pa.binary())], ["part", "block", "hashes", "counts"])

    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block the frequencies, over all blocks, of those of its shingles that are on several sets."""
    blocks, hashes, counts = [], [], []
    for batch in batches:
        blocks += batch.column(1).to_pylist()
        hashes += [np.frombuffer(x, dtype="<u8") for x in batch.column(2).to_pylist()]
        counts += [np.frombuffer(x, dtype="<u4") for x in batch.column(3).to_pylist()]
    if not blocks:
        return
    source = np.repeat(np.arange(len(blocks)), [len(h) for h in hashes])
    h, n = np.concatenate(hashes), np.concatenate(counts).astype(np.int64)
    order = np.argsort(h, kind="stable")
    h, source = h[order], source[order]
    starts, run = _runs(h)
    total = np.add.reduceat(n[order], starts)[run]
    shared = total > 1
    h, total, source = h[shared], np.minimum(total[shared], 2**32 - 1).astype("<u4"), source[shared]
    order = np.argsort(source, kind="stable")
    h, total, source = h[order], total[order], source[order]
    ends = np.searchsorted(source, np.arange(len(blocks) + 1))
    full = np.flatnonzero(np.diff(ends))
    yield pa.RecordBatch.from_arrays([pa.array([blocks[i] for i in full], pa.int64()), pa.array([h[ends[i] : ends[i + 1]].tobytes() for i in full], pa.binary()), pa.array([total[ends[i] : ends[i + 1]].tobytes() for i in full], pa.binary())], ["block", "hashes", "totals"])


def _suffix_parities(shared: np.ndarray, k: int) -> np.ndarray:
    """For the first k places: the parities, in 256 classes, of what follows (4 words a place)."""
    words = np.zeros((len(shared) + 1, _CLASSES // 64), dtype=np.uint64)
    at = (shared & _U(_CLASSES - 1)).astype(np.int64)
    words[np.arange(len(shared)), at >> 6] = _U(1) << (at & 63).astype(np.uint64)
    after = np.bitwise_xor.accumulate(words[::-1], axis=0)[::-1]
    return after[1 : k + 1]


def _live_rows(percent: int):
    """Nodes whose prefix isn't all unique: size, postings, and the shared shingles in the order of rarity."""
    names = ("gram", "pos", "p0", "p1", "p2", "p3")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                replies = batch.column(3)[i].as_py() or []
                known = _join([np.frombuffer(x["hashes"], dtype="<u8") for x in replies], np.uint64)
                if not len(known):
                    continue
                order = np.argsort(known)
                known, total = known[order], np.concatenate([np.frombuffer(x["totals"], dtype="<u4") for x in replies])[order]
                nodes, sizes = batch.column(0)[i].values.to_numpy(), batch.column(1)[i].values.to_numpy().astype(np.int64)
                items = np.frombuffer(batch.column(2)[i].as_buffer(), dtype="<u8")
                at = np.minimum(np.searchsorted(known, items), len(known) - 1)
                hit = known[at] == items
                own = np.repeat(np.arange(len(nodes)), sizes)[hit]
                items, total = items[hit], total[at[hit]]
                order = np.lexsort((items, total, own))
                items = items[order]
                ends = np.searchsorted(own, np.arange(len(nodes) + 1))
                unique = sizes - np.diff(ends)
                live = np.flatnonzero(unique < _prefix(sizes, percent))
                if not len(live):
                    continue
                sets = [items[ends[j] : ends[j + 1]] for j in live]
                first, lengths = unique[live], (_prefix(sizes, percent) - unique)[live]
                grams = np.concatenate([s[:k] for s, k in zip(sets, lengths, strict=True)]).view(np.int64)
                place = np.concatenate([np.arange(u, u + k) for u, k in zip(first, lengths, strict=True)])
                parity = np.concatenate([_suffix_parities(s, k) for s, k in zip(sets, lengths, strict=True)]).view(np.int64)
                postings = pa.StructArray.from_arrays([pa.array(grams, pa.int64()), pa.array(place, pa.int32()), *(pa.array(np.ascontiguousarray(parity[:, w]), pa.int64()) for w in range(4))], names)
                offsets = np.zeros(len(live) + 1, dtype=np.int32)
                np.cumsum(lengths, out=offsets[1:])
                yield pa.RecordBatch.from_arrays([pa.array(nodes[live], pa.int64()), pa.array(sizes[live], pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), postings), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "n", "postings", "shared"])

    return run


def similar(shared: int, n: int, m: int, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union."""
    return 100 * shared >= percent * (n + m - shared)


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4), batch.column(5)
            keep = []
            for i in range(batch.num_rows):
                both = np.concatenate([np.frombuffer(x[i].as_buffer(), dtype="<u8"), np.frombuffer(y[i].as_buffer(), dtype="<u8")])
                both.sort()
                keep.append(similar(int((both[1:] == both[:-1]).sum()), n[i], m[i], percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def connected(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Components of an undirected graph: node, label (its component's least node), by alternating star contraction.

    Large-star ties each node's larger neighbours to its least one, small-star its smaller ones; both keep the components
    and soon leave only edges (node, least), which no step changes. Every step is an aggregate, combined before the
    shuffle, and a join. Loops and repeated edges don't matter; without edges there are no rows.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum("v")).first())

    step, path = common.stored(spark, edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    now = state(step)
    while now[0]:
        both = step.unionByName(step.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least, least_path = common.stored(spark, both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "edges-least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large, large_path = common.stored(spark, large.filter("u <> v").distinct(), "edges-large")
        least2, least2_path = common.stored(spark, large.groupBy("u").agg(F.min("v").alias("m")), "edges-least")
        small = large.join(least2, "u")
        small = small.select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        nxt, nxt_path = common.stored(spark, small.filter("u <> v").distinct(), "edges")
        common.remove(spark, path, least_path, large_path, least2_path)
        step, path, before, now = nxt, nxt_path, now, state(nxt)
        if now == before:
            break
    return step.select(F.col("u").alias("node"), F.col("v").alias("label"))


def _possible(x: str, y: str, percent: int) -> Column:
    """Length, positional and suffix filter for two postings of one shingle."""
    c = lambda alias, name: F.col(f"{alias}{name}")
    n, m = c(x, "n"), c(y, "n")
    left = lambda alias: c(alias, "n") - c(alias, "pos")
    fits = lambda bound: bound * (100 + percent) >= percent * (n + m)
    differ = sum((F.bit_count(c(x, f"p{w}").bitwiseXOR(c(y, f"p{w}"))) for w in range(1, 4)), F.bit_count(c(x, "p0").bitwiseXOR(c(y, "p0"))))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & fits(F.least(left(x), left(y))) & fits(F.lit(1) + F.floor((left(x) + left(y) - 2 - differ) / 2))


def _partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def link_components(spark: SparkSession, docs: DataFrame, *, percent: int = 85, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id (least doc_id reachable by links, itself included).

    Two documents link when ``100 * intersection >= percent * union`` of their sets of ``width``-word shingles (words of a
    text with fewer: one shingle). ``docs`` is read more than once, so it has to be a stored table or the same each time.

    Null or wordless text: an empty set, linked with nothing. Null doc_id: n_shingles, no component, no link.
    Repeated rows: equal sets, one component. Rows of one doc_id with different texts: each row stands for itself.
    Very long texts: read whole; a set is held by one worker at a time (8 bytes a shingle). Ties in the order of
    shingles go by hash. Empty table: no rows. Other columns are ignored, whatever their names.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    parts, gone = _partitions(spark), []

    def keep(df: DataFrame, name: str) -> DataFrame:
        out, path = common.stored(spark, df, name)
        gone.append(path)
        return out

    def done() -> None:
        common.remove(spark, *gone)
        gone.clear()
        common.release(spark)

    # 1. suspects by the frequencies of a part of the shingles
    sent = common.arrow_map(rows, _screen_rows(width, percent, parts), "part int, block long, ids array<long>, margins array<int>, sizes array<int>, hashes binary, places binary")
    replies = common.arrow_map(sent.repartitionById(parts, "part"), _screen_replies, "block long, ids array<long>, margins array<int>, sizes array<int>, places binary")
    blocks = replies.groupBy("block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("ids", "margins", "sizes")), F.collect_list("places").alias("places")).drop("block")
    screened, screened_path = common.stored(spark, common.arrow_map(blocks, _screened, "doc_id long, n int, suspect boolean"), "screened")
    common.release(spark)
    suspects = screened.filter("suspect and doc_id is not null").select("doc_id").distinct()
    held, held_path = common.stored(spark, rows.join(suspects.hint("shuffle_hash"), "doc_id", "left_semi").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("sha"), F.monotonically_increasing_id().alias("row")), "suspects")
    common.release(spark)

    # 2. the nodes and the order of their shingles
    nodes, nodes_path = common.stored(spark, held.groupBy("sha").agg(F.min(F.struct("doc_id", "row")).alias("first")).select("sha", F.col("first.doc_id").alias("rid"), F.col("first.row").alias("node")), "nodes")
    texts = held.select(F.col("row").alias("node"), "text").join(nodes.select("node").hint("shuffle_hash"), "node", "left_semi")
    sets, sets_path = common.stored(spark, common.arrow_map(texts, _set_blocks(width), "block long, nodes array<long>, sizes array<int>, items binary"), "sets")
    common.release(spark)
    counted = common.arrow_map(sets.select("block", "items"), _distinct_rows(parts), "part int, block long, hashes binary, counts binary")
    counted = common.arrow_map(counted.repartitionById(parts, "part"), _frequencies, "block long, hashes binary, totals binary")
    counted = counted.groupBy("block").agg(F.collect_list(F.struct("hashes", "totals")).alias("replies"))
    ordered = sets.join(counted, "block").select("nodes", "sizes", "items", "replies")
    posting = "struct<gram:long,pos:int,p0:long,p1:long,p2:long,p3:long>"
    live, live_path = common.stored(spark, common.arrow_map(ordered, _live_rows(percent), f"node long, n int, postings array<{posting}>, shared binary"), "live")
    sizes, sizes_path = common.stored(spark, sets.select(F.explode(F.arrays_zip("nodes", "sizes")).alias("x")).select(F.col("x.nodes").alias("node"), F.col("x.sizes").alias("n")).repartition("node"), "sizes")
    common.remove(spark, sets_path)
    common.release(spark)

    def verify(pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) that link, stored."""
        one = live.select(F.col("node").alias("u"), F.col("n").alias("n"), F.col("shared").alias("x"))
        two = live.select(F.col("node").alias("v"), F.col("n").alias("m"), F.col("shared").alias("y"))
        return keep(common.arrow_map(pairs.join(one, "u").join(two, "v").select("u", "v", "n", "m", "x", "y"), _verified(percent), "u long, v long"), "links")

    # 3. and 4. lists, and their leaders
    postings = live.select("node", "n", F.explode("postings").alias("x")).select("node", "n", "x.*")
    leaders = keep(postings.groupBy("gram").agg(F.min(F.struct("pos", "node", "n", "p0", "p1", "p2", "p3")).alias("lead"), F.count(F.lit(1)).alias("size")).filter("size > 1").select("gram", F.struct("lead.*").alias("lead")), "leaders")
    shared, shared_path = common.stored(spark, postings.join(leaders, "gram"), "postings")
    star = shared.filter(F.col("node") != F.col("lead.node")).filter(_possible("", "lead.", percent))
    star, star_path = common.stored(spark, star.select(F.col("node").alias("u"), F.col("lead.node").alias("v")).groupBy(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).agg(F.lit(1).alias("seen")), "star")
    labels = connected(spark, verify(star))
    done()

    # 5. lists of several components
    labelled = keep(shared.drop("lead").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled")
    spans = labelled.groupBy("gram", "label").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("least"))
    spans = keep(spans.groupBy("gram").agg(F.max(F.struct("c", "label")).alias("top"), F.min("least").alias("least"), F.count(F.lit(1)).alias("k")).filter("k > 1").select("gram", F.col("top.label").alias("top"), "least"), "spans")
    able = labelled.join(spans, "gram").filter((F.col("n") - F.col("pos")) * (100 + percent) >= percent * (F.col("n") + F.col("least")))
    able = keep(able.withColumn("major", F.col("label") == F.col("top")).drop("top", "least"), "able")
    a, b = able.filter("not major").alias("a"), able.alias("b")
    apart = (F.col("a.label") != F.col("b.label")) & (F.col("b.major") | (F.col("a.node") < F.col("b.node")))
    cross = a.join(b, (F.col("a.gram") == F.col("b.gram")) & apart & _possible("a.", "b.", percent))
    cross = cross.select(F.greatest("a.node", "b.node").alias("u"), F.least("a.node", "b.node").alias("v")).distinct()
    cross = keep(cross.join(star, ["u", "v"], "left_anti"), "pairs")
    if cross.limit(1).count():
        labels = connected(spark, verify(cross).unionByName(labels.select(F.col("node").alias("u"), F.col("label").alias("v"))))
    common.remove(spark, shared_path, star_path, live_path)

    # the result
    named = nodes.join(sizes, "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = keep(named.select("sha", "rid", "n", "label"), "named")
    least = keep(named.groupBy("label").agg(F.min("rid").alias("component_id")), "least")
    own = held.select("doc_id", "sha").join(named.join(least, "label").select("sha", "n", "component_id"), "sha")
    own = own.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    free = screened.join(suspects, "doc_id", "left_anti").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    out, _ = common.stored(spark, free.unionByName(own), "components")
    common.remove(spark, screened_path, held_path, nodes_path, sizes_path)
    done()
    return out


def first_of_each(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows, one of each component (that with the least id, one without an id last), with all their columns.

    Rows are the nodes: where an id is null or on several rows, a stored copy gives each row a key of its own.
    """
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    if not ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("id is null or n > 1").limit(1).count():
        drop = link_components(spark, docs, id_col=id_col, **options).filter("component_id <> doc_id").select("doc_id")
        (key,) = common.hidden(docs, "dropped")
        drop, _ = common.stored(spark, drop.withColumnRenamed("doc_id", key), "drop")
        return docs.join(drop, F.col(id_col).cast("long") == F.col(key), "left_anti")
    (key,) = common.hidden(docs, "row")
    rows, _ = common.stored(spark, docs.withColumn(key, F.monotonically_increasing_id()), "rows")
    found = link_components(spark, rows, id_col=key, **options).select(F.col("doc_id").alias("row"), "component_id")
    found = found.join(rows.select(F.col(key).alias("row"), F.col(id_col).cast("long").alias("id")), "row")
    kept = found.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"))
    kept, _ = common.stored(spark, kept.select(F.col("first.row").alias(key)), "kept")
    return rows.join(kept, key, "left_semi").select(*[rows[f"`{c}`"] for c in docs.columns])
