"""Mixture-controlled packing of token sequences by deficit round-robin over source queues.

Every source is a queue of tokens (its documents by doc_id). A window of ``length`` tokens credits each queue
with ``length * weight``; the queue's deficit is what it has been credited and not yet served. The tokens of all
queues are served in the order of the round in which the credit covers them: token p of queue i is due at
``(p + 1/2) / weight_i``, ties by queue. So at every window end each queue has been served its share to within
a token or two, what is short or over is carried into the next window, and a queue that has run dry leaves its share to
the others. As that order has a closed form, a partition finds the deficits carried into its first window by
itself instead of waiting for the partition before it: no global sequential pass, and no task that holds a queue.

Inside a window the queues' pieces stand one after the other. All windows are full but the last.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .piece_cache import encoder, tokenizer_path

#: Boundaries that are computed at once: windows times queues.
_CELLS = 1 << 20


class Schedule:
    """The closed form of the round-robin: what each queue has been served at any window end."""

    def __init__(self, totals: list[int], weights: list[float] | None = None, length: int = 2048):
        self.totals = np.asarray(totals, dtype=np.int64)
        w = np.asarray(weights if weights is not None else totals, dtype=np.float64)
        if len(w) != len(self.totals) or (w < 0).any() or (w[self.totals > 0] <= 0).any():
            raise ValueError("each queue with tokens needs a positive weight")
        self.weights = np.where(w > 0, w / max(w.sum(), 1e-300), 1.0)
        self.length = length
        self.total = int(self.totals.sum())
        self.windows = -(-self.total // length)
        self.end = float(np.max((self.totals + 0.5) / self.weights, initial=1.0)) * 2
        self._blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # the last ones, for the queues that a task has one after the other

    def _served(self, v: np.ndarray) -> np.ndarray:
        """Tokens of each queue that are due by v (rows: values of v)."""
        c = np.clip(np.floor(v[:, None] * self.weights + 0.5), 0, self.totals).astype(np.int64)
        late = (c > 0) & ((c - 0.5) / self.weights > v[:, None])
        c -= late
        c += (c < self.totals) & ((c + 0.5) / self.weights <= v[:, None])
        return c

    def rank(self, queue: int, token: int) -> int:
        """Place of a queue's token in the order of service."""
        v = np.array([(token + 0.5) / self.weights[queue]])
        upto = self._served(v)[0]
        before = self._served(np.nextafter(v, -np.inf))[0]
        return int(upto[:queue].sum() + before[queue + 1 :].sum() + token)

    def boundaries(self, first: int, last: int) -> np.ndarray:
        """Served tokens by window end: row m is for the first ``first + m`` windows, up to ``last``."""
        h = np.minimum(np.arange(first, last + 1, dtype=np.int64) * self.length, self.total)
        lo, hi = np.full(len(h), -1.0), np.full(len(h), self.end)
        guess = h.astype(np.float64)  # exact up to the number of queues while none has run dry
        for v, below in ((guess - len(self.totals) - 2, True), (guess + len(self.totals) + 2, False)):
            n = self._served(v).sum(axis=1)
            if below:
                lo = np.where((n < h) & (v > lo), v, lo)
            else:
                hi = np.where((n >= h) & (v < hi), v, hi)
        at_hi = self._served(hi)
        for _ in range(200):
            open_ = np.flatnonzero((at_hi.sum(axis=1) > h) & (np.nextafter(lo, np.inf) < hi))
            if not len(open_):
                break
            mid = lo[open_] + (hi[open_] - lo[open_]) / 2
            got = self._served(mid)
            up = got.sum(axis=1) >= h[open_]
            hi[open_[up]], lo[open_[~up]] = mid[up], mid[~up]
            at_hi[open_[up]] = got[up]
        over = at_hi.sum(axis=1) - h
        tied = np.flatnonzero(over > 0)  # several queues are due at once: the first ones are served
        if len(tied):
            base = self._served(lo[tied])
            more = at_hi[tied] - base
            left = (h[tied] - base.sum(axis=1))[:, None] - (np.cumsum(more, axis=1) - more)
            at_hi[tied] = base + np.clip(left, 0, more)
        return at_hi

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For block k of windows: the served tokens by window end, and by window what lies ahead of each queue's tokens."""
        if k not in self._blocks:
            while len(self._blocks) >= 4:
                self._blocks.pop(next(iter(self._blocks)))
            size = self.block_size()
            served = self.boundaries(k * size, min((k + 1) * size, self.windows))
            counts = np.diff(served, axis=0)
            self._blocks[k] = served, np.cumsum(counts, axis=1) - counts
        return self._blocks[k]

    def block_size(self) -> int:
        return max(1, min(4096, _CELLS // max(1, len(self.totals))))

    def pieces(self, queue: int, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Cut documents that lie at [start, end) of a queue, in order: (document, start, length, window, offset)."""
        if not len(starts):
            return
        size = self.block_size()
        k0, k1 = self.rank(queue, int(starts[0])) // self.length, self.rank(queue, int(ends[-1]) - 1) // self.length
        for b in range(k0 // size, k1 // size + 1):
            served, before = self.block(b)
            k, own, ahead = b * size, served[:, queue], before[:, queue]
            lo, hi = max(int(own[0]), int(starts[0])), min(int(own[-1]), int(ends[-1]))
            if lo >= hi:
                continue
            cuts = np.unique(np.concatenate([[lo, hi], own[(own > lo) & (own < hi)], starts[(starts > lo) & (starts < hi)]]))
            at, to = cuts[:-1], cuts[1:]
            doc = np.searchsorted(starts, at, side="right") - 1
            window = np.searchsorted(own, at, side="right") - 1
            yield doc, at - starts[doc], to - at, window + k, ahead[window] + at - own[window]


def _token_rows(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(path), TaskContext.get().partitionId()
        kind = np.dtype("<u2") if max(enc.vocab_size, end_id + 1) <= 65536 else np.dtype("<u4")
        now, at = None, 0  # rows come queue by queue
        last = np.array([end_id], dtype=kind).tobytes()
        for batch in common.gathered(batches):
            queues, starts, counts, ids = batch.column(0).to_pylist(), [], [], []
            with common.no_cycles():
                for queue, own in zip(queues, enc.encode_many(batch.column(2)), strict=True):
                    own = np.frombuffer(own, dtype=np.uint32).astype(kind).tobytes() + last
                    n = len(own) // kind.itemsize
                    if queue != now:
                        now, at = queue, 0
                    starts.append(at)
                    counts.append(n)
                    ids.append(own)
                    at += n
            m = len(queues)
            rows = pa.record_batch([pa.array([part] * m, pa.int32()), batch.column(0), batch.column(1), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], ["part", "queue", "doc_id", "at", "n", "ids"])
            yield from (rows.slice(k, common.BATCH_ROWS) for k in range(0, m, common.BATCH_ROWS))

    return run


def _piece_rows(bases: dict, order: dict[str, int], schedule: Schedule, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, queue = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            doc, at, n = batch.column(2), batch.column(3).to_numpy(), batch.column(4).to_numpy()
            ids = batch.column(5)
            runs = [0, *(i for i in range(1, len(part)) if part[i] != part[i - 1] or queue[i] != queue[i - 1]), len(part)]
            for a, b in zip(runs, runs[1:], strict=False):
                if a == b:
                    continue
                starts = at[a:b] + bases[part[a], queue[a]]
                for d, start, length, window, offset in schedule.pieces(order[queue[a]], starts, starts + n[a:b]):
                    crcs, seen, own = [], -1, None
                    for k, at_, n_ in zip(d.tolist(), (4 * start).tolist(), (4 * length).tolist(), strict=True):
                        if k != seen:
                            seen = k
                            own = memoryview(np.frombuffer(ids[a + k].as_buffer(), dtype=f"<u{width}").astype("<u4").tobytes())
                        crcs.append(zlib.crc32(own[at_ : at_ + n_]))
                    take = pa.array(d + a)
                    yield pa.record_batch([doc.take(take), pa.array(start), pa.array(length), pa.array(crcs, pa.int64()), pa.array(n[a:b][d]), pa.array(window), pa.array(offset), batch.column(1).take(take)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue"])

    return run


def pack(
    spark: SparkSession,
    docs: DataFrame,
    *,
    tokenizer: str | None = None,
    end_id: int = 1,
    length: int = 2048,
    weights: dict[str | None, float] | None = None,
) -> DataFrame:
    """Pack documents (columns doc_id, text, source) into sequences of ``length`` tokens, mixed by source.

    Returns a row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, queue. Each id lies in
    exactly one piece. ``weights`` are target proportions by source (null source: key None); by default the sources'
    shares of all tokens, so that all queues run dry together.

    Null or empty text: a document of the end id alone. Null source: a queue of its own. Null doc_id: kept, first
    in its queue. Rows with the same doc_id: each is a document; those with the same text stand in any order. Ties in
    the order of service go to the queue first by name. Very long texts: encoded whole by one worker, cut over as many
    windows as needed. Empty table: no rows. Other columns are ignored, whatever their names.

    Every source has a queue of its own, however many there are. The driver and each task hold a number of tokens and a weight
    for each queue, and the work for a window grows with the number of queues.
    """
    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    source = F.col("source").cast("string")
    queue = F.when(source.isNull(), "null").otherwise(F.concat(F.lit("="), source))
    rows = docs.select(queue.alias("queue"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # equal rows are dealt out by the task that read them
    rows = rows.select("queue", "doc_id", "text", F.xxhash64("text").alias("h"), F.spark_partition_id().alias("task"))
    ordered = rows.repartitionByRange("queue", "doc_id", "h", "task").sortWithinPartitions("queue", "doc_id", "h").select("queue", "doc_id", "text")
    tokens, _ = common.stored(spark, common.arrow_map(ordered, _token_rows(path, end_id), "part int, queue string, doc_id long, at long, n long, ids binary"), "pack")

    sums = sorted((r["queue"], r["part"], r["n"]) for r in tokens.groupBy("queue", "part").agg(F.sum("n").alias("n")).collect())  # partitions plus queues, at most
    names = sorted({q for q, _, _ in sums})
    bases, totals = {}, dict.fromkeys(names, 0)
    for q, part, n in sums:
        bases[part, q] = totals[q]
        totals[q] += n
    share = None if weights is None else [float(weights[None if q == "null" else q[1:]]) for q in names]
    schedule = Schedule([totals[q] for q in names], share, length)
    width = 2 if max(encoder(path).vocab_size, end_id + 1) <= 65536 else 4
    out = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, queue string"
    return common.arrow_map(tokens, _piece_rows(bases, {q: i for i, q in enumerate(names)}, schedule, width), out)
