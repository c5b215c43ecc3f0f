"""Sorted-string tables of token ids: documents keyed by identifier, written and read back in key order.

A shard is one file:

    block*  index  bloom  footer

A block holds entries (shared, unshared, value length as varints; key suffix; value); a key keeps only what differs
from the one before, but for every 16th, whose place stands in the block's restart array. Blocks are compressed
(zstd) with a crc32 behind. The index has each block's last key, offset and size; the Bloom filter has the keys;
the fixed-size footer has the places of both, counts, the width of an id and a magic number. A lookup asks the
filter, then finds the block by binary search in the index and the entry by binary search over the restarts.

A key is 9 bytes: 0 for a null id, else 1 and the id as big-endian 64 bits with the sign flipped, so byte order is
id order. Rows with equal ids are several entries with one key.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .piece_cache import encoder, tokenizer_path

_MAGIC = b"CVSST001"
_FOOTER = struct.Struct("<QQQQQQI4x8s")  # index offset, size; bloom offset, size; entries; ids; id width; magic
_RESTART = 16


def key_of(doc_id: int | None) -> bytes:
    return b"\x00" + bytes(8) if doc_id is None else b"\x01" + struct.pack(">Q", (doc_id + (1 << 63)) & (1 << 64) - 1)


def id_of(key: bytes) -> int | None:
    return None if key[0] == 0 else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


class Bloom:
    """About 1% false positives at 10 bits a key."""

    HASHES = 7

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @classmethod
    def of(cls, keys: list[bytes]) -> "Bloom":
        size = max(64, len(keys) * 10 + 7 & ~7)
        out = cls(np.zeros(size // 8, dtype=np.uint8))
        for key in keys:
            for i in out._places(key):
                out.bits[i >> 3] |= 1 << (i & 7)
        return out

    def _places(self, key: bytes) -> list[int]:
        h = xxhash.xxh3_128_intdigest(key)
        a, b, size = h & (1 << 64) - 1, h >> 64 | 1, len(self.bits) * 8
        return [(a + i * b) % size for i in range(self.HASHES)]

    def __contains__(self, key: bytes) -> bool:
        return all(self.bits[i >> 3] >> (i & 7) & 1 for i in self._places(key))


class Writer:
    """Entries in ascending key order to the parts of one shard file."""

    def __init__(self, width: int, block_bytes: int = 1 << 16):
        self.width, self.block_bytes = width, block_bytes
        self.parts: list[bytes] = []
        self.size = self.entries = self.ids = 0
        self._index: list[bytes] = []
        self._keys: list[bytes] = []
        self._codec = pa.Codec("zstd", compression_level=1)
        self._new_block()

    def _new_block(self) -> None:
        self._buf, self._restarts, self._count, self._last = bytearray(), [], 0, b""

    def add(self, key: bytes, value: bytes) -> None:
        shared = 0
        if self._count % _RESTART:
            while shared < len(key) and key[shared] == self._last[shared]:
                shared += 1
        else:
            self._restarts.append(len(self._buf))
        self._buf += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        if not self._keys or self._keys[-1] != key:
            self._keys.append(key)
        self._last = key
        self._count += 1
        self.entries += 1
        self.ids += len(value) // self.width
        if len(self._buf) >= self.block_bytes:
            self._end_block()

    def _end_block(self) -> None:
        if not self._count:
            return
        raw = bytes(self._buf) + struct.pack(f"<{len(self._restarts) + 1}I", *self._restarts, len(self._restarts))
        packed = struct.pack("<Q", len(raw)) + self._codec.compress(raw, asbytes=True)
        packed += struct.pack("<I", zlib.crc32(packed))
        self._index.append(_varint(len(self._last)) + self._last + _varint(self.size) + _varint(len(packed)))
        self._put(packed)
        self._new_block()

    def _put(self, data: bytes) -> None:
        self.parts.append(data)
        self.size += len(data)

    def finish(self) -> list[bytes]:
        self._end_block()
        index, bloom = b"".join(self._index), Bloom.of(self._keys).bits.tobytes()
        at = self.size
        self._put(index)
        self._put(bloom)
        self._put(_FOOTER.pack(at, len(index), at + len(index), len(bloom), self.entries, self.ids, self.width, _MAGIC))
        return self.parts


class Reader:
    """A shard opened by its URI; blocks are read one at a time."""

    def __init__(self, uri: str):
        fs, path = common.open_store(uri)
        self._file = fs.open_input_file(path)
        size = self._file.size()
        index_at, index_size, bloom_at, bloom_size, self.entries, self.ids, self.width, magic = _FOOTER.unpack(self._read(size - _FOOTER.size, _FOOTER.size))
        if magic != _MAGIC:
            raise ValueError(f"{uri} is no token table")
        self._bloom = Bloom(np.frombuffer(self._read(bloom_at, bloom_size), dtype=np.uint8))
        self._last_keys: list[bytes] = []
        self._places: list[tuple[int, int]] = []
        data, at = self._read(index_at, index_size), 0
        while at < len(data):
            n, at = _read_varint(data, at)
            self._last_keys.append(data[at : at + n])
            offset, at = _read_varint(data, at + n)
            length, at = _read_varint(data, at)
            self._places.append((offset, length))
        self._codec = pa.Codec("zstd")

    def _read(self, at: int, size: int) -> bytes:
        return self._file.read_at(size, at)

    def _block(self, i: int) -> tuple[bytes, list[int]]:
        packed = self._read(*self._places[i])
        if struct.unpack("<I", packed[-4:])[0] != zlib.crc32(packed[:-4]):
            raise ValueError("a block's checksum differs")
        raw = self._codec.decompress(packed[8:-4], struct.unpack("<Q", packed[:8])[0], asbytes=True)
        n = struct.unpack("<I", raw[-4:])[0]
        return raw[: -4 * (n + 1)], list(struct.unpack(f"<{n}I", raw[-4 * (n + 1) : -4]))

    @staticmethod
    def _entries(data: bytes, at: int = 0) -> Iterator[tuple[bytes, bytes]]:
        last = b""
        while at < len(data):
            shared, at = _read_varint(data, at)
            unshared, at = _read_varint(data, at)
            size, at = _read_varint(data, at)
            last = last[:shared] + data[at : at + unshared]
            at += unshared
            yield last, data[at : at + size]
            at += size

    def scan(self) -> Iterator[tuple[bytes, bytes]]:
        for i in range(len(self._places)):
            yield from self._entries(self._block(i)[0])

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of each entry of a document."""
        key, out = key_of(doc_id), []
        if key not in self._bloom:
            return out
        for i in range(bisect.bisect_left(self._last_keys, key), len(self._places)):
            data, restarts = self._block(i)
            first = lambda at: next(self._entries(data, at))[0]  # noqa: B023,E731
            at = restarts[max(0, bisect.bisect_left(restarts, key, key=first) - 1)]
            for k, value in self._entries(data, at):
                if k > key:
                    return out
                if k == key:
                    out.append(np.frombuffer(value, dtype=f"<u{self.width}"))
        return out

    def close(self) -> None:
        self._file.close()


def _write_shards(path: str, end_id: int, base: str, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task = encoder(path), TaskContext.get()
        width = 2 if max(enc.vocab_size, end_id + 1) <= 65536 else 4
        kind = np.dtype(f"<u{width}")
        last = np.array([end_id], dtype=kind).tobytes()
        writer, shard, made = None, 0, []

        def finish():
            uri = f"{base}/part-{task.partitionId():06d}-{shard:04d}.cvsst"
            common.put_file(uri, writer.finish(), f"attempt-{task.taskAttemptId()}")
            made.append((uri, task.partitionId(), shard, writer.entries, writer.ids))

        for batch in common.gathered(batches):
            with common.no_cycles():
                for doc_id, ids in zip(batch.column(0).to_pylist(), enc.encode_many(batch.column(1)), strict=True):
                    if writer is not None and writer.size >= shard_bytes:
                        finish()
                        writer, shard = None, shard + 1
                    writer = writer or Writer(width)
                    writer.add(key_of(doc_id), np.frombuffer(ids, dtype=np.uint32).astype(kind).tobytes() + last)
        if writer is not None:
            finish()
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*made, strict=True) if made else [[]] * 5, (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["shard", "part", "seq", "n_docs", "n_ids"])

    return run


def write_token_tables(spark: SparkSession, docs: DataFrame, base: str, *, tokenizer: str | None = None, end_id: int = 2, shard_bytes: int = 128 << 20) -> DataFrame:
    """Encode documents and write shards in ascending doc_id order under ``base``; a row per shard, with its first id's place.

    The manifest has a row per ``shard_bytes`` or partition, so it fits the driver, which adds up the places.
    """
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # rows that share one id are dealt out by a hash of the text, equal ones by the task that read them
    rows = rows.withColumns({"h": F.xxhash64("text"), "task": F.spark_partition_id()})
    ordered = rows.repartitionByRange("doc_id", "h", "task").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    manifest = common.arrow_map(ordered, _write_shards(path, end_id, base, shard_bytes), "shard string, part int, seq int, n_docs long, n_ids long")
    shards, at = [], 0
    for r in sorted(manifest.collect(), key=lambda r: (r["part"], r["seq"])):
        shards.append((r["shard"], at, r["n_docs"], r["n_ids"]))
        at += r["n_ids"]
    return spark.createDataFrame(shards, "shard string, start long, n_docs long, n_ids long")


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    types = [pa.int64()] * 4
    for batch in batches:
        for uri, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            reader, rows = Reader(uri), []
            for key, value in reader.scan():
                ids = np.frombuffer(value, dtype=f"<u{reader.width}").astype("<u4")
                rows.append((id_of(key), at, len(ids), zlib.crc32(ids.tobytes())))
                at += len(ids)
                if len(rows) >= 4096:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                    rows = []
            reader.close()
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def read_token_tables(spark: SparkSession, shards: DataFrame) -> DataFrame:
    """A row per entry of the shards: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    spread = shards.select("shard", "start").repartition(max(1, min(shards.count(), 4096)), "shard")
    return common.arrow_map(spread, _read_shards, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_tables(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Write documents (doc_id, text) as token tables in the shared folder and read them back.

    Null or empty text: the end id alone. Null doc_id: a key of its own, before all others. Rows with one doc_id:
    an entry each, ordered by a hash of the text; equal rows in any order. Very long texts: an entry of their own size, in a
    block and shard of their own where they exceed these. Empty table: no shards, no rows. Other columns are ignored, whatever
    their names. A worker holds one shard (``shard_bytes``) and its keys at a time.
    """
    base = common.scratch(spark, "sst")
    return read_token_tables(spark, write_token_tables(spark, docs, base, **options))
