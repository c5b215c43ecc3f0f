"""Shared helpers of the training-data operators: scratch tables, file access, Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows per Arrow batch handed to Python. Texts have no length bound, so batches stay short.
BATCH_ROWS = 512
#: Bytes of a batch that an operator works on, unless one row has more.
BATCH_BYTES = 16 << 20

#: Options of a write. Without its native library Hadoop starts a chmod for each file, its checksum file and their folders on
#: a ``file:`` path, and until that runs it is a second process with all the memory of the JVM. The raw file system, written
#: through these, starts none and makes no checksum files. Other stores take no notice.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}

#: White space as the word contracts have it: [\x20\x09-\x0D].
SPACE = " \t-\r"


_local_base: dict[str, str] = {}


def shared_base(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder serves a local master, whose executor is this machine; any other master is an
    error, as each executor would write to a disk of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_base:
        _local_base[app] = "file://" + tempfile.mkdtemp(prefix="corvane-shared-")
    return _local_base[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_base(spark)}/corvane-{name}-{uuid.uuid4().hex}"


def stored(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    The table cuts the lineage: a lost executor costs a rerun of the reading task only.
    """
    path = scratch(spark, name)
    df.write.options(**PLAIN_FILES).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of jobs whose results are stored: it does so when its driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete scratch paths through Hadoop's file system, whatever store they are in."""
    for path in paths:
        hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the rows of an Arrow batch, so that a batch of usual texts fits in a Python worker many times.

    A plan reads this setting when it runs, so it stays lowered for the session; results don't depend on it. Spark bounds the
    bytes of a batch as well (``spark.sql.execution.arrow.maxBytesPerBatch``), and ``pieces`` those that are worked on at once.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def pieces(batches: Iterable[pa.RecordBatch], most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut where one has more than ``most`` bytes and several rows."""
    for batch in batches:
        todo = [batch]
        while todo:
            part = todo.pop()
            if part.num_rows > 1 and part.nbytes > most:
                half = part.num_rows // 2
                todo += [part.slice(half), part.slice(0, half)]
            else:
                yield part


def gathered(batches: Iterable[pa.RecordBatch], most: int = BATCH_BYTES // 2) -> Iterator[pa.RecordBatch]:
    """Short batches put together up to ``most`` bytes, for work that gains from repeats; the rows stay in order."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > most:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def ship_package(spark: SparkSession) -> None:
    """Let executors import this package wherever the driver found it; once for each Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_corvane_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="corvane-"), "corvane_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._corvane_shipped = True


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with short batches; a task gives the memory that it has freed back to the system."""
    bounded_batches(df.sparkSession)
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(pieces(batches))
        trim()

    return df.mapInArrow(run, schema)


@contextmanager
def no_cycles() -> Iterator[None]:
    """For loops whose objects form no cycles: without the collector's walks over large memos."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def trim() -> None:
    """Python workers live on from one operator to the next: hand back what the last one no longer holds."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of an Arrow text column; null is the empty string."""
    return [x or "" for x in column.to_pylist()]


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path in it of a URI or plain path."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), os.path.abspath(uri)
    return pafs.FileSystem.from_uri(uri)


def put_file(uri: str, parts: Iterable[bytes], attempt: str) -> None:
    """Write a file under an attempt's own name and move it into place, so that retried and doubled tasks agree."""
    fs, path = open_store(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    own = f"{path}.{attempt}"
    with fs.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
    try:
        fs.move(own, path)
    except OSError:
        # some stores refuse to replace; the file there is another attempt's, with the same bytes
        if fs.get_file_info(path).type != pafs.FileType.File:
            raise
        fs.delete_file(own)


def crc_mod(column: str, mod: int) -> "F.Column":
    """crc32 of the column as decimal text, modulo ``mod``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(mod)


def hidden(df: DataFrame, *names: str) -> list[str]:
    """Names built on ``names`` that no column of ``df`` has (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        new = f"__{name}"
        while new.lower() in taken:
            new = "_" + new
        taken.add(new.lower())
        out.append(new)
    return out
