"""Versioned collections on Parquet.

A collection is a folder with its schema; each partition in it has a log of commits and a folder of rows for each commit.
A commit takes the next sequence number by creating its log file, which only one writer can. The newest row of an id
counts; deletions are rows too. Compaction writes a base in which ids are unique: it is scanned directly,
with pushed filters and pruned columns, and only ids written since are looked up in the commits after it. A base
says which number its snapshot was taken at, so what others commit meanwhile is read after it. A write that depends on
what was read (a deletion by filter, an update) takes the number that follows the one it read, or reads again.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import asdict
from typing import Any
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import AlreadyExists, InvalidArgument, NotFound
from ..operators.latest import newest
from ..plans.ir import Expr, Query
from ..plans.lower import Lowering, Source, run_with_matched
from ..plans.schema import FieldSpec, Index, Schema
from . import codec
from .files import Files

CONSISTENCY = ("default", "indexed", "strong")
DEFAULT_PARTITION = "_default"
MAX_NAME = 512


def merge(old: Any, new: Any) -> Any:
    """Fields of ``new`` put into ``old``, structs deeply; null removes a field."""
    if isinstance(old, Mapping) and isinstance(new, Mapping):
        out = dict(old)
        for k, v in new.items():
            if v is None:
                out.pop(k, None)
            else:
                out[k] = merge(old.get(k), v)
        return out
    return new


def _spec_from(d: Mapping[str, Any]) -> FieldSpec:
    index = d["index"] and Index(d["index"]["kind"], d["index"]["metric"], d["index"]["exact"], tuple(map(tuple, d["index"]["options"])))
    return FieldSpec(d["type"], d["dim"], d["element"], tuple((n, _spec_from(f)) for n, f in d["fields"]), d["is_required"], index)


class Store:
    """Collections under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def _path(self, name: str) -> str:
        if not name or len(name) > MAX_NAME or name.startswith("_"):
            raise InvalidArgument(f"`{name}` is no name for a collection")
        return f"{self.root}/{quote(name, safe='')}"

    def create(self, name: str, schema: Schema | Mapping[str, FieldSpec] | None = None, region: str = "local") -> "Collection":
        schema = schema if isinstance(schema, Schema) else Schema(dict(schema or {}))
        schema.check()
        text = json.dumps({"name": name, "region": region, "created_at": int(time.time() * 1000), "fields": {n: asdict(f) for n, f in schema.fields.items()}})
        if not self.files.create(f"{self._path(name)}/schema.json", text):
            raise AlreadyExists(f"collection `{name}` exists")
        return self.collection(name)

    def describe(self, name: str) -> dict[str, Any]:
        path = f"{self._path(name)}/schema.json"
        if not self.files.exists(path):
            raise NotFound(f"collection `{name}` not found")
        d = json.loads(self.files.read(path))
        return d | {"schema": Schema({n: _spec_from(f) for n, f in d.pop("fields").items()})}

    def list(self) -> list[str]:
        return [unquote(n) for n in self.files.list(self.root) if self.files.exists(f"{self.root}/{n}/schema.json")]

    def drop(self, name: str) -> None:
        self.describe(name)
        self.files.delete(self._path(name))

    def collection(self, name: str, partition: str | None = None, encoder: Callable[[Column, str], Column] | None = None) -> "Collection":
        return Collection(self, name, self.describe(name)["schema"], partition, encoder)


class Collection:
    """One partition of a collection."""

    def __init__(self, store: Store, name: str, schema: Schema, partition: str | None, encoder: Callable | None):
        if partition is not None and (not partition or partition == DEFAULT_PARTITION or len(partition) > MAX_NAME):
            raise InvalidArgument(f"`{partition}` is no name for a partition")
        self.store, self.spark, self.name, self.schema, self.encoder = store, store.spark, name, schema, encoder
        self.base = store._path(name)
        self.path = f"{self.base}/p={quote(partition or DEFAULT_PARTITION, safe='')}"
        self._statistics: tuple[int, dict] = (-1, {})

    # layout

    def row_type(self) -> T.StructType:
        fields = [T.StructField("_id", T.StringType()), T.StructField("_lsn", T.LongType()), T.StructField("_deleted", T.BooleanType())]
        fields += [T.StructField(n, f.spark_type()) for n, f in self.schema.fields.items()]
        return T.StructType([*fields, T.StructField("_extra", T.VariantType())])

    def _commits(self) -> list[dict[str, Any]]:
        names = self.store.files.list(f"{self.path}/log")
        return [json.loads(self.store.files.read(f"{self.path}/log/{n}")) for n in names if n.endswith(".json")]

    def lsn(self) -> int:
        names = [n for n in self.store.files.list(f"{self.path}/log") if n.endswith(".json")]
        return int(names[-1][:-5]) if names else 0

    def _commit(self, rows: DataFrame | None, kind: str, *, after: int | None = None, upto: int | None = None) -> str | None:
        """Write rows (without _lsn) and take the next number; with ``after`` only the one that follows it, else None."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        if rows is not None:
            rows.write.parquet(folder)
        entry = {"kind": kind, "folder": rows is not None and folder} | ({} if upto is None else {"upto": upto})
        while True:
            lsn = self.lsn() + 1 if after is None else after + 1
            if (after is None or self.lsn() == after) and self.store.files.create(f"{self.path}/log/{lsn:020d}.json", json.dumps({"lsn": lsn} | entry)):
                self._statistics = (-1, {})
                return str(lsn)
            if after is not None:
                self.store.files.delete(folder)
                return None

    def _read(self, commits: list[dict[str, Any]]) -> DataFrame:
        """The rows of commits with their numbers, in one scan."""
        kinds = T.StructType([f for f in self.row_type().fields if f.name != "_lsn"])
        names = [F.col(f"`{f.name}`") for f in self.row_type().fields]
        commits = [c for c in commits if c["folder"]]
        if not commits:
            return self.spark.createDataFrame([], self.row_type())
        df = self.spark.read.schema(kinds).parquet(*[c["folder"] for c in commits])
        if len(commits) == 1:
            return df.withColumn("_lsn", F.lit(commits[0]["lsn"]).cast("long")).select(*names)
        numbers = self.spark.createDataFrame([(c["folder"].rsplit("/", 1)[-1], c["lsn"]) for c in commits], "_folder string, _lsn long")
        df = df.withColumn("_folder", F.regexp_extract(F.col("_metadata.file_path"), r"/data/([0-9a-f]{32})/", 1))
        return df.join(F.broadcast(numbers), "_folder").select(*names)  # a row for each commit since the base

    def snapshot(self, upto: int | None = None) -> DataFrame:
        """The newest row of each id that isn't deleted."""
        commits = [c for c in self._commits() if upto is None or c["lsn"] <= upto]
        bases = [c for c in commits if c["kind"] == "base"]
        base = max(bases, key=lambda c: (c.get("upto", c["lsn"]), c["lsn"]), default=None)
        start = 0 if base is None else base.get("upto", base["lsn"])
        later = [c for c in commits if c["folder"] and c["kind"] != "base" and c["lsn"] > start]
        if base is None:
            rows = newest(self._read(later))
        else:
            rows = self._read([base])
            if later:
                delta = newest(self._read(later))
                rows = rows.join(delta.select("_id"), "_id", "left_anti").unionByName(delta)
        return rows.filter("not _deleted").drop("_lsn", "_deleted")

    # writes

    def _frame(self, docs: list[Mapping[str, Any]]) -> DataFrame:
        rows = [(i, False, *[known[n] for n in self.schema.fields], rest) for i, known, rest in codec.encode(self.schema, docs)]
        kinds = self.row_type().fields
        t = T.StructType([kinds[0], kinds[2], *kinds[3:-1], T.StructField("_extra", T.StringType())])
        df = self.spark.createDataFrame(rows, t)
        return df.withColumn("_extra", F.parse_json("_extra"))

    def upsert(self, docs: Iterable[Mapping[str, Any]]) -> str:
        """Replace or add whole documents; the last of a repeated id counts."""
        docs = list({d.get("_id") if isinstance(d.get("_id"), str) else k: d for k, d in enumerate(docs)}.values())
        if not docs:
            raise InvalidArgument("a write needs documents")
        return self._commit(self._frame(docs), "upsert")

    def upsert_frame(self, df: DataFrame, *, unique: bool = False, order: str | None = None) -> str:
        """The same from a DataFrame with ``_id``, in Spark; columns that aren't declared are stored as they are.

        ``unique`` promises that no id repeats, in ``df`` or before: the first such write is a base at once. Otherwise
        the row with the largest ``order`` counts (ties: the larger by its other columns); without it a repeated id is an error.
        """
        known = [F.col(f"`{n}`").cast(f.spark_type()).alias(n) if n in df.columns else F.lit(None).cast(f.spark_type()).alias(n) for n, f in self.schema.fields.items()]
        rest = [c for c in df.columns if c not in self.schema.fields and c != "_id"]
        if not unique and order is not None:
            df = newest(df.withColumn("__order", F.struct(F.col(f"`{order}`"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))), version="__order").drop("__order")
        elif not unique and df.groupBy("_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count():
            raise InvalidArgument("an id repeats: name the column by which its newest row is known")
        extra = F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in rest])) if rest else F.parse_json(F.lit("{}"))
        rows = df.select(F.col("_id").cast("string").alias("_id"), F.lit(False).alias("_deleted"), *known, extra.alias("_extra"))
        return self._commit(rows, "base" if unique and self.lsn() == 0 else "upsert")

    def update(self, docs: Iterable[Mapping[str, Any]], fail_on_missing: bool = False) -> str:
        """Merge fields into existing documents, structs deeply; null removes a field; unknown ids are left out or fail."""
        docs = list(docs)
        if not docs:
            raise InvalidArgument("a write needs documents")
        codec.encode(self.schema, docs, whole=False)
        while True:
            now = self.lsn()
            found = self.get([d["_id"] for d in docs])
            missing = [d["_id"] for d in docs if d["_id"] not in found]
            if missing and fail_on_missing:
                raise NotFound(f"documents not found: {', '.join(missing)}")
            merged: dict[str, Any] = {}
            for d in docs:
                if d["_id"] in found:
                    merged[d["_id"]] = merge(merged.get(d["_id"], found[d["_id"]]), d)
            if not merged:
                return ""
            if lsn := self._commit(self._frame(list(merged.values())), "update", after=now):
                return lsn

    def change(self, plan: Callable[[dict[str, dict[str, Any]]], Mapping[str, Mapping[str, Any] | None]], ids: Iterable[str]) -> str:
        """Replace or delete (None) documents as ``plan`` says from the documents there are, all in one commit."""
        ids = list(dict.fromkeys(ids))
        while True:
            now = self.lsn()
            changes = plan(self.get(ids))
            if not changes:
                return ""
            docs, gone = [d for d in changes.values() if d is not None], [i for i, d in changes.items() if d is None]
            rows = self._frame(docs) if docs else None
            if gone:
                marks = self._tombstones(self.spark.createDataFrame([(i,) for i in gone], "_id string"))
                rows = marks if rows is None else rows.unionByName(marks)
            if lsn := self._commit(rows, "change", after=now):
                return lsn

    def _tombstones(self, ids: DataFrame) -> DataFrame:
        return ids.select("_id", F.lit(True).alias("_deleted"), *[F.lit(None).cast(f.spark_type()).alias(n) for n, f in self.schema.fields.items()], F.parse_json(F.lit("{}")).alias("_extra"))

    def delete(self, what: Iterable[str] | Expr) -> str:
        """By ids, or all that a predicate is true for now."""
        if isinstance(what, Expr):
            while True:
                now = self.lsn()
                low = Lowering(Source(self.snapshot(now), self.schema, self.encoder), Query().filter(what))
                if lsn := self._commit(self._tombstones(low.df.filter(low.predicate(what)).select("_id")), "delete", after=now):
                    return lsn
        ids = list(what)
        if not ids:
            raise InvalidArgument("a delete needs ids")
        return self._commit(self._tombstones(self.spark.createDataFrame([(i,) for i in ids], "_id string")), "delete")

    def compact(self) -> str:
        """Write the snapshot as a new base; later reads scan it directly, and what was committed after that snapshot."""
        now = self.lsn()
        rows = self.snapshot(now).withColumn("_deleted", F.lit(False))
        return self._commit(rows.select(*[f"`{f.name}`" for f in self.row_type().fields if f.name != "_lsn"]), "base", upto=now)

    # reads

    def _check(self, consistency: str, required_lsn: str | None) -> None:
        if consistency not in CONSISTENCY:
            raise InvalidArgument(f"unknown consistency `{consistency}`")
        if required_lsn is not None:
            if not str(required_lsn).isdigit() or int(required_lsn) < 1:
                raise InvalidArgument("required_lsn must be 1 or more")
            if int(required_lsn) > self.lsn():
                raise InvalidArgument(f"sequence number {required_lsn} has not been reached")

    def source(self, consistency: str = "default", required_lsn: str | None = None) -> Source:
        self._check(consistency, required_lsn)
        lsn = self.lsn()
        if self._statistics[0] != lsn:
            self._statistics = (lsn, {})
        return Source(self.snapshot(), self.schema, self.encoder, self._statistics[1])

    def get(self, ids: Iterable[str], fields: Iterable[str] | None = None, consistency: str = "default", required_lsn: str | None = None) -> dict[str, dict[str, Any]]:
        """Documents by id; unknown ids are left out."""
        self._check(consistency, required_lsn)
        df = self.snapshot().filter(F.col("_id").isin(list(ids)))
        docs = {r["_id"]: codec.decode(r) for r in df.collect()}
        if fields is None:
            return docs
        names = list(fields)

        def pick(doc: dict[str, Any], path: str) -> Any:
            if path in doc:
                return doc[path]
            head, _, rest = path.partition(".")
            return pick(doc[head], rest) if rest and isinstance(doc.get(head), dict) else None

        return {i: {"_id": i} | {n: v for n in names if (v := pick(d, n)) is not None} for i, d in docs.items()}

    def frame(self, query: Query, consistency: str = "default", required_lsn: str | None = None) -> DataFrame:
        return Lowering(self.source(consistency, required_lsn), query).run()

    def query(self, query: Query, consistency: str = "default", required_lsn: str | None = None) -> list[dict[str, Any]]:
        return [codec.decode(r) for r in self.frame(query, consistency, required_lsn).collect()]

    def query_with_matched(self, query: Query) -> tuple[list[dict[str, Any]], int | None]:
        df, matched = run_with_matched(self.source(), query)
        return [codec.decode(r) for r in df.collect()], matched()

    def count(self) -> int:
        return self.query(Query().count())[0]["_count"]

    # partitions

    def partitions(self, prefix: str = "") -> list[str]:
        names = [unquote(n[2:]) for n in self.store.files.list(self.base) if n.startswith("p=")]
        return [n for n in names if n != DEFAULT_PARTITION and n.startswith(prefix)]

    def partition(self, name: str) -> "Collection":
        return Collection(self.store, self.name, self.schema, name, self.encoder)

    def drop_partition(self) -> None:
        self.store.files.delete(self.path)
