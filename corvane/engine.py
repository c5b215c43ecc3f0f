"""The engine: collections, SQL and the JSON search form over one store."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .errors import InvalidArgument, NotFound, Unsupported
from .plans.ir import Query
from .plans.lower import Lowering, Source
from .plans.schema import Schema
from .sources.datasets import Datasets
from .sources.store import CONSISTENCY, Collection, Store
from .sql import lower as sql_lower
from .sql.parser import Select, Statement, parse


def select_frame(source: Source, sql: sql_lower.Lowered) -> DataFrame:
    """The DataFrame of a lowered SELECT: its columns only, in order, with output casts."""
    low = Lowering(source, sql.query)
    df = low.run()
    out = []
    for name in sql.columns:
        cast = sql.casts.get(name)
        if cast and cast.startswith("="):
            out.append(F.col(f"`{name}`").alias(cast[1:]))
        elif name not in df.columns:
            out.append(F.lit(None).alias(name))
        else:
            c = F.col(f"`{name}`")
            out.append(c.cast(cast).alias(name) if cast else c)
    return df.select(*out)


def run_select(source: Source, text: str, params: list[Any] | None = None) -> DataFrame:
    """A SELECT over one source, whatever the table's name is."""
    tree = parse(text, params)
    if not isinstance(tree, Select):
        raise InvalidArgument("a SELECT is asked for")
    return select_frame(source, sql_lower.lower_select(tree))


class Engine:
    """Set ``spark.sql.session.timeZone`` to UTC: parts of timestamps are taken in the session's zone."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.store, self.consistency = spark, Store(spark, root), "default"
        self.datasets = Datasets(self.store)

    def collection(self, name: str, partition: str | None = None) -> Collection:
        return self.store.collection(name, partition)

    def query(self, name: str, query: Query, partition: str | None = None) -> list[dict[str, Any]]:
        return self.collection(name, partition).query(query, self.consistency)

    def sql(self, text: str, params: list[Any] | None = None) -> DataFrame:
        """Run a statement; writes return one row with the sequence number."""
        tree = parse(text, params)
        if isinstance(tree, Select):
            return self._select(tree)
        return getattr(self, f"_do_{tree.kind}")(tree)

    def _one(self, **values: Any) -> DataFrame:
        return self.spark.createDataFrame([tuple(values.values())], ", ".join(f"`{k}` string" for k in values))

    def _select(self, tree: Select) -> DataFrame:
        lowered = sql_lower.lower_select(tree)
        if tree.table.lower().startswith("information_schema."):
            return select_frame(Source(self._information(tree.table.lower().split(".", 1)[1]), Schema()), lowered)
        return select_frame(self.collection(tree.table, tree.partition).source(self.consistency), lowered)

    def _information(self, table: str) -> DataFrame:
        names = self.store.list()
        if table == "tables":
            rows = [(n, "public", n, "BASE TABLE") for n in names]
            return self.spark.createDataFrame(rows, "_id string, table_schema string, table_name string, table_type string")
        if table == "columns":
            rows = []
            for n in names:
                fields = {"_id": "text"} | {k: f.type for k, f in self.store.describe(n)["schema"].fields.items()}
                rows += [(f"{n}.{c}", "public", n, c, i + 1, kind) for i, (c, kind) in enumerate(fields.items())]
            return self.spark.createDataFrame(rows, "_id string, table_schema string, table_name string, column_name string, ordinal_position int, data_type string")
        raise NotFound(f"information_schema.{table}")

    def _do_insert(self, s: Statement) -> DataFrame:
        columns = s.data["columns"]
        if "_id" not in columns:
            raise InvalidArgument("INSERT needs the column _id")
        docs = [{c: sql_lower.value(v) for c, v in zip(columns, row, strict=True)} for row in s.data["rows"]]
        return self._one(lsn=self.collection(s.table, s.partition).upsert([{k: v for k, v in d.items() if v is not None} for d in docs]))

    def _do_update(self, s: Statement) -> DataFrame:
        ids = sql_lower.ids_of(s.data["where"], "UPDATE")
        if ids is None:
            raise Unsupported("UPDATE needs WHERE _id = .. or _id IN (..)")
        if any(c == "_id" for c, _ in s.data["set"]):
            raise InvalidArgument("_id cannot be changed")
        patch: dict[str, Any] = {}
        for column, v in s.data["set"]:
            at = patch
            *heads, last = column.split(".")
            for h in heads:
                at = at.setdefault(h, {})
            at[last] = sql_lower.value(v)
        return self._one(lsn=self.collection(s.table, s.partition).update([{"_id": i} | patch for i in ids]))

    def _do_delete(self, s: Statement) -> DataFrame:
        c = self.collection(s.table, s.partition)
        if s.data["where"] is None:
            if s.partition is None:
                raise Unsupported("DELETE without WHERE")
            c.drop_partition()
            return self._one(lsn="")
        ids = sql_lower.ids_of(s.data["where"], "DELETE")
        return self._one(lsn=c.delete(ids if ids is not None else sql_lower.logical(s.data["where"])))

    def _do_create(self, s: Statement) -> DataFrame:
        if s.data["missing_ok"] and s.table in self.store.list():
            return self._one(created="")
        specs = {n: sql_lower.field_spec(k, r, i) for n, k, r, i in s.data["columns"] if n != "_id"}
        self.store.create(s.table, {n: f for n, f in specs.items() if f is not None})
        return self._one(created=s.table)

    def _do_drop(self, s: Statement) -> DataFrame:
        if s.data["missing_ok"] and s.table not in self.store.list():
            return self._one(dropped="")
        self.store.drop(s.table)
        return self._one(dropped=s.table)

    def _do_explain(self, s: Statement) -> DataFrame:
        tree = s.data["statement"]
        return self._one(plan=repr(sql_lower.lower_select(tree).query) if isinstance(tree, Select) else repr(tree))

    def _do_set(self, s: Statement) -> DataFrame:
        if s.data["variable"] != "consistency_level":
            raise Unsupported(f"SET {s.data['variable']}")
        if s.data["value"] not in CONSISTENCY:
            raise InvalidArgument(f"unknown consistency `{s.data['value']}`")
        self.consistency = s.data["value"]
        return self._one(consistency_level=self.consistency)

    def _do_show(self, s: Statement) -> DataFrame:
        if s.data["variable"] != "consistency_level":
            raise Unsupported(f"SHOW {s.data['variable']}")
        return self._one(consistency_level=self.consistency)

    def _do_noop(self, s: Statement) -> DataFrame:
        return self._one(status=s.data["word"])
