"""Search requests: retrievers, fusion, sorting, paging, sources and aggregations over DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import EngineError, InvalidArgument, SchemaError, Unsupported
from ..operators.fusion import reciprocal_rank_fusion, sum_fusion
from ..plans import builder as b
from ..plans.ir import DenseVector, Query
from ..plans.lower import Lowering, Source
from ..sources import codec
from ..sources.store import Collection, merge
from .compile import TRUE, Clause, Compiler, all_of, field_name

MAX_WINDOW = 10_000
RRF_CONSTANT, RRF_WINDOW = 60, 10
_REQUEST = {"query", "knn", "rank", "sort", "from", "size", "_source", "aggs", "aggregations", "track_scores", "track_total_hits"}


def fold(score: Column, metric: str) -> Column:
    """A similarity as a score that grows with likeness."""
    if metric in ("cosine", "dot_product"):
        return (F.lit(1.0) + score) / 2
    return score if metric == "maxsim" else F.lit(1.0) / (F.lit(1.0) + score)


def fold_cutoff(value: float, metric: str) -> float:
    if metric == "euclidean":
        return 1.0 / (1.0 + value * value)
    if metric == "hamming":
        return 1.0 / (1.0 + value)
    return value if metric == "maxsim" else (1.0 + value) / 2


class Search:
    """One request over one source."""

    def __init__(self, source: Source, request: Mapping[str, Any], params: Mapping[str, Any] | None = None):
        body = dict(request) | dict(params or {})
        if extra := set(body) - _REQUEST:
            raise InvalidArgument(f"search: unknown {', '.join(sorted(extra))}")
        self.source, self.body = source, body
        self.compiler = Compiler(source.schema)
        self.start, self.size = body.get("from", 0), body.get("size", 10)
        if self.start < 0 or self.size < 0 or self.start + self.size > MAX_WINDOW:
            raise InvalidArgument(f"from + size must be 0 to {MAX_WINDOW}")
        knn = body.get("knn") or []
        self.knn = [knn] if isinstance(knn, Mapping) else list(knn)
        self.clause = self.compiler.compile(body["query"]) if body.get("query") else Clause(TRUE, constants=[(1.0, None)]) if not self.knn else None
        self.rrf = self._rank(body.get("rank"))

    def _rank(self, rank: Any) -> tuple[int, int] | None:
        if rank is None:
            return None
        o = rank.get("rrf") if isinstance(rank, Mapping) else None
        if o is None:
            raise Unsupported("rank other than rrf")
        if (self.clause is not None) + len(self.knn) < 2:
            raise InvalidArgument("rrf needs two retrievers or more")
        if self.size == 0:
            raise InvalidArgument("rrf needs a size above 0")
        if self.body.get("sort"):
            raise InvalidArgument("rrf cannot be combined with sort")
        window = int(o.get("rank_window_size", max(self.start + self.size, RRF_WINDOW)))
        if not 1 <= window <= MAX_WINDOW:
            raise InvalidArgument(f"rank_window_size must be 1 to {MAX_WINDOW}")
        return int(o.get("rank_constant", RRF_CONSTANT)), window

    # retrievers

    def scored(self, clause: Clause) -> DataFrame:
        """All rows of a clause with ``_score``."""
        q = Query()
        for t, _ in clause.texts:
            q = q.filter(t)
        low = Lowering(self.source, q)
        df = low.df.filter(low.predicate(clause.gate)) if clause.gate is not TRUE else low.df
        score = low._bm25([t for t, _ in clause.texts], 0.75, 1.2).cast("double") if clause.texts else F.lit(0.0)
        for s, weight in clause.functions:
            score = score + F.coalesce(low.score(s).cast("double"), F.lit(0.0)) * weight
        for v, condition in clause.constants:
            score = score + (F.lit(v) if condition is None else F.when(low.predicate(condition), F.lit(v)).otherwise(F.lit(0.0)))
        return df.withColumn("_score", score)

    def nearest(self, k: Mapping[str, Any]) -> DataFrame:
        """Exactly k nearest rows after the filter, with the folded score."""
        if extra := set(k) - {"field", "query_vector", "k", "num_candidates", "filter", "similarity", "boost"}:
            raise InvalidArgument(f"knn: unknown {', '.join(sorted(extra))}")
        name, n = field_name(k["field"]), int(k.get("k", self.size or 10))
        if n < 1 or int(k.get("num_candidates", n)) < n:
            raise InvalidArgument("knn: num_candidates must be k or more")
        index = self.source.schema.index(name)
        if index is None or index.kind not in ("vector", "multi_vector"):
            raise InvalidArgument(f"knn: `{name}` has no vector index")
        vector = k["query_vector"]
        fn = b.fn.multi_vector_distance(name, vector) if index.kind == "multi_vector" else b.fn.vector_distance(name, vector)
        low = Lowering(self.source, Query())
        df = low.df
        if k.get("filter"):
            filters = [k["filter"]] if isinstance(k["filter"], Mapping) else k["filter"]
            df = df.filter(low.predicate(all_of([self.compiler.compile(f, False).gate for f in filters])))
        metric = index.metric or "maxsim"
        df = df.withColumn("_score", fold(low.score(fn).cast("double"), metric)).filter("_score is not null")
        if k.get("similarity") is not None:
            df = df.filter(F.col("_score") >= fold_cutoff(float(k["similarity"]), metric))
        df = df.orderBy(F.desc("_score"), "_id").limit(n)
        return df.withColumn("_score", F.col("_score") * float(k.get("boost", 1.0)))

    def retrievers(self) -> list[DataFrame]:
        return ([self.scored(self.clause)] if self.clause is not None else []) + [self.nearest(k) for k in self.knn]

    # fusion

    def fused(self) -> DataFrame:
        """Rows of all retrievers by id with one score; where the score alone sorts them, only those up to the page's end."""
        parts = self.retrievers()
        if self.rrf is None and len(parts) == 1:
            return parts[0]
        scores = sum_fusion(parts) if self.rrf is None else reciprocal_rank_fusion(parts, *self.rrf)
        if self.body.get("sort"):
            return self.source.df.join(scores, "_id")
        top = scores.orderBy(F.desc("_score"), "_id").limit(self.start + self.size)
        return self.source.df.join(F.broadcast(top), "_id")  # MAX_WINDOW ids at most

    # sorting

    def _sort_keys(self, low: Lowering) -> list[tuple[str, Column, bool]]:
        keys = self.body.get("sort") or ["_score"]
        keys = [keys] if isinstance(keys, (str, Mapping)) else keys
        if len(keys) > 8:
            raise InvalidArgument("sort takes 8 keys at most")
        out = []
        for k in keys:
            name, o = (k, {}) if isinstance(k, str) else next(iter(k.items()))
            o = {"order": o} if isinstance(o, str) else o
            if o.get("missing", "_last") != "_last":
                raise Unsupported("sort: missing other than _last")
            name = field_name(name)
            index = self.source.schema.index(name)
            if index and (index.kind == "semantic" or index.kind == "keyword" and not index.exact):
                raise InvalidArgument(f"sort: `{name}` is a text field")
            asc = o.get("order", "desc" if name == "_score" else "asc") == "asc"
            c = F.col("_score") if name == "_score" else low.column(name)
            if c is None:
                raise InvalidArgument(f"sort: unknown field `{name}`")
            if isinstance(low.type_of(c), T.VariantType):
                c = low._sortable_variant(c)
            out.append((name, c, asc))
        return out

    def hits_frame(self) -> DataFrame:
        df = self.fused()
        low = Lowering(Source(df, self.source.schema), Query())
        keys = self._sort_keys(low)
        self.scores = not self.body.get("sort") or bool(self.body.get("track_scores")) or any(n == "_score" for n, _, _ in keys)
        df = df.orderBy(*[c.asc_nulls_last() if asc else c.desc_nulls_last() for _, c, asc in keys], "_id")
        return df.offset(self.start).limit(self.size) if self.start else df.limit(self.size)

    def gated(self) -> DataFrame:
        """Documents that any retriever may return: what aggregations run over."""
        low = Lowering(self.source, Query())
        gate = F.lit(False)
        if self.clause is not None:
            gate = F.lit(True) if self.clause.gate is TRUE else low.predicate(self.clause.gate)
        for k in self.knn:
            filters = k.get("filter") or []
            filters = [filters] if isinstance(filters, Mapping) else filters
            gate = gate | F.coalesce(low.predicate(all_of([self.compiler.compile(f, False).gate for f in filters])) if filters else F.lit(True), F.lit(False))
        return low.df.filter(gate)

    # aggregations

    def aggregation_frame(self, name: str, body: Mapping[str, Any]) -> tuple[str, DataFrame]:
        kinds = [k for k in body if k not in ("aggs", "aggregations", "meta")]
        if len(kinds) != 1:
            raise InvalidArgument(f"aggregation `{name}` needs one kind")
        kind, o = kinds[0], body[kinds[0]]
        rows = self.gated()
        low = Lowering(Source(rows, self.source.schema), Query())
        subs = body.get("aggs") or body.get("aggregations") or {}
        if kind == "terms":
            column = self._agg_field(o["field"])
            c = low.column(column)
            c = F.lit(None).cast("string") if c is None else c
            if isinstance(low.type_of(c), T.VariantType):
                c = F.try_variant_get(c, "$", "string")
            metrics = []
            for sub, s in subs.items():
                sub_kind, so = next(iter(s.items()))
                if sub_kind == "terms":
                    raise Unsupported("nested terms aggregations")
                metrics.append(self._metric(low, sub_kind, so).alias(f"m_{sub}"))
            out = rows.filter(c.isNotNull()).groupBy(c.alias("key")).agg(F.count(F.lit(1)).alias("doc_count"), *metrics)
            return kind, out.orderBy(F.desc("doc_count"), "key").limit(int(o.get("size", 10)))
        return kind, rows.agg(self._metric(low, kind, o).alias("value"))

    def _agg_field(self, name: str) -> str:
        name = field_name(name)
        index = self.source.schema.index(name)
        if index and (index.kind == "semantic" or index.kind == "keyword" and not index.exact):
            raise InvalidArgument(f"aggregation: `{name}` is a text field")
        return name

    def _metric(self, low: Lowering, kind: str, o: Mapping[str, Any]) -> Column:
        c = low.column(self._agg_field(o["field"]))
        c = F.lit(None).cast("double") if c is None else c
        if isinstance(low.type_of(c), T.VariantType):
            c = F.try_variant_get(c, "$", "double")
        made = {"avg": F.avg, "min": F.min, "max": F.max, "sum": lambda x: F.coalesce(F.sum(x), F.lit(0).cast("double")), "value_count": F.count}
        if kind not in made:
            raise Unsupported(f"aggregation `{kind}`")
        return made[kind](c)

    # response

    def _source_fields(self) -> tuple[bool, list[str], list[str]]:
        s = self.body.get("_source", True)
        if isinstance(s, bool):
            return s, [], []
        if isinstance(s, str):
            s = [s]
        if isinstance(s, list):
            return True, s, []
        one = lambda v: [v] if isinstance(v, str) else list(v or ())
        return True, one(s.get("includes")), one(s.get("excludes"))

    def run(self) -> dict[str, Any]:
        keep, includes, excludes = self._source_fields()
        frame = self.hits_frame() if self.size else None
        hits = []
        for r in frame.collect() if frame is not None else ():
            doc = codec.decode(r)
            score = doc.pop("_score", None)
            hit: dict[str, Any] = {"_id": doc.pop("_id"), "_score": score if self.scores else None}
            if keep:
                hit["_source"] = filter_source(doc, includes, excludes)
            hits.append(hit)
        n = (self.clause is not None) + len(self.knn)
        if frame is None or n == 1:
            total = {"value": self.gated().count() if self.clause is not None else len(hits), "relation": "eq"}
        else:
            total = {"value": max(r.count() for r in self.retrievers()), "relation": "gte"}
        scores = [h["_score"] for h in hits if h["_score"] is not None]
        out: dict[str, Any] = {"timed_out": False, "hits": {"total": total, "max_score": max(scores, default=None), "hits": hits}}
        aggs = self.body.get("aggs") or self.body.get("aggregations")
        if aggs:
            out["aggregations"] = {name: self._aggregated(name, a) for name, a in aggs.items()}
        return out

    def _aggregated(self, name: str, body: Mapping[str, Any]) -> dict[str, Any]:
        kind, df = self.aggregation_frame(name, body)
        if kind != "terms":
            return {"value": df.first()["value"]}
        buckets = []
        for r in df.collect():
            key = r["key"]
            bucket: dict[str, Any] = {"key": int(key), "key_as_string": str(key).lower(), "doc_count": r["doc_count"]} if isinstance(key, bool) else {"key": key, "doc_count": r["doc_count"]}
            buckets.append(bucket | {c[2:]: {"value": r[c]} for c in df.columns if c.startswith("m_")})
        return {"buckets": buckets}


def filter_source(doc: dict[str, Any], includes: list[str], excludes: list[str]) -> dict[str, Any]:
    """Fields by path prefixes; excludes win."""

    def covers(p: str, path: str) -> bool:
        return path == p or path.startswith(p + ".") or p.endswith("*") and path.startswith(p[:-1])

    def walk(d: dict[str, Any], prefix: str) -> dict[str, Any]:
        out = {}
        for k, v in d.items():
            path = prefix + k
            if any(covers(p, path) for p in excludes):
                continue
            if isinstance(v, dict):
                if inner := walk(v, path + "."):
                    out[k] = inner
            elif not includes or any(covers(p, path) for p in includes):
                out[k] = v
        return out

    return walk(doc, "")


def search(collection: Collection, request: Mapping[str, Any], **params: Any) -> dict[str, Any]:
    return Search(collection.source(), request, params).run()


def count(collection: Collection, request: Mapping[str, Any]) -> dict[str, Any]:
    if extra := set(request) - {"query"}:
        raise InvalidArgument(f"count: unknown {', '.join(sorted(extra))}")
    return {"count": Search(collection.source(), {"size": 0} | dict(request)).gated().count()}


def multi_search(pairs: Iterable[tuple[Collection, Mapping[str, Any]]]) -> dict[str, Any]:
    """Each search on its own: a failed one is an error in its place."""
    out = []
    for c, request in pairs:
        try:
            out.append(search(c, request) | {"status": 200})
        except EngineError as e:
            out.append({"error": {"reason": str(e)}, "status": 400})
    return {"responses": out}


def multi_get(collection: Collection, ids: Iterable[Any]) -> dict[str, Any]:
    wanted = [str(i) for i in ids]
    found = collection.get(wanted)
    return {"docs": [{"_id": i, "found": i in found} | ({"_source": {k: v for k, v in found[i].items() if k != "_id"}} if i in found else {}) for i in wanted]}


def check_vectors(collection: Collection, doc: Mapping[str, Any]) -> None:
    """Finite values; unit length for dot products, not zero for cosines."""
    for name, spec in collection.schema.fields.items():
        v = doc.get(name)
        if v is None or not spec.index or spec.index.kind != "vector" or spec.type.endswith("sparse_vector"):
            continue
        values = [float(x) for x in (v.values if isinstance(v, DenseVector) else v)]
        if any(x != x or x in (float("inf"), float("-inf")) for x in values):
            raise SchemaError([f"`{name}`: values must be finite"])
        length = sum(x * x for x in values) ** 0.5
        if spec.index.metric == "dot_product" and abs(length - 1) > 1e-4:
            raise SchemaError([f"`{name}`: dot_product needs vectors of length 1"])
        if spec.index.metric == "cosine" and length == 0:
            raise SchemaError([f"`{name}`: cosine needs a vector that isn't zero"])


def _whole(collection: Collection, doc_id: Any, doc: Mapping[str, Any]) -> dict[str, Any]:
    check_vectors(collection, doc)
    out = {"_id": str(doc_id)} | {k: codec.from_json(v) if k not in collection.schema.fields else v for k, v in doc.items()}
    codec.encode(collection.schema, [out])
    return out


def index_document(collection: Collection, doc_id: Any, doc: Mapping[str, Any]) -> dict[str, Any]:
    existed = str(doc_id) in collection.get([str(doc_id)])
    collection.upsert([_whole(collection, doc_id, doc)])
    return {"_id": str(doc_id), "result": "updated" if existed else "created"}


def get_document(collection: Collection, doc_id: Any) -> dict[str, Any]:
    """One document, or that it isn't there."""
    return multi_get(collection, [doc_id])["docs"][0]


def delete_document(collection: Collection, doc_id: Any) -> dict[str, Any]:
    existed = str(doc_id) in collection.get([str(doc_id)])
    if existed:
        collection.delete([str(doc_id)])
    return {"_id": str(doc_id), "result": "deleted" if existed else "not_found"}


def refresh(collection: Collection) -> dict[str, Any]:
    """Every search reads the newest commit, so there is nothing to wait for."""
    collection.lsn()
    return {"_shards": {"total": 1, "successful": 1, "failed": 0}}


def bulk(collection: Collection, lines: Iterable[Mapping[str, Any]]) -> dict[str, Any]:
    """Action lines and their documents in turn: index, update (with doc) and delete.

    All is read once and written in one commit; an action sees what those before it did. A bad one is an error in its place.
    """
    actions, it = [], iter(lines)
    for action in it:
        kind, meta = next(iter(action.items()))
        actions.append((kind, meta.get("_id"), next(it) if kind in ("index", "update", "create") else None))
    items: list[dict[str, Any]] = []

    def plan(found: dict[str, dict[str, Any]]) -> dict[str, dict[str, Any] | None]:
        items.clear()
        now: dict[str, dict[str, Any] | None] = dict(found)
        changes: dict[str, dict[str, Any] | None] = {}
        for kind, doc_id, body in actions:
            key = str(doc_id)
            old = now.get(key)
            try:
                if kind == "index":
                    now[key] = changes[key] = _whole(collection, doc_id, body)
                    result, status = "updated" if old is not None else "created", 200
                elif kind == "update":
                    if set(body) != {"doc"}:
                        raise Unsupported("update with anything but doc")
                    new = {"_id": key} | dict(body["doc"])
                    codec.encode(collection.schema, [new], whole=False)
                    result, status = ("updated", 200) if old is not None else ("not_found", 404)
                    if old is not None:
                        merged = merge(old, new)
                        codec.encode(collection.schema, [merged])
                        now[key] = changes[key] = merged
                elif kind == "delete":
                    result, status = ("deleted", 200) if old is not None else ("not_found", 404)
                    if old is not None:
                        now[key] = changes[key] = None
                else:
                    raise Unsupported(f"bulk action `{kind}`")
                items.append({kind: {"_id": key, "result": result, "status": status}})
            except EngineError as e:
                items.append({kind: {"_id": doc_id, "error": {"reason": str(e)}, "status": 400}})
        return changes

    collection.change(plan, [str(i) for _, i, _ in actions])
    return {"errors": any("error" in next(iter(i.values())) for i in items), "items": items}
