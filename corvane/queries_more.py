"""More queries with their SQL: the SQL form's functions, null rules, the JSON form, and writes that go through a store."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .engine import Engine, run_select
from .es.search import Search
from .plans import builder as b
from .plans import schema as s
from .plans.ir import Query
from .plans.lower import Source, run

f = b.field
Registry = dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]]


def _rounded(df: DataFrame, *names: str, digits: int = 3) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n).cast("double"), digits) for n in names})


def _null_rules(q: Registry, source: Callable[..., Source]) -> None:
    def on(table: str, query: Query, every_row: bool = False):
        return lambda spark, sf: run(source(spark, sf, table), query, every_row=every_row)

    two = {"v": (f("event_type") == "purchase").choose(f("value"), None), "w": (f("user_id") < 50).choose(f("value"), None)}
    two_sql = "CASE WHEN event_type = 'purchase' THEN value END AS v, CASE WHEN user_id < 50 THEN value END AS w"
    q["sort_drops_rows_without_any_key"] = (on("events", b.select(two).sort([(f("v"), True), (f("w"), False)]), every_row=True), f"SELECT event_id::VARCHAR AS _id, {two_sql} FROM events WHERE event_type = 'purchase' OR user_id < 50")
    q["sort_nulls_last"] = (
        on("events", b.filter(f("event_id") < 400).select(two).sort([(f("v"), False), (f("w"), True)]).limit(90)),
        f"SELECT event_id::VARCHAR AS _id, {two_sql} FROM events WHERE event_id < 400 AND (event_type = 'purchase' OR user_id < 50) ORDER BY v DESC NULLS LAST, w ASC NULLS LAST, _id LIMIT 90",
    )
    q["sort_by_a_constant"] = (on("orders", b.select("o_custkey").sort([(b.literal(1), True)]).limit(60)), "SELECT o_orderkey::VARCHAR AS _id, o_custkey FROM orders ORDER BY _id LIMIT 60")
    q["sort_by_expression_descending"] = (on("part", b.select("p_size").sort([((f("p_size") - 25).abs(), False)]).limit(70)), "SELECT p_partkey::VARCHAR AS _id, p_size FROM part ORDER BY abs(p_size::BIGINT - 25) DESC, _id LIMIT 70")


def _sql_form(q: Registry, source: Callable[..., Source], texts: Mapping[str, s.FieldSpec], tokens_sql: Callable[[str], str], bm25_sql: Callable[..., str], probe: list[float], derived: Callable[[SparkSession, str], Source]) -> None:
    def sql(table: str, text: str, fields: Mapping[str, s.FieldSpec] | None = None, params: list[Any] | None = None):
        return lambda spark, sf: run_select(source(spark, sf, table, fields), text, params)

    for name, table, text, other in (
        ("sql_unary_minus", "part", "SELECT p_partkey, -p_size AS m, -(p_size - 30) AS d FROM part", "SELECT p_partkey, -p_size AS m, -(p_size::BIGINT - 30) AS d FROM part"),
        ("sql_is_null", "events", "SELECT event_id, CASE WHEN event_type = 'view' THEN value END AS v FROM events WHERE value IS NOT NULL AND NOT event_type IS NULL", None),
        ("sql_not_in_not_between", "lineitem", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag NOT IN ('A', 'R') AND l_quantity NOT BETWEEN 5 AND 45", None),
        ("sql_elapsed", "orders", "SELECT o_orderkey, elapsed(TIMESTAMP '1992-01-01', o_orderdate, 'day') AS d FROM orders", "SELECT o_orderkey, (epoch_us(o_orderdate) // 1000 - 694224000000) // 86400000 AS d FROM orders WHERE o_orderdate >= TIMESTAMP '1992-01-01'"),
        ("sql_boost", "part", "SELECT p_partkey, boost(p_retailprice, p_size > 25, 2) AS x FROM part", "SELECT p_partkey, p_retailprice * CASE WHEN p_size > 25 THEN 2 ELSE 1 END AS x FROM part"),
        ("sql_contains", "part", "SELECT p_partkey, contains(p_type, 'O') AS x FROM part WHERE contains(p_brand, '#1')", None),
        ("sql_projection_cast", "orders", "SELECT o_orderkey, o_custkey::int4 AS k, o_totalprice::float8 AS t FROM orders WHERE o_totalprice > 2000", "SELECT o_orderkey, o_custkey::INTEGER AS k, o_totalprice::DOUBLE AS t FROM orders WHERE o_totalprice > 2000"),
        ("sql_like_contains", "part", "SELECT p_partkey FROM part WHERE p_brand LIKE '%#2%' OR p_brand LIKE 'Brand#33'", None),
        ("sql_regexp_unicode", "documents", r"SELECT doc_id, lang FROM documents WHERE text ~ '\wé\w+ó?\b' AND lang <> 'en'", r"SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '[\p{L}\p{N}_]é[\p{L}\p{N}_]+ó?([^\p{L}\p{N}_]|$)') AND lang <> 'en'"),
        ("sql_regexp_not", "documents", "SELECT doc_id FROM documents WHERE text !~ '[*+]' AND text !~* 'THEA'", "SELECT doc_id FROM documents WHERE NOT regexp_matches(text, '[*+]') AND NOT regexp_matches(text, 'THEA', 'i')"),
        ("sql_regexp_flags", "documents", "SELECT doc_id FROM documents WHERE regexp_like(text, 'THE . and', 'xti') OR regexp_like(text, 'on. ', 'qx')", "SELECT doc_id FROM documents WHERE regexp_matches(text, '(?s)THE . and', 'i') OR contains(text, 'on. ')"),
        ("sql_regexp_lines", "documents", "SELECT doc_id FROM documents WHERE regexp_like(text, '^[A-Z][a-z]+ [a-z]+[.]$', 'n')", "SELECT doc_id FROM documents WHERE regexp_matches(text, '(?m)^[A-Z][a-z]+ [a-z]+[.]$')"),
    ):
        q[name] = (sql(table, text), other or text)
    q["sql_parameters"] = (sql("orders", "SELECT o_orderkey FROM orders WHERE o_totalprice > $1 AND o_orderstatus = $2", params=[1500.0, "F"]), "SELECT o_orderkey FROM orders WHERE o_totalprice > 1500 AND o_orderstatus = 'F'")
    toks = tokens_sql("text")
    q["sql_match_all_any"] = (
        sql("documents", "SELECT doc_id FROM documents WHERE match_all(text, ARRAY['from', 'thea']) OR match_any(text, 'que des')", texts),
        f"SELECT doc_id FROM documents WHERE list_has_all({toks}, ['from', 'thea']) OR list_has_any({toks}, ['que', 'des'])",
    )
    q["sql_match_tokens"] = (
        sql("documents", "SELECT doc_id, lang FROM documents WHERE match_tokens(ARRAY['de', 'fr'], lang)", texts),
        "SELECT doc_id, lang FROM documents WHERE lang IN ('de', 'fr')",
    )
    named = lambda text: text.replace("doc_id::VARCHAR AS _id", "doc_id")
    q["sql_bm25_should"] = (
        lambda spark, sf: _rounded(run_select(source(spark, sf, "documents", texts), "SELECT doc_id, bm25_score() AS score FROM documents WHERE match('from', text) AND should('thea', text, 0.5)"), "score"),
        named(bm25_sql([("from", 1.0), ("thea", 0.5)], "list_contains(toks, 'from')", "")),
    )
    vector = ", ".join(map(str, probe))
    q["sql_vector_distance"] = (
        lambda spark, sf: _rounded(run_select(source(spark, sf, "embeddings", {"embedding": s.vector(64).indexed(s.vector_index("euclidean"))}), f"SELECT vec_id, vector_distance(embedding, f32_vector(ARRAY[{vector}])) AS d FROM embeddings WHERE label < 5 ORDER BY d ASC LIMIT 25"), "d"),
        f"SELECT vec_id, round(pow(list_distance(embedding::DOUBLE[], [{vector}]::DOUBLE[]), 2)::FLOAT::DOUBLE, 3) AS d FROM embeddings WHERE label < 5 ORDER BY pow(list_distance(embedding::DOUBLE[], [{vector}]::DOUBLE[]), 2), vec_id::VARCHAR LIMIT 25",
    )
    rows = [[0.5, -0.25, *([0.0] * 14)], [0.0] * 8 + [0.25] * 8]
    said = ", ".join("ARRAY[" + ", ".join(map(str, r)) + "]" for r in rows)
    best = lambda r: f"list_max(list_transform(range(4), lambda i: list_inner_product(embedding[i * 16 + 1 : i * 16 + 16]::DOUBLE[], {r}::DOUBLE[])))"
    q["sql_multi_vector_distance"] = (
        lambda spark, sf: _rounded(run_select(derived(spark, sf), f"SELECT vec_id, multi_vector_distance(tokens, f32_matrix(ARRAY[{said}])) AS d FROM t"), "d"),
        f"SELECT vec_id, round(({best(rows[0])} + {best(rows[1])})::FLOAT::DOUBLE, 3) AS d FROM embeddings",
    )
    q["sql_sparse_distance"] = (
        lambda spark, sf: _rounded(run_select(derived(spark, sf), """SELECT vec_id, vector_distance(sparse, f32_sparse_vector(ARRAY[0, 9, 30], ARRAY[1.0, 0.5, 2.0])) AS d FROM t"""), "d"),
        "SELECT vec_id, round((greatest(embedding[1], 0)::DOUBLE + 0.5 * greatest(embedding[10], 0)::DOUBLE + 2 * greatest(embedding[31], 0)::DOUBLE)::FLOAT::DOUBLE, 3) AS d FROM embeddings",
    )


def _json_form(q: Registry, source: Callable[..., Source], texts: Mapping[str, s.FieldSpec], tokens_sql: Callable[[str], str], bm25_sql: Callable[..., str]) -> None:
    toks = tokens_sql("text")

    def hits(table: str, request: Mapping[str, Any], *names: str, fields: Mapping[str, s.FieldSpec] | None = None):
        def made(spark: SparkSession, sf: str) -> DataFrame:
            df = Search(source(spark, sf, table, fields), request).hits_frame()
            return df.select("_id", *[F.round("_score", 3).alias("score") if n == "score" else F.col(n) for n in names])

        return made

    q["es_match_all"] = (hits("orders", {"query": {"match_all": {"boost": 2.0}}, "size": 40}, "score"), "SELECT o_orderkey::VARCHAR AS _id, 2.0::DOUBLE AS score FROM orders ORDER BY _id LIMIT 40")
    q["es_multi_match"] = (
        lambda spark, sf: Search(source(spark, sf, "documents", texts), {"query": {"multi_match": {"query": "from thea", "fields": ["text^2"], "operator": "and"}}, "size": 0}).gated().select("_id"),
        f"SELECT doc_id::VARCHAR AS _id FROM documents WHERE list_has_all({toks}, ['from', 'thea'])",
    )
    scored = bm25_sql([("from", 2.0), ("thea", 2.0)], "list_has_any(toks, ['from', 'thea'])", "").replace("round(score::DOUBLE, 3) AS score", "score AS raw")
    q["es_match_boost"] = (
        hits("documents", {"query": {"match": {"text": {"query": "from thea", "boost": 2.0}}}, "size": 30}, "score", fields=texts),
        f"SELECT _id, round(raw::DOUBLE, 3) AS score FROM ({scored}) ORDER BY raw DESC, _id LIMIT 30",
    )
    q["es_regexp_exists"] = (
        lambda spark, sf: Search(source(spark, sf, "part"), {"query": {"bool": {"filter": [{"regexp": {"p_brand": {"value": "Brand#[12]."}}}, {"exists": {"field": "p_size"}}], "must_not": [{"range": {"p_size": {"lte": 10}}}]}}, "size": 0}).gated().select("_id", "p_brand"),
        "SELECT p_partkey::VARCHAR AS _id, p_brand FROM part WHERE regexp_full_match(p_brand, 'Brand#[12].') AND p_size IS NOT NULL AND NOT p_size <= 10",
    )

    def response(spark: SparkSession, sf: str) -> DataFrame:
        """hits.total, and a page's sources cut to the fields asked for."""
        out = Search(source(spark, sf, "part"), {"query": {"range": {"p_size": {"gte": 10}}}, "sort": [{"p_retailprice": "desc"}], "size": 15, "_source": {"includes": ["p_*"], "excludes": ["p_name", "p_retailprice"]}}).run()
        rows = [(h["_id"], out["hits"]["total"]["value"], ",".join(sorted(h["_source"])), h["_source"]["p_brand"]) for h in out["hits"]["hits"]]
        return spark.createDataFrame(rows, "_id string, total long, fields string, p_brand string")

    q["es_total_and_source"] = (response, "SELECT p_partkey::VARCHAR AS _id, (SELECT count(*) FROM part WHERE p_size >= 10) AS total, 'p_brand,p_partkey,p_size,p_type' AS fields, p_brand FROM part WHERE p_size >= 10 ORDER BY p_retailprice DESC, _id LIMIT 15")


def store_root(spark: SparkSession) -> str:
    """A new folder for a store where all executors can write."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/corvane-store-{uuid.uuid4().hex}"


def _through_a_store(q: Registry) -> None:
    kinds = {"event_type": s.text(), "value": s.float_(), "event_id": s.integer()} if hasattr(s, "float_") else {"event_type": s.text(), "value": s.float(), "event_id": s.integer()}
    shown = ("event_id", "event_type", "value")

    def users(spark: SparkSession, sf: str) -> DataFrame:
        return spark.read.parquet(f"{sf}/events.parquet").select(F.col("user_id").cast("string").alias("_id"), "event_type", "value", "event_id")

    def written(spark: SparkSession, sf: str):
        """Even events first, odd ones over them: each user's newest odd event, else the newest even one."""
        c = Engine(spark, store_root(spark)).store.create("users", kinds)
        df = users(spark, sf)
        c.upsert_frame(df.filter("event_id % 2 = 0"), order="event_id")
        c.upsert_frame(df.filter("event_id % 2 = 1"), order="event_id")
        return c

    def look(c) -> DataFrame:
        return c.snapshot().select("_id", *shown)

    newest_sql = "SELECT user_id, event_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 2 DESC, event_id DESC) AS r FROM events"
    base = f"SELECT user_id::VARCHAR AS _id, event_id, event_type, value FROM ({newest_sql}) WHERE r = 1"
    q["store_upsert"] = (lambda spark, sf: look(written(spark, sf)), base)

    def compacted(spark: SparkSession, sf: str) -> DataFrame:
        c = written(spark, sf)
        c.compact()
        c.upsert_frame(users(spark, sf).filter("event_id % 7 = 3"), order="event_id")
        return look(c)

    q["store_compact_then_upsert"] = (compacted, f"SELECT user_id::VARCHAR AS _id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY (event_id % 7 = 3) DESC, event_id % 2 * (event_id % 7 <> 3)::INTEGER DESC, event_id DESC) AS r FROM events) WHERE r = 1")

    def deleted(what: Callable[[Any], Any]):
        def made(spark: SparkSession, sf: str) -> DataFrame:
            c = written(spark, sf)
            what(c)
            return look(c)

        return made

    q["store_delete_by_filter"] = (deleted(lambda c: c.delete((f("event_type") == "error") | (f("value") > 400.0))), f"SELECT * FROM ({base}) WHERE NOT (event_type = 'error' OR value > 400)")
    q["store_delete_by_ids"] = (deleted(lambda c: c.delete(["1", "2", "3", "none"])), f"SELECT * FROM ({base}) WHERE _id NOT IN ('1', '2', '3')")

    def updated(c) -> None:
        c.update([{"_id": str(i), "event_type": "changed", "value": None if i % 2 else 0.5} for i in range(1, 30)])

    q["store_update"] = (
        deleted(updated),
        f"SELECT _id, event_id, CASE WHEN _id::BIGINT BETWEEN 1 AND 29 THEN 'changed' ELSE event_type END AS event_type, CASE WHEN _id::BIGINT BETWEEN 1 AND 29 THEN CASE WHEN _id::BIGINT % 2 = 1 THEN NULL ELSE 0.5 END ELSE value END AS value FROM ({base})",
    )

    def got(spark: SparkSession, sf: str) -> DataFrame:
        found = written(spark, sf).get([str(i) for i in range(40)], ["event_type", "event_id"], required_lsn="2")
        return spark.createDataFrame([(i, d.get("event_id"), d.get("event_type")) for i, d in found.items()] or [], "_id string, event_id long, event_type string")

    q["store_get"] = (got, f"SELECT _id, event_id, event_type FROM ({base}) WHERE _id::BIGINT < 40")

    def partitions(spark: SparkSession, sf: str) -> DataFrame:
        c = Engine(spark, store_root(spark)).store.create("orders", {"o_totalprice": kinds["value"], "o_orderstatus": s.text()})
        df = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").cast("string").alias("_id"), "o_totalprice", "o_orderstatus")
        for status in ("O", "F", "P"):
            c.partition(status).upsert_frame(df.filter(F.col("o_orderstatus") == status), unique=True)
        c.partition("P").drop_partition()
        names = c.partitions()
        return spark.createDataFrame([(n, c.partition(n).count()) for n in names], "part string, n long")

    q["store_partitions"] = (partitions, "SELECT o_orderstatus AS part, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")

    def statements(spark: SparkSession, sf: str) -> DataFrame:
        """CREATE, INSERT, UPDATE, DELETE and SELECT over the nations."""
        engine = Engine(spark, store_root(spark))
        engine.sql("CREATE TABLE nation (n_name TEXT NOT NULL, n_regionkey INTEGER)")
        rows = spark.read.parquet(f"{sf}/nation.parquet").collect()
        engine.sql("INSERT INTO nation (_id, n_name, n_regionkey) VALUES " + ", ".join(f"('{r['n_nationkey']}', '{r['n_name']}', {r['n_regionkey']})" for r in rows))
        engine.sql("UPDATE nation SET n_regionkey = 9 WHERE _id IN ('1', '2')")
        engine.sql("DELETE FROM nation WHERE n_regionkey = 3")
        engine.sql("DELETE FROM nation WHERE _id = '5'")
        return engine.sql("SELECT _id, n_name, n_regionkey FROM nation WHERE n_regionkey >= 0")

    q["sql_statements"] = (statements, "SELECT n_nationkey::VARCHAR AS _id, n_name, CASE WHEN n_nationkey IN (1, 2) THEN 9 ELSE n_regionkey END::BIGINT AS n_regionkey FROM nation WHERE n_nationkey <> 5 AND (n_nationkey IN (1, 2) OR n_regionkey <> 3)")


def register(q: Registry, **parts: Any) -> None:
    """Add these queries to ``q``."""
    _null_rules(q, parts["source"])
    _sql_form(q, parts["source"], parts["texts"], parts["tokens_sql"], parts["bm25_sql"], parts["probe"], parts["derived"])
    _json_form(q, parts["source"], parts["texts"], parts["tokens_sql"], parts["bm25_sql"])
    _through_a_store(q)
