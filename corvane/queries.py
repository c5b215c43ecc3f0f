"""The engine's operators as queries over the driver's tables, each with the SQL that DuckDB should agree on."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import queries_more
from .engine import run_select
from .es.search import Search
from .operators.latest import newest
from .plans import builder as b
from .plans import schema as s
from .plans.builder import agg, fn, match, match_tokens, should
from .plans.ir import Query
from .plans.lower import Source, run, run_with_matched

f = b.field
_KEYS = {"lineitem": ("l_orderkey", "l_linenumber"), "orders": ("o_orderkey",), "customer": ("c_custkey",), "part": ("p_partkey",), "supplier": ("s_suppkey",), "nation": ("n_nationkey",), "events": ("event_id",), "documents": ("doc_id",), "embeddings": ("vec_id",), "conversations": ("conv_id", "turn")}
_TEXT = {"text": s.text().indexed(s.keyword_index()), "lang": s.text().indexed(s.keyword_index(exact=True))}
_PROBE = [round(0.125 * ((i * 7) % 5 - 2), 3) for i in range(64)]


def source(spark: SparkSession, sf_dir: str, table: str, fields: Mapping[str, s.FieldSpec] | None = None) -> Source:
    """A table with an ``_id`` made of its key."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return Source(df.withColumn("_id", F.concat_ws("-", *_KEYS[table])), s.Schema(dict(fields or {})))


def _embeddings(spark: SparkSession, sf_dir: str, metric: str) -> Source:
    return source(spark, sf_dir, "embeddings", {"embedding": s.vector(64).indexed(s.vector_index(metric))})


def _rounded(df: DataFrame, *names: str, digits: int = 3) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n).cast("double"), digits) for n in names})


def _tokens_sql(text: str) -> str:
    from .functions.text import STOP_WORDS

    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '' AND x NOT IN ({stop}))"


def _bm25_sql(terms: list[tuple[str, float]], gate: str, tail: str) -> str:
    values = ", ".join(f"('{t}', {w})" for t, w in terms)
    return f"""
WITH d AS (SELECT doc_id, lang, {_tokens_sql('text')} AS toks FROM documents),
st AS (SELECT count(toks)::DOUBLE AS n, avg(len(toks)::DOUBLE) AS a FROM d),
q(t, w) AS (VALUES {values}),
df AS (SELECT t, sum(CASE WHEN list_contains(toks, t) THEN 1 ELSE 0 END)::DOUBLE AS df FROM d, q GROUP BY t),
p AS (SELECT d.doc_id, w * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(toks) / a)) AS part
      FROM d, q, st, df, LATERAL (SELECT len(list_filter(d.toks, lambda x: x = q.t)) AS tf) WHERE df.t = q.t AND tf > 0),
sc AS (SELECT d.doc_id, d.lang, d.toks, coalesce(sum(part), 0)::FLOAT AS score FROM d LEFT JOIN p USING (doc_id) GROUP BY ALL)
SELECT doc_id::VARCHAR AS _id, round(score::DOUBLE, 3) AS score FROM sc WHERE {gate} {tail}"""


def _registry() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]]:
    q: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {}
    lid = "l_orderkey || '-' || l_linenumber AS _id"

    def on(table: str, query: Query, fields: Mapping[str, s.FieldSpec] | None = None, rounded: tuple[str, ...] = (), digits: int = 3, every_row: bool = False):
        return lambda spark, sf: _rounded(run(source(spark, sf, table, fields), query, every_row=every_row), *rounded, digits=digits)

    # stages
    q["filter_sort_limit"] = (
        on("lineitem", b.filter((f("l_quantity") >= 45) & (f("l_returnflag") == "R")).select("l_orderkey", "l_extendedprice").sort(f("l_extendedprice")).limit(100)),
        f"SELECT {lid}, l_orderkey, l_extendedprice FROM lineitem WHERE l_quantity >= 45 AND l_returnflag = 'R' ORDER BY l_extendedprice DESC, _id LIMIT 100",
    )
    q["sort_offset_limit"] = (
        on("orders", b.select("o_totalprice").sort([(f("o_totalprice"), True)]).limit(50).offset(25)),
        "SELECT o_orderkey::VARCHAR AS _id, o_totalprice FROM orders ORDER BY o_totalprice, _id LIMIT 50 OFFSET 25",
    )
    q["multi_key_sort"] = (
        on("part", b.select("p_size", "p_brand").sort([(f("p_size"), True), (f("p_brand"), False)]).limit(200)),
        "SELECT p_partkey::VARCHAR AS _id, p_size, p_brand FROM part ORDER BY p_size, p_brand DESC, _id LIMIT 200",
    )
    q["sort_drops_null_keys"] = (
        on("events", b.select(v=(f("event_type") == "purchase").choose(f("value"), None)).sort(f("v")), every_row=True),
        "SELECT event_id::VARCHAR AS _id, value AS v FROM events WHERE event_type = 'purchase'",
    )
    q["topk_alias"] = (
        on("customer", b.select("c_acctbal").topk(f("c_acctbal"), 20)),
        "SELECT c_custkey::VARCHAR AS _id, c_acctbal FROM customer ORDER BY c_acctbal DESC, _id LIMIT 20",
    )
    q["count"] = (on("lineitem", b.filter(f("l_discount") > 0.05).count()), "SELECT count(*) AS _count FROM lineitem WHERE l_discount > 0.05")

    def matched(spark: SparkSession, sf: str) -> DataFrame:
        _, n = run_with_matched(source(spark, sf, "orders"), b.filter(f("o_orderstatus") == "F").select("o_totalprice").sort(f("o_totalprice")).limit(5))
        return spark.createDataFrame([(n(),)], "matched long")

    q["matched_count"] = (matched, "SELECT count(*) AS matched FROM orders WHERE o_orderstatus = 'F'")
    q["select_is_additive"] = (on("part", b.select("_id").filter(f("p_size") < 10)), "SELECT p_partkey::VARCHAR AS _id FROM part WHERE p_size < 10")
    q["fetch"] = (
        on("orders", b.select(price=f("o_totalprice")).sort(f("price")).limit(30).fetch(["o_orderstatus", "o_orderdate"])),
        "SELECT o_orderkey::VARCHAR AS _id, o_totalprice AS price, o_orderstatus, epoch_ms(o_orderdate) AS o_orderdate FROM orders ORDER BY price DESC, _id LIMIT 30",
    )
    q["no_collector"] = (on("nation", b.filter(f("n_regionkey").in_([1, 2])).select("n_name")), "SELECT n_nationkey::VARCHAR AS _id, n_name FROM nation WHERE n_regionkey IN (1, 2)")

    # groups and aggregates
    q["group_by_aggregates"] = (
        on("lineitem", b.group_by(["l_returnflag", "l_linestatus"], {"n": agg.count(), "q": agg.sum("l_quantity"), "lo": agg.min("l_extendedprice"), "hi": agg.max("l_extendedprice"), "a": agg.avg("l_discount")}), rounded=("q", "a"), digits=6),
        "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 6) AS q, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, round(avg(l_discount), 6) AS a FROM lineitem GROUP BY ALL",
    )
    q["group_by_expression"] = (
        on("orders", b.group_by({"y": f("o_orderdate").date_part("year"), "big": f("o_totalprice") > 100000}, {"n": agg.count()})),
        "SELECT year(o_orderdate)::INTEGER AS y, o_totalprice > 100000 AS big, count(*) AS n FROM orders GROUP BY ALL",
    )
    q["having_sort_limit_select"] = (
        on("orders", b.group_by(["o_custkey"], {"n": agg.count(), "total": agg.sum("o_totalprice")}).filter(f("n") > 5).sort([(f("n"), False), (f("o_custkey"), True)]).limit(50).select(k=f("o_custkey") * 2), rounded=("total",), digits=2),
        "SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total, o_custkey * 2 AS k FROM orders GROUP BY o_custkey HAVING count(*) > 5 ORDER BY n DESC, o_custkey LIMIT 50",
    )
    q["count_field"] = (
        on("events", b.select(v=(f("event_type") == "purchase").choose(f("value"), None)).group_by(["user_id"], {"rows": agg.count(), "values": agg.count("v")})),
        "SELECT user_id, count(*) AS rows, count(CASE WHEN event_type = 'purchase' THEN value END) AS values FROM events GROUP BY user_id",
    )

    # scalar expressions
    q["arithmetic"] = (
        on("lineitem", b.select(net=f("l_extendedprice") * (1 - f("l_discount")) + f("l_tax"), ratio=f("l_extendedprice") / f("l_quantity"), back=100 - f("l_quantity")), rounded=("net", "ratio"), digits=9),
        f"SELECT {lid}, round(l_extendedprice * (1 - l_discount) + l_tax, 9) AS net, round(l_extendedprice / l_quantity, 9) AS ratio, 100 - l_quantity AS back FROM lineitem",
    )
    q["integer_division"] = (
        on("part", b.select(tens=f("p_size") / 10, minus=(0 - f("p_size")) / 7)),
        "SELECT p_partkey::VARCHAR AS _id, p_size::BIGINT // 10 AS tens, -(p_size::BIGINT // 7) AS minus FROM part",
    )
    q["non_linear"] = (
        on("part", b.select(l=f("p_retailprice").ln(), e=(f("p_retailprice") / 1000.0).exp(), r=f("p_retailprice").sqrt(), sq=f("p_size").square(), a=(f("p_size") - 25).abs()), rounded=("l", "e", "r"), digits=4),
        "SELECT p_partkey::VARCHAR AS _id, round(ln(p_retailprice), 4) AS l, round(exp(p_retailprice / 1000.0), 4) AS e, round(sqrt(p_retailprice), 4) AS r, p_size * p_size AS sq, abs(p_size::BIGINT - 25) AS a FROM part",
    )
    q["clamp_coalesce_choose"] = (
        on("customer", b.select(lo=f("c_acctbal").max(0.0), hi=f("c_acctbal").min(1000.0), c=f("nothing").coalesce(f("c_nationkey")), t=(f("c_acctbal") < 0).choose("debt", "fine"))),
        "SELECT c_custkey::VARCHAR AS _id, greatest(c_acctbal, 0.0) AS lo, least(c_acctbal, 1000.0) AS hi, c_nationkey AS c, CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'fine' END AS t FROM customer",
    )
    q["logical_and_or_not"] = (
        on("lineitem", b.filter(((f("l_quantity") < 5) | (f("l_discount") >= 0.09)) & b.not_(f("l_returnflag") == "N") & f("l_shipdate").is_not_null()).select("l_quantity")),
        f"SELECT {lid}, l_quantity FROM lineitem WHERE (l_quantity < 5 OR l_discount >= 0.09) AND NOT (l_returnflag = 'N') AND l_shipdate IS NOT NULL",
    )
    q["all_any"] = (
        on("part", b.filter(b.all([f("p_size") > 5, f("p_size") <= 40, b.any([f("p_brand").ne("Brand#11"), f("p_retailprice") > 1500])])).select("p_size")),
        "SELECT p_partkey::VARCHAR AS _id, p_size FROM part WHERE p_size > 5 AND p_size <= 40 AND (p_brand <> 'Brand#11' OR p_retailprice > 1500)",
    )
    q["boost_and_min"] = (
        on("part", b.select(score=f("p_retailprice").boost(f("p_size") > 25, 2).min(3000.0))),
        "SELECT p_partkey::VARCHAR AS _id, least(p_retailprice * CASE WHEN p_size > 25 THEN 2 ELSE 1 END, 3000.0) AS score FROM part",
    )
    q["saturate_decay"] = (
        on("part", b.select(sat=f("p_retailprice").saturate(1000.0, 2.0), dec=f("p_retailprice").decay(1000.0, 2.0)), rounded=("sat", "dec"), digits=6),
        "SELECT p_partkey::VARCHAR AS _id, round(1 - pow(2.0, -pow(p_retailprice / 1000.0, 2.0)), 6) AS sat, round(pow(2.0, -pow(p_retailprice / 1000.0, 2.0)), 6) AS dec FROM part",
    )

    # texts, lists and dates
    q["starts_with_contains_in"] = (
        on("documents", b.select(a=f("text").starts_with("Th"), c=f("text").contains("tion "), i=f("lang").in_(["en", "de"]), s=f("lang").in_("de,fr")), _TEXT),
        "SELECT doc_id::VARCHAR AS _id, starts_with(text, 'Th') AS a, contains(text, 'tion ') AS c, lang IN ('en', 'de') AS i, contains('de,fr', lang) AS s FROM documents",
    )
    q["regexp_match"] = (
        on("documents", b.filter(f("text").regexp_match(r" [a-z]{3}tion[,.]", "i")).select("lang")),
        r"SELECT doc_id::VARCHAR AS _id, lang FROM documents WHERE regexp_matches(text, ' [a-z]{3}tion[,.]', 'i')",
    )
    q["list_contains"] = (
        lambda spark, sf: run(Source(source(spark, sf, "documents").df.withColumn("words", F.split("text", " "))), b.filter(f("words").contains("the") & f("words").starts_with("an")).select("lang")),
        "SELECT doc_id::VARCHAR AS _id, lang FROM (SELECT *, string_split(text, ' ') AS words FROM documents) WHERE list_contains(words, 'the') AND len(list_filter(words, lambda x: starts_with(x, 'an'))) > 0",
    )
    parts = {"y": "year", "mo": "month", "w": "week", "d": "day", "doy": "day_of_year", "dow": "day_of_week", "h": "hour", "mi": "minute", "se": "second", "ms": "millisecond"}
    q["date_parts"] = (
        on("events", b.select({k: f("ts").date_part(v) for k, v in parts.items()})),
        "SELECT event_id::VARCHAR AS _id, year(ts)::INTEGER AS y, month(ts)::INTEGER AS mo, week(ts)::INTEGER AS w, day(ts)::INTEGER AS d, dayofyear(ts)::INTEGER AS doy, (isodow(ts) - 1)::INTEGER AS dow, hour(ts)::INTEGER AS h, minute(ts)::INTEGER AS mi, second(ts)::INTEGER AS se, (epoch_us(ts) // 1000 % 1000)::INTEGER AS ms FROM events",
    )
    q["elapsed"] = (
        lambda spark, sf: run(Source(source(spark, sf, "events").df.withColumn("t0", F.timestamp_millis(F.lit(1577836800000)))), b.select(d=f("t0").elapsed(f("ts"), "day"), h=f("t0").elapsed(f("ts"), "h"))),
        "SELECT event_id::VARCHAR AS _id, (epoch_us(ts) // 1000 - 1577836800000) // 86400000 AS d, (epoch_us(ts) // 1000 - 1577836800000) // 3600000 AS h FROM events",
    )
    q["variant_union"] = (
        lambda spark, sf: run(Source(source(spark, sf, "events").df.withColumn("props", F.parse_json("props"))), b.filter(f("props.k") > 50).select(k=f("props.k").coalesce(0.0) * 1.0, n=f("props.nothing").is_null())),
        "SELECT event_id::VARCHAR AS _id, json_extract(props, '$.k')::DOUBLE AS k, TRUE AS n FROM events WHERE json_extract(props, '$.k')::DOUBLE > 50",
    )

    # text search
    toks = _tokens_sql("text")
    q["match_any"] = (on("documents", b.filter(match("thea from des", "text")).select("lang"), _TEXT), f"SELECT doc_id::VARCHAR AS _id, lang FROM documents WHERE list_has_any({toks}, ['thea', 'from', 'des'])")
    q["match_all_terms"] = (on("documents", b.filter(match("from the thea", "text", all=True)).select("lang"), _TEXT), f"SELECT doc_id::VARCHAR AS _id, lang FROM documents WHERE list_contains({toks}, 'from') AND list_contains({toks}, 'thea')")
    q["match_logical"] = (
        on("documents", b.filter(f("text").match_all(["from", "thea"]) | (f("lang") == "fr")).select("lang"), _TEXT),
        f"SELECT doc_id::VARCHAR AS _id, lang FROM documents WHERE list_has_all({toks}, ['from', 'thea']) OR lang = 'fr'",
    )
    q["match_exact_keyword"] = (on("documents", b.filter(match_tokens(["de", "es"], "lang")).select("lang"), _TEXT), "SELECT doc_id::VARCHAR AS _id, lang FROM documents WHERE lang IN ('de', 'es')")
    q["bm25"] = (
        on("documents", b.select(score=fn.bm25_score()).filter(match("from thea which", "text")).sort(f("score")), _TEXT, rounded=("score",), every_row=True),
        _bm25_sql([("from", 1.0), ("thea", 1.0), ("which", 1.0)], "list_has_any(toks, ['from', 'thea', 'which'])", ""),
    )
    q["bm25_should_boost"] = (
        on("documents", b.select(score=fn.bm25_score()).filter(match("from", "text").boost(2) & should("thea", "text", 0.5)), _TEXT, rounded=("score",)),
        _bm25_sql([("from", 2.0), ("thea", 0.5)], "list_contains(toks, 'from')", ""),
    )
    q["text_or"] = (
        on("documents", b.filter(match("from", "text") | match_tokens([("que", 1.0), ("des", 2.0)], "text", all=True)).select("lang"), _TEXT),
        f"SELECT doc_id::VARCHAR AS _id, lang FROM documents WHERE list_contains({toks}, 'from') OR list_has_all({toks}, ['que', 'des'])",
    )
    q["semantic_similarity"] = (
        lambda spark, sf: _rounded(run(source(spark, sf, "conversations", {"text": s.text().indexed(s.semantic_index())}), b.select(x=fn.semantic_similarity("text", "how are thea from which"))), "x"),
        "",
    )

    # vectors
    probe = "[" + ", ".join(map(str, _PROBE)) + "]::DOUBLE[]"
    for name, metric, sql, asc in (
        ("knn_l2", "euclidean", f"pow(list_distance(embedding::DOUBLE[], {probe}), 2)", True),
        ("knn_cosine", "cosine", f"list_cosine_similarity(embedding::DOUBLE[], {probe})", False),
        ("knn_dot", "dot_product", f"list_inner_product(embedding::DOUBLE[], {probe})", False),
    ):
        query = b.select("label", d=fn.vector_distance("embedding", _PROBE)).sort(f("d"), asc).limit(50)
        q[name] = (
            lambda spark, sf, metric=metric, query=query: _rounded(run(_embeddings(spark, sf, metric), query), "d"),
            f"SELECT vec_id::VARCHAR AS _id, label, round({sql}::FLOAT::DOUBLE, 3) AS d FROM embeddings ORDER BY {sql} {'ASC' if asc else 'DESC'}, _id LIMIT 50",
        )

    def derived(spark: SparkSession, sf: str) -> Source:
        df = source(spark, sf, "embeddings").df
        bits = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.aggregate(F.sequence(F.lit(0), F.lit(7)), F.lit(0), lambda acc, j: acc + F.when(F.get("embedding", i * 8 + j) > 0, F.pow(F.lit(2), j).cast("int")).otherwise(F.lit(0))).cast("short"))
        keep = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.get("embedding", i) > 0)
        sparse = F.struct(F.transform(keep, lambda i: i.cast("long")).alias("indices"), F.transform(keep, lambda i: F.get("embedding", i)).alias("values"))
        rows = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.slice("embedding", i * 16 + 1, F.lit(16)))
        fields = {"bits": s.vector(8, "binary").indexed(s.vector_index("hamming")), "sparse": s.sparse_vector().indexed(s.vector_index("dot_product")), "tokens": s.matrix(16).indexed(s.multi_vector_index())}
        return Source(df.select("_id", "vec_id", bits.alias("bits"), sparse.alias("sparse"), rows.alias("tokens")), s.Schema(fields))

    q["hamming"] = (
        lambda spark, sf: run(derived(spark, sf), b.select(d=fn.vector_distance("bits", [255, 0, 255, 0, 15, 15, 240, 240]))),
        "SELECT vec_id::VARCHAR AS _id, list_sum(list_transform(range(64), lambda i: CASE WHEN (embedding[i + 1] > 0) <> (([255, 0, 255, 0, 15, 15, 240, 240][i // 8 + 1] >> (i % 8)) & 1 = 1) THEN 1 ELSE 0 END))::FLOAT AS d FROM embeddings",
    )
    sparse_query = {i: round(0.25 * (i % 4 + 1), 2) for i in range(0, 64, 3)}
    q["sparse_dot"] = (
        lambda spark, sf: _rounded(run(derived(spark, sf), b.select(d=fn.vector_distance("sparse", sparse_query)).sort(f("d")).limit(40)), "d"),
        "SELECT vec_id::VARCHAR AS _id, round(raw::FLOAT::DOUBLE, 3) AS d FROM (SELECT vec_id, list_sum(list_transform([" + ", ".join(f"{{'i': {i}, 'v': {v}}}" for i, v in sparse_query.items()) + "], lambda p: CASE WHEN embedding[p.i + 1] > 0 THEN embedding[p.i + 1]::DOUBLE * p.v ELSE 0 END)) AS raw FROM embeddings) ORDER BY raw DESC, _id LIMIT 40",
    )
    matrix = [[round(0.1 * ((i * 5 + j * 3) % 7 - 3), 2) for j in range(16)] for i in range(3)]
    one = lambda r: "list_max(list_transform(range(4), lambda i: list_inner_product(embedding[i * 16 + 1 : i * 16 + 16]::DOUBLE[], " + str(r) + "::DOUBLE[])))"
    q["max_sim"] = (
        lambda spark, sf: _rounded(run(derived(spark, sf), b.select(d=fn.multi_vector_distance("tokens", matrix)).sort(f("d")).limit(40)), "d"),
        "SELECT vec_id::VARCHAR AS _id, round(raw::FLOAT::DOUBLE, 3) AS d FROM (SELECT vec_id, " + " + ".join(map(one, matrix)) + " AS raw FROM embeddings) ORDER BY raw DESC, _id LIMIT 40",
    )
    q["filtered_knn"] = (
        lambda spark, sf: _rounded(run(_embeddings(spark, sf, "euclidean"), b.filter(f("label").in_([1, 3])).select(d=fn.vector_distance("embedding", _PROBE)).sort(f("d"), True).limit(25)), "d"),
        f"SELECT vec_id::VARCHAR AS _id, round(pow(list_distance(embedding::DOUBLE[], {probe}), 2)::FLOAT::DOUBLE, 3) AS d FROM embeddings WHERE label IN (1, 3) ORDER BY pow(list_distance(embedding::DOUBLE[], {probe}), 2), _id LIMIT 25",
    )

    # hybrid: documents with the vector of the same number
    def hybrid(spark: SparkSession, sf: str) -> Source:
        docs, vecs = source(spark, sf, "documents").df, spark.read.parquet(f"{sf}/embeddings.parquet")
        df = docs.join(vecs.select(F.col("vec_id").alias("doc_id"), "embedding"), "doc_id")
        return Source(df, s.Schema(_TEXT | {"embedding": s.vector(64).indexed(s.vector_index("cosine"))}))

    def hybrid_sql(ranked: str) -> str:
        inner = _bm25_sql([("from", 1.0), ("thea", 1.0)], "TRUE", "")
        inner = inner.replace("FROM documents)", "FROM documents JOIN embeddings ON vec_id = doc_id)", 1).replace("round(score::DOUBLE, 3) AS score", "score::DOUBLE AS s, list_has_any(toks, ['from', 'thea']) AS g")
        return f"WITH t AS ({inner}), v AS (SELECT vec_id::VARCHAR AS _id, (1 + list_cosine_similarity(embedding::DOUBLE[], {probe})::FLOAT::DOUBLE) / 2 AS c FROM embeddings JOIN documents ON vec_id = doc_id), {ranked}"

    request = {"query": {"match": {"text": "from thea"}}, "knn": {"field": "embedding", "query_vector": _PROBE, "k": 30, "num_candidates": 30}}
    q["hybrid_expression"] = (
        lambda spark, sf: _rounded(run(hybrid(spark, sf), b.select(t=fn.bm25_score(), d=fn.vector_distance("embedding", _PROBE)).filter(match("from thea", "text")).select(x=f("t") + f("d") * 2).sort(f("x")).limit(40)).select("_id", "x"), "x"),
        hybrid_sql("h AS (SELECT _id, round(s + (c * 2 - 1)::FLOAT::DOUBLE * 2, 3) AS x FROM t JOIN v USING (_id) WHERE g) SELECT _id, x FROM h ORDER BY x DESC, _id LIMIT 40"),
    )
    q["hybrid_sum"] = (
        lambda spark, sf: Search(hybrid(spark, sf), request | {"size": 20}).hits_frame().select("_id", F.round("_score", 3).alias("score")),
        hybrid_sql("k AS (SELECT _id, c FROM v ORDER BY c DESC, _id LIMIT 30), u AS (SELECT _id, s AS x FROM t WHERE g UNION ALL SELECT _id, c FROM k) SELECT _id, round(sum(x), 3) AS score FROM u GROUP BY _id ORDER BY sum(x) DESC, _id LIMIT 20"),
    )
    q["hybrid_rrf"] = (
        lambda spark, sf: Search(hybrid(spark, sf), request | {"rank": {"rrf": {}}, "size": 20}).hits_frame().select("_id", F.round("_score", 6).alias("score")),
        hybrid_sql("a AS (SELECT _id, row_number() OVER (ORDER BY s DESC, _id) AS r FROM t WHERE g QUALIFY r <= 20), k AS (SELECT _id, row_number() OVER (ORDER BY c DESC, _id) AS r FROM v QUALIFY r <= 20), u AS (SELECT * FROM a UNION ALL SELECT * FROM k) SELECT _id, round(sum(1.0::DOUBLE / (60 + r)), 6) AS score FROM u GROUP BY _id ORDER BY sum(1.0::DOUBLE / (60 + r)) DESC, _id LIMIT 20"),
    )

    # the JSON search form
    query = {"bool": {"must": [{"term": {"lang": "en"}}], "filter": [{"range": {"n_chars": {"gte": 500, "lt": 5000}}}], "must_not": [{"prefix": {"source": "src1"}}], "should": [{"exists": {"field": "text"}}]}}
    q["es_bool"] = (
        lambda spark, sf: Search(source(spark, sf, "documents", _TEXT), {"query": query, "size": 0}).gated().select("_id", "lang"),
        "SELECT doc_id::VARCHAR AS _id, lang FROM documents WHERE lang = 'en' AND n_chars >= 500 AND n_chars < 5000 AND NOT starts_with(source, 'src1')",
    )
    q["es_sorted_page"] = (
        lambda spark, sf: Search(source(spark, sf, "orders"), {"query": {"terms": {"o_orderstatus": ["O", "P"]}}, "sort": [{"o_totalprice": "desc"}, "o_custkey"], "from": 10, "size": 30}).hits_frame().select("_id", "o_totalprice"),
        "SELECT o_orderkey::VARCHAR AS _id, o_totalprice FROM orders WHERE o_orderstatus IN ('O', 'P') ORDER BY o_totalprice DESC, o_custkey, _id LIMIT 30 OFFSET 10",
    )
    q["es_terms_aggregation"] = (
        lambda spark, sf: _rounded(Search(source(spark, sf, "events"), {"query": {"range": {"value": {"gt": 10}}}, "size": 0}).aggregation_frame("t", {"terms": {"field": "event_type", "size": 4}, "aggs": {"mean": {"avg": {"field": "value"}}, "top": {"max": {"field": "value"}}}})[1], "m_mean", digits=6),
        "SELECT event_type AS key, count(*) AS doc_count, round(avg(value), 6) AS m_mean, max(value) AS m_top FROM events WHERE value > 10 GROUP BY event_type ORDER BY doc_count DESC, key LIMIT 4",
    )
    q["es_metric_aggregation"] = (
        lambda spark, sf: _rounded(Search(source(spark, sf, "lineitem"), {"query": {"ids": {"values": ["1-1", "1-2", "2-1"]}}, "size": 0}).aggregation_frame("s", {"sum": {"field": "l_quantity"}})[1], "value"),
        "SELECT round(coalesce(sum(l_quantity), 0), 3) AS value FROM lineitem WHERE l_orderkey || '-' || l_linenumber IN ('1-1', '1-2', '2-1')",
    )

    # SQL front end
    def sql(table: str, text: str, fields: Mapping[str, s.FieldSpec] | None = None):
        return lambda spark, sf: run_select(source(spark, sf, table, fields), text)

    for name, table, text in (
        ("sql_where", "lineitem", "SELECT l_orderkey, l_linenumber, l_quantity + 1 AS q FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_returnflag IN ('A', 'R') AND NOT l_linestatus = 'O'"),
        ("sql_case_like", "part", "SELECT p_partkey, CASE WHEN p_size > 30 THEN 'large' WHEN p_size > 10 THEN 'medium' ELSE 'small' END AS size FROM part WHERE p_brand LIKE 'Brand#1%'"),
        ("sql_order_limit_offset", "orders", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 1000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 40 OFFSET 5"),
        ("sql_functions", "customer", "SELECT c_custkey, abs(c_acctbal) AS a, coalesce(c_nationkey, 0) AS n, least(c_acctbal, 100.0) AS l, greatest(c_acctbal, 0.0) AS g FROM customer WHERE c_mktsegment <> 'BUILDING'"),
    ):
        q[name] = (sql(table, text), text)
    q["sql_group_having"] = (
        sql("lineitem", "SELECT l_suppkey, COUNT(*) AS n, MAX(l_extendedprice) AS top FROM lineitem WHERE l_discount > 0.02 GROUP BY l_suppkey HAVING n > 10"),
        "SELECT l_suppkey, count(*) AS n, max(l_extendedprice) AS top FROM lineitem WHERE l_discount > 0.02 GROUP BY l_suppkey HAVING count(*) > 10",
    )
    q["sql_count"] = (sql("orders", "SELECT COUNT(*) FROM orders WHERE o_orderpriority ~ '^[12]-'"), "SELECT count(*) AS _count FROM orders WHERE regexp_matches(o_orderpriority, '^[12]-')")
    q["sql_match"] = (
        sql("documents", "SELECT doc_id, lang FROM documents WHERE match('from thea', text, 1.0, TRUE) AND n_chars > 1000", _TEXT),
        f"SELECT doc_id, lang FROM documents WHERE list_has_all({toks}, ['from', 'thea']) AND n_chars > 1000",
    )
    q["sql_extract"] = (
        sql("orders", "SELECT o_orderkey, EXTRACT(year FROM o_orderdate) AS y, date_part('day_of_week', o_orderdate) AS dow FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'"),
        "SELECT o_orderkey, year(o_orderdate)::INTEGER AS y, (isodow(o_orderdate) - 1)::INTEGER AS dow FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'",
    )

    # versioned writes: the newest row of each key, and deletion by filter
    def versions(spark: SparkSession, sf: str) -> DataFrame:
        df = spark.read.parquet(f"{sf}/events.parquet").select(F.col("user_id").cast("string").alias("_id"), F.col("event_id").alias("_lsn"), "event_type", "value")
        return newest(df)

    ranked = "SELECT user_id, event_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events"
    q["latest_upsert"] = (versions, f"SELECT user_id::VARCHAR AS _id, event_id AS _lsn, event_type, value FROM ({ranked}) WHERE r = 1")
    q["delete_by_filter"] = (
        lambda spark, sf: versions(spark, sf).filter(~F.coalesce(F.col("event_type") == "error", F.lit(False))),
        f"SELECT user_id::VARCHAR AS _id, event_id AS _lsn, event_type, value FROM ({ranked}) WHERE r = 1 AND event_type <> 'error'",
    )
    queries_more.register(q, source=source, texts=_TEXT, tokens_sql=_tokens_sql, bm25_sql=_bm25_sql, probe=_PROBE, derived=derived)
    return q


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run_ for name, (run_, _) in _registry().items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for name, (_, text) in _registry().items() if text}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hybrid top-k: keyword relevance and vector similarity in one expression."""
    return _registry()["hybrid_expression"][0](spark, sf_dir)
