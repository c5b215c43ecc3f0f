"""SQL and the JSON search form over a small store."""

import datetime as dt

import pytest

from corvane.engine import Engine
from corvane.errors import EngineError, InvalidArgument, Unsupported
from corvane.es import mapping
from corvane.es import search as es
from corvane.plans import schema as s
from corvane.sources import codec
from corvane.sources.datasets import chunks
from corvane.streaming.ingest import write_stream

BOOKS = [
    ("hobbit", "The Hobbit", "Tolkien", "fantasy", 1937, 4.3, True, [1.0, 0.0, 0.0, 0.0], ["adventure", "magic"]),
    ("lotr", "The Lord of the Rings", "Tolkien", "fantasy", 1954, 4.5, True, [0.9, 0.1, 0.0, 0.0], ["adventure", "magic"]),
    ("harry", "Harry Potter", "Rowling", "fantasy", 1997, 4.5, True, [0.0, 1.0, 0.0, 0.0], ["magic"]),
    ("catcher", "The Catcher in the Rye", "Salinger", "fiction", 1951, 3.8, False, [0.0, 0.0, 1.0, 0.0], ["youth"]),
    ("gatsby", "The Great Gatsby", "Fitzgerald", "fiction", 1925, 3.9, True, [0.0, 0.0, 0.9, 0.1], None),
    ("pride", "Pride and Prejudice", "Austen", "romance", 1813, 4.2, True, None, ["love"]),
]


@pytest.fixture(scope="module")
def engine(spark, tmp_path_factory):
    e = Engine(spark, f"file://{tmp_path_factory.mktemp('sql')}")
    e.sql("""CREATE TABLE books (_id TEXT PRIMARY KEY, title TEXT NOT NULL INDEX keyword_index(type='text'), author TEXT, genre TEXT INDEX keyword_index(type='exact'), published_year INTEGER,
             rating FLOAT, in_print BOOLEAN, embedding f32_vector(4) INDEX vector_index(metric='cosine'), tags TEXT[], published_ts TIMESTAMP, metadata JSONB)""")
    for i, title, author, genre, year, rating, in_print, vector, tags in BOOKS:
        cols = {"_id": i, "title": title, "author": author, "genre": genre, "published_year": year, "rating": rating, "in_print": in_print}
        text = ", ".join(f"'{v}'" if isinstance(v, str) else str(v).upper() if isinstance(v, bool) else str(v) for v in cols.values())
        extra = (f", f32_vector(ARRAY{vector})" if vector else ", NULL") + (", ARRAY[" + ", ".join(f"'{t}'" for t in tags) + "]" if tags else ", NULL")
        e.sql(f"INSERT INTO books ({', '.join(cols)}, embedding, tags, published_ts, metadata) VALUES ({text}{extra}, TIMESTAMP '{year}-03-04T05:06:07Z', struct('pages', {year}))")
    e.collection("books").compact()
    return e


def rows(engine, text, params=None):
    return [tuple(r) for r in engine.sql(text, params).collect()]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("SELECT title FROM books WHERE _id = 'hobbit'", [("The Hobbit",)]),
        ("SELECT published_year, published_year + 1 AS n FROM books WHERE _id = 'hobbit'", [(1937, 1938)]),
        ("SELECT _id, ABS(published_year - 1953) AS d FROM books ORDER BY ABS(published_year - 1953) ASC LIMIT 1", [("lotr", 1)]),
        ("SELECT CASE WHEN rating >= 4.5 THEN 'great' ELSE 'good' END AS t FROM books WHERE _id = 'lotr'", [("great",)]),
        ("SELECT CASE genre WHEN 'fantasy' THEN 1 END AS t FROM books WHERE _id = 'pride'", [(None,)]),
        ("SELECT _id FROM books WHERE published_year BETWEEN 1930 AND 1952 ORDER BY _id ASC LIMIT 9", [("catcher",), ("hobbit",)]),
        ("SELECT _id FROM books WHERE title LIKE '%Catcher%' OR title LIKE 'Pride%' ORDER BY _id LIMIT 9", [("catcher",), ("pride",)]),
        ("SELECT _id FROM books WHERE title ~* '^harry'", [("harry",)]),
        ("SELECT _id FROM books WHERE tags IS NULL", [("gatsby",)]),
        ("SELECT _id FROM books WHERE contains(tags, 'love') AND NOT in_print = FALSE", [("pride",)]),
        ("SELECT COUNT(*) FROM books WHERE genre IN ('fantasy', 'fiction')", [(5,)]),
        ("SELECT genre, COUNT(*) AS n, MAX(rating) FROM books GROUP BY genre HAVING n > 1 ORDER BY n DESC LIMIT 5", [("fantasy", 3, 4.5), ("fiction", 2, 3.9)]),
        ("SELECT EXTRACT(month FROM published_ts) AS m, published_year::int4 AS y FROM books WHERE _id = 'harry'", [(3, 1997)]),
        ("SELECT _id, vector_distance(embedding, f32_vector(ARRAY[1, 0, 0, 0])) AS s FROM books ORDER BY s DESC LIMIT 1", [("hobbit", 1.0)]),
        ("SELECT _id FROM books WHERE match('rings') AND published_year > 1900", [("lotr",)]),
        ("SELECT _id FROM books WHERE match_tokens(ARRAY['fiction'], genre) ORDER BY _id LIMIT 1 OFFSET 1", [("gatsby",)]),
        ("SELECT metadata.pages AS p FROM books WHERE metadata.pages = 1813", None),
        ("SELECT _id FROM books WHERE _id = $1", [("harry",)]),
        ("SELECT elapsed(TIMESTAMP '2000-01-01', TIMESTAMP '2000-01-03', 'day') AS d, date_part('year', published_ts) AS y FROM books WHERE _id = 'pride'", [(2, 1813)]),
        ("SELECT -published_year AS n, least(rating, 4) AS l FROM books WHERE _id = 'pride'", [(-1813, 4.0)]),
        ("SELECT _id FROM books WHERE (genre = 'romance' OR in_print = false) AND rating IS NOT NULL ORDER BY _id LIMIT 3", [("catcher",), ("pride",)]),
        ("SELECT table_name FROM information_schema.tables", [("books",)]),
    ],
)
def test_select(engine, text, expected):
    got = rows(engine, text, ["harry"] if "$1" in text else None)
    if expected is None:
        assert len(got) == 1
    else:
        assert got == expected


@pytest.mark.parametrize(
    ("text", "message"),
    [
        ("SELECT * FROM books", "SELECT *"), ("SELECT DISTINCT _id FROM books", "SELECT DISTINCT"), ("SELECT _id FROM books JOIN b ON 1 = 1", "JOIN"),
        ("SELECT _id FROM books, b", "multiple FROM"), ("SELECT _id FROM (SELECT 1)", "subqueries"), ("WITH x AS (SELECT 1) SELECT _id FROM x", "WITH"),
        ("SELECT _id FROM books UNION SELECT _id FROM books", "UNION"), ("SELECT _id FROM books ORDER BY _id", "ORDER BY without LIMIT"), ("SELECT _id FROM books OFFSET 1", "OFFSET without LIMIT"),
        ("SELECT _id FROM books ORDER BY 1 LIMIT 1", "ordinal"), ("SELECT _id FROM books LIMIT 0", "Limit k"), ("SELECT _id FROM books LIMIT 1.5", "positive integer"),
        ("SELECT _id FROM books ORDER BY _id NULLS FIRST LIMIT 1", "NULLS FIRST/LAST"), ("SELECT _id FROM books WHERE title ILIKE 'x'", "ILIKE"), ("SELECT _id FROM books WHERE title IS DISTINCT FROM 'x'", "IS DISTINCT FROM"),
        ("SELECT _id FROM books WHERE _id IN (SELECT 1)", "IN (SELECT"), ("SELECT _id FROM books WHERE _id IN UNNEST(x)", "IN UNNEST"), ("SELECT _id FROM books WHERE _id IN (title)", "only literal values"),
        ("SELECT _id FROM books WHERE title LIKE '%rings'", "LIKE pattern `%rings` is not supported"), ("SELECT _id FROM books WHERE title LIKE 'a%b'", "unsupported wildcard"), ("SELECT _id FROM books WHERE EXISTS (SELECT 1)", "EXISTS"),
        ("SELECT _id, COUNT(*) FROM books", "non-COUNT(*)"), ("SELECT SUM(rating) FROM books", "non-COUNT(*)"), ("SELECT COUNT(*) FROM books LIMIT 1", "LIMIT"), ("SELECT COUNT(*) FROM books ORDER BY _id LIMIT 1", "ORDER BY"),
        ("SELECT genre FROM books GROUP BY genre", "at least one aggregate"), ("SELECT genre, COUNT(*) FROM books GROUP BY ALL", "GROUP BY ALL"), ("SELECT genre, COUNT(*) FROM books GROUP BY ROLLUP (genre)", "ROLLUP"),
        ("SELECT title, COUNT(*) FROM books GROUP BY genre", "must be a group key"), ("SELECT genre, COUNT(DISTINCT title) FROM books GROUP BY genre", "DISTINCT aggregates"), ("SELECT genre, COUNT(*) FROM books GROUP BY genre HAVING COUNT(*) > 1", "HAVING"),
        ("SELECT genre, SUM(rating) OVER () AS s FROM books", "OVER"), ("SELECT genre, COUNT(*) FILTER (WHERE TRUE) FROM books GROUP BY genre", "FILTER"), ("SELECT foo(title) AS x FROM books", "function foo"),
        ("SELECT _id FROM books WHERE match('x', title) OR rating > 1", "using AND"), ("SELECT bm25_score() AS s FROM books", "text filter"), ("SELECT vector_distance(embedding, f32_vector(ARRAY[1,0,0,0])) + 1 AS s FROM books", "SELECT projection item"),
        ("SELECT _id FROM books WHERE match(title)", "string literal"), ("SELECT _id FROM books WHERE match_tokens('x', title)", "array of strings"), ("SELECT rating + 1 FROM books", "alias"), ("SELECT _id FROM books WHERE u8_vector(ARRAY[300]) = title", "out of range"),
        ("UPDATE books SET title = 'x' WHERE rating > 1", "UPDATE needs WHERE"), ("UPDATE books SET _id = 'x' WHERE _id = 'y'", "_id cannot"), ("DELETE FROM books", "DELETE without WHERE"), ("INSERT INTO books VALUES ('x')", "explicit list"), ("INSERT INTO books (title) VALUES ('x')", "_id"),
        ("DROP TABLE books CASCADE", "CASCADE"), ("SET other = 'x'", "SET other"), ("SELECT _id FROM books FOR UPDATE", "locks"), ("GRANT x", "statement"),
    ],
)
def test_rejected(engine, text, message):
    with pytest.raises(EngineError) as err:
        engine.sql(text).collect()
    assert message in str(err.value)


def test_statements(engine):
    engine.sql("CREATE TABLE IF NOT EXISTS t (n INTEGER, v f32_vector(2))")
    engine.sql("CREATE TABLE IF NOT EXISTS t (n INTEGER)")
    engine.sql("INSERT INTO t (_id, n, v, meta.x) VALUES ('a', 1, '[1, 2]'::f32_vector(2), 3), ('b', 2, NULL, 4)")
    engine.sql("UPDATE t SET n = 5 WHERE _id IN ('a', 'zz')")
    assert rows(engine, "SELECT n FROM t ORDER BY n DESC LIMIT 2") == [(5,), (2,)]
    engine.sql("INSERT INTO t PARTITION p (_id, n) VALUES ('a', 9)")
    assert rows(engine, "SELECT n FROM t$p WHERE _id = 'a'") == [(9,)]
    engine.sql("DELETE FROM t PARTITION p")
    engine.sql("DELETE FROM t WHERE n > 3")
    assert rows(engine, "SELECT COUNT(*) FROM t") == [(1,)]
    assert "filter" in rows(engine, "EXPLAIN SELECT n FROM t WHERE n > 1")[0][0]
    engine.sql("SET consistency_level = 'strong'")
    assert rows(engine, "SHOW consistency_level") == [("strong",)]
    engine.sql("BEGIN")
    engine.sql("DROP TABLE t")
    engine.sql("DROP TABLE IF EXISTS t")


def found(engine, request, **params):
    return [h["_id"] for h in es.search(engine.collection("books"), request, **params)["hits"]["hits"]]


@pytest.mark.parametrize(
    ("query", "expected"),
    [
        ({"match_all": {}}, {b[0] for b in BOOKS}), ({"match": {"title": "hobbit rings"}}, {"hobbit", "lotr"}), ({"match": {"title": {"query": "great gatsby", "operator": "and"}}}, {"gatsby"}),
        ({"multi_match": {"query": "fiction", "fields": ["title", "genre^2"]}}, {"catcher", "gatsby"}), ({"term": {"genre.keyword": "romance"}}, {"pride"}), ({"term": {"published_year": 1937}}, {"hobbit"}), ({"term": {"published_year": "1937"}}, set()),
        ({"terms": {"author": ["Tolkien", "Austen"]}}, {"hobbit", "lotr", "pride"}), ({"ids": {"values": ["pride", 7]}}, {"pride"}), ({"prefix": {"author": "Fitz"}}, {"gatsby"}), ({"regexp": {"author": {"value": "^aus", "case_insensitive": True}}}, {"pride"}),
        ({"range": {"published_year": {"gte": 1950, "lt": 1990}}}, {"lotr", "catcher"}), ({"exists": {"field": "embedding"}}, None),
        ({"bool": {"must": [{"term": {"genre": "fantasy"}}], "must_not": [{"match": {"title": "harry"}}], "should": [{"term": {"published_year": 1937}}]}}, {"hobbit", "lotr"}),
        ({"bool": {"should": [{"term": {"genre": "romance"}}, {"range": {"rating": {"gt": 4.4}}}]}}, {"pride", "lotr", "harry"}), ({"bool": {}}, {b[0] for b in BOOKS}),
    ],
)
def test_search_clauses(engine, query, expected):
    if expected is None:
        with pytest.raises(InvalidArgument):
            found(engine, {"query": query})
        return
    assert set(found(engine, {"query": query})) == expected
    assert es.count(engine.collection("books"), {"query": query})["count"] == len(expected)


def test_search_features(engine):
    c = engine.collection("books")
    knn = {"field": "embedding", "query_vector": [1.0, 0.0, 0.0, 0.0], "k": 2, "num_candidates": 5}
    out = es.search(c, {"knn": knn})
    assert [(h["_id"], round(h["_score"], 3)) for h in out["hits"]["hits"]] == [("hobbit", 1.0), ("lotr", 0.997)]
    assert found(engine, {"knn": knn | {"filter": {"term": {"genre": "fiction"}}, "k": 1}}) == ["catcher"]
    assert found(engine, {"knn": knn | {"similarity": 0.999}}) == ["hobbit"]
    both = {"query": {"match": {"title": "rings"}}, "knn": knn}
    assert found(engine, both)[0] == "lotr"
    rrf = es.search(c, both | {"rank": {"rrf": {}}})["hits"]["hits"]
    assert [(h["_id"], round(h["_score"], 5)) for h in rrf] == [("lotr", round(1 / 61 + 1 / 62, 5)), ("hobbit", round(1 / 61, 5))]
    with pytest.raises(InvalidArgument):
        es.search(c, {"query": {"match_all": {}}, "rank": {"rrf": {}}})
    assert found(engine, {"sort": [{"rating": "desc"}, "published_year"], "from": 1, "size": 2}) == ["harry", "hobbit"]
    assert es.search(c, {"sort": ["published_year"], "size": 1})["hits"]["hits"][0]["_score"] is None
    hit = es.search(c, {"query": {"ids": {"values": ["pride"]}}, "_source": {"includes": ["title", "metadata.*"], "excludes": ["genre"]}})["hits"]["hits"][0]
    assert hit["_source"] == {"title": "Pride and Prejudice", "metadata": {"pages": 1813}}
    aggs = es.search(c, {"size": 0, "aggs": {"g": {"terms": {"field": "genre"}, "aggs": {"m": {"avg": {"field": "rating"}}}}, "top": {"max": {"field": "published_year"}}, "p": {"terms": {"field": "in_print"}}}})["aggregations"]
    assert [(x["key"], x["doc_count"]) for x in aggs["g"]["buckets"]] == [("fantasy", 3), ("fiction", 2), ("romance", 1)]
    assert aggs["top"]["value"] == 1997 and aggs["p"]["buckets"][0] == {"key": 1, "key_as_string": "true", "doc_count": 5}
    empty = es.search(c, {"size": 0, "query": {"term": {"genre": "x"}}, "aggs": {"s": {"sum": {"field": "rating"}}, "a": {"avg": {"field": "rating"}}}})["aggregations"]
    assert empty["s"]["value"] == 0 and empty["a"]["value"] is None
    for bad in ({"from": 9999, "size": 10}, {"query": {"match_all": {}}, "sort": ["title"]}, {"query": {"fuzzy": {}}}, {"nope": 1}):
        with pytest.raises((InvalidArgument, Unsupported)):
            es.search(c, bad)
    assert es.multi_search([(c, {"size": 0}), (c, {"nope": 1})])["responses"][1]["status"] == 400
    assert [d["found"] for d in es.multi_get(c, ["pride", "x"])["docs"]] == [True, False]


def test_bulk_and_mapping(engine):
    fields = mapping.from_mapping({"properties": {"t": {"type": "text"}, "k": {"type": "keyword"}, "v": {"type": "dense_vector", "dims": 2, "similarity": "dot_product"}, "b": {"type": "dense_vector", "dims": 16, "element_type": "bit"}, "o": {"properties": {"n": {"type": "long"}}}}})
    c = engine.store.create("bulk", fields)
    out = es.bulk(c, [{"index": {"_id": 1}}, {"t": "x", "v": [1.0, 0.0]}, {"index": {"_id": 2}}, {"v": [1.0, 1.0]}, {"update": {"_id": 1}}, {"doc": {"k": "y"}}, {"delete": {"_id": 5}}, {"create": {"_id": 6}}, {}])
    assert [next(iter(i.values()))["status"] for i in out["items"]] == [200, 400, 200, 404, 400] and out["errors"]
    assert c.get(["1"])["1"]["k"] == "y"
    assert mapping.to_mapping(fields)["properties"]["b"]["dims"] == 16
    assert mapping.field_caps(fields)["fields"]["k"]["keyword"]["aggregatable"]
    assert mapping.resolve(["a1", "a2", "b"], "a*,b") == ["a1", "a2", "b"]
    engine.store.drop("bulk")


def test_codec():
    assert codec.from_json({"1": 2, "5": 0.5}).values == ((1, 2.0), (5, 0.5))
    assert codec.from_json([[1, 2], [3, 4]]).rows == ((1.0, 2.0), (3.0, 4.0))
    assert codec.from_json([1, 2.5]) == [1.0, 2.5] and codec.from_json({"a": [1, "x"]}) == {"a": [1, "x"]}
    assert [codec.e4m3(x) for x in (0.1, 1.0, 17.3, 1000.0, -0.3)] == [0.1015625, 1.0, 18.0, 448.0, -0.3125]
    assert chunks("a\n\n" + "b " * 30, 20)[0].startswith("a")
    with pytest.raises(InvalidArgument):
        from corvane.plans.ir import timestamp_ms

        timestamp_ms(dt.datetime(2020, 1, 1))


def test_stream(spark, engine, tmp_path):
    spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 3)], "_id string, n long, at long").write.parquet(f"{tmp_path}/in")
    c = engine.store.create("stream", {"n": s.integer()})
    stream = spark.readStream.schema("_id string, n long, at long").parquet(f"{tmp_path}/in")
    write_stream(stream, c, f"{tmp_path}/ckpt", order_by="at").awaitTermination()
    assert c.get(["a", "b"], ["n"]) == {"a": {"_id": "a", "n": 2}, "b": {"_id": "b", "n": 1}}
    engine.store.drop("stream")
