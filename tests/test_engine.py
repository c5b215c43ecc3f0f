"""The builder over a store: stages, null rules, text, vectors, unions, writes."""

import datetime as dt

import pytest

from corvane.engine import Engine
from corvane.errors import AlreadyExists, EngineError, InvalidArgument, NotFound, SchemaError
from corvane.plans import builder as b
from corvane.plans import schema as s
from corvane.plans.builder import agg, fn, match, match_tokens, should

from . import books

f = b.field


@pytest.fixture(scope="module")
def engine(spark, tmp_path_factory):
    e = Engine(spark, f"file://{tmp_path_factory.mktemp('store')}")
    c = e.store.create("books", books.SCHEMA)
    docs = books.documents()
    for at in range(0, len(docs), 4):
        c.upsert(docs[at : at + 4])
    c.compact()
    return e


@pytest.fixture(scope="module")
def c(engine):
    return engine.collection("books")


def ids(rows):
    return [r["_id"] for r in rows]


def test_filter_select_sort_limit(c):
    rows = c.query(b.filter(f("published_year") >= 1950).select("title").sort(f("published_year"), True).limit(3))
    assert ids(rows) == ["catcher", "lotr", "mockingbird"]
    assert set(rows[0]) == {"_id", "title"}


def test_sort_defaults_to_descending(c):
    assert ids(c.query(b.select("title").sort(f("published_year")).limit(3))) == ["harry", "alchemist", "mockingbird"]


def test_offset_skips_after_ordering(c):
    q = b.select("title").sort(f("published_year"), True)
    assert ids(c.query(q.limit(4).offset(3))) == ids(c.query(q.limit(7)))[3:]


def test_single_key_sort_drops_nulls(c):
    assert ids(c.query(b.select("rating").sort(f("rating")).limit(10))) == ["moby", "pride", "gatsby", "hobbit"]


def test_multi_key_sort_keeps_rows_with_one_key(c):
    rows = c.query(b.select("rating", "importance").sort([(f("importance"), False), (f("rating"), True)]).limit(10))
    assert ids(rows) == ["moby", "mockingbird", "gatsby", "hobbit", "pride"]


def test_constant_key_keeps_everything(c):
    assert len(c.query(b.select("rating").sort([(f("rating"), False), (b.literal(1), True)]).limit(20))) == 10


def test_select_is_additive(c):
    assert ids(c.query(b.select("_id").filter(f("published_year") < 1850))) == ["pride"]


def test_unknown_field_is_left_out_and_null(c):
    assert c.query(b.select("nothing").filter(f("_id").eq("moby"))) == [{"_id": "moby"}]
    assert len(c.query(b.filter(f("nothing").is_null()))) == 10


def test_count_and_matched(c):
    assert c.query(b.filter(f("published_year") < 1940).count()) == [{"_count": 4}]
    rows, matched = c.query_with_matched(b.filter(f("published_year") < 1940).select("title").sort(f("published_year")).limit(2))
    assert len(rows) == 2 and matched == 4
    assert c.query_with_matched(b.select("title").limit(2))[1] is None


def test_group_by_and_having(c):
    rows = c.query(b.group_by({"old": f("published_year") < 1940}, {"n": agg.count(), "total": agg.sum("published_year"), "rated": agg.count("rating")}))
    assert sorted((r["old"], r["n"], r["total"], r["rated"]) for r in rows) == [(False, 6, 11799, 0), (True, 4, 7526, 4)]
    rows = c.query(b.group_by({"c": f("published_year") / 100}, {"n": agg.count()}).filter(f("n") > 2).select("n"))
    assert [(r["c"], r["n"]) for r in rows] == [(19, 8)]


def test_group_by_date_part_after_select(c):
    rows = c.query(b.select("_id").group_by({"m": f("published_ts").date_part("month")}, {"n": agg.count()}).sort(f("n")).limit(1))
    assert rows == [{"m": 7, "n": 3}]


@pytest.mark.parametrize("bad", [lambda: b.select("a").sort(f("a")), lambda: b.select("a").limit(0), lambda: b.select("a").limit(1).count(), lambda: b.group_by({}, {"n": agg.count()}), lambda: b.group_by({"a": f("a")}, {}), lambda: b.select("a").fetch(["a"]).limit(1), lambda: b.select("a").sort([(f("a"), True)] * 9).limit(1)])
def test_rejected_queries(c, bad):
    with pytest.raises(InvalidArgument):
        c.query(bad())


def test_sort_on_unknown_field(c):
    with pytest.raises(InvalidArgument):
        c.query(b.select("_id").sort(f("nothing")).limit(2))


def test_depth_and_arity(c):
    e = f("published_year") > 0
    deep = e
    for _ in range(17):
        deep = deep & e
    with pytest.raises(InvalidArgument, match="deep"):
        c.query(b.filter(deep))
    with pytest.raises(InvalidArgument):
        b.all([e] * 33)
    assert len(c.query(b.filter(b.all([e] * 32)))) == 10


def test_arithmetic(c):
    one = lambda e: c.query(b.select(x=e).filter(f("_id").eq("harry")))[0].get("x")
    assert one(f("published_year") / 10) == 199
    assert one(f("published_year") / 10.0) == 199.7
    assert one((f("published_year") + -2000).abs()) == 3
    assert one(f("published_year").max(2000)) == 2000
    assert one(f("rating").coalesce(7)) == 7
    assert one(f("rating").is_null().choose("none", "some")) == "none"
    assert one(b.literal(4) * 2 - 1) == 7
    assert one(f("published_year").sqrt()) == pytest.approx(44.687, abs=1e-2)
    assert one((f("published_year") * 0).ln()) == float("-inf")
    assert one(f("published_year").boost(f("title").contains("Harry"), 2)) == 3994
    assert one(f("published_year").saturate(1997.0)) == pytest.approx(0.5)
    assert one(f("published_year").decay(1997.0)) == pytest.approx(0.5)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        one(f("published_year") / (f("published_year") - 1997))
    with pytest.raises(Exception, match="u32 overflow"):
        one(b.literal(4_000_000_000, "u32") * b.literal(2, "u32"))


def test_not_matches_null_operands(c):
    assert "harry" in ids(c.query(b.filter((f("rating") > 3).not_())))


def test_strings_and_lists(c):
    assert set(ids(c.query(b.filter(f("title").starts_with("The ")))) ) == {"gatsby", "catcher", "hobbit", "lotr", "alchemist"}
    assert set(ids(c.query(b.filter(f("tags").starts_with("mag"))))) == {"hobbit", "harry", "lotr"}
    assert ids(c.query(b.filter(f("title").contains("hobbit")))) == []
    assert set(ids(c.query(b.filter(f("tags").contains("magic"))))) == {"hobbit", "harry", "lotr"}
    assert ids(c.query(b.filter(f("published_year").contains("19")))) == []
    assert set(ids(c.query(b.filter(f("_id").in_(["moby", "pride", 3]))))) == {"moby", "pride"}
    assert set(ids(c.query(b.filter(f("_id").in_("moby pride"))))) == {"moby", "pride"}
    assert ids(c.query(b.filter(f("title").regexp_match("^moby", "i")))) == ["moby"]
    with pytest.raises(InvalidArgument):
        c.query(b.filter(f("title").regexp_match(r"(a)\1")))


def test_dates(c):
    assert c.query(b.select("published_ts").filter(f("_id").eq("alchemist")))[0]["published_ts"] == int(dt.datetime(1988, 1, 1, tzinfo=dt.UTC).timestamp() * 1000)
    at = b.literal(dt.datetime(1997, 6, 26, 12, 34, 56, 789000, tzinfo=dt.UTC))
    parts = ["year", "month", "week", "day", "day_of_year", "day_of_week", "hour", "minute", "second", "millisecond"]
    row = c.query(b.select({p: at.date_part(p) for p in parts}).limit(1))[0]
    assert [row[p] for p in parts] == [1997, 6, 26, 26, 177, 3, 12, 34, 56, 789]
    row = c.query(b.select(d=f("published_ts").elapsed(b.literal(dt.datetime(1988, 1, 8, tzinfo=dt.UTC)), "week")).filter(f("_id").eq("alchemist")))[0]
    assert row["d"] == 1


def test_unions(c):
    assert set(ids(c.query(b.filter(f("user_ratings").contains("good"))))) == {"pride", "gatsby", "lotr"}
    assert set(ids(c.query(b.filter(f("user_ratings").contains(4))))) == {"1984", "catcher", "hobbit"}
    assert ids(c.query(b.filter(f("user_ratings").eq(10)))) == ["harry"]
    assert set(ids(c.query(b.filter(f("user_ratings").starts_with("good"))))) == {"pride", "gatsby", "lotr"}
    with pytest.raises(InvalidArgument, match="mixed"):
        c.query(b.select("user_ratings").sort(f("user_ratings")).limit(1))
    assert c.get(["gatsby", "moby"], ["user_ratings"]) == {"gatsby": {"_id": "gatsby", "user_ratings": "good book"}, "moby": {"_id": "moby", "user_ratings": [-5, 2, -1, 1]}}


def test_struct_paths(c):
    assert set(ids(c.query(b.filter(f("meta.century").eq(19))))) == {"pride", "moby"}
    assert c.query(b.select(x=f("meta.name.short")).filter(f("_id").eq("lotr")))[0]["x"] == "lot"


def test_text_gates(c):
    assert set(ids(c.query(b.filter(match("LOVE", "summary"))))) == {"1984", "pride", "gatsby"}
    assert ids(c.query(b.filter(match("the a of", "summary")))) == []
    assert ids(c.query(b.filter(match("hobbit dragon", "summary", all=True)))) == ["hobbit"]
    assert len(c.query(b.filter(should("hobbit", "summary")))) == 10
    assert set(ids(c.query(b.filter(match("High Fantasy", "genre"))))) == {"hobbit", "lotr"}
    assert ids(c.query(b.filter(match("fantasy", "genre")))) == []
    assert set(ids(c.query(b.filter(match_tokens(["love", "whale"], "tags"))))) == {"1984", "pride", "gatsby", "moby"}
    assert ids(c.query(b.filter(match("love", "summary") & match("lost", "summary")))) == ["gatsby"]
    assert set(ids(c.query(b.filter(match("whale", "summary") | match("wizard", "summary"))))) == {"moby", "harry"}
    assert set(ids(c.query(b.filter(f("summary").match_any("whale wizard") | (f("_id") == "pride"))))) == {"moby", "harry", "pride"}
    with pytest.raises(InvalidArgument):
        c.query(b.filter(f("rating").match_any("x")))


def test_bm25(c):
    rows = c.query(b.select("title", score=fn.bm25_score()).filter(match("love", "summary")).sort(f("score")).limit(3))
    assert ids(rows)[0] == "gatsby" and all(0 < r["score"] < 3 for r in rows)
    heavy = c.query(b.select(score=fn.bm25_score()).filter(match("love", "summary").boost(2)).sort(f("score")).limit(1))
    assert heavy[0]["score"] == pytest.approx(2 * rows[0]["score"], rel=1e-5)
    with pytest.raises(InvalidArgument, match="text filter"):
        c.query(b.select(score=fn.bm25_score()).limit(1))


def test_vectors(c):
    rows = c.query(b.select(d=fn.vector_distance("summary_embedding", [2.0] * 16)).sort(f("d"), True).limit(3))
    assert [(r["_id"], r["d"]) for r in rows] == [("1984", 0.0), ("mockingbird", 16.0), ("pride", 16.0)]
    rows = c.query(b.select(d=fn.vector_distance("nullable_embedding", [1.0, 0.0, 0.0, 0.0])).sort(f("d")).limit(9))
    assert ids(rows) == ["lotr", "moby", "pride"]
    rows = c.query(b.select(d=fn.vector_distance("binary_embedding", [3, 255])).sort(f("d"), True).limit(4))
    assert [(r["_id"], r["d"]) for r in rows] == [("pride", 0), ("1984", 1), ("mockingbird", 1), ("gatsby", 3)]
    rows = c.query(b.select(d=fn.vector_distance("sparse_embedding", {3: 10.0, 100: 1.0})).sort(f("d")).limit(2))
    assert [(r["_id"], r["d"]) for r in rows] == [("pride", 11.5), ("alchemist", 5.0)]
    rows = c.query(b.select(d=fn.multi_vector_distance("token_embeddings", [[1.0, 1.0], [1.0, 0.0]])).sort(f("d")).limit(5))
    assert [(r["_id"], r["d"]) for r in rows] == [("lotr", 11.0), ("moby", 8.0), ("pride", 5.0)]
    with pytest.raises(InvalidArgument):
        c.query(b.select(d=fn.vector_distance("rating", [1.0])).limit(1))
    with pytest.raises(InvalidArgument):
        c.query(b.select("summary_embedding").limit(1))


def test_semantic_and_hybrid(c):
    rows = c.query(b.select(x=fn.semantic_similarity("blurb", "quest of a hobbit"), y=fn.vector_distance("summary_embedding", [7.0] * 16)).sort(f("x") - f("y") * 0.001).limit(2))
    assert set(ids(rows)) == {"hobbit", "lotr"}


def test_fetch(c):
    rows = c.query(b.select(y=f("published_year")).sort(f("y")).limit(1).fetch(["title", "rating"]))
    assert rows == [{"_id": "harry", "y": 1997, "title": books.TITLES["harry"]}]


def test_expressions_are_values():
    assert (1 + f("a")).same(b.literal(1) + f("a"))
    with pytest.raises(TypeError):
        bool(f("a") == 1)


def test_writes(spark, tmp_path):
    e = Engine(spark, f"file://{tmp_path}")
    c = e.store.create("w", {"n": s.integer().required(), "t": s.text(), "m": s.struct({"a": s.text(), "b": s.integer()})})
    with pytest.raises(AlreadyExists):
        e.store.create("w")
    assert c.query(b.select("n").sort(f("zzz")).limit(1)) == []
    assert c.upsert([{"_id": "1", "n": 1, "t": "x", "m": {"a": "p", "b": 1}, "u": [1, "q"]}, {"_id": "2", "n": 2}]) == "1"
    assert c.upsert([{"_id": "2", "n": 3}]) == "2"
    assert c.get(["1", "2", "3"]) == {"1": {"_id": "1", "n": 1, "t": "x", "m": {"a": "p", "b": 1}, "u": [1, "q"]}, "2": {"_id": "2", "n": 3}}
    assert c.update([{"_id": "1", "t": None, "m": {"b": 2}, "v": 1}, {"_id": "9", "n": 1}]) == "3"
    assert c.get(["1"])["1"] == {"_id": "1", "n": 1, "m": {"a": "p", "b": 2}, "u": [1, "q"], "v": 1}
    assert c.update([{"_id": "9", "n": 1}]) == ""
    with pytest.raises(NotFound):
        c.update([{"_id": "9", "n": 1}], fail_on_missing=True)
    with pytest.raises(SchemaError):
        c.update([{"_id": "1", "n": None}])
    with pytest.raises(SchemaError) as err:
        c.upsert([{"_id": "a"}, {"_id": "b", "n": "x", "_r": 1}, {"n": 1}])
    assert len(err.value.problems) >= 4
    assert c.delete(["2", "5"]) == "4"
    assert c.delete(f("n") > 5) == "5"
    c.upsert([{"_id": "2", "n": 9}])
    assert c.count() == 2
    with pytest.raises(EngineError):
        c.delete(f("n") + 1)
    c.compact()
    c.upsert([{"_id": "2", "n": 10}])
    assert c.query(b.select("n").filter(f("n") > 5)) == [{"_id": "2", "n": 10}]
    with pytest.raises(InvalidArgument):
        c.query(b.select("n"), required_lsn="0")
    with pytest.raises(InvalidArgument):
        c.query(b.select("n"), required_lsn="99")
    p = c.partition("tenant-1")
    p.upsert([{"_id": "2", "n": 77}])
    assert c.partitions() == ["tenant-1"] and p.count() == 1 and c.get(["2"])["2"]["n"] == 10
    p.drop_partition()
    assert c.partitions("ten") == [] and c.count() == 2
    assert e.store.list() == ["w"]
    e.store.drop("w")
    with pytest.raises(NotFound):
        e.collection("w")


def test_frames_and_schema_errors(spark, tmp_path):
    e = Engine(spark, f"file://{tmp_path}")
    c = e.store.create("f", {"n": s.integer()})
    c.upsert_frame(spark.range(10).selectExpr("cast(id as string) _id", "id n", "id * 0.5 extra"), unique=True)
    assert c.query(b.select("n", "extra").filter(f("n").eq(3) & (f("extra") > 1)))[0]["n"] == 3
    for bad in ({"_x": s.text()}, {"v": s.vector(20_000)}, {"v": s.vector(4, "binary").indexed(s.vector_index("cosine"))}, {"t": s.integer().indexed(s.keyword_index())}, {"a.b": s.text(), "a": s.struct({})}):
        with pytest.raises(SchemaError):
            e.store.create("bad", bad)


def test_datasets(spark, tmp_path):
    d = Engine(spark, f"file://{tmp_path}").datasets
    d.create("d")
    d.upsert_file("d", "one", "Whales live in the sea.\n\n" + "filler words here " * 60, {"kind": "a"})
    d.upsert_file("d", "two", "Dragons live in caves.", {"kind": "b"})
    assert d.search("where do whales live", ["d"], 1)[0]["doc_id"] == "one"
    assert d.search("live", [("d", f("kind").eq("b"))], 5)[0]["doc_id"] == "two"
    for bad in (("x" * 513, 5), ("x", 0), ("x", 1001)):
        with pytest.raises(InvalidArgument):
            d.search(bad[0], ["d"], bad[1])
    assert d.list() == ["d"]
