"""Writers that overlap, repeated ids, regular expressions, widths of integers, and refused forms."""

import re

import pytest

from corvane.engine import Engine
from corvane.errors import EngineError, InvalidArgument
from corvane.es import search as es
from corvane.functions import text as text_functions
from corvane.plans import builder as b
from corvane.plans import schema as s
from corvane.plans.ir import Int
from corvane.plans.lower import Source, java_pattern, run
from corvane.sources.store import Collection

f = b.field


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    return Engine(spark, f"file://{tmp_path_factory.mktemp('safe')}").store


def meanwhile(monkeypatch, act):
    """Run ``act`` once, between a writer's snapshot and its commit."""
    plain, todo = Collection._commit, [act]

    def commit(self, rows, kind, **options):
        if kind in ("base", "delete", "update", "change") and todo:
            todo.pop()()
        return plain(self, rows, kind, **options)

    monkeypatch.setattr(Collection, "_commit", commit)


def test_compaction_keeps_what_is_written_meanwhile(store, monkeypatch):
    c, other = store.create("compacted", {"n": s.integer()}), store.collection("compacted")
    c.upsert([{"_id": "a", "n": 1}, {"_id": "b", "n": 1}])
    meanwhile(monkeypatch, lambda: (other.upsert([{"_id": "b", "n": 2}, {"_id": "c", "n": 2}]), other.delete(["a"])))
    c.compact()
    assert {i: d["n"] for i, d in c.get(["a", "b", "c"]).items()} == {"b": 2, "c": 2}
    c.compact()
    c.upsert([{"_id": "d", "n": 3}])
    assert {i: d["n"] for i, d in c.get(["a", "b", "c", "d"]).items()} == {"b": 2, "c": 2, "d": 3}


def test_delete_by_filter_reads_again(store, monkeypatch):
    c, other = store.create("filtered", {"n": s.integer()}), store.collection("filtered")
    c.upsert([{"_id": "a", "n": 1}, {"_id": "b", "n": 1}])
    meanwhile(monkeypatch, lambda: other.upsert([{"_id": "a", "n": 5}, {"_id": "c", "n": 1}]))
    c.delete(f("n") == 1)
    assert {i: d["n"] for i, d in c.get(["a", "b", "c"]).items()} == {"a": 5}


def test_update_and_bulk_read_again(store, monkeypatch):
    c, other = store.create("updated", {"n": s.integer(), "m": s.integer()}), store.collection("updated")
    c.upsert([{"_id": "a", "n": 1}])
    meanwhile(monkeypatch, lambda: other.update([{"_id": "a", "m": 7}]))
    c.update([{"_id": "a", "n": 2}])
    assert c.get(["a"])["a"] == {"_id": "a", "n": 2, "m": 7}
    before = c.lsn()
    meanwhile(monkeypatch, lambda: other.upsert([{"_id": "z", "n": 1}]))
    out = es.bulk(c, [{"index": {"_id": "x"}}, {"n": 1}, {"update": {"_id": "x"}}, {"doc": {"m": 2}}, {"delete": {"_id": "a"}}, {"index": {"_id": "y"}}, {"n": "no number"}, {"delete": {"_id": "z"}}])
    assert [next(iter(i.values())).get("result") for i in out["items"]] == ["created", "updated", "deleted", None, "deleted"]
    assert c.lsn() == before + 2 and c.get(["a", "x", "y", "z"]) == {"x": {"_id": "x", "n": 1, "m": 2}}
    assert es.get_document(c, "x")["found"] and es.delete_document(c, "x")["result"] == "deleted" and es.delete_document(c, "x")["result"] == "not_found"
    assert es.refresh(c)["_shards"]["failed"] == 0


def test_repeated_ids_need_an_order(spark, store):
    c = store.create("repeated", {"n": s.integer()})
    df = spark.createDataFrame([("a", 1, 3), ("a", 2, 1), ("b", 3, 1)], "_id string, n long, at long")
    with pytest.raises(InvalidArgument, match="repeats"):
        c.upsert_frame(df)
    c.upsert_frame(df, order="at")
    assert {i: d["n"] for i, d in c.get(["a", "b"]).items()} == {"a": 1, "b": 3}


@pytest.mark.parametrize(
    "pattern,flags,text,want",
    [
        (r"^\w+$", "", "naïve", True), (r"(?i)^é$", "", "É", True), (r"^é$", "i", "É", True), (r"\bé", "", "aé é", True), (r"\d", "", "٣", True), ("[*+]", "", "a+b", True), ("[-*+/]", "", "a/b", True), (r"C\++", "", "C++", True),
        (r"(?<y>\d+)-(?P<z_1>\d+)", "", "1-2", True), ("a$", "", "a\n", False), ("a$", "m", "a\nb", True), ("^b", "m", "a\nb", True), ("a.b", "", "a\nb", False), ("a.b", "s", "a\nb", True), ("a.b", "", "a\rb", True), ("^b", "m", "a\rb", False),
        ("^[[:alpha:]]+$", "", "abc", True), ("^[^[:digit:]]+$", "", "ab1", False), ("a b", "x", "ab", True), ("[]a]+$", "", "]a", True), (r"(?:ab)+?c", "", "ababc", True), ("x{2,3}", "", "xx", True), (r"\p{Lu}", "", "É", True), (r"a\z", "", "a", True),
    ],
)
def test_regular_expressions(spark, pattern, flags, text, want):
    df = spark.createDataFrame([("1", text)], "_id string, t string")
    assert run(Source(df), b.select(x=f("t").regexp_match(pattern, flags))).first()["x"] is want


@pytest.mark.parametrize("pattern", [r"(a)\1", "(?=a)", "(?!a)", "(?<=a)b", "(?<!a)b", "(?>a)", "a++", "a*+", "a?+", "a{2}+", r"\k<x>", "a\\", "(", "[[:nope:]]", "(?U)a"])
def test_refused_regular_expressions(spark, pattern):
    df = spark.createDataFrame([("1", "a")], "_id string, t string")
    with pytest.raises(InvalidArgument):
        run(Source(df), b.select(x=f("t").regexp_match(pattern, "")))


def test_unknown_flags():
    with pytest.raises(InvalidArgument):
        java_pattern("a", "g")


def test_integers_of_a_width_overflow(spark):
    df = spark.createDataFrame([("1", 1997)], "_id string, year long")
    top = Int(2**32 - 1, "u32")
    for e in (f("year") * Int(4_000_000, "u32"), f("year") + top, f("year") - top):
        with pytest.raises(Exception, match="overflow"):
            run(Source(df), b.select(x=e)).collect()
    assert run(Source(df), b.select(x=f("year") + Int(3, "u32"), y=f("year") + 2**40, z=f("year") * 4_000_000)).first()[1:] == (2000, 1997 + 2**40, 1997 * 4_000_000)
    wide = spark.createDataFrame([("1", 2**40)], "_id string, year long")  # wider than u32 itself
    assert run(Source(wide), b.select(x=f("year") + Int(3, "u32"))).first()["x"] == 2**40 + 3


def test_terms_are_tokens(spark):
    """A term's matches, and the length, are those of the tokens."""
    texts = ["The Ring, the rings; RING ring2 ring", "", None, "to be or not to be", "Öl und öl-Öle", "a_b a-b a.b", "x" * 50, "ring"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    field = text_functions.TokenField(df["t"])
    terms = ["ring", "rings", "ring2", "the", "öl", "a", "b", "x", "a-b", "", "Ring"]
    got = df.select(field.length(), text_functions.tokens(df["t"]), *[field.frequency(t) for t in terms], *[field.has(t) for t in terms]).collect()
    for r in got:
        toks = r[1]
        assert r[0] == (None if toks is None else len(toks))
        counts = [(toks or []).count(t) for t in terms]
        assert list(r[2 : 2 + len(terms)]) == counts and list(r[2 + len(terms) :]) == [c > 0 for c in counts]


@pytest.mark.parametrize("text", ["SELECT ARRAY[1 2] AS x FROM t", "SELECT CASE 1 END AS x FROM t", "SELECT CASE ELSE 1 END AS x FROM t"])
def test_incomplete_sql(spark, store, text):
    with pytest.raises(EngineError):
        Engine(spark, store.root).sql(text)


def test_rank_windows_are_bounded(store):
    c = store.create("ranked", {"v": s.vector(2).indexed(s.vector_index("cosine"))})
    c.upsert([{"_id": "a", "v": [1.0, 0.0]}])
    request = {"query": {"match_all": {}}, "knn": {"field": "v", "query_vector": [1.0, 0.0], "k": 1}, "rank": {"rrf": {"rank_window_size": 10**6}}}
    with pytest.raises(InvalidArgument, match="rank_window_size"):
        es.search(c, request)
    assert es.multi_search([(c, request)])["responses"][0]["status"] == 400


def test_faults_of_the_engine_are_not_answers(store, monkeypatch):
    c = store.collection("ranked")
    monkeypatch.setattr(es.Search, "run", lambda self: re.compile(None))
    with pytest.raises(TypeError):
        es.multi_search([(c, {"size": 1})])
