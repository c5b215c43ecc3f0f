"""Very long texts, empty tables, nulls in every column, repeated rows and clashing names, for every operator and stage."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corvane.llm import bpe_lexicon, common, html_text, jaccard_join, language_id, packing, piece_cache, queries, radix_dedup, rule_ledger, secret_scan, sstable, token_counts

from . import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("spans", "n", "h", "t", "node", "row", "label", "rid", "sha", "gram", "kept", "keep_id", "text_sha256", "payload", "lang_pred", "queue", "__row", "__dropped", "c0", "suspect", "n_tokens", "score")


@pytest.fixture(scope="module")
def long_texts():
    """10 MB each: alike but for the last word, and with a secret in the middle."""
    rng = random.Random(1)
    words = [f"{rng.choice('abcdefgh')}{rng.choice(['ing', 'tion', 'le', 'ment'])}{i % 977}" for i in range(1_150_000)]
    words[600_000] = "password=hunter22222"
    text = " ".join(words)
    assert len(text) > 9_000_000
    return [text + " end", text + " fin"]


@pytest.fixture(scope="module")
def long_docs(spark, long_texts):
    out, _ = common.stored(spark, spark.createDataFrame([(7, long_texts[0], "en", "a", 1), (9, long_texts[1], "en", "a", 1), (11, "a short one", "en", "b", 1)], SCHEMA), "test-long")
    return out


def test_long_texts(spark, long_docs, long_texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(piece_cache.tokenizer_path("byte_bpe_50k.json"))
    ids = {i: tok.encode(t, add_special_tokens=False).ids for i, t in zip((7, 9), long_texts, strict=True)}
    got = {r["doc_id"]: r for r in bpe_lexicon.round_trip(spark, long_docs).collect()}
    assert all(got[i]["n_tokens"] == len(x) and got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for i, x in ids.items())
    got = {r["doc_id"]: r for r in sstable.token_tables(spark, long_docs).collect()}
    import numpy as np

    assert all(got[i]["ids_crc32"] == zlib.crc32(np.array([*x, 2], dtype="<u4").tobytes()) for i, x in ids.items())
    got = {r["doc_id"]: r for r in packing.pack(spark, long_docs).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("d")).collect()}
    assert all(r["n"] == r["d"] for r in got.values()) and got[7]["n"] > 2_000_000
    got = {r["doc_id"]: r for r in jaccard_join.link_components(spark, long_docs).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == {7: 7, 9: 7, 11: 11}
    assert got[7]["n_shingles"] == len(brute.shingles(long_texts[0]))
    got = {r["doc_id"]: r for r in radix_dedup.radix_groups(spark, long_docs).collect()}
    assert all(got[i]["kept"] and got[i]["text_sha256"] == hashlib.sha256(t.encode()).hexdigest() for i, t in zip((7, 9), long_texts, strict=True))
    got = {r["doc_id"]: r for r in secret_scan.secrets(spark, long_docs).collect()}
    at = long_texts[0].index("password=")
    assert f"assign:{at}:{at + 20}" in got[7]["spans"]
    redacted = {r["doc_id"]: r["text"] for r in secret_scan.redact(long_docs).collect()}
    assert len(redacted[7]) == len(long_texts[0]) - 20 + len("[secret]")
    assert {r["doc_id"]: r["n_words"] for r in rule_ledger.quality(long_docs).select("doc_id", "n_words").collect()} == {7: 1_150_001, 9: 1_150_001, 11: 3}
    assert {r["lang_pred"] for r in language_id.identify(spark, long_docs).collect()} == {"en"}
    counts = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(long_docs).collect()}
    assert abs(counts[7] - counts[9]) < 10 and counts[7] > 2_000_000
    page = spark.createDataFrame([(1, "http://h.example/", "<p>" + long_texts[0] + "</p>")], "page_id long, url string, html string")
    assert html_text.extract(spark, page).first()["n_chars"] == len(long_texts[0])


def nulls(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "en", None, 0), (2, "the cat sat on the mat and saw", "en", "s", 9), (2, "the cat sat on the mat and saw", "en", "s", 9), (3, "le chat est sur le tapis", None, "s", 1), (None, "the cat", "en", "s", 1)]
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(None).cast("int") for c in CLASHES})


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_awkward_tables(spark, name, stage):
    docs, _ = common.stored(spark, nulls(spark), "test-nulls")
    out = stage(spark, docs, "").collect()
    empty = stage(spark, docs.filter("false"), "")
    assert empty.count() == 0
    if name != "packing":
        assert empty.columns == docs.columns and empty.schema.simpleString() == docs.schema.simpleString()
    ids = sorted((r["doc_id"] or 0, r["text"] or "") if name != "packing" else (r["doc_id"] or 0, "") for r in out)
    cat, chat = "the cat sat on the mat and saw", "le chat est sur le tapis"
    want = {
        "language_id": [(0, "the cat"), (2, cat), (2, cat), (3, chat)],
        "exact_dedup": [(0, "the cat"), (1, ""), (2, cat), (3, chat)],
        "jaccard_join": [(0, ""), (0, ""), (0, "the cat"), (1, ""), (2, cat), (3, chat)],
        "secret_scan": [(0, ""), (0, ""), (0, "the cat"), (1, ""), (2, cat), (2, cat), (3, chat)],
        "packing": [(0, ""), (0, ""), (0, ""), (1, ""), (2, ""), (2, ""), (3, "")],
    }
    assert ids == want[name]
    if name == "secret_scan":
        assert sum(r["text"] is None for r in out) == 2


def test_queries_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    for name, query in [*queries.queries().items(), ("pipeline", corpus_pipeline.run)]:
        assert query(spark, str(tmp_path)).count() == 0, name


def test_a_hot_group_that_shares_shingles_without_linking(spark):
    """500 texts of one passage and words of their own: rare shingles shared by all, no links but the planted ones."""
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(100)]
    docs = [(i, " ".join(passage[: 100 - i % 7] + [word() for _ in range(20 + i % 11)])) for i in range(500)]
    docs += [(1000 + i, docs[i][1] + " " + word()) for i in range(0, 500, 25)]
    base = [word() for _ in range(80)]
    for i in range(200):  # near copies that drift from one another
        t = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 6])):
            t[rng.randrange(80)] = rng.choice(passage)
        docs.append((2000 + i, " ".join(t)))
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.link_components(spark, spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == brute.components(docs)


def test_a_shared_folder_is_needed_on_a_cluster(spark):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_base(Session())
    Context.master = "local[4]"
    assert common.shared_base(Session()) == common.shared_base(Session())
