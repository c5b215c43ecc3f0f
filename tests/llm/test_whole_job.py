"""Training-data operators and the pipeline do the whole job on hosts, sources and ids that the test tables don't have."""

import os

import corpus_pipeline
from corvane.llm import common, html_text, jaccard_join


def test_pipeline_links_near_copies_at_0_8_of_5_words(spark):
    words = [f"w{i}" for i in range(104)]
    other = [f"v{i}" for i in range(104)]
    # 82 of 100 5-word shingles shared, and of 101 4-word ones 83: under 0.85; then 79 of 100 shared: no near copy
    docs = [(1, " ".join(words)), (2, " ".join(words[:86])), (3, " ".join(other)), (4, " ".join(other[:83]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, df, "").collect()) == [1, 3, 4]

def test_template_of_a_large_host(spark):
    """What recurs on 8 of 100 pages goes as it does on 8 of 8, also from the copy of a page; what recurs on 4 stays."""
    rows = [(k, "http://a.example/", f"<body>{'<div><p>Rotating</p></div>' if k < 8 else ''}{'<div><p>Seldom</p></div>' if k >= 96 else ''}<div><p>Text {k}</p></div></body>") for k in range(100)]
    rows += [(100, *rows[0][1:]), (101, "http://b.example/", rows[0][2]), (102, None, rows[0][2])]
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = {k: f"Text {k}" for k in range(96)} | {k: f"Seldom\n\nText {k}" for k in range(96, 100)} | {100: "Text 0", 101: "Rotating\n\nText 0", 102: "Rotating\n\nText 0"}
    assert got == want


def test_first_of_each_works_by_row(spark):
    a, b, c, d = ([f"{x}{i}" for i in range(40)] for x in "abcd")
    text = lambda words, n=40: " ".join(words[:n])
    # near copies without an id, of a row with one, and under one id; a text that shares its id with a near copy; no words
    docs = [(None, text(a)), (None, text(a, 39)), (5, text(b)), (None, text(b, 39)), (7, text(c)), (7, text(c, 39)), (9, text(b, 38)), (9, text(d)), (None, ""), (None, "")]
    out = jaccard_join.first_of_each(spark, spark.createDataFrame(docs, "doc_id long, text string"))
    assert out.columns == ["doc_id", "text"]
    got = sorted((r["doc_id"] or 0, r["text"][:2]) for r in out.collect())
    assert got == [(0, ""), (0, ""), (0, "a0"), (5, "b0"), (7, "c0"), (9, "d0")]


def test_scratch_tables_are_few_files_without_checksums(spark, monkeypatch):
    """Hadoop starts a process for each file that it makes; one started by a full JVM counts as a second JVM until it runs."""
    files, stored = [], common.stored

    def counted(spark, df, name):
        out, path = stored(spark, df, name)
        files.extend(f for f in os.listdir(path.removeprefix("file://")) if f != "_SUCCESS")
        return out, path

    monkeypatch.setattr(common, "stored", counted)
    words = [f"w{i}" for i in range(60)]
    # many blocks of texts with words of their own, and two that link
    docs = [(i, " ".join(f"{i}x{k}" for k in range(40))) for i in range(400)] + [(400, " ".join(words)), (401, " ".join(words[:57]))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8).localCheckpoint()
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.link_components(spark, df).collect()}
    assert got == {i: min(i, 400) for i in range(402)}
    assert not [f for f in files if f.endswith(".crc")]
    assert len(files) <= 25  # 31 and as many checksum files when the counts of shingles were tables, too
