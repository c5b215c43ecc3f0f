"""The pipeline stage by stage against plain versions."""

import re

import corpus_pipeline
from corvane.llm import common, piece_cache, secret_scan

from . import brute

SF = "/root/testdata/sf0.001"
SCANNER = secret_scan.Scanner(piece_cache.tokenizer_path("byte_bpe_50k.tiktoken"), 2.0)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.filter("lang = 'en' and n_chars > 500").orderBy("doc_id").first()
    secret = " ".join(reversed(first["text"].split())) + " password = hunter22222"
    docs = docs.unionByName(spark.createDataFrame([(10**6, secret, "en", "src0", len(secret))], docs.schema))
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()} if "text" in docs.columns else {}
        docs, _ = common.stored(spark, stage(spark, docs, SF), "test")
        after = {r["doc_id"]: r["text"] for r in docs.collect()} if "text" in docs.columns else {}
        seen[name] = (before, after)
        if name != "packing":
            assert docs.columns == columns
    before, after = seen["language_id"]
    assert set(after) == {i for i, t in before.items() if re.search(r"[^\W\d_]", t or "")}
    before, after = seen["exact_dedup"]
    assert set(after) == {max(i for i, x in before.items() if x == t) for t in set(before.values())}
    before, after = seen["jaccard_join"]
    assert set(after) == {i for i, root in brute.components(list(before.items())).items() if i == root}
    before, after = seen["secret_scan"]
    assert set(before) == set(after) and after[10**6].endswith(" [secret]")
    assert {i for i in after if after[i] != before[i]} == {i for i, t in before.items() if SCANNER.scan(t)}
    assert {r["doc_id"] for r in docs.collect()} == set(after)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).select("doc_id").distinct().count() > 100
    assert len(corpus_pipeline.STAGES) == 5
