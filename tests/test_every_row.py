"""Registered queries return all rows that their SQL does, at sizes beyond the test tables."""

from corvane import queries


def test_sort_drops_null_keys_has_no_cap(spark, tmp_path):
    n = 1_000_003
    rows = spark.range(n + 2).selectExpr("id event_id", f"if(id < {n}, 'purchase', 'view') event_type", "cast(id as double) value")
    rows.write.parquet(f"{tmp_path}/events.parquet")
    out = queries.queries()["sort_drops_null_keys"](spark, str(tmp_path))
    assert out.selectExpr("count(*)", "min(v)", "max(v)").first()[:] == (n, 0.0, n - 1.0)
    assert [r["v"] for r in out.take(3)] == [n - 1.0, n - 2.0, n - 3.0]


def test_bm25_has_no_cap(spark):
    out = queries.queries()["bm25"](spark, "/root/testdata/sf0.001")
    assert "Limit" not in out._jdf.queryExecution().analyzed().toString()
