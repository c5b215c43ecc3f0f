"""Exact dedup by distributed most-significant-byte-first radix partitioning.

All documents start as one group. Each round splits every open group by the next bytes of its texts: 64 bytes in the
first round, then 16 times as many each time. A group of one is done; a group whose chunk is shorter than the
round's width has ended, so its texts are equal byte by byte; all others go on to the next round. No digest
decides equality. The number of rounds is the logarithm of the longest text that has a near twin, and
from the second round on only documents that share all bytes so far are read.

A round is an aggregate over (group, chunk), combined before the shuffle, so a hot group costs a row per task;
the groups of two and more are written out, and joined back to the documents. That is a sort-merge join at every
size, so the plan doesn't change with the number of groups; both its sides are plain shuffles, which adaptive
execution splits if a group is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

FIRST_WIDTH, GROWTH, MAX_WIDTH = 64, 16, 1 << 20


def radix_groups(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", payload: list[str] | None = None, keep_text: bool = False) -> DataFrame:
    """A row per document: doc_id, text (if ``keep_text``), payload (struct of the named columns), keep_id, group_size, kept, text_sha256.

    Texts are equal when identical. Of equal texts the row with the largest doc_id stays; of rows that also share
    that doc_id (or have none: null is lowest) exactly one stays. A null text counts as empty. An empty table gives no rows.
    Very long texts: read in chunks of up to 1 MB a round. Columns that aren't named in ``payload`` are ignored; those named keep clear of the results inside their struct.
    """
    raw = F.col(text_col).cast("string")
    extra = F.struct(*[F.col(f"`{c}`") for c in payload]) if payload else F.lit(None).cast("struct<none:int>")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), raw.alias("text"), extra.alias("payload"))
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sha = F.sha2(body, 256)
    chunk = lambda at, width: F.substring(body, at + 1, width)  # noqa: E731  on binary: bytes

    # the first round: prefixes that several documents share
    at, width = 0, FIRST_WIDTH
    shared = rows.select(chunk(0, width).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups, _ = common.stored(spark, shared.select("k", F.monotonically_increasing_id().alias("gid")), "radix-groups")
    joined = rows.withColumn("k", chunk(0, width)).join(groups.hint("merge"), "k", "left")
    done_text = F.col("text") if keep_text else F.lit(None).cast("string")
    first = joined.select(
        "doc_id", "payload", "gid", F.when(F.col("gid").isNull(), done_text).otherwise(F.col("text")).alias("text"),
        F.when(F.col("gid").isNull(), sha).alias("text_sha256"), F.monotonically_increasing_id().alias("uid"),
    )
    table, _ = common.stored(spark, first, "radix-rows")
    outputs = ["doc_id", *(["text"] if keep_text else []), "payload", "keep_id", "group_size", "kept", "text_sha256"]
    alone = (F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    named = lambda df, *more: df.select(*[c for c in df.columns if c not in ("keep_id", "group_size", "kept")], *more).select(outputs)
    results = [named(table.filter("gid is null"), *alone)]
    active = table.filter("gid is not null")
    at += width

    while True:
        width = min(width * GROWTH, MAX_WIDTH)
        k, ended = chunk(at, width), F.length(F.col("k")) < width
        found = active.select("gid", k.alias("k"), "doc_id", "uid").groupBy("gid", "k").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "uid")).alias("top")).filter("n > 1")
        groups, _ = common.stored(spark, found.select("gid", "k", "n", "top", F.monotonically_increasing_id().alias("next")), "radix-groups")
        split = active.withColumn("k", k).join(groups.hint("merge"), ["gid", "k"], "left")
        single = F.col("next").isNull()
        over = single | ended
        out = split.select(
            "doc_id", "payload", "uid", F.when(~over, F.col("next")).alias("gid"), F.when(over, done_text).otherwise(F.col("text")).alias("text"),
            F.when(over, sha).alias("text_sha256"), F.when(single, F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("keep_id"),
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), (single | (F.col("uid") == F.col("top.uid"))).alias("kept"),
        )
        go_on = groups.filter(~ended).limit(1).count() > 0
        table, _ = common.stored(spark, out, "radix-rows")
        results.append(table.filter("gid is null").select(outputs))
        if not go_on:
            break
        active = table.filter("gid is not null").select("doc_id", "payload", "gid", "text", "text_sha256", "uid")
        at += width

    whole = results[0]
    for more in results[1:]:
        whole = whole.unionByName(more)
    return whole


def dedup(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, one row of each group of equal texts, with all their columns.

    The row with the largest id stays, one without an id only if no row of the group has one; of rows with that id exactly one.
    A null text equals an empty one; the row that stays keeps its own. Very long texts: compared whole, chunk by chunk, only
    where they share all bytes so far. Empty table: no rows. Columns of any name pass through.
    """
    rest = [c for c in docs.columns if c != text_col]
    kept = radix_groups(spark, docs, id_col=id_col, text_col=text_col, payload=rest, keep_text=True).filter("kept")
    return kept.select(*[F.col("text").cast(docs.schema[c].dataType).alias(c) if c == text_col else F.col("payload").getField(c).alias(c) for c in docs.columns])


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
