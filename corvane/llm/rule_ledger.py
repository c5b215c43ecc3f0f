"""Quality rules as a bitmask ledger, in DataFrame functions only.

Each rule is evaluated once for each document; the ledger holds the measurements and one integer with a bit for each
failed rule. A policy is a named, versioned set of rules, that is a mask: documents pass if ``fail_bits & mask = 0``.
Other policies, and what each rule takes away on its own, come from the ledger by bit operations, without
the texts being read again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements."""

    name: str
    fails: str


#: In the order of their bits; a rule keeps its bit for good, new ones go to the end.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("few_alphabetic", "100 * n_alpha_words < 60 * n_words"),
)

#: Name and version to the rules that reject.
POLICIES = {
    "base@1": ("few_words", "repeated_windows"),
    "standard@1": ("few_words", "repeated_windows", "word_length", "symbols", "duplicate_lines", "few_alphabetic"),
    "lenient@1": ("few_words", "repeated_windows", "symbols"),
}
PRODUCTION = "standard@1"


def mask_of(policy: str) -> int:
    names = [r.name for r in RULES]
    return sum(1 << names.index(x) for x in POLICIES[policy])


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    The windows' 64-bit hashes are made distinct first, which most documents end with. Otherwise (hash, position) pairs
    are sorted, positions whose hash equals a neighbour's are kept, and each covers its 3 words up to the next one.
    """
    n = F.size(words)
    windows = F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)))
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # pairs is used several times: bind it once by a one-element transform
    bound = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))
    repeated = lambda s: F.array_sort(F.filter(F.transform(s, lambda p, i: F.when((F.get(s, i + 1)["h"] == p["h"]) | (F.get(s, i - 1)["h"] == p["h"]), p["i"])), lambda x: x.isNotNull()))
    covered = lambda p: F.aggregate(p, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")), lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")), lambda acc: acc["n"])
    slow = bound(pairs, lambda s: covered(repeated(s)))
    return F.when(n < 4, F.lit(0)).when(F.size(F.array_distinct(windows)) == n - 2, F.lit(0)).otherwise(slow)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` with the measurements; a column that is called like one is an error.

    Null or empty text: all measurements 0. Repeated rows and nulls elsewhere: measured row by row. Very long texts: whole, in
    the JVM, with an array of their words. Empty table: no rows.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_alpha_words")
    body, parts, words, lines = common.hidden(docs, "body", "parts", "words", "lines")
    df = docs.withColumn(body, F.coalesce(F.col(text).cast("string"), F.lit("")))
    others = docs.columns
    if clash := [c for c in others if c.lower() in names]:
        raise ValueError(f"there are columns {clash} already")
    df = df.select(*[F.col(f"`{c}`") for c in others], body, F.split(body, r"[ \t-\r]", -1).alias(parts))
    df = df.withColumn(words, F.array_remove(F.col(parts), ""))
    df = df.withColumn(lines, F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^ \t-\r]")))
    long = lambda c, name: c.cast("long").alias(name)
    return df.select(
        *[F.col(f"`{c}`") for c in others],
        long(F.size(words), "n_words"),
        long(F.length(body) - (F.size(parts) - 1), "word_chars"),
        long(F.regexp_count(F.col(body), F.lit(r"[#*$%&|<>]")), "n_symbols"),
        long(F.size(lines), "n_lines"),
        long(F.size(lines) - F.size(F.array_distinct(lines)), "n_dup_lines"),
        long(_repeat_words(F.col(words)), "n_repeat_words"),
        long(F.regexp_count(F.col(body), F.lit(r"[^ \t-\r]*\p{L}[^ \t-\r]*")), "n_alpha_words"),
    )


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with their measurements and ``fail_bits``; a column that is called so is an error. Awkward rows: as ``measure`` states."""
    if "fail_bits" in (c.lower() for c in docs.columns):
        raise ValueError("there is a column fail_bits already")
    df = measure(docs, text)
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return df.withColumn("fail_bits", bits)


def passes(policy: str = PRODUCTION) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask_of(policy))) == 0


def ablations(rows: DataFrame) -> DataFrame:
    """For each policy and rule of it: documents, kept, failed by the rule, and failed by it alone (kept without it).

    ``rows`` is a ledger. It is counted by fail_bits first (at most 2^rules rows), all else works on these counts.
    """
    counts = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    names = [r.name for r in RULES]
    spec = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(x).alias("rule"), F.lit(mask_of(p)).cast("long").alias("mask"), F.lit(1 << names.index(x)).cast("long").alias("bit")) for p in POLICIES for x in POLICIES[p]])
    each = counts.select("fail_bits", "n", F.explode(spec).alias("s")).select("fail_bits", "n", "s.*")
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    total = lambda when, name: F.sum(F.when(when, F.col("n")).otherwise(F.lit(0))).cast("long").alias(name)
    return each.groupBy("policy", "rule").agg(F.sum("n").alias("n_docs"), total(hit == 0, "n_kept"), total(hit.bitwiseAND(F.col("bit")) != 0, "n_failed"), total(hit == F.col("bit"), "n_failed_alone"))


def quality(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, fail_bits, n_lines, n_alpha_words.

    Null or empty text: no words, fails few_words. Null doc_id and repeated rows: measured row by row. Empty table: no rows.
    Ties don't
    arise. Very long texts: measured whole. Other columns are ignored, whatever their names.
    """
    df = ledger(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    base = F.col("fail_bits").bitwiseAND(F.lit(mask_of("base@1"))) != 0
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), passes().alias("kept"), "fail_bits", "n_lines", "n_alpha_words")


SQL = r"""
WITH p AS (SELECT doc_id, coalesce(text, '') AS t, regexp_split_to_array(coalesce(text, ''), '[ \t-\r]') AS parts FROM documents),
w AS (SELECT doc_id, t, len(t) - (len(parts) - 1) AS word_chars, list_filter(parts, lambda x: x <> '') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS lines FROM p),
g AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM g) WHERE c > 1),
r AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM d, (VALUES (0), (1), (2)) AS v(o) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(words) AS n_words, word_chars, len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
             len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) AS n_alpha_words FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
             + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 4 ELSE 0 END + CASE WHEN 10 * n_symbols > 3 * n_words THEN 8 ELSE 0 END
             + CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 16 ELSE 0 END + CASE WHEN 100 * n_alpha_words < 60 * n_words THEN 32 ELSE 0 END AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits::BIGINT AS fail_bits, n_lines, n_alpha_words FROM b
"""
