"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Texts are lower-cased, runs of other characters than letters become one boundary, and all 1- to 3-grams are hashed to
``2^bits`` features. A feature's value is its share of the text's n-grams times its inverse document frequency. The
frequencies cover all labelled documents; the weights are fitted by follow-the-regularised-leader (proximal, with
per-coordinate rates, L1 and L2) on a bounded sample; a temperature fitted on a part of the sample kept from
training calibrates the scores. As the features are shares, a document's scores are sums over its
positions, so prediction reads each text once and needs no counts by feature.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

UNKNOWN = "und"
_U = np.uint64
_SCALE = 50.0
#: Weights that are gathered at once.
_GATHER = 1 << 20
_KEYS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)  # odd multipliers


class NGrams:
    """Hashed character n-grams of a text."""

    def __init__(self, bits: int, orders: int = 3):
        self.bits, self.orders = bits, orders
        self._letter = np.array([chr(i).isalpha() for i in range(0x110000)])

    def features(self, text: str) -> np.ndarray:
        """A feature for each n-gram position; empty without a letter."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = self._letter[codes]
        if not letter.any():
            return np.empty(0, dtype=np.int64)
        codes = np.where(letter, codes, 0).astype(np.uint64)
        codes = codes[letter | np.concatenate([[True], letter[:-1]])]  # one boundary for each run of others
        edge = np.zeros(1, dtype=np.uint64)
        codes = np.concatenate([edge[: int(codes[0] != 0)], codes, edge[: int(codes[-1] != 0)]])
        out, h = [], np.zeros(len(codes), dtype=np.uint64)
        for n in range(self.orders):
            if len(codes) <= n:
                break
            h = h[: len(codes) - n] + codes[n:] * _KEYS[n]
            mixed = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9) + _U(n * 0x9E3779B97F4A7C15 % (1 << 64))
            mixed = (mixed ^ (mixed >> _U(32))) * _U(0x94D049BB133111EB)
            if n == 0:
                mixed = mixed[codes != 0]
            out.append((mixed >> _U(64 - self.bits)).astype(np.int64))
        return np.concatenate(out)


@dataclass
class Model:
    """Weights by feature and language, inverse document frequencies multiplied in."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    bits: int

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Calibrated probabilities; the weights of a long text are gathered in pieces of a bounded size."""
        total, step = np.zeros(len(self.languages)), max(64, _GATHER // len(self.languages))
        for at in range(0, len(features), step):
            total += self.weights[features[at : at + step]].sum(axis=0, dtype=np.float64)
        return _softmax((self.bias + total * (_SCALE / len(features))) / self.temperature)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Multinomial follow-the-regularised-leader with proximal steps and elastic-net penalties."""

    def __init__(self, features: int, classes: int, *, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((features, classes))
        self.n = np.zeros((features, classes))

    def weights(self, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def learn(self, rows: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(rows)
        error = _softmax(values @ w)
        error[label] -= 1
        g = values[:, None] * error
        n = self.n[rows]
        self.z[rows] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[rows] = n + g * g


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least cross-entropy, by golden-section search over its logarithm.

    It is 1/2 at least: a fold without errors would ask for ever sharper scores.
    """
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        p = _softmax(logits / math.exp(t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    lo, hi, g = math.log(0.5), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return math.exp((lo + hi) / 2)


def _df_rows(bits: int):
    """Texts by feature, and as feature -1 all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, df, texts = NGrams(bits), np.zeros(1 << bits, dtype=np.int64), 0
        for batch in batches:
            texts += batch.num_rows
            for text in common.texts_of(batch.column(0)):
                seen = np.zeros(1 << bits, dtype=bool)
                seen[grams.features(text)] = True
                df += seen
        at = np.flatnonzero(df)
        yield pa.record_batch([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(df[at], texts))], ["feature", "n"])

    return run


def _sample_rows(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = NGrams(bits)
        for batch in batches:
            rows, counts = [], []
            for text in common.texts_of(batch.column(2)):
                at, n = np.unique(grams.features(text), return_counts=True)
                rows.append(at.astype("<i4").tobytes())
                counts.append(n.astype("<i4").tobytes())
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(rows, pa.binary()), pa.array(counts, pa.binary())], ["h", "lang", "features", "counts"])

    return run


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that are never learned from: crc32 of the id as text is 2 modulo 4. Without an id: false."""
    return F.coalesce(common.crc_mod(doc_id, 4) == 2, F.lit(False))


def train(spark: SparkSession, docs: DataFrame, *, bits: int = 16, sample_per_language: int = 1000, sample: int = 20_000, epochs: int = 3) -> Model | None:
    """Fit on documents (doc_id, text, lang) with an id and a language that aren't held out; None if there are none.

    Document frequencies are counted over all of them, and every value of lang is learned. Weights and temperature come
    from a bounded sample: of each language the ``sample_per_language`` distinct texts with the least hashes, or an equal part
    of ``sample`` in all if that is less (one text at least). A text with several languages counts for the least of them.
    The driver holds the sample and two tables of ``2^bits`` by languages. Extra columns are ignored.
    """
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out())
    df, total = np.zeros(1 << bits, dtype=np.int64), 0
    got = common.arrow_map(rows.select("text"), _df_rows(bits), "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()  # 2^bits + 1 rows at most
    for feature, n in zip(got.column("feature").to_numpy(), got.column("n").to_numpy(), strict=True):
        if feature < 0:
            total = int(n)
        else:
            df[feature] = n
    if not total:
        return None
    idf = np.log((1 + total) / (1 + df)) + 1

    # distinct texts by hash; a share of each language's, then the least hashes up to the bound
    distinct, path = common.stored(spark, rows.groupBy(F.xxhash64("text").alias("h")).agg(F.min("lang").alias("lang")), "labelled")
    by = {r["lang"]: r["n"] for r in distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each language
    languages, place = sorted(by), F.pmod("h", F.lit(1 << 40))
    each = max(1, min(sample_per_language, sample // len(languages)))
    shares = spark.createDataFrame([(x, min(1.0, 1.5 * each / n + 8 * math.sqrt(each) / n) * (1 << 40)) for x, n in by.items()], "lang string, share double")
    near = distinct.join(F.broadcast(shares), "lang").filter(place < F.col("share")).toArrow()  # about 1.5 times the sample
    taken: dict[str, list[int]] = {}
    for h, lang in sorted(zip(near.column("h").to_pylist(), near.column("lang").to_pylist(), strict=True), key=lambda x: (x[0] % (1 << 40), x[0])):
        if len(taken.setdefault(lang, [])) < each:
            taken[lang].append(h)
    chosen = spark.createDataFrame(pa.table({"h": pa.array([h for x in languages for h in taken.get(x, ())], pa.int64()), "label": pa.array([x for x in languages for _ in taken.get(x, ())], pa.string())}))
    texts = rows.select(F.xxhash64("text").alias("h"), "text").join(F.broadcast(chosen), "h").groupBy("h").agg(F.first("label").alias("lang"), F.first("text").alias("text"))
    picked = common.arrow_map(texts.select("h", "lang", "text"), _sample_rows(bits), "h long, lang string, features binary, counts binary").toArrow()
    common.remove(spark, path)
    hashes, labels = picked.column("h").to_numpy(), picked.column("lang").to_pylist()
    numbers = {x: i for i, x in enumerate(languages)}
    examples = []
    for i in np.argsort(hashes, kind="stable").tolist():
        at, n = (np.frombuffer(picked.column(c)[i].as_buffer(), dtype="<i4") for c in ("features", "counts"))
        values = (n / n.sum() * idf[at] * _SCALE).astype(np.float32)
        examples.append((np.append(at, np.int32(1 << bits)), np.append(values, np.float32(1)), numbers[labels[i]], int(hashes[i]) % 5 == 0))
    del picked, hashes, labels
    learner = Ftrl((1 << bits) + 1, len(languages))
    chooser = np.random.default_rng(7)
    fit = [x for x in examples if not x[3]] or examples
    for _ in range(epochs):
        for i in chooser.permutation(len(fit)):
            learner.learn(*fit[i][:3])
    w = learner.weights()
    apart = [x for x in examples if x[3]]
    logits = np.array([v @ w[at] for at, v, _, _ in apart]).reshape(len(apart), len(languages))
    temperature = fit_temperature(logits, np.array([x[2] for x in apart], dtype=np.int64))
    out = Model(languages, (w[:-1] * idf[:, None]).astype(np.float32), w[-1].copy(), temperature, bits)
    del examples, fit, apart, learner, w
    common.trim()
    return out


_grams: dict[int, NGrams] = {}


def _predicted(model, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model | None = model.value
        for batch in batches:
            names, scores = [], []
            for text in batch.column(text_at).to_pylist():
                f = ()
                if m is not None and text:
                    if m.bits not in _grams:
                        _grams[m.bits] = NGrams(m.bits)
                    f = _grams[m.bits].features(text)
                if len(f):
                    p = m.scores(f)
                    best = int(p.argmax())
                    names.append(m.languages[best])
                    scores.append(min(1.0, float(p[best])))
                else:
                    names.append(UNKNOWN)
                    scores.append(0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names, "lang_pred", "score"])

    return run


def predict(spark: SparkSession, docs: DataFrame, model: Model | None, *, text: str = "text", into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns and the language with its calibrated probability.

    Null texts and texts without a letter: ``und`` with score 0, as are all if there was nothing to learn from. Whole
    texts are read; no other column is. A column that has one of the names ``into`` is an error. Empty table: no rows.
    """
    if {x.lower() for x in into} & {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column of {into} already")
    sent = spark.sparkContext.broadcast(model)  # 2^bits features times the languages
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.withColumn(*common.hidden(docs, "lid_text"), F.col(text).cast("string")).toDF(*names, "t")
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    out = common.arrow_map(rows, _predicted(sent, len(names)), schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)], F.col("lang_pred").alias(into[0]), F.col("score").alias(into[1]))


def identify(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """A row per document: doc_id, held_out, lang_pred, score.

    Null doc_id: predicted, not learned from, not held out. Null lang: not learned from. Null text or one without a letter:
    ``und``, score 0. Repeated rows: a row each, all alike. Very long texts: read whole, in one worker. Ties between
    languages go to the first by name. Empty table: no rows. Other columns are ignored, whatever their names.
    """
    model = train(spark, docs, **options)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return predict(spark, rows, model).select("doc_id", "held_out", "lang_pred", "score")


def known_language(spark: SparkSession, docs: DataFrame, *, min_score: float = 0.5, **options) -> DataFrame:
    """The documents whose language is one of those learned, with all their columns; ``und`` and scores under ``min_score`` go.

    So a null text or one without a letter goes, and everything if nothing could be learned. Repeated rows stay or go together;
    nulls in other columns, names that clash and very long texts don't matter. Empty table: no rows.
    """
    name, score = common.hidden(docs, "lang_pred", "lang_score")
    found = predict(spark, docs, train(spark, docs, **options), into=(name, score))
    return found.filter((F.col(name) != UNKNOWN) & (F.col(score) >= min_score)).select(*[f"`{c}`" for c in docs.columns])
