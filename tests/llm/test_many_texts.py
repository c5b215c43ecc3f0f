"""Encoding of many texts at once: the library's ids, and each word of a batch looked up once."""

import array
import random
import zlib

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from corvane.llm import common, packing, piece_cache

NAMES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
PARTS = [
    *"abAB1²é", "the", " the", "Anblewh", "ßöä", "don't", "'s", " ", " ", " ", " ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "\r\n", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", " ", "​", "　", "﻿",
    ".", ",", "!!", '."', ")]}", "###", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "é", "́", "İ", "K", "漢字", "🙂", "؀", "x" * 60, "1234567",
]


def library(name):
    tok = Tokenizer.from_file(piece_cache.tokenizer_path(name))
    return lambda text: array.array("I", tok.encode(text or "", add_special_tokens=False).ids).tobytes()


@pytest.mark.parametrize("name", NAMES)
def test_many_texts_are_the_library(name):
    enc, one, rng = piece_cache.PieceEncoder(piece_cache.tokenizer_path(name), limit=300), library(name), random.Random(5)
    fixed = [None, "", " ", "  ", "\n", " a", "a ", "a  b", "a \nb", "a\n b", "a\nb", "a\n\nb", "a\n\n", "\na", " \na", "a.\nB.", "\n<|endoftext|>", "a\n\n<|endoftext|>b", "a\n1", "a\n²"]
    texts = fixed + ["".join(rng.choices(PARTS, k=rng.randrange(1, 12))) for _ in range(3000)]
    texts += [" ".join(rng.choices(PARTS[:12] + ["a.\nB", "c\nd,\ne"], k=40)) for _ in range(300)]
    rng.shuffle(texts)
    for kind in (pa.string(), pa.large_string()):
        assert enc.encode_many(pa.array(texts, kind)) == [one(t) for t in texts]
        assert enc.encode_many(pa.array(texts, kind).slice(7, 500)) == [one(t) for t in texts[7:507]]
    assert enc.encode_many(pa.array([], pa.string())) == [] and enc.encode_many(pa.array([None], pa.string())) == [b""]


@pytest.mark.parametrize("name", NAMES)
def test_long_texts_stand_alone(name, monkeypatch):
    enc, one = piece_cache.PieceEncoder(piece_cache.tokenizer_path(name)), library(name)
    monkeypatch.setattr(piece_cache, "_MOST_BYTES", 50)
    texts = ["the cat, the dog.\nA cat. " * 20, None, "a  b"]
    assert enc.encode_many(pa.array(texts)) == [one(t) for t in texts]


@pytest.mark.parametrize("name", NAMES)
def test_a_word_of_a_batch_is_looked_up_once(name, monkeypatch):
    """Else every occurrence is a string of Python's and a look into a large memo, which was most of the operators' time."""
    asked = []
    many = piece_cache._Memo.many
    monkeypatch.setattr(piece_cache._Memo, "many", lambda self, pieces: asked.extend(pieces) or many(self, pieces))
    enc = piece_cache.PieceEncoder(piece_cache.tokenizer_path(name))
    split, cut = enc._split, []
    enc._split = lambda text: cut.append(text) or split(text)
    texts = ["the cat sat, the dog sat.\nThe cat sat; the dog sat!"] * 1000
    assert enc.encode_many(pa.array(texts)) == [library(name)(texts[0])] * 1000
    assert len(asked) < 25 and sum(map(len, cut)) <= 3 * len(texts)


def test_short_batches_are_gathered_in_order():
    batches = [pa.record_batch([pa.array([f"{i}" * 100])], ["text"]) for i in range(10)]
    got = list(common.gathered(iter(batches), 350))
    assert pa.Table.from_batches(got) == pa.Table.from_batches(batches) and 1 < len(got) < 6
    assert list(common.gathered(iter([]))) == []
    big = pa.record_batch([pa.array(["x" * 1000])], ["text"])
    assert [b.num_rows for b in common.gathered(iter([batches[0], big, batches[1]]), 350)] == [1, 1, 1]


def test_packing_encodes_gathered_batches_and_yields_short_ones(monkeypatch):
    path, calls = piece_cache.tokenizer_path(NAMES[1]), []

    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 3)

    enc = piece_cache.PieceEncoder(path)
    many = enc.encode_many
    enc.encode_many = lambda texts: calls.append(len(texts)) or many(texts)
    monkeypatch.setattr(packing, "TaskContext", Task)
    monkeypatch.setattr(packing, "encoder", lambda _: enc)
    rows = [("=a" if i < 700 else "=b", i, f"text {i}, the cat." if i % 9 else None) for i in range(1200)]
    batch = pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], ["queue", "doc_id", "text"])
    out = list(packing._token_rows(path, 1)(batch.slice(k, 100) for k in range(0, 1200, 100)))
    assert calls == [1200] and max(b.num_rows for b in out) <= common.BATCH_ROWS
    got, one = pa.Table.from_batches(out).to_pylist(), library(NAMES[1])
    want = [array.array("I", one(t)).tolist() + [1] for _, _, t in rows]
    assert [(r["part"], r["queue"], r["doc_id"], array.array("H", r["ids"]).tolist()) for r in got] == [(3, q, i, ids) for (q, i, _), ids in zip(rows, want, strict=True)]
    upto = {"=a": 0, "=b": 0}
    for r in got:
        assert (r["at"], r["n"]) == (upto[r["queue"]], len(r["ids"]) // 2)
        upto[r["queue"]] += r["n"]


def test_packing_of_a_capital_with_a_mark_before_punctuation(spark):
    text, one = "\u0130. \u0130!! A\u0130)", library(NAMES[1])
    (row,) = packing.pack(spark, spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")).collect()
    assert row["ids_crc32"] == zlib.crc32(one(text) + array.array("I", [1]).tobytes())
