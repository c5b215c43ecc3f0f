"""Token counts of a unigram tokenizer without its tokens.

An Aho-Corasick automaton over the vocabulary yields every piece that ends at each position, longest first. Dynamic
programming keeps for each position the best score of a path that ends there and the number of its tokens; a later start
must be strictly better, which is the tokenizers library's rule for ties. A character without a piece of its own
costs the least score less 10, and counts as its bytes if the vocabulary has them all, else runs of such
characters count once.

No piece has white space after another character, so paths are independent between words and a word's count is kept
for the next time; this holds exactly if the scores are whole numbers, otherwise texts are run whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .piece_cache import tokenizer_path

SPACE = "▁"
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_UNKNOWN_PENALTY = 10.0


def unigram_vocabulary(path: str) -> tuple[list[tuple[str, float]], int]:
    """Pieces with scores, and the unknown piece's id, of a sentencepiece model file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())], sp.unk_id()


class Counter:
    """``count(text)`` is the number of tokens of the whole text."""

    def __init__(self, pieces: list[tuple[str, float]], limit: int = 500_000):
        import ahocorasick

        scores: dict[str, float] = dict(pieces)
        self.automaton = ahocorasick.Automaton()
        for piece, score in scores.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in pieces), default=0.0) - _UNKNOWN_PENALTY
        self.by_bytes = all(f"<0x{b:02X}>" in scores for b in range(256))
        self.by_word = self.by_bytes and all(float(s).is_integer() for s in scores.values()) and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in scores)
        self.limit = limit
        self._memo: dict[str, int] = {}

    def path(self, text: str) -> int:
        """Tokens on the best path."""
        n = len(text)
        # per position: score, tokens, whether the last one is unknown (runs of these may be one token)
        score, tokens, open_ = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        unknown, by_bytes = self.unknown, self.by_bytes
        done = 0

        def step(end: int, found: list[tuple[int, float]]) -> None:
            best, start, alone = None, -1, False
            for length, s in found:  # longest first: the earliest start
                candidate = score[end - length] + s
                alone = alone or length == 1
                if best is None or candidate > best:
                    best, start = candidate, end - length
            if not alone:
                candidate = score[end - 1] + unknown
                if best is None or candidate > best:
                    score[end], open_[end] = candidate, True
                    if by_bytes:
                        tokens[end] = tokens[end - 1] + len(text[end - 1].encode("utf-8"))
                    else:
                        tokens[end] = tokens[end - 1] + (not open_[end - 1])
                    return
            score[end], tokens[end] = best, tokens[start] + 1

        found: list[tuple[int, float]] = []
        for at, value in self.automaton.iter(text):
            while done < at:
                done += 1
                step(done, found)
                found = []
            found.append(value)
        while done < n:
            done += 1
            step(done, found)
            found = []
        return tokens[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        if not self.by_word:
            return self.path(text)
        memo, total = self._memo, 0
        for word in _WORD.findall(text):
            n = memo.get(word)
            if n is None:
                n = self.path(word)
                if len(word) <= 48:
                    if len(memo) >= self.limit:
                        memo.clear()
                    memo[word] = n
            total += n
        return total


_counters: dict[str, Counter] = {}


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = Counter(unigram_vocabulary(path)[0])
        count = _counters[path].count
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([count(t) for t in common.texts_of(batch.column(1))], pa.int64())], ["doc_id", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, *, model: str | None = None) -> DataFrame:
    """A row per document: doc_id, n_tokens of its whole text by the unigram model over the file's pieces and scores.

    Null or empty text: 0. Null doc_id and repeated rows pass through. Ties of score are decided as the library's
    Unigram does. Very long texts: read whole, word by word, by one worker. Empty table: no rows. Other columns are
    ignored, whatever their names.
    """
    path = model or tokenizer_path("piece_bpe_32k.model")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return common.arrow_map(rows, _counted(path), "doc_id long, n_tokens long")
