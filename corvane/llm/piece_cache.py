"""Encoding of whole texts with the tokenizers library, memoised by white-space delimited piece.

A byte-level or word tokenizer never joins characters across a boundary between a character that is not
white space and an ASCII white-space character. A text can so be cut there, each piece be encoded by the
library once, and the ids be joined. Texts for which that isn't certain go to the library whole.

Many texts at once are cut at single spaces, and their words and the words' trailing punctuation made unique, by Arrow; only
what is left is looked up in the memo, and the texts' ids are taken from a table of the unique words.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: ASCII white space with what follows it up to the next; for tokenizers that keep white space.
_KEEPING = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
#: For tokenizers that drop white space.
_DROPPING = re.compile(r"[^ \t-\r]+")
#: Other white space and format characters: such a text goes to the library whole.
_ODD = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -‏ -  -⁠　﻿]")
#: Punctuation that ends a token after a letter or digit in either tokenizer (no apostrophe, nothing of an added token).
_TAIL = ".,;:!?)]}\"*#$%&"
#: A space or none and letters of Latin-1 and Latin Extended, all precomposed, without the one whose lower case has two characters.
_PLAIN = re.compile("( ?)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)")
#: The same with such punctuation behind.
_TAILED = re.compile(f"{_PLAIN.pattern}([{re.escape(_TAIL)}]*)")

#: A word after which a space may not be cut off in a tokenizer that keeps white space: it is empty or ends with white space.
_OPEN = "(?:^|[\t-\r])\\z"
#: A word with more white space inside than single ends of lines.
_HARD = "[\t\x0b-\r]|\n\n|^\n|\n\\z"
#: What has to stand before the punctuation of ``_TAIL``: a letter or digit, ASCII or below U+0250, but for U+0130, whose lower case ends with a mark.
_BEFORE_TAIL = "[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]\\z"
#: Longer texts are encoded by themselves, so that offsets into a batch's ids fit 32 bits.
_MOST_BYTES = 64 << 20


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Generations(dict):
    """A bounded memo: when ``limit`` entries are in it they become the old generation, of which what is asked for comes back."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}

    def known(self, key):
        """The value of a key that isn't in the young generation, or None."""
        value = self.old.get(key)
        if value is not None:
            self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(self) >= self.limit:
            self.old = None  # freed before the copy, so that no third generation is held
            self.old = dict(self)
            self.clear()
        self[key] = value


class _Memo(Generations):
    """Piece to its ids as native unsigned 32-bit integers; misses are encoded, long pieces not kept."""

    def __init__(self, tokenizer, limit: int):
        super().__init__(limit)
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.plain_word = None  # how the model writes a word of Latin letters, if words are known to be one token of the pattern

    def encode(self, piece: str) -> bytes:
        return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        if len(piece) > 48:
            return self.encode(piece)
        if (ids := self.known(piece)) is not None:
            return ids
        tail = ""
        if self.plain_word is not None and (m := _TAILED.fullmatch(piece)):
            space, word, tail = m.groups()
            core = space + word
            if not tail:
                # one word that the normalizer and pattern leave whole: straight to the model, which costs a third
                ids = array("I", [t.id for t in self.model.tokenize(self.plain_word(space, word))]).tobytes()
        elif self.plain_word is not None and piece[:1] == "\n" and piece[1:2].isalnum():
            return self["\n"] + self[piece[1:]]  # a line's end is a token of its own before a letter or digit
        else:
            core = piece.rstrip(_TAIL)
            tail = piece[len(core) :] if core and core[-1] < "\u0250" and core[-1] != "\u0130" and core[-1].isalnum() else ""
            if not tail:
                ids = self.encode(piece)
        if tail:
            again = core in self
            ids = self[core] + self[tail]
            if not again:  # of a new word only the word is kept: most of them are seen once
                return ids
        self.keep(piece, ids)
        return ids

    def many(self, pieces: list[str]) -> list[bytes]:
        """The ids of different pieces; the ones of ASCII letters, most of those that are new, without calls of Python's own."""
        found = [*map(self.get, pieces)]
        old, write, tokenize = self.old, self.plain_word, self.model.tokenize
        for i, ids in enumerate(found):
            if ids is not None:
                continue
            piece = pieces[i]
            if (ids := old.get(piece)) is None:
                space = " " if piece[:1] == " " else ""
                word = piece[1:] if space else piece
                if len(piece) > 48 or not (word.isascii() and word.isalpha()):
                    found[i] = self[piece]
                    old = self.old
                    continue
                ids = array("I", [t.id for t in tokenize(write(space, word))]).tobytes()
            if len(self) >= self.limit:
                self.keep(piece, ids)
                old = self.old
            else:
                self[piece] = ids
            found[i] = ids
        return found


def _words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """What stands between the spaces of all texts, and where each text's words start and the last one's end."""
    cut = pc.split_pattern(texts, " ")
    starts = cut.offsets.to_numpy()
    return cut.flatten().dictionary_encode(), starts - starts[0]


def _strings(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


def _rests(words: pa.Array, heads: pa.Array) -> pa.Array:
    """What is left of each word behind its head."""
    ends, sizes = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset :][1 : len(words) + 1], pc.binary_length(words).to_numpy()
    sizes = sizes - pc.binary_length(heads).to_numpy()
    upto = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)[np.repeat(ends - upto[1:], sizes) + np.arange(upto[-1])]
    return pa.StringArray.from_buffers(len(words), pa.py_buffer(upto), pa.py_buffer(data))


class PieceEncoder:
    """``encode(text)`` gives the library's ids (no special tokens added) as packed unsigned 32-bit integers."""

    def __init__(self, path: str, limit: int = 400_000):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        self.vocab_size = tokenizer.get_vocab_size(with_added_tokens=True)
        self._memo = _Memo(tokenizer, limit)
        self._space = None  # what a space before a word adds to its piece, if texts can be cut at spaces
        normalizer, pre = spec.get("normalizer"), spec.get("pre_tokenizer") or {}
        plain = all(not (a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] or re.search(r"\s", a["content"])) for a in spec.get("added_tokens", []))
        steps = [x["type"] for x in (normalizer or {}).get("normalizers", [])]
        if plain and normalizer is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
            self._space = " "
            self._split = lambda text: [text] if _ODD.search(text) else _KEEPING.findall(text)
            letters = dict(enumerate(_byte_letters()))
            blank = {"": "", " ": letters[32]}
            self._memo.plain_word = lambda space, word: blank[space] + (word if word.isascii() else word.encode("utf-8").decode("latin-1").translate(letters))
        elif plain and steps == ["NFC", "Replace", "Lowercase"] and pre.get("type") == "Sequence" and pre["pretokenizers"][0]["type"] == "Split" and pre["pretokenizers"][0]["invert"]:
            self._space = ""
            self._split = _DROPPING.findall
            letters = dict(enumerate(_byte_letters()))
            self._memo.plain_word = lambda space, word: word.lower() if word.isascii() else word.lower().encode("utf-8").decode("latin-1").translate(letters)
        else:
            self._split = lambda text: [text]

    def encode(self, text: str) -> bytes:
        return b"".join(map(self._memo.__getitem__, self._split(text)))

    def encode_many(self, texts: pa.Array) -> list[bytes]:
        """``encode`` of each text, of null as of the empty text."""
        texts = texts.fill_null("")
        if self._space is None or not len(texts) or texts.nbytes > _MOST_BYTES:
            return [self.encode(t) for t in texts.to_pylist()]
        texts = texts.cast(pa.string())
        words, starts = _words(texts)
        apart = self._apart(words, starts)
        if len(apart):
            mask = np.zeros(len(texts), dtype=bool)
            mask[apart] = True
            words, starts = _words(pc.if_else(pa.array(mask), "", texts))
        table, at = self._ids_of(words.dictionary), words.indices
        if self._space:  # no space stands before a text's first word
            first = pc.list_element(pc.split_pattern(texts, " ", max_splits=1), 0).to_pylist()
            at = at.to_numpy().copy()
            at[starts[:-1]] = len(table) + np.arange(len(first))
            table, at = pa.concat_arrays([table, pa.array(map(self.encode, first), pa.binary())]), pa.array(at)
        ids = table.take(at)
        ends = np.frombuffer(ids.buffers()[1], dtype=np.int32)[starts].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        out = [bytes(data[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
        for i in apart.tolist():
            out[i] = self.encode(texts[i].as_py())
        return out

    def _apart(self, words: pa.DictionaryArray, starts: np.ndarray) -> np.ndarray:
        """The texts that can't be cut at each space, where white space is kept: those with other white space, or several in a row."""
        if not self._space:
            return np.empty(0, dtype=np.int64)
        unique, at = words.dictionary, words.indices.to_numpy()
        odd = pc.match_substring_regex(unique, _ODD.pattern).to_numpy(zero_copy_only=False)
        open_ = pc.match_substring_regex(unique, _OPEN).to_numpy(zero_copy_only=False)
        empty = pc.equal(pc.binary_length(unique), 0).to_numpy(zero_copy_only=False)
        cut = open_[at]
        cut[starts[1:] - 1] = False  # nothing follows a text's last word
        cut[starts[:-1]] &= ~empty[at[starts[:-1]]]  # nor stands anything before a space that starts a text
        if odd.any():
            cut |= odd[at]
        return np.unique(np.searchsorted(starts, np.flatnonzero(cut), side="right") - 1)

    def _ids_of(self, words: pa.Array) -> pa.Array:
        """Packed ids of words, each with the space before it where spaces are kept."""
        hard = pc.match_substring_regex(words, _HARD)
        cut = pc.split_pattern(pc.if_else(hard, "", words), "\n")
        starts, pieces = cut.offsets.to_numpy() - cut.offsets[0].as_py(), cut.flatten()
        if self._space:
            new_line = np.ones(len(pieces), dtype=bool)
            new_line[starts[:-1]] = False
            pieces = pc.binary_join_element_wise(pc.if_else(pa.array(new_line), "\n", " "), pieces, "")
        core = pc.ascii_rtrim(pieces, _TAIL)
        core = pc.if_else(pc.match_substring_regex(core, _BEFORE_TAIL), core, pieces).dictionary_encode()
        tail = _rests(pieces, core.dictionary.take(core.indices)).dictionary_encode()
        cores, tails = (pa.array(self._memo.many(_strings(x.dictionary)), pa.binary()).take(x.indices) for x in (core, tail))
        ids = pc.binary_join_element_wise(cores, tails, b"")
        ends = np.frombuffer(ids.buffers()[1], dtype=np.int32)[starts]
        ids = pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(ends), ids.buffers()[2]])
        if not pc.any(hard).as_py():
            return ids
        own = pa.array([self.encode(self._space + w) for w in _strings(words.filter(hard))], pa.binary())
        return pc.replace_with_mask(ids, hard, own)


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder for each file and Python worker."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
