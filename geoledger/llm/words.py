"""Ids of texts by a public tokenizer, with each distinct word encoded by the library once a worker.

Both vocabularies split a text before they merge bytes, and never merge over a split. A byte-level text may be cut
before a space or on both sides of a line break wherever single white space stands between two other characters; a
text for the word vocabulary may be cut at any ASCII white space, which it drops. So the ids of a text are those of
its cut units in order, and units repeat. Texts with other white space are cut only where that rule holds.
"""

from __future__ import annotations

import functools
import re

UNIT = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")
#: Bytes of byte-level units that a worker keeps, and of words, and what a unit takes about. The units not used lately
#: are forgotten beyond that, which costs time and changes no result.
KEPT_BYTES, KEPT_WORD_BYTES, UNIT_BYTES = 300 << 20, 128 << 20, 200
#: Letters whose bytes the vocabularies write one by one.
LATIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: Longest unit that is kept.
KEPT_UNIT = 128


class Uncut(Exception):
    """The text may not be cut here."""


class Units(dict):
    """Unit -> its ids as little-endian unsigned 32-bit integers.

    Plain letters go to the library's merges at once, without its normalizer and its patterns; it is what they would
    make of them. A mark behind letters is a piece of its own. All other units take the library's whole way.
    """

    def __init__(self, tokenizer, prefix: str = "", lower: bool = False, kept_bytes: int = KEPT_BYTES):
        super().__init__()
        self.older, self.room = {}, kept_bytes // UNIT_BYTES // 2
        self.tokenizer, self.model, self.prefix, self.lower = tokenizer, tokenizer.model, prefix, lower
        self.marks = {m: self.whole(m) for m in ".,"}
        self.table: dict[int, str] = {}
        self.head = self.written(" ") if prefix else ""

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def written(self, letters: str) -> str:
        """The letters as the vocabulary writes their bytes."""
        for c in letters:
            if ord(c) not in self.table:
                piece = self.tokenizer.pre_tokenizer.pre_tokenize_str(c if c != " " else " a")[0][0]
                self.table[ord(c)] = piece if c != " " else piece[:1]
        return letters.translate(self.table)

    def made(self, unit) -> bytes:
        text = unit.decode() if (raw := isinstance(unit, bytes)) else unit
        if not text or text != "\n" and (text[0].isspace() or text[-1].isspace()):
            raise Uncut
        if self.lower and text.isalpha() and LATIN.fullmatch(text) and (small := text.lower()) != text:
            return self[small.encode()]
        if text.isalpha() and (text.isascii() or LATIN.fullmatch(text)):
            letters = text if text.isascii() else self.written(text)
            return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(self.head + letters)])
        if text[-1] in self.marks and LATIN.fullmatch(text, 0, len(text) - 1):
            return self[text[:-1].encode() if raw else text[:-1]] + self.marks[text[-1]]
        return self.whole(self.prefix + text)

    def __missing__(self, unit):
        if (packed := self.older.get(unit)) is None:
            packed = self.made(unit)
        if len(unit) <= KEPT_UNIT:
            if len(self) >= self.room:
                self.older = dict(self)
                self.clear()
            self[unit] = packed
        return packed


@functools.cache
def tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    if hasattr(made.model, "_resize_cache"):
        made.model._resize_cache(0)  # units are kept here, a second memory of them only costs time
    return made


class ByteLevel:
    """Ids by a byte-level vocabulary."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.plain, self.spaced = Units(self.tokenizer), Units(self.tokenizer, " ")

    def ids(self, text: str, behind_space: bool = False) -> bytes:
        """The ids of a text, or of a text behind a space that may be cut before that space."""
        if not text:
            return b""
        plain, spaced, out = self.plain, self.spaced.__getitem__, []
        try:
            for k, line in enumerate(text.split("\n")):
                words = line.split(" ")
                if k:
                    out.append(plain["\n"])
                if behind_space and not k:
                    out.extend(map(spaced, words))
                else:
                    out.append(plain[words[0]])
                    out.extend(map(spaced, words[1:]))
        except Uncut:
            return b"".join([self.ids_of_unit(u) for u in UNIT.split(" " + text if behind_space else text)])
        return b"".join(out)

    def ids_of_unit(self, unit: str) -> bytes:
        if unit[:1] == " " and len(unit) > 1 and not (unit[1].isspace() or unit[-1].isspace()):
            return self.spaced[unit[1:]]
        return self.plain.whole(unit)


class WordLevel:
    """Ids by a vocabulary that drops white space."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.units = Units(self.tokenizer, lower=True, kept_bytes=KEPT_WORD_BYTES)

    def ids(self, text: str) -> bytes:
        words = text.encode().split()
        try:
            return b"".join(map(self.units.__getitem__, words))
        except Uncut:
            return b"".join([self.units.whole(w.decode()) for w in words])

@functools.cache
def byte_level(path: str) -> ByteLevel:
    return ByteLevel(path)


@functools.cache
def word_level(path: str) -> WordLevel:
    return WordLevel(path)
