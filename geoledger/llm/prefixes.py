"""Token counts of every prefix of a text by dynamic programming.

Of all tokens that end at a place of a piece, one can be the last token of the piece's encoding up to there: the one
that the encoding before it may stand beside. Two tokens may stand side by side if their bytes together are encoded
as just these two. So the last tokens of all prefixes follow from those of shorter prefixes, without encoding any
prefix, and the count of a prefix is one more than that of the prefix before its last token.

Texts are cut into units, white space and the piece behind it, in which the counts depend on nothing around them: the
vocabulary splits white space before its last character if something follows, and does not if the text ends there.
A text's counts are stored as one signed byte a code point, the step from one prefix to the next, and the count at
every MARK-th code point. Truncation and budget questions are answered from the stored steps alone.
"""

from __future__ import annotations

import array
import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoledger.llm.rows import documents, keeping, ship, text_of

#: Code points between stored counts.
MARK = 1024
#: What a worker keeps from text to text: bytes of unit steps, of some UNIT_BYTES each, and token pairs, prefixes and
#: endings of some 100 bytes each. It is forgotten beyond that, which costs time only.
KEPT_BYTES, UNIT_BYTES = 96 << 20, 200
KEPT_PAIRS, KEPT_PREFIXES, KEPT_ENDINGS = 1 << 18, 1 << 17, 1 << 15
#: Bytes that the tokens ending at a place are looked up by.
TAIL = 4
#: Longest unit that is kept.
KEPT_UNIT = 64
LIMIT = 1024
STORE = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("limit_chars", T.LongType()),
        T.StructField("steps", T.BinaryType()),
        T.StructField("marks", T.BinaryType()),
    ]
)
OWN = ["n_bytes", "n_tokens", "over_limit", "limit_chars", "prefix_steps", "prefix_marks"]
#: Of a class of characters, one that the vocabulary's pattern and this one agree on. No contraction holds them.
STAND_INS = {"letter": "a", "number": "1", "other": "!", "space": "\t"}
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CLASSES = {"space": f"[{SPACES}]", "letter": r"[^\W\d_]", "number": r"\d"}
UNIT = (
    r" ?[^\W\d_]+|'(?:[stmd]|re|ve|ll)|[SPACES]*(?:(?<! )'(?:[stmd]|re|ve|ll)|[^\W\d_]+|\d+|(?:[^\wSPACES]|_)+)|[SPACES]+"
).replace("SPACES", SPACES)


LETTERS = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")


class Prefixes:
    """Steps of the token count from each prefix of a text to the next, for a byte-level vocabulary."""

    def __init__(self, path: str):
        from geoledger.llm.chunks import byte_pieces
        from geoledger.llm.words import tokenizer

        made = tokenizer(path)
        self.model, self.splitter = made.model, made.pre_tokenizer
        added = made.get_added_tokens_decoder()
        odd = [t for t in added.values() if t.single_word or t.lstrip or t.rstrip or t.normalized]
        if odd or made.normalizer is not None:
            raise ValueError("prefix counts need a vocabulary without a normalizer and with plain special tokens")
        self.specials = sorted((t.content for t in added.values()), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, self.specials)) or r"(?!)")
        pieces, _ = byte_pieces(path)
        self.ids = {p: k for k, p in enumerate(pieces) if k not in added}
        self.written = [made.id_to_token(k) for k in range(len(pieces))]
        self.tails: dict[bytes, set[int]] = {}  # last bytes of longer tokens -> their sizes
        for piece in self.ids:
            if len(piece) > TAIL:
                self.tails.setdefault(piece[-TAIL:], set()).add(len(piece))
        self.endings: dict[bytes, list[tuple[int, int]]] = {}
        self.unit = re.compile(UNIT)
        self.classes = {name: re.compile(p) for name, p in CLASSES.items()}
        self.seen: set[str] = set()
        self.shadows: dict[int, str] = {}
        self.shadowed: set[str] = set()
        self.learn({chr(k) for k in range(128)})
        self.odd_ascii = bool(self.shadows)
        self.known, self.pairs, self.met = Units(self), {}, {}

    # -- characters -------------------------------------------------------------------------------------------------

    def learn(self, chars: set[str]) -> None:
        """Note the characters that the vocabulary's own pattern puts in another class than this one does."""
        for c in chars:
            probes = (("letter", "a"), ("number", "1"), ("other", "!"))
            theirs = next((k for k, x in probes if len(self.splitter.pre_tokenize_str(x + c + x)) == 1), "space")
            ours = next((k for k, pattern in self.classes.items() if pattern.match(c)), "other")
            if theirs != ours:
                self.shadows[ord(c)] = STAND_INS[theirs]
                self.shadowed.add(c)
        self.seen |= chars

    def units(self, text: str) -> list[str]:
        if not text.isascii() or self.odd_ascii:
            chars = set(text)
            if new := chars - self.seen:
                self.learn(new)
            if not self.shadowed.isdisjoint(chars):
                shadow = text.translate(self.shadows)
                return [text[m.start() : m.end()] for m in self.unit.finditer(shadow)]
        return self.unit.findall(text)

    def is_space(self, c: str) -> bool:
        shadow = self.shadows.get(ord(c), c)
        return bool(self.classes["space"].match(shadow))

    # -- pieces -----------------------------------------------------------------------------------------------------

    def piece(self, text: str) -> list[int]:
        """Token counts of all prefixes of a piece that the vocabulary does not split, by code points."""
        data = text.encode()
        ids, endings, pairs, met = self.ids, self.endings, self.pairs, self.met
        last, counts = [], []  # of the prefix that ends behind a byte
        for end in range(1, min(len(data), KEPT_UNIT) + 1):  # what shorter pieces with the same beginning have told
            if (state := met.get(data[:end])) is None:
                break
            last.append(state & 0xFFFFFFFF)
            counts.append(state >> 32)
        for end in range(len(last) + 1, len(data) + 1):
            key = data[end - TAIL if end > TAIL else 0 : end]
            for size, token in endings[key] if key in endings else self.endings_of(key):
                start = end - size
                if token < 0 and (start < 0 or (token := ids.get(data[start:end], -1)) < 0):
                    continue
                pair = last[start - 1] << 32 | token if start else -1 - token
                if pairs[pair] if pair in pairs else self.fits(pair):
                    n = counts[start - 1] + 1 if start else 1
                    last.append(token)
                    counts.append(n)
                    if end <= KEPT_UNIT:
                        met[data[:end]] = n << 32 | token
                    break
            else:
                raise ValueError("no token ends here")
        if len(met) > KEPT_PREFIXES:
            met.clear()
        if len(data) == len(text):
            return counts
        at, ends = -1, []
        for c in text:
            at += len(c.encode())
            ends.append(counts[at])
        return ends

    def endings_of(self, key: bytes) -> list[tuple[int, int]]:
        """Tokens that may end in these bytes, from the longest down, as size and id; the id is -1 where the size
        alone does not tell. The bytes are the last TAIL of a prefix, or all there are."""
        found = [(n, -1) for n in sorted(self.tails.get(key, ()), reverse=True)]
        found += [(n, self.ids[key[-n:]]) for n in range(len(key), 0, -1) if key[-n:] in self.ids]
        if len(self.endings) >= KEPT_ENDINGS:
            self.endings.clear()
        self.endings[key] = found
        return found

    def fits(self, pair: int) -> bool:
        """May two tokens stand side by side? A single token, as -1 - token: is it its own encoding?"""
        tokens = [pair >> 32, pair & 0xFFFFFFFF] if pair >= 0 else [-1 - pair]
        made = self.model.tokenize("".join([self.written[t] for t in tokens]))
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        self.pairs[pair] = found = [t.id for t in made] == tokens
        return found

    def counts(self, unit: str) -> list[int]:
        """Token counts of all prefixes of a unit."""
        if LETTERS.fullmatch(unit):
            return self.piece(unit)
        n = 0
        while n < len(unit) and self.is_space(unit[n]):
            n += 1
        space, rest = unit[:n], unit[n:]
        out = self.piece(space) if space else []
        if not rest:
            return out
        before = out[-2] if n > 1 else 0
        if n and space[-1] == " ":
            return out + [before + k for k in self.piece(" " + rest)[1:]]
        if n:
            before += self.piece(space[-1])[0]
        if rest[0] == "'" and len(rest) == 3 and rest[1:].isalpha():
            ends = [self.piece("'")[0], self.piece("'")[0] + self.piece(rest[1])[0], self.piece(rest)[-1]]
        else:
            ends = self.piece(rest)
        return out + [before + k for k in ends]

    # -- texts ------------------------------------------------------------------------------------------------------

    def plain_steps(self, text: str) -> bytes:
        """Steps of a text in which special strings are ordinary text."""
        return b"".join(map(self.known.__getitem__, self.units(text)))

    def steps(self, text: str) -> bytes:
        """One signed byte a code point: by how much the count changes with it."""
        import numpy as np

        if not any(s in text for s in self.specials):
            return self.plain_steps(text)
        out, at = [], 0
        for found in self.special.finditer(text):
            # Up to its last character the special string is ordinary text behind what stands before it.
            made = np.frombuffer(self.plain_steps(text[at : found.end() - 1]), "i1")
            size = found.start() - at
            back = 1 - int(made[size:].sum(dtype="i8"))
            out += [made.tobytes(), back.to_bytes(1, "little", signed=True)]
            at = found.end()
        out.append(self.plain_steps(text[at:]))
        return b"".join(out)


class Units(dict):
    """Unit -> steps of its token count, as signed bytes. Holds the last units used, within KEPT_BYTES."""

    def __init__(self, prefixes: Prefixes):
        super().__init__()
        self.prefixes, self.older, self.size = prefixes, {}, 0

    def __missing__(self, unit: str) -> bytes:
        if (made := self.older.get(unit)) is None:
            counts = self.prefixes.counts(unit)
            made = array.array("b", [b - a for a, b in zip([0, *counts], counts)]).tobytes()
        if len(unit) <= KEPT_UNIT:
            if self.size > KEPT_BYTES // 2:
                self.older, self.size = dict(self), 0
                self.clear()
            self[unit] = made
            self.size += UNIT_BYTES
        return made


@functools.cache
def prefixes(path: str) -> Prefixes:
    return Prefixes(path)


def stored_counts(steps: bytes) -> bytes:
    """The counts at every MARK-th code point, from the start on, as unsigned 32-bit integers."""
    import numpy as np

    data = np.frombuffer(steps, "i1")
    blocks = np.add.reduceat(data, np.arange(0, len(data), MARK), dtype="i8") if len(data) else []
    return np.concatenate([[0], np.cumsum(blocks)]).astype("<u4").tobytes()


def count_at(steps: bytes, marks: bytes, chars: int) -> int:
    """Tokens of the prefix of so many code points."""
    import numpy as np

    chars = min(max(chars, 0), len(steps))
    block = chars // MARK
    start = block * MARK
    base = int(np.frombuffer(marks, "<u4")[block])
    return base + int(np.frombuffer(steps, "i1")[start:chars].sum(dtype="i8"))


def longest_within(steps: bytes, marks: bytes, tokens: int) -> int:
    """Code points of the longest prefix of at most so many tokens.

    Counts may fall with a further character, so blocks are searched from the last one that may hold such a prefix.
    """
    import numpy as np

    if tokens < 0:
        return 0
    data, bases = np.frombuffer(steps, "i1"), np.frombuffer(marks, "<u4").astype("i8")
    if bases[-1] <= tokens:
        return len(data)
    for block in range((len(data) - 1) // MARK, -1, -1):
        counts = bases[block] + np.cumsum(data[block * MARK : (block + 1) * MARK], dtype="i8")
        within = np.flatnonzero(counts <= tokens)
        if len(within):
            return block * MARK + int(within[-1]) + 1
    return 0


def store(vocabulary: str, limit: int = LIMIT):
    """A column function: the stored counts of a text, its tokens, and its longest prefix within the limit."""

    @F.arrow_udf(STORE)
    def prefix_store(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np

        counter = prefixes(vocabulary)
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for value in batch:
                steps = counter.steps(value.as_py() or "")
                marks = stored_counts(steps)
                total = int(np.frombuffer(marks, "<u4")[-1])
                within = len(steps) if total <= limit else longest_within(steps, marks, limit)
                for column, x in zip(columns, (total, within, steps, marks), strict=True):
                    column.append(x)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.StructArray.from_arrays(arrays, [f.name for f in STORE.fields])

    return prefix_store


@F.arrow_udf(T.LongType())
def tokens_of_prefix(steps: pa.Array, marks: pa.Array, chars: pa.Array) -> pa.Array:
    """Column function: tokens of the prefix of so many code points, from stored counts. Null for a null."""
    rows = zip(steps, marks, chars, strict=True)
    found = [None if any(not x.is_valid for x in row) else count_at(*[x.as_py() for x in row]) for row in rows]
    return pa.array(found, pa.int64())


@F.arrow_udf(T.LongType())
def longest_prefix(steps: pa.Array, marks: pa.Array, tokens: pa.Array) -> pa.Array:
    """Column function: code points of the longest prefix of at most so many tokens, from stored counts."""
    rows = zip(steps, marks, tokens, strict=True)
    found = [None if any(not x.is_valid for x in row) else longest_within(*[x.as_py() for x in row]) for row in rows]
    return pa.array(found, pa.int64())


def with_prefix_counts(df: DataFrame, vocabulary: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """Each row with the token counts of all prefixes of its text, and what follows from them.

    Added: n_bytes (UTF-8), n_tokens, over_limit, limit_chars (code points of the longest prefix within the limit),
    prefix_steps and prefix_marks (the stored counts). A null text counts as empty. Each row stands for itself, so
    repeated rows and keys are no matter. A text is worked on whole, with one byte a code point. Other columns stay;
    columns named like the added ones are replaced. An empty table gives none.
    """
    ship(df.sparkSession)

    def body(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("counts", store(vocabulary, limit)(text_of("text")))
        counts = F.col("counts")
        return rows.select(
            "*",
            F.octet_length(text_of("text")).cast("long").alias("n_bytes"),
            counts["n_tokens"].alias("n_tokens"),
            (counts["n_tokens"] > limit).alias("over_limit"),
            counts["limit_chars"].alias("limit_chars"),
            counts["steps"].alias("prefix_steps"),
            counts["marks"].alias("prefix_marks"),
        )

    return keeping(df, {"text": text}, body, OWN)


def truncated(df: DataFrame, tokens: Column, text: str = "text") -> DataFrame:
    """Rows with stored counts, their text cut to its longest prefix within a budget. No text is encoded again.

    A null text stays null; a null budget gives a null text. The stored counts stay those of the whole text.
    """
    chars = longest_prefix(F.col("prefix_steps"), F.col("prefix_marks"), tokens.cast("long"))
    return df.withColumn(text, F.substring(F.col(text), F.lit(1), chars.cast("int")))


def op13_prefix_token_counts(spark, sf_dir: str) -> DataFrame:
    """Token counts of all documents, and how much of each fits the limit."""
    import public_tokenizers

    docs = documents(spark, sf_dir).select("doc_id", "text")
    counted = with_prefix_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit", "limit_chars")


__all__: list[str] = ["with_prefix_counts", "truncated", "tokens_of_prefix", "longest_prefix", "op13_prefix_token_counts"]
