"""BPE encoding and decoding with chunks shared across documents.

A rolling hash over the last 32 bytes cuts texts into chunks where its low bits are zero, so a passage gives the same
chunks wherever it stands. Documents are dealt out by their least chunk hash and sorted by it, which brings copies and
near copies together; a chunk met before is not encoded again. Large groups of copies are split by Spark at run time,
each part encodes a chunk once.

A chunk is encoded without its neighbours, which is wrong at its two ends. Its encoding is taken as certain between
the first and the last place in it where the vocabulary splits text whatever stands around; the open ends of two
neighbours are joined and encoded again, over as many chunks as it takes to reach a certain place on either side.
"""

from __future__ import annotations

import functools
import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoledger.llm.rows import documents, ship, text_of

#: One byte in so many ends a chunk, on average. A power of two.
CHUNK_BYTES = 1024
#: Bytes of chunk encodings that a worker keeps; emptied beyond, which costs time only.
KEPT_BYTES = 64 << 20
SINGLE = re.compile(r"(?<=\S) (?=\S)")
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


@functools.cache
def gear():
    import numpy as np

    return np.random.default_rng(7).integers(0, 1 << 32, 256, dtype="u4")


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of a UTF-8 text, the last one included; never inside a character."""
    import numpy as np

    n = len(data)
    if n < 64:
        return [n]
    units = np.frombuffer(data, "u1")
    rolled = gear()[units]
    for reach in (1, 2, 4, 8, 16):  # doubles the bytes that each place has seen, up to 32
        rolled[reach:] += rolled[:-reach] << np.uint32(reach)
    ends = np.flatnonzero((rolled >> np.uint32(12)) & np.uint32(CHUNK_BYTES - 1) == 0) + 1
    ends = ends[(ends >= 32) & (ends < n)]
    while len(inside := np.flatnonzero(units[ends] & 0xC0 == 0x80)):
        ends[inside] += 1
        ends = ends[ends < n]
    return [*dict.fromkeys(ends.tolist()), n]


def chunk_key(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def route(text: str) -> int:
    """The least chunk hash of a text, as a signed 64-bit integer."""
    data = text.encode("utf-8", "surrogatepass")
    start, least = 0, None
    for end in cuts(data):
        key = chunk_key(data[start:end])
        least = key if least is None or key < least else least
        start = end
    return int.from_bytes(least[:8], "little", signed=True)


@F.pandas_udf(T.LongType())
def route_of(text: pd.Series) -> pd.Series:
    return pd.Series([route(t) for t in text], dtype="int64")


def certain_places(text: str) -> tuple[int, int]:
    """The first and the last single space between other characters, before which the vocabulary always cuts; two
    equal numbers if there are fewer than two."""
    first = SINGLE.search(text)
    if not first:
        return 0, 0
    last = text.rfind(" ", 0, len(text) - 1)
    while text[last - 1].isspace() or text[last + 1].isspace():
        last = text.rfind(" ", 0, last)
    return first.start(), last


class Chunks:
    """The encodings of chunks met so far: open head, certain ids, open tail. No certain place: all is head."""

    def __init__(self, encoder):
        self.encoder, self.known, self.size = encoder, {}, 0

    def of(self, chunk: bytes) -> tuple[str, bytes | None, str]:
        key = chunk_key(chunk)
        if (found := self.known.get(key)) is not None:
            return found
        text = chunk.decode("utf-8", "surrogatepass")
        first, last = certain_places(text)
        if first == last:
            made = (text, None, "")
        else:
            made = (text[:first], self.encoder.ids(text[first + 1 : last], behind_space=True), text[last:])
        if self.size > KEPT_BYTES:
            self.known, self.size = {}, 0
        self.known[key] = made
        self.size += len(made[1] or b"") + 4 * len(made[0]) + 200
        return made

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        data = text.encode("utf-8", "surrogatepass")
        out, open_text, start = [], "", 0
        for end in cuts(data):
            head, certain, tail = self.of(data[start:end])
            open_text += head
            if certain is not None:
                out += [self.joined(open_text), certain]
                open_text = tail
            start = end
        out.append(self.joined(open_text))
        return b"".join(out)

    def joined(self, open_text: str) -> bytes:
        """The ids of open ends put together; all but the first begin with a space before which text is cut."""
        if len(open_text) > 1 and open_text[0] == " " and not open_text[1].isspace():
            return self.encoder.ids(open_text[1:], behind_space=True)
        return self.encoder.ids(open_text)


@functools.cache
def byte_pieces(path: str) -> tuple[list[bytes], list[str]]:
    """The bytes of each id, and its decimal form."""
    from geoledger.llm.words import tokenizer

    made = tokenizer(path)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {
        chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)
    }
    special = {t.content for t in made.get_added_tokens_decoder().values()}
    pieces = []
    for k in range(made.get_vocab_size()):
        token = made.id_to_token(k)
        pieces.append(token.encode() if token in special else bytes([letters[c] for c in token]))
    return pieces, [str(k) for k in range(len(pieces))]


def digests(path: str):
    """For mapInArrow over (doc_id, text): ids and decoded text of each document, as digests."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from geoledger.llm.words import byte_level

        chunks = Chunks(byte_level(path))
        pieces, decimal = byte_pieces(path)
        names = [x.split()[0] for x in DIGESTS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            keys, texts, out = batch.column("doc_id"), batch.column("text"), []
            for i in range(batch.num_rows):
                ids = np.frombuffer(chunks.encode(texts[i].as_py()), "<u4").tolist()
                decoded = b"".join([pieces[k] for k in ids]).decode("utf-8", "replace").encode()
                listed = ",".join([decimal[k] for k in ids]).encode()
                out.append(
                    (
                        keys[i].as_py(),
                        len(ids),
                        hashlib.sha256(listed).hexdigest(),
                        hashlib.sha256(decoded).hexdigest(),
                    )
                )
            columns = [list(c) for c in zip(*out, strict=True)] or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def together(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) of all rows, with texts that share their least chunk side by side. Spark splits large groups."""
    ship(df.sparkSession)
    rows = df.select(df[key].cast("long").alias("doc_id"), text_of(text).alias("text"))
    routed = rows.withColumn("route", route_of("text"))
    return routed.hint("rebalance", "route").sortWithinPartitions("route").select("doc_id", "text")


def encode_digests(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the number of its ids and digests of its ids and of the text they decode to.

    A null text is an empty one without ids. Rows with one key, also a null one, stay rows of their own. Other columns
    are left out; an empty table gives no rows.
    """
    return together(df, key, text).mapInArrow(digests(vocabulary), DIGESTS)


def op10_chunk_reuse_bpe(spark, sf_dir: str) -> DataFrame:
    """All documents encoded by shared chunks and decoded."""
    import public_tokenizers

    return encode_digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
