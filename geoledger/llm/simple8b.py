"""Token ids in 64-bit words: Simple-8b.

The upper four bits of a word select how many ids of how many bits its other sixty hold. Selector 0 is the escape: the
next word is one raw integer of up to 64 bits. A coded block stands alone: it starts with the number of ids and of
words, so a reader can place a block without decoding others, and all words of a selector decode in one vector step.

Files are Parquet tables of blocks that Spark writes, so a lost task leaves no half file. A block holds whole
documents in ascending order, their lengths, the first id's place in its file, and the coded words.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoledger.llm.rows import documents, shared_folder, ship, text_of

#: Selector -> (ids in a word, bits of an id).
SELECTORS = ((1, 64), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
COUNTS = tuple(count for count, _ in SELECTORS)
ESCAPE = 0
#: Ids of a block, or more if its last document is longer.
BLOCK_IDS = 1 << 16
HEADER = struct.Struct("<II")
END_ID = 0
BLOCKS = (
    "part int, block long, first long, n_ids long, doc_ids array<long>, lengths array<long>, words binary"
)
DIGESTS = "part int, doc_id long, start long, n_tokens long, ids_crc32 long"


@functools.cache
def bounds():
    """The least integers that need more bits than each selector has."""
    import numpy as np

    return np.array([1 << bits for _, bits in SELECTORS[1:]], "u8")


@functools.cache
def small_widths():
    """By integer below 2**16 the bits of the narrowest selector that holds it."""
    import numpy as np

    narrow = np.searchsorted(bounds(), np.arange(1 << 16, dtype="u8"), side="right")
    return np.array([bits for _, bits in SELECTORS[1:]], "u1")[narrow]


def encode(ids) -> bytes:
    """One coded block of unsigned integers below 2**64."""
    import numpy as np

    ids = np.ascontiguousarray(ids, dtype="<u8")
    n = len(ids)
    if not n:
        return HEADER.pack(0, 0)
    if ids.max() < 1 << 16:
        widths = small_widths()[ids]
    else:
        widths = np.searchsorted(bounds(), ids, side="right").astype("u1")
        widths = np.array([b for _, b in SELECTORS[1:]] + [64], "u1")[widths]
    choice = np.zeros(n, "u1")
    peak, reach = widths.copy(), 1  # the widest of so many ids from each place on
    for selector in range(len(SELECTORS) - 1, 0, -1):
        count, bits = SELECTORS[selector]
        if count > n:
            break
        while reach < count:
            step = min(reach, count - reach)
            peak = np.maximum(peak[: len(peak) - step], peak[step:])
            reach += step
        fits = np.flatnonzero(peak <= bits)
        choice[fits] = selector
    steps, starts, at = choice.tobytes(), [], 0
    while at < n:
        starts.append(at)
        at += COUNTS[steps[at]]
    starts = np.asarray(starts, "i8")
    chosen = choice[starts]
    size = 1 + (chosen == ESCAPE)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), "<u8")
    words[place] = chosen.astype("u8") << np.uint64(60)
    for selector in np.unique(chosen):
        count, bits = SELECTORS[selector]
        mine = np.flatnonzero(chosen == selector)
        if selector == ESCAPE:
            words[place[mine] + 1] = ids[starts[mine]]
            continue
        for k in range(count):
            words[place[mine]] |= ids[starts[mine] + k] << np.uint64(k * bits)
    return HEADER.pack(n, len(words)) + words.tobytes()


def decode(block: bytes):
    """The integers of a coded block."""
    import numpy as np

    n, size = HEADER.unpack_from(block)
    words = np.frombuffer(block, "<u8", size, HEADER.size)
    if not n:
        return np.zeros(0, "u8")
    selector = (words >> np.uint64(60)).astype("i8")
    # The word behind an escape is no selector. Escapes in a row alternate, so each run is followed in order.
    raw = np.zeros(size, bool)
    for at in np.flatnonzero(selector == ESCAPE):
        if not raw[at] and at + 1 < size:
            raw[at + 1] = True
    counts = np.where(raw, 0, np.array([c for c, _ in SELECTORS] + [0], "i8")[np.minimum(selector, 15)])
    starts = np.cumsum(counts) - counts
    out = np.zeros(n, "u8")
    for s in np.unique(selector[~raw]):
        count, bits = SELECTORS[s]
        mine = np.flatnonzero((selector == s) & ~raw)
        if s == ESCAPE:
            out[starts[mine]] = words[mine + 1]
            continue
        mask = np.uint64((1 << bits) - 1)
        for k in range(count):
            out[starts[mine] + k] = (words[mine] >> np.uint64(k * bits)) & mask
    return out


def block_writer(vocabulary: str):
    """For mapInArrow over (doc_id, text) in order: coded blocks of whole documents."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from geoledger.llm.words import byte_level

        encoder, end = byte_level(vocabulary), END_ID.to_bytes(4, "little")
        part, number, first = TaskContext.get().partitionId(), 0, 0
        keys: list[int | None] = []
        held: list[bytes] = []

        def closed() -> pa.RecordBatch:
            nonlocal number, first
            ids = np.frombuffer(b"".join(held), "<u4")
            row = {
                "part": [part],
                "block": [number],
                "first": [first],
                "n_ids": [len(ids)],
                "doc_ids": [list(keys)],
                "lengths": [[len(x) // 4 for x in held]],
                "words": [encode(ids)],
            }
            number, first = number + 1, first + len(ids)
            keys.clear()
            held.clear()
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds, strict=True)], list(row))

        size = 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                keys.append(ids[i].as_py())
                held.append(encoder.ids(texts[i].as_py() or "") + end)
                size += len(held[-1]) // 4
                if size >= BLOCK_IDS:
                    yield closed()
                    size = 0
        if held:
            yield closed()

    return run


def read_blocks(batches) -> Iterator:
    """For mapInArrow over blocks: a digest of each document, from the coded words alone."""
    import pyarrow as pa

    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in DIGESTS.split(", ")]
    for batch in batches:
        for row in batch.to_pylist():
            ids = decode(row["words"]).astype("<u4")
            out, at = [], 0
            for key, n in zip(row["doc_ids"], row["lengths"], strict=True):
                out.append((row["part"], key, row["first"] + at, n, zlib.crc32(ids[at : at + n].tobytes())))
                at += n
            columns = [list(c) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def write_ids(df: DataFrame, path: str, vocabulary: str, key: str = "doc_id", text: str = "text") -> None:
    """The ids of all rows in ascending key order as coded files; null keys come first, a null text is an empty one.

    Rows with the same key are ordered by a hash of their text. Files follow each other by their part number.
    """
    ship(df.sparkSession)
    rows = df.select(df[key].cast("long").alias("doc_id"), text_of(text).alias("text")).withColumn(
        "_tie", F.xxhash64("text")
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("_tie").asc()]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    blocks = ranged.select("doc_id", "text").mapInArrow(block_writer(vocabulary), BLOCKS)
    blocks.write.option("compression", "zstd").parquet(path)


def read_digests(spark, path: str) -> DataFrame:
    """Per document of coded files: its place, length and checksum."""
    ship(spark)
    blocks = spark.read.schema(BLOCKS).parquet(path)
    # One row a file here, so a running total in one task is small.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        blocks.groupBy("part")
        .agg(F.sum("n_ids").alias("_n"))
        .select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    return (
        blocks.mapInArrow(read_blocks, DIGESTS)
        .join(shift, "part")
        .select("doc_id", (F.col("start") + F.col("_shift")).alias("start"), "n_tokens", "ids_crc32")
    )


def op5_simple8b_ids(spark, sf_dir: str) -> DataFrame:
    """All documents encoded, written in order as coded files and read back."""
    import uuid

    import public_tokenizers

    path = f"{shared_folder(spark)}/ids-{uuid.uuid4().hex}"
    write_ids(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_digests(spark, path)
