"""Hierarchical packing of documents into sequences of several lengths.

A document's ids are cut into whole windows of the longest length and a rest. The rest goes to the shortest tier that
holds it. Tiers are packed from the longest down: each rest opens a window, and its gap is filled by the largest rests
of shorter tiers that fit, then by cutting one to measure. Rests of the shortest tier are joined and cut. What has no
filling left is joined into windows of the longest length. Every sequence is therefore full but the last one of a
partition. Sequences of a tier form step groups of equal token count, one after the other.

The work needs no shuffle: a partition is packed in blocks of documents as it streams by, and what a block leaves open
is carried to the next. Whole windows leave at once, so a block holds less than a window of each document, however long
its text. A task that runs again reads the same rows and gives the same sequences.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame

from geoledger.llm.rows import documents, ship, text_of

#: Window lengths, from the longest down. All are powers of two and need no padding when full.
TIERS = (2048, 1024, 512, 256)
#: Tokens of a step group: eight of the longest windows.
GROUP_TOKENS = 8 * TIERS[0]
#: Documents that are packed together.
BLOCK = 2048
#: Sequence numbers kept for a partition.
SEQUENCES_A_PARTITION = 1 << 40
END_ID = 1
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, tier int, step_group long"
)

Piece = tuple[int, int, int]  # document of the block, first id, length
Rest = tuple[object, bytes, int, int]  # key, ids of the piece, its start, ids of the document


def fill(rests: Sequence[Piece], tiers: Sequence[int]) -> tuple[list[tuple[int, list[Piece]]], list[Piece]]:
    """Full windows as (tier, pieces), and the pieces that found no full window."""
    by_tier: dict[int, list[Piece]] = {t: [] for t in tiers}
    for piece in rests:
        by_tier[min(t for t in tiers if t >= piece[2])].append(piece)
    last = tiers[-1]
    # Rests of shorter tiers than the one at work, by length; those of the tier itself leave before it starts.
    shorter = sorted((p[2], p[0], p[1]) for t in tiers[1:] for p in by_tier[t])
    full, left = [], []
    for tier, below in zip(tiers[:-1], tiers[1:], strict=True):
        if tier != tiers[0]:
            cut = bisect.bisect_left(shorter, (below + 1,))
            own, shorter = shorter[cut:], shorter[:cut]
        else:
            own = sorted((p[2], p[0], p[1]) for p in by_tier[tier])
        for length, doc, start in reversed(own):
            window, gap = [(doc, start, length)], tier - length
            while gap and shorter:
                at = bisect.bisect_left(shorter, (gap + 1,)) - 1
                if at >= 0:
                    n, d, s = shorter.pop(at)
                else:
                    n, d, s = shorter.pop(0)
                    bisect.insort(shorter, (n - gap, d, s + gap))
                    n = gap
                window.append((d, s, n))
                gap -= n
            if gap:
                left += window
            else:
                full.append((tier, window))
    windows, rest = join([(d, s, n) for n, d, s in shorter], last)
    return full + [(last, w) for w in windows], left + rest


def join(pieces: Sequence[Piece], size: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Pieces joined and cut into windows of a size, and what is left of the last one."""
    windows, window, room = [], [], size
    for doc, start, length in pieces:
        while length:
            n = min(length, room)
            window.append((doc, start, n))
            start, length, room = start + n, length - n, room - n
            if not room:
                windows.append(window)
                window, room = [], size
    return windows, window


def pack_stream(
    docs: Iterator[tuple[object, bytes]], tiers: Sequence[int] = TIERS, block: int = BLOCK
) -> Iterator[tuple]:
    """Pieces of (document key, ids as unsigned 32-bit integers), sequence by sequence."""
    longest, number, groups = tiers[0], 0, dict.fromkeys(tiers, 0)
    carried: list[Rest] = []

    def emit(tier: int, window: list[Rest]) -> Iterator[tuple]:
        nonlocal number
        offset, group = 0, groups[tier] // (GROUP_TOKENS // tier)
        for key, ids, start, total in window:
            n = len(ids) // 4
            yield key, start, n, zlib.crc32(ids), total, number, offset, tier, group
            offset += n
        groups[tier] += 1
        number += 1

    def flush(batch: list[Rest]) -> Iterator[tuple]:
        nonlocal carried
        rests = [(k, 0, len(ids) // 4) for k, (_, ids, _, _) in enumerate(batch)]
        full, left = fill(rests, tiers)

        def known(piece: Piece) -> Rest:
            doc, start, n = piece
            key, ids, first, total = batch[doc]
            return key, ids[4 * start : 4 * (start + n)], first + start, total

        for tier, window in full:
            yield from emit(tier, [known(p) for p in window])
        pool = carried + [known(p) for p in left]
        windows, rest = join([(k, 0, len(p[1]) // 4) for k, p in enumerate(pool)], longest)

        def part(piece: Piece) -> Rest:
            k, start, n = piece
            key, ids, first, total = pool[k]
            return key, ids[4 * start : 4 * (start + n)], first + start, total

        for window in windows:
            yield from emit(longest, [part(p) for p in window])
        carried = [part(p) for p in rest]

    batch: list[Rest] = []
    for key, ids in docs:
        total = len(ids) // 4
        whole = total - total % longest
        for start in range(0, whole, longest):
            yield from emit(longest, [(key, ids[4 * start : 4 * (start + longest)], start, total)])
        if total > whole:
            batch.append((key, ids[4 * whole :], whole, total))
        if len(batch) == block:
            yield from flush(batch)
            batch = []
    yield from flush(batch)
    if carried:
        yield from emit(longest, carried)


def packer(vocabulary: str) -> Callable:
    """For mapInArrow over (doc_id, text)."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from geoledger.llm.words import word_level

        encoder, end = word_level(vocabulary), END_ID.to_bytes(4, "little")
        base = TaskContext.get().partitionId() * SEQUENCES_A_PARTITION
        types = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
        names = [part.split()[0] for part in SCHEMA.split(", ")]

        def docs():
            for batch in batches:
                keys = batch.column(0)
                texts = batch.column(1)
                for i in range(batch.num_rows):
                    yield keys[i].as_py(), encoder.ids(texts[i].as_py() or "") + end

        held: list[tuple] = []

        def made() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*held, strict=True)] or [[] for _ in names]
            columns[5] = [base + x for x in columns[5]]
            columns[8] = [base + x for x in columns[8]]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for row in pack_stream(docs()):
            held.append(row)
            if len(held) == 20_000:
                yield made()
        if held:
            yield made()

    return run


def pack(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of all rows. A null text counts as empty: its document is its end id. Rows with the same key, also
    a null one, are packed each on its own. A very long text is encoded whole, one at a time, and its whole windows
    leave at once. Other columns are left out; an empty table gives no pieces."""
    ship(df.sparkSession)
    rows = df.select(df[key].cast("long").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(packer(vocabulary), SCHEMA)


def op2_hierarchical_packing(spark, sf_dir: str) -> DataFrame:
    """All documents by the word vocabulary in sequences of 2048 and shorter powers of two."""
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
