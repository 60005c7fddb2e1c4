"""Document fingerprints: a Merkle tree over sections, paragraphs and segments.

A text is cut into paragraphs at line breaks, a paragraph into segments behind spaces that the bytes before them
choose, behind the first words and after a longest length, and paragraphs are gathered into sections that end where a paragraph's own hash says so. Cuts depend on near-by
content only, so an edit changes the branches it touches and moves no others. A node's hash covers its children's.

The fingerprint is one line: the root, then the sections with their paragraphs with their segments' shortened hashes.
Roots test equality; equal sections and paragraphs are passed over, and what differs is located by its branch.
"""

from __future__ import annotations

import bisect
import hashlib
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoledger.llm.rows import conf_int, documents, ship, text_of

#: A segment ends behind one in so many spaces, a section behind one in so many paragraphs, on average.
SPACES_A_SEGMENT = 8
PARAGRAPHS_A_SECTION = 4
#: Longest segment. Where a longer one has no space for LEAST_BYTES, it ends behind one in so many characters on average.
MOST_BYTES, LEAST_BYTES, CHARACTERS_A_SEGMENT = 128, 16, 32
#: Bytes from the start of a paragraph in which each word is a segment, and the longest first segment.
OPENING_BYTES, FIRST_BYTES = 16, 8
#: Text of a range at most, on average; there are as many ranges as shuffle partitions at least.
RANGE_BYTES = 256 << 20
#: Bytes of a segment's hash in the fingerprint. Of two unrelated texts of 2 million segments each, one segment matches by
#: chance in some 1.4 % of cases (n * m / 2^48).
SHORT = 6
RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def mixed_of(units, places):
    """A hash of the eight bytes that end at each place."""
    import numpy as np

    mixed = np.zeros(len(places), "u8")
    for k in range(8):
        mixed = (mixed ^ units[places - k]) * np.uint64(0x100000001B3)
    return mixed >> np.uint64(13)


def further_ends(data: bytes, units, start: int, end: int) -> list[int]:
    """Ends inside a segment that is too long: where eight bytes of a stretch without spaces choose so, else behind the
    last space in reach, else behind the last whole character in reach."""
    import numpy as np

    chosen: list[int] = []
    if max(map(len, data[start : end + 1].split(b" "))) >= LEAST_BYTES:
        own = units[start : end + 2]
        places = np.arange(end - start + 1)
        behind = places - np.maximum.accumulate(np.where(own[: len(places)] == 32, places, -1))
        whole = np.r_[own[1:] & 0xC0 != 0x80, True][: len(places)]
        places = places[(behind >= LEAST_BYTES) & whole]
        chosen = (places[mixed_of(own, places) % np.uint64(CHARACTERS_A_SEGMENT) == 0] + start).tolist()
    out, at = [], start
    while end - at >= MOST_BYTES:
        reach = at + MOST_BYTES - 1
        k = bisect.bisect_left(chosen, at + LEAST_BYTES - 1)
        if k < len(chosen) and chosen[k] <= reach:
            cut = chosen[k]
        else:
            cut = data.rfind(b" ", at, reach + 1)
            if cut < 0:
                cut = reach
                while cut > reach - 3 and data[cut + 1] & 0xC0 == 0x80:
                    cut -= 1
        out.append(cut)
        at = cut + 1
    return out


def segment_ends(data: bytes) -> list[int]:
    """Ends of segments: behind spaces chosen by the eight bytes that end there, behind line breaks, and the end. The
    opening of a paragraph is cut behind each word, so that short texts have segments too, and its first segment and
    all others have a longest length."""
    import numpy as np

    units, last = np.frombuffer(data, "u1"), len(data) - 1
    spaces = np.flatnonzero(units == 32)
    late = spaces[spaces >= 8]
    chosen = late[mixed_of(units, late) % np.uint64(SPACES_A_SEGMENT) == 0]
    breaks = np.flatnonzero(units == 10)
    starts = np.r_[0, breaks + 1]
    words = spaces[np.r_[np.diff(spaces) > 1, True][: len(spaces)]]
    words = words[words - starts[np.searchsorted(starts, words, "right") - 1] < OPENING_BYTES]
    ends = np.unique(np.r_[chosen, breaks, words, last])
    starts = starts[starts <= last]
    firsts = starts[ends[np.searchsorted(ends, starts)] - starts >= FIRST_BYTES] + FIRST_BYTES - 1
    for _ in range(3):
        firsts = firsts - (units[firsts + 1] & 0xC0 == 0x80)
    ends = np.union1d(ends, firsts)
    opened = np.r_[0, ends[:-1] + 1]
    wide = np.flatnonzero(ends - opened >= MOST_BYTES)
    more = [x for k in wide.tolist() for x in further_ends(data, units, int(opened[k]), int(ends[k]))]
    ends = np.union1d(ends, np.array(more, "i8")).tolist()
    return [*ends, last] if data.endswith(b"\n") else ends  # behind a last line break stands an empty paragraph


def fingerprint(text: str) -> str:
    """Equal texts have equal fingerprints; the empty text has a tree of one empty paragraph."""
    from xxhash import xxh3_128_digest

    data = text.encode("utf-8", "surrogatepass")
    sections: list[tuple[bytes, list[str]]] = []
    hashes: list[bytes] = []
    written: list[str] = []
    leaves: list[bytes] = []
    start, last = 0, len(data) - 1
    for end in segment_ends(data):
        leaves.append(xxh3_128_digest(data[start : end + 1]))
        start = end + 1
        if end == last or data[end] == 10:
            own = digest(b"p" + b"".join(leaves))
            hashes.append(own)
            written.append(b"".join([x[:SHORT] for x in leaves]).hex())
            leaves = []
            if own[0] % PARAGRAPHS_A_SECTION == 0:
                sections.append((digest(b"s" + b"".join(hashes)), written))
                hashes, written = [], []
    if hashes:
        sections.append((digest(b"s" + b"".join(hashes)), written))
    root = digest(b"r" + b"".join(h for h, _ in sections)).hex()
    return f"{root}:" + "/".join(";".join(w) for _, w in sections)


def paragraphs_of(tree: str) -> list[str]:
    return tree[33:].replace("/", ";").split(";")


def leaves_of(tree: str) -> Counter:
    """Shortened segment hashes with their numbers."""
    size = 2 * SHORT
    return Counter([p[i : i + size] for p in paragraphs_of(tree) for i in range(0, len(p), size)])


def likeness(one: str, other: str) -> float:
    """The share of segments that both trees have, 0 to 1. Equal roots end the comparison."""
    if one[:32] == other[:32]:
        return 1.0
    a, b = leaves_of(one), leaves_of(other)
    if len(a) > len(b):
        a, b = b, a
    both = sum([min(n, b[leaf]) for leaf, n in a.items() if leaf in b])
    return 2 * both / (a.total() + b.total())


def differing(one: str, other: str) -> tuple[list[int], list[int]]:
    """The numbers of the paragraphs on either side whose branch the other side does not have."""
    if one[:32] == other[:32]:
        return [], []
    a, b = paragraphs_of(one), paragraphs_of(other)

    def odd(own: list[str], there: list[str]) -> list[int]:
        left, out = Counter(there), []
        for k, p in enumerate(own):
            if left[p] > 0:
                left[p] -= 1
            else:
                out.append(k)
        return out

    return odd(a, b), odd(b, a)


@F.pandas_udf(T.StringType())
def fingerprint_of(text: pd.Series) -> pd.Series:
    return text.fillna("").map(fingerprint)


@F.pandas_udf(T.DoubleType())
def likeness_of(one: pd.Series, other: pd.Series) -> pd.Series:
    return pd.Series([None if a is None or b is None else likeness(a, b) for a, b in zip(one, other, strict=True)])


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_neighbours(batches):
    """For mapInArrow over (bucket, guest, doc_id, text) in order: each document against the one behind it."""
    import pyarrow as pa

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [x.split()[0] for x in RESULT.split(", ")]
    held, out = None, []

    def against(following: str, its: str) -> None:
        key, text, own = held
        changed = edited(text, following)
        its_own = fingerprint(changed)
        out.append(
            (
                key,
                len(text),
                hashlib.sha256(changed.encode()).hexdigest(),
                own,
                its_own,
                likeness(own, its_own),
                likeness(own, its),
            )
        )

    def made() -> pa.RecordBatch:
        columns = [list(c) for c in zip(*out, strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        guests, keys, texts = batch.column("guest"), batch.column("doc_id"), batch.column("text")
        for i in range(batch.num_rows):
            text = texts[i].as_py()
            own = fingerprint(text)
            if held is not None:
                against(text, own)
            held = None if guests[i].as_py() else (keys[i].as_py(), text, own)
            if len(out) == 500:
                yield made()
    if out:
        yield made()


def neighbours(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row against the next one by ascending key, the last against the first.

    Null keys come first, a null text is an empty one, and rows with one key are ordered by a hash of their text; equal
    rows follow each other. One row alone follows itself; an empty table gives no rows.

    The keys are range-partitioned first, without texts; the least key of each range is exact and opens a bucket. Texts
    then move once, to their bucket, and the first row of each bucket is a guest at the end of the one before.
    """
    ship(df.sparkSession)
    rows = df.select(df[key].cast("long").alias("doc_id"), text_of(text).alias("text")).select(
        "doc_id",
        "text",
        F.struct(
            F.col("doc_id").isNotNull().cast("int").alias("a"),
            F.coalesce("doc_id", F.lit(0)).alias("b"),
            F.xxhash64("text").alias("c"),
        ).alias("place"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(conf_int(df.sparkSession, "spark.sql.shuffle.partitions", 200), -(-size // RANGE_BYTES))
    firsts = (
        rows.select("place")
        .repartitionByRange(ranges, "place")
        .withColumn("range", F.spark_partition_id())
        .groupBy("range")
        .agg(F.min("place").alias("first"))
        .collect()
    )
    cuts = sorted(tuple(r["first"]) for r in firsts)  # one a range

    @F.pandas_udf("bucket int, opens boolean")
    def bucket(place: pd.DataFrame) -> pd.DataFrame:
        at = [bisect.bisect_right(cuts, p) - 1 for p in zip(place["a"], place["b"], place["c"], strict=True)]
        keys = zip(place["a"], place["b"], place["c"], strict=True)
        return pd.DataFrame({"bucket": at, "opens": [cuts[k] == p for k, p in zip(at, keys, strict=True)]})

    placed = rows.withColumn("_at", bucket("place"))
    own = placed.select("_at.bucket", F.lit(False).alias("guest"), "place", "doc_id", "text")
    guests = (
        placed.where("_at.opens")
        .groupBy(F.col("_at.bucket").alias("opened"))
        .agg(F.first("place").alias("place"), F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
        .select(
            F.pmod(F.col("opened") - 1, F.lit(max(1, len(cuts)))).alias("bucket"),
            F.lit(True).alias("guest"),
            "place",
            "doc_id",
            "text",
        )
    )
    order = ["bucket", "guest", "place"]
    return (
        own.unionByName(guests)
        .repartitionById(max(1, len(cuts)), F.col("bucket"))
        .sortWithinPartitions(*order)
        .select("bucket", "guest", "doc_id", "text")
        .mapInArrow(compare_neighbours, RESULT)
    )


def op8_merkle_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, compared with each other and with the next document."""
    return neighbours(documents(spark, sf_dir))
