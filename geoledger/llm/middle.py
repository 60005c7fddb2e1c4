"""Fill-in-middle transformation by a learned index of the places where a text may be cut.

A text is cut into units: a run of ASCII letters, or one other character. The offsets of all unit boundaries are
learned as a function of their rank: pieces of straight line between knots, each within ERROR of every offset it
covers, and one signed byte per boundary for what is left. A cut is predicted from the knots beside its rank and
corrected by its stored byte, which makes it exact.

The index is built in Python, one text at a time. Looking up cuts, moving the middle and restoring it are column
expressions.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoledger.llm.rows import documents, keeping, ship, text_of

#: Code points that a predicted offset may be off; what is left fits one signed byte.
ERROR = 127
SENTINELS = "<[PSM]>"
#: Percent of the texts that are transformed, and of those the percent with the suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
INDEX = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("ranks", T.ArrayType(T.LongType())),
        T.StructField("offsets", T.ArrayType(T.LongType())),
        T.StructField("residuals", T.BinaryType()),
    ]
)
OWN = ["n", "form", "prefix_chars", "middle_chars", "output"]


def boundaries(data):
    """Offsets in code points of all unit boundaries of a UTF-8 text, its start and its end included."""
    import numpy as np

    first = (data & 0xC0) != 0x80
    letter = ((data | 0x20) - np.uint8(97)) < 26
    inside = letter.copy()
    inside[1:] &= letter[:-1]
    inside[:1] = False
    at = np.flatnonzero(first & ~inside)
    chars = int(np.count_nonzero(first))
    if chars < len(data):
        at = np.cumsum(first, dtype="i8")[at] - 1
    return np.append(at, chars)


def line(first, last, ranks):
    """Offsets predicted on the line between two knots (rank, offset), rounded down."""
    return first[1] + (ranks - first[0]) * (last[1] - first[1]) // max(last[0] - first[0], 1)


def fit(offsets, error: int = ERROR):
    """Knots as ranks and offsets, and the residual of every offset as a signed byte.

    A stretch of ranks whose line is off by more than `error` somewhere is halved.
    """
    import numpy as np

    n = len(offsets) - 1
    residuals, knots, open_ = np.zeros(n + 1, "i1"), [], [(0, n)]
    while open_:
        lo, hi = open_.pop()
        off = offsets[lo:hi] - line((lo, offsets[lo]), (hi, offsets[hi]), np.arange(lo, hi))
        if hi - lo > 1 and max(off.max(), -off.min()) > error:
            open_ += [((lo + hi) // 2, hi), (lo, (lo + hi) // 2)]
        else:
            residuals[lo:hi] = off
            knots.append(lo)
    knots = np.array([*knots, n] if n else [0])
    return knots, offsets[knots], residuals


def look_up(knots, offsets, residuals, ranks):
    """The offsets of boundaries by their ranks."""
    import numpy as np

    ranks = np.asarray(ranks)
    at = np.clip(np.searchsorted(knots, ranks, "right") - 1, 0, max(len(knots) - 2, 0))
    after, widths = np.minimum(at + 1, len(knots) - 1), np.maximum(np.diff(knots, append=knots[-1]), 1)
    steps = (ranks - knots[at]) * (offsets[after] - offsets[at])
    return offsets[at] + steps // widths[at] + residuals[ranks]


@F.arrow_udf(INDEX)
def boundary_index(text: pa.Array) -> pa.Array:
    """The index of a text's unit boundaries; of a null one that of the empty text."""
    import numpy as np

    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
    columns: list[list] = [[], [], [], []]
    for value in text:
        raw = value.as_buffer()
        data = np.frombuffer(raw, "u1") if raw is not None and raw.size else np.empty(0, "u1")
        knots, offsets, residuals = fit(boundaries(data))
        for column, x in zip(columns, (len(residuals) - 1, knots, offsets, residuals.tobytes()), strict=True):
            column.append(x)
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.StructArray.from_arrays(arrays, [f.name for f in INDEX.fields])


def offset_at(index: Column, rank: Column) -> Column:
    """The offset in code points of the boundary of a rank: the line beside it, corrected by the stored byte."""
    ranks, offsets = index["ranks"], index["offsets"]
    knot = F.greatest(
        F.least(F.size(F.filter(ranks, lambda x: x <= rank)), F.size(ranks) - 1), F.lit(1)
    )  # counted from one
    lo, hi = F.get(ranks, knot - 1), F.get(ranks, knot)
    first, last = F.get(offsets, knot - 1), F.get(offsets, knot)
    predicted = first + F.call_function("div", (rank - lo) * (last - first), F.greatest(hi - lo, F.lit(1)))
    byte = F.conv(F.hex(F.substring(index["residuals"], (rank + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    exact = predicted + F.when(byte > 127, byte - 256).otherwise(byte)
    return F.when(F.size(ranks) > 1, exact).otherwise(F.lit(0).cast("long"))


def hashes(key: Column) -> list[Column]:
    """Four unsigned 32-bit integers by a key."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row with its number of units, form (plain, psm, spm), cut lengths and transformed text `output`.

    A null text counts as empty, and an empty one stays plain, as does one that holds a sentinel. Rows with one key
    are cut by the same hashes; a null key hashes as "null". Long texts are indexed whole, one at a time. Other
    columns stay, whatever their names; columns named like the added ones are replaced. An empty table gives none.
    """
    ship(df.sparkSession)

    def body(rows: DataFrame) -> DataFrame:
        h1, h2, h3, h4 = hashes(F.col("key"))
        rows = rows.withColumn("whole", text_of("text")).withColumn("index", boundary_index("whole"))
        n = F.col("index")["n"]
        plain = (n == 0) | F.col("whole").rlike(SENTINELS) | (h3 % 100 >= TRANSFORMED)
        rows = rows.select(
            "*",
            n.alias("n"),
            F.when(plain, "plain").when(h4 % 100 < SUFFIX_FIRST, "spm").otherwise("psm").alias("form"),
            F.least(h1 % (n + 1), h2 % (n + 1)).alias("first_cut"),
            F.greatest(h1 % (n + 1), h2 % (n + 1)).alias("second_cut"),
        )
        start, end = (offset_at(F.col("index"), F.col(c)) for c in ("first_cut", "second_cut"))
        cut = F.col("form") != "plain"
        rows = rows.withColumns(
            {"prefix_chars": F.when(cut, start), "middle_chars": F.when(cut, end - start)}
        )
        return rows.withColumn("output", transformed(*[F.col(c) for c in ("whole", "form", "prefix_chars", "middle_chars")]))

    return keeping(df, {"key": key, "text": text}, body, OWN)


def transformed(text: Column, form: Column, prefix_chars: Column, middle_chars: Column) -> Column:
    """The text with its middle moved to the end, by lengths in code points."""
    start, size = prefix_chars.cast("int"), middle_chars.cast("int")
    prefix, middle = F.substring(text, F.lit(1), start), F.substring(text, start + 1, size)
    suffix = F.substring(text, start + size + 1, F.lit(2**31 - 1))
    return (
        F.when(form == "psm", F.concat(F.lit("<P>"), prefix, F.lit("<S>"), suffix, F.lit("<M>"), middle))
        .when(form == "spm", F.concat(F.lit("<S>"), suffix, F.lit("<P>"), prefix, F.lit("<M>"), middle))
        .otherwise(text)
    )


def restored(output: Column, form: Column) -> Column:
    """The text of a transformed one. Its parts hold no sentinel, so the sentinels are found by their looks."""
    parts = F.split(output, SENTINELS, -1)
    one, two, three = (F.get(parts, F.lit(k)) for k in (1, 2, 3))
    return (
        F.when(form == "psm", F.concat(one, three, two)).when(form == "spm", F.concat(two, three, one)).otherwise(output)
    )


def op11_learned_rank_middle(spark, sf_dir: str) -> DataFrame:
    """All documents cut at two places by hash, with the digests of the transformed and the restored text."""
    done = fill_in_middle(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLE = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, 'null')) AS d,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
  FROM documents),
numbered AS (
  SELECT doc_id, t, u, len(u) AS n, list_transform(range(4), lambda k: list_reduce(
           list_transform(range(8), lambda j: instr('0123456789abcdef', substr(d, 8 * k + j + 1, 1)) - 1),
           lambda x, y: 16 * x + y)) AS h
  FROM hashed),
formed AS (
  SELECT doc_id, t, u, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS p, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS q,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbered),
parted AS (
  SELECT *, array_to_string(u[1:p], '') AS prefix, array_to_string(u[p + 1:q], '') AS middle,
         array_to_string(u[q + 1:], '') AS suffix
  FROM formed)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parted
"""
