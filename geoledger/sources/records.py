"""Lines of splittable files with their place, and what depends on it: records with line breaks, ordered digests.

Spark cuts files into splits and reads the lines of a split in order. Sums over each split, and a running total over the
few splits of a file, tell for every line how many bytes and quotation marks stand before it in the file, so no task
ever reads a whole file.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as S

from geoledger.operators.quality import DataRejected
from geoledger.session import written

#: Bytes of a range that is hashed as one value; a line belongs to the range in which it starts.
RANGE_BYTES = 1 << 20
#: Bytes of a range that are put together at a time. Short lines take ten times their bytes on their way into a text, of
#: which Spark holds up to 128 a task, so whole ranges would fill an executor.
PIECE_BYTES = 1 << 14
#: Hashes that are folded into one.
FOLD = 1024


def placed_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, block, seq, value, offset, marks): the lines of all files, with the bytes and marks before each.

    `block` is where the line's split starts, `seq` orders the lines of a split. Lines end with a line feed; a carriage
    return before it stays in `value`. Files are read and written once, as later steps need the same splits.
    """
    lines = spark.read.option("lineSep", "\n").text([*paths]).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )
    staged = written(lines)
    size = F.octet_length("value").cast("long") + 1
    marks = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = staged.groupBy("path", "block").agg(F.sum(size).alias("size"), F.sum(marks).alias("marks"))
    splits = splits.select(
        "path",
        "block",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in ("size", "marks")],
    )
    above = Window.partitionBy("path", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    inside = staged.withColumns(
        {"offset": F.coalesce(F.sum(size).over(above), F.lit(0)), "marks": F.coalesce(F.sum(marks).over(above), F.lit(0))}
    )
    return inside.join(splits, ["path", "block"]).select(
        "path",
        "block",
        "seq",
        "value",
        (F.col("offset") + F.col("_size")).alias("offset"),
        (F.col("marks") + F.col("_marks")).alias("marks"),
    )


def records(lines: DataFrame) -> DataFrame:
    """(path, offset, record): lines put together where a line break stands between quotation marks.

    A line whose number of marks before it is odd goes on with the record of the line before. Only such lines, and
    those they go on from, are grouped; a record may reach over any number of splits. A carriage return that ends a
    record goes. Raises if the marks of a file are odd in number, as then nothing tells what is inside.
    """
    own = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    flagged = written(lines.withColumns({"inside": F.col("marks") % 2 == 1, "open": (F.col("marks") + own) % 2 == 1}))
    last = flagged.groupBy("path").agg(F.max_by("open", "offset").alias("open")).where("open").limit(1).collect()
    if last:
        raise DataRejected(f"{last[0]['path']}: quotation marks do not pair up")
    whole = flagged.where("NOT inside AND NOT open").select("path", "offset", F.col("value").alias("record"))
    parts = flagged.where("inside OR open")
    # The record a part belongs to starts at the last line that is not inside: found in its split, or in one before.
    starts = F.when(~F.col("inside"), F.col("offset"))
    here = Window.partitionBy("path", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.groupBy("path", "block").agg(F.max(starts).alias("_last"))
    carried = carried.select("path", "block", F.max("_last").over(before).alias("_carried"))
    owned = parts.withColumn("_own", F.max(starts).over(here)).join(carried, ["path", "block"])
    owned = owned.select("path", F.coalesce("_own", "_carried").alias("start"), "offset", "value")
    joined = owned.groupBy("path", "start").agg(F.sort_array(F.collect_list(F.struct("offset", "value"))).alias("lines"))
    text = F.array_join(F.col("lines.value"), "\n")
    found = whole.unionByName(joined.select("path", F.col("start").alias("offset"), text.alias("record")))
    return found.withColumn("record", F.regexp_replace("record", r"\r\z", ""))


def read_records(spark: SparkSession, path: str, header: Sequence[str], bad: str) -> DataFrame:
    """CSV rows of files with line breaks in quoted fields, cut in parallel; a ragged row stands in `bad`.

    Every file starts with the header.
    """
    found = written(records(placed_lines(spark, path)))
    schema = S.StructType([S.StructField(name, S.StringType()) for name in [*header, bad]])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad, "maxCharsPerColumn": "-1", "multiLine": "true"}
    kinds = ", ".join(f"`{f.name.replace('`', '``')}` STRING" for f in schema.fields)
    parsed = found.withColumn("row", F.from_csv("record", kinds, options))
    heads = parsed.where("offset = 0").select("path", F.col("row"), "record")
    names = [F.trim(F.replace(F.col("row").getField(h), F.lit("\ufeff"), F.lit(""))) for h in header]
    same = reduce(lambda a, b: a & b, [n.eqNullSafe(F.lit(h.strip())) for n, h in zip(names, header, strict=True)])
    if head := heads.where(~same).limit(1).collect():
        raise DataRejected(f"{head[0]['path']}: header {head[0]['record']}")
    rows = parsed.where("offset > 0").where(F.trim("record") != "")
    return rows.select(*[F.col("row").getField(name).alias(name) for name in [*header, bad]])


def pieces(lines: DataFrame) -> DataFrame:
    """(path, block, range, offset, value): lines of a split that stand in the same PIECE_BYTES of a range, as one text.

    Lines keep the partitions of their splits, so none travels. A piece is as long as PIECE_BYTES and one line at most.
    """
    place = [F.floor(F.col("offset") / size).alias(name) for name, size in (("range", RANGE_BYTES), ("piece", PIECE_BYTES))]
    cut = lines.select("path", "block", *place, "offset", "value")
    cut = cut.groupBy("path", "block", "range", "piece").agg(F.min("offset").alias("offset"), _in_order("offset", "value", "\n"))
    return cut.drop("piece")


def ordered_digest(lines: DataFrame) -> DataFrame:
    """(path, tree_sha256): a hash of each range of a file's bytes, folded in order to one.

    A range holds the lines that start in it, so it is as long as RANGE_BYTES and one line at most. Levels of FOLD
    hashes fold to one until one is left; other lines or another order of them give another root.
    """
    level = written(pieces(lines).groupBy("path", "range").agg(F.sha2(_in_order("offset", "value", "\n"), 256).alias("hash")))
    most = level.agg(F.max("range")).first()[0] or 0
    while True:
        above = F.floor(F.col("range") / FOLD).alias("range")
        level = level.groupBy("path", above).agg(F.sha2(_in_order("range", "hash", ""), 256).alias("hash"))
        if most < FOLD:
            return level.select("path", F.col("hash").alias("tree_sha256"))
        most, level = most // FOLD, written(level)


def _in_order(place: str, text: str, between: str) -> Column:
    """The texts of a group put together by their place."""
    return F.array_join(F.sort_array(F.collect_list(F.struct(place, text)))[text], between).alias(text)
