"""Reading source snapshots and describing the files they came from."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from geoledger import constants as K
from geoledger.operators.quality import DataRejected
from geoledger.sources.records import ordered_digest, placed_lines, read_records

_BAD = "_bad"


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Header cells of the first file, as written."""
    first = spark.read.text(path).first()
    if first is None:
        raise DataRejected(f"{path} is empty")
    return next(csv.reader([first["value"].lstrip("\ufeff").rstrip("\r\n")]), [])


def check_header(header: Sequence[str], columns: Sequence[str]) -> list[str]:
    """The header's trimmed names, when they are exactly the expected columns in any order."""
    names = [name.strip(K.WHITESPACE) for name in header]
    repeated = sorted({name for name in names if names.count(name) > 1})
    missing = [name for name in columns if name not in names]
    extra = [name for name in names if name not in columns]
    if repeated or missing or extra:
        raise DataRejected(f"header: repeated {repeated}, missing {missing}, extra {extra}")
    return names


def read_raw(
    spark: SparkSession, path: str, header: Sequence[str], multi_line: bool = False
) -> DataFrame:
    """CSV rows as text under the given header cells, with the broken line in `_bad`.

    Spark splits the files at line breaks. Where one stands inside quotes, which leaves an odd number of quotation
    marks on its line, records are put together from lines in parallel; `multi_line` reads each file in one task.
    """
    if not multi_line:
        marks = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
        if not spark.read.text(path).where(marks % 2 == 1).isEmpty():
            return read_records(spark, path, header, _BAD)
    schema = S.StructType(
        [S.StructField(name, S.StringType()) for name in header] + [S.StructField(_BAD, S.StringType())]
    )
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BAD)
        .option("maxCharsPerColumn", -1)
        .csv(path)
    )


def read_snapshot(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = K.SOURCE_COLUMNS,
    multi_line: bool = False,
) -> DataFrame:
    """Text columns of a snapshot by name, plus `_bad` with the text of a ragged row.

    Every file of a folder must carry the first file's header. Blank rows are dropped whatever
    their number of cells. Fields may hold line breaks; `multi_line` reads each file in one task.
    """
    header = read_header(spark, path)
    names = check_header(header, columns)
    raw = read_raw(spark, path, header, multi_line)
    rows = raw.toDF(*names, _BAD)
    text = F.coalesce(F.col(_BAD), F.concat_ws("", *names))
    filled = F.regexp_replace(text, rf'{K.SPACE_PATTERN}|[,"]', "") != ""
    # A good row holds something in a cell even when that is a comma or a quotation mark.
    cells = F.trim(F.concat_ws("", *names), F.lit(K.WHITESPACE)) != ""
    return rows.where(F.when(F.col(_BAD).isNull(), cells).otherwise(filled)).select(*columns, _BAD)


def ragged_rows(snapshot: DataFrame) -> DataFrame:
    """Rows of read_snapshot whose number of cells differs from the header's."""
    return snapshot.where(F.col(_BAD).isNotNull()).select(F.col(_BAD).alias("line"))


#: Files up to this size are hashed as one value. Larger ones get the root of a tree of ranges.
WHOLE_BYTES = 64 << 20


def snapshot_meta(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256, tree_sha256) per file.

    `sha256` is the SHA-256 of the file's bytes, as its publisher would state it; it is null for a file that is too
    large to be one value. Such a file has `tree_sha256`, the root over hashes of its ranges in order, which Spark
    computes range by range; it is null for the others.
    """
    files = spark.read.format("binaryFile").load(path)
    small = files.where(F.col("length") <= WHOLE_BYTES).select(
        "path",
        F.col("length").alias("bytes"),
        F.sha2("content", 256).alias("sha256"),
        F.lit(None).cast("string").alias("tree_sha256"),
    )
    large = files.where(F.col("length") > WHOLE_BYTES).select("path", "length").collect()  # few, as each is large
    if not large:
        return small
    roots = ordered_digest(placed_lines(spark, *[r["path"] for r in large]))
    sizes = spark.createDataFrame([(r["path"], r["length"]) for r in large], "path string, bytes bigint")
    found = sizes.join(roots, "path").select("path", "bytes", F.lit(None).cast("string").alias("sha256"), "tree_sha256")
    return small.unionByName(found)


def source_digest(meta: DataFrame) -> DataFrame:
    """One row for all files of a snapshot: bytes and one digest.

    A single file has its own digest. Of several files it is the hash of their digests, whatever the files are called.
    """
    own = F.coalesce("sha256", "tree_sha256")
    return meta.agg(
        F.sum("bytes").alias("source_bytes"),
        F.when(F.count(F.lit(1)) == 1, F.max(own))
        .otherwise(F.sha2(F.array_join(F.sort_array(F.collect_list(own)), ""), 256))
        .alias("source_sha256"),
    )
