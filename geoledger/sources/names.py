"""The versioned name table and the archive of names from a completion service."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.functions import text as T
from geoledger.operators.quality import DataRejected, enforce, require_unique
from geoledger.session import written
from geoledger.sources.snapshot import read_header, read_raw

ARCHIVE_PREFIX = "llm:"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whichever file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _read_strict(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    header = read_header(spark, path)
    if header != list(columns):
        raise DataRejected(f"{path}: header {header} is not {list(columns)}")
    rows = written(read_raw(spark, path, header))
    enforce(rows.where("_bad is not null").select(columns[0], "_bad"), f"{path}: ragged rows")
    return rows.drop("_bad")


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """Name entries; the header must be the 15 columns in order and ids must be unique."""
    rows = _read_strict(spark, path, K.NAME_COLUMNS)
    ids = T.parse_long("id")
    enforce(rows.where(ids.isNull()).select("id"), f"{path}: id is not a whole number")
    entries = rows.select(
        ids.alias("id"), *[T.blank_to_null(name).alias(name) for name in K.NAME_COLUMNS[1:]]
    )
    enforce(require_unique(entries, "id"), f"{path}: id occurs more than once")
    return entries


def _write_csv(df: DataFrame, path: str) -> None:
    text = df.select(*[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in df.columns])
    text.write.mode("overwrite").option("header", True).option("escape", '"').option(
        "emptyValue", ""
    ).csv(path)


def write_names(entries: DataFrame, path: str) -> None:
    """Name entries as CSV part files that are sorted by id as a whole."""
    _write_csv(entries.select(*K.NAME_COLUMNS).orderBy("id"), path)


def archive_rows(entries: DataFrame) -> DataFrame:
    """The entries an archive keeps: names that came from a completion service."""
    return entries.where(F.col("name_zh_source").startswith(ARCHIVE_PREFIX)).select(
        "id", "ident", "name", "name_zh", F.col("name_zh_source").alias("source")
    )


def archive_names(rows: DataFrame) -> DataFrame:
    """(id, name_zh, source) of archive rows that hold a name."""
    return rows.where(T.blank_to_null("name_zh").isNotNull()).select(
        "id",
        "name_zh",
        F.coalesce(T.blank_to_null("source"), F.lit(f"{ARCHIVE_PREFIX}unknown")).alias("source"),
    )


def write_archive(entries: DataFrame, path: str) -> None:
    _write_csv(archive_rows(entries).select(*K.ARCHIVE_COLUMNS).orderBy("id"), path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Archived names; an archive that does not exist yet is empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "id bigint, name_zh string, source string")
    rows = _read_strict(spark, path, K.ARCHIVE_COLUMNS)
    return archive_names(rows.withColumn("id", T.parse_long("id")))
