"""A corpus pipeline in five stages: quality rules, line dedup, near duplicates, secrets, packing.

A stage takes (spark, docs, sf_dir) and returns a table. Each but the last returns the columns of documents; the table
is written as Parquet and read again as the next stage's documents. Nulls and empty texts have a defined result in each
operator: quality rejects them, so later stages meet them only where a caller starts there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger.llm import jaccard, lines, packing, quality, secrets
from geoledger.llm.rows import documents, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def as_documents(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    if "n_chars" in columns:
        df = df.withColumn("n_chars", F.length("text").cast("long"))
    return df.select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and weak supervision keep."""
    return quality.assess(docs).where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated runs of lines; one of which no line is left goes."""
    found = lines.dedup_lines(docs)
    return as_documents(found.where("n_deleted = 0 OR n_deleted < n_lines"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.one_of_each(docs).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    return as_documents(secrets.mask_secrets(docs), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("packing", pack_sequences),
]

#: Tokens, expectation-maximisation and components are beyond SQL; tests compare with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
