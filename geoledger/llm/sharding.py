"""Rendezvous hashing of stable record keys over weighted shards.

Each shard scores a key by -weight / ln(u), u being a hash of key and shard in (0, 1); the highest score takes the
row. A new shard can only win rows for itself, the others keep theirs; a changed weight moves rows only to or from
that shard. The decision needs the key and the list of weights, no other row and no state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoledger.llm.rows import documents, text_of

#: Rows that one numbering task should sort at most, on average.
ROWS_A_BUCKET = 50_000
#: Equal rows that one task writes out of a counted group.
COPIES_A_TASK = 10_000
SHARDS = 24


def score(key: Column, shard: int, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key.cast("string"), F.lit(shard)), 11)
    return F.lit(-float(weight)) / F.log((bits.cast("double") + 0.5) * F.lit(2.0**-53))


def winner(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key; equal scores go to the lower shard. Null keys are one key of their own."""
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("shards need weights of 0 or more, one of them above 0")
    scores = [
        F.struct(score(key, i, w).alias("score"), F.lit(-i).alias("back"))
        for i, w in enumerate(weights)
        if w > 0
    ]
    best = F.array_max(F.array(*scores))
    return (-best["back"]).cast("int")


def assign(df: DataFrame, key: str, weights: Sequence[float], column: str = "shard") -> DataFrame:
    """All rows with the shard of their key; a column of that name is replaced. An empty table stays empty."""
    return df.withColumn(column, winner(F.col(key), weights))


def numbered(df: DataFrame, group: str, keys: Sequence[str], column: str = "slot") -> DataFrame:
    """The columns group and keys, with a number in each group without gaps from 0.

    Rows equal in all of them are counted first and written out again last, in pieces, so that neither a frequent key
    nor a repeated row meets in one task. Buckets by hash of the keys are numbered on their own and shifted by the
    sizes of those before, so no task sorts a whole group. The number of buckets follows the number of rows.
    """
    wide = df.select(group, *keys)
    groups = max(1, wide.select(group).distinct().count())
    buckets = max(1, -(-wide.count() // (groups * ROWS_A_BUCKET)))
    counted = (
        wide.groupBy(group, *keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    )
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        counted.groupBy(group, "_bucket")
        .agg(F.sum("_n").alias("_size"))
        .select(
            F.col(group).alias("_group"),
            F.col("_bucket").alias("_b"),
            F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"),
        )
    )
    inside = (
        Window.partitionBy(group, "_bucket")
        .orderBy(*[F.col(k).asc_nulls_first() for k in keys])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    started = counted.withColumn("_first", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(
        sizes, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_bucket") == F.col("_b"))
    )
    pieces = started.select(
        group,
        *keys,
        (F.col("_first") + F.col("_shift")).alias("_from"),
        "_n",
        F.explode(
            F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES_A_TASK))
        ).alias("_piece"),
    ).repartition(*[F.col(k) for k in keys], F.col("_piece"))
    first = F.col("_piece") * COPIES_A_TASK
    last = F.least(first + COPIES_A_TASK, F.col("_n")) - 1
    return pieces.select(
        group,
        *keys,
        "_from",
        F.explode(F.sequence(first, last)).alias("_copy"),
    ).select(group, *keys, (F.col("_from") + F.col("_copy")).cast("long").alias(column))


def write_shards(df: DataFrame, path: str, key: str, weights: Sequence[float], files: int = 1) -> None:
    """All rows as Parquet in one folder a shard, each of up to so many files."""
    spread = F.pmod(F.xxhash64(*[c for c, kind in df.dtypes if not kind.startswith("map")]), F.lit(files))
    assign(df, key, weights, "shard").repartition(F.col("shard"), spread).write.partitionBy("shard").parquet(path)


def op3_rendezvous_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents over 24 shards of equal weight, and over 25."""
    text = text_of()
    docs = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
    )
    placed = assign(docs, "doc_id", [1.0] * SHARDS)
    slots = numbered(placed, "shard", ["doc_id", "size", "text_crc32"])
    return assign(slots, "doc_id", [1.0] * (SHARDS + 1), "grown_shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )
