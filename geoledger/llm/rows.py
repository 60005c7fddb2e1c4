"""Helpers shared by the operators of this package: reading, storing, ordering."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoledger.session import ensure_checkpoint_dir, ship, written

__all__ = ["documents", "stored", "text_of", "shared_folder", "conf_int", "keeping", "ship"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, so that later steps read them and lineage ends."""
    return written(df)


def shared_folder(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark)


def text_of(column: str = "text") -> Column:
    """A text, the empty one for null."""
    return F.coalesce(F.col(column).cast(T.StringType()), F.lit(""))


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))


def keeping(df: DataFrame, columns: dict[str, str], body: Callable[[DataFrame], DataFrame], own: Sequence[str]) -> DataFrame:
    """An operator's rows with all columns of its input, whatever their names.

    `columns` maps the operator's names to the input's; the other columns travel in a box and come back in place. The
    operator adds the columns `own`, which replace input columns of the same name.
    """
    used = {theirs: ours for ours, theirs in columns.items()}
    names = [c for c in df.columns if c in used or c.lower() not in {n.lower() for n in own}]
    rest = [F.col(f"`{c}`") for c in names if c not in used]
    box = F.struct(*rest) if rest else F.struct(F.lit(0).alias("none"))
    done = body(df.select(*[F.col(f"`{theirs}`").alias(ours) for ours, theirs in columns.items()], box.alias("box")))
    back = [F.col(used[c]).alias(c) if c in used else F.col("box").getField(c).alias(c) for c in names]
    added = [n for n in own if n not in used]
    return done.select(*back, *added)
