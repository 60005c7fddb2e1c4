"""Counts of active places by facet, kept up by the changes of each merge instead of a recount."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoledger.operators.merge import merge_join

#: What places are counted by; the last one is whether the place has a name.
FACETS = ("type", "continent", "iso_country", "scheduled_service", "named")


def _facets(side: str = "") -> list[Column]:
    """Facet values of a row, or of one side of a merge."""
    at = f"{side}." if side else ""
    return [F.col(f"{at}{name}").alias(name) for name in FACETS[:-1]] + [F.col(f"{at}name_zh").isNotNull().alias("named")]


def facet_counts(state: DataFrame) -> DataFrame:
    """Active rows by all facets at once; null values are values."""
    return state.where("is_active").select(*_facets()).groupBy(*FACETS).agg(F.count(F.lit(1)).alias("places"))


def facet_deltas(current: DataFrame, incoming: DataFrame, snapshot_at: datetime) -> DataFrame:
    """Signed counts by facet that a merge brings: old values of active rows go out, new ones come in.

    Rows whose facets and activity stay add nothing, so what is kept is as large as the change. It belongs beside the
    change feed of the merge and is taken from the same join.
    """
    at = F.lit(snapshot_at)
    needed = ["id", *FACETS[:-1], "name_zh"]
    joined = merge_join(current.select(*needed, "is_active", "source_snapshot_at"), incoming.select(*needed))
    seen, was = F.col("i").isNotNull(), F.coalesce(F.col("c.is_active"), F.lit(False))
    stays = was & ~F.coalesce(F.col("c.source_snapshot_at") < at, F.lit(False))
    old, new = F.struct(*_facets("c")), F.when(seen, F.struct(*_facets("i"))).otherwise(F.struct(*_facets("c")))
    moves = joined.select(
        F.when(was, old).alias("old"), F.when(seen | stays, new).alias("new")
    ).where(~F.col("old").eqNullSafe(F.col("new")))
    sides = F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("old").alias("facet")), F.struct(F.lit(1).alias("sign"), F.col("new").alias("facet"))
    )
    signed = moves.select(F.inline(sides)).where("facet IS NOT NULL").select("facet.*", "sign")
    return signed.groupBy(*FACETS).agg(F.sum("sign").alias("places")).where("places <> 0")


def apply_deltas(counts: DataFrame, *deltas: DataFrame) -> DataFrame:
    """Counts after some merges. Reads the counts and the deltas only; facets without places go."""
    for delta in deltas:
        counts = counts.unionByName(delta)
    return counts.groupBy(*FACETS).agg(F.sum("places").alias("places")).where("places <> 0")


def counts_by(counts: DataFrame, *facets: str, only: Sequence[str] = ()) -> DataFrame:
    """Places by some of the facets, from the counts by all; `only` some types."""
    kept = counts.where(F.col("type").isin(*only)) if only else counts
    return kept.groupBy(*facets).agg(F.sum("places").alias("places"))
