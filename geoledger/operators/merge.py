"""Upsert of a full snapshot into the current state, with counts and soft deactivation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoledger import constants as K

COMPARED = ("row_hash", "name_zh", "municipality_zh", "location_zh")
INCOMING_COLUMNS = K.SOURCE_COLUMNS + K.ATTACHED_NAME_COLUMNS + ("row_hash",)
CHANGE_COLUMNS = ("change", "reactivated")


def merge_join(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """One full outer join by id; both sides stay whole as the structs `c` and `i`."""
    c = current.select("id", F.struct(*current.columns).alias("c"))
    i = incoming.select("id", F.struct(*incoming.columns).alias("i"))
    return c.join(i, "id", "full_outer")


def _is_new() -> Column:
    return F.col("c").isNull() & F.col("i").isNotNull()


def _is_seen() -> Column:
    return F.col("i").isNotNull()


def _differs() -> Column:
    same = F.lit(True)
    for name in COMPARED:
        same = same & F.col(f"c.{name}").eqNullSafe(F.col(f"i.{name}"))
    return ~same


def _expires(snapshot_at: Column) -> Column:
    return (
        F.col("i").isNull()
        & F.coalesce(F.col("c.is_active"), F.lit(False))
        & (F.col("c.source_snapshot_at") < snapshot_at)
    )


def change_label(snapshot_at: Column) -> Column:
    """inserted, updated, unchanged, deactivated or absent for a merge_join row."""
    return (
        F.when(_is_new(), "inserted")
        .when(_is_seen() & _differs(), "updated")
        .when(_is_seen(), "unchanged")
        .when(_expires(snapshot_at), "deactivated")
        .otherwise("absent")
    )


def was_reactivated() -> Column:
    return _is_seen() & F.coalesce(~F.col("c.is_active"), F.lit(False))


def change_feed(current: DataFrame, incoming: DataFrame, snapshot_at: datetime) -> DataFrame:
    """Per id one change label and, apart from it, whether an inactive row came back."""
    at = F.lit(snapshot_at)
    needed = ["id", "is_active", "source_snapshot_at", *COMPARED]
    joined = merge_join(current.select(*needed), incoming.select("id", *COMPARED))
    return joined.select(
        "id", change_label(at).alias("change"), was_reactivated().alias("reactivated")
    )


def merge_counts(feed: DataFrame) -> DataFrame:
    """One row of counters over a change feed; reactivated overlaps the others."""
    return feed.agg(
        *[
            F.count_if(F.col("change") == label).alias(label)
            for label in ("inserted", "updated", "unchanged", "deactivated")
        ],
        F.count_if("reactivated").alias("reactivated"),
    )


def absent_keys(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Ids of the state that the snapshot no longer has."""
    return current.select("id").join(incoming.select("id"), "id", "left_anti")


def deactivate_missing(state: DataFrame, snapshot_at: datetime) -> DataFrame:
    """Switch off active rows last confirmed by an older snapshot."""
    at = F.lit(snapshot_at)
    expired = F.col("is_active") & (F.col("source_snapshot_at") < at)
    return state.withColumns(
        {
            "deactivated_at": F.when(expired, at).otherwise(F.col("deactivated_at")),
            "updated_at": F.when(expired, at).otherwise(F.col("updated_at")),
            "is_active": F.col("is_active") & ~expired,
        }
    )


def merge_with_changes(current: DataFrame, incoming: DataFrame, snapshot_at: datetime) -> DataFrame:
    """Next state plus the two change columns, in one pass over one join."""
    at = F.lit(snapshot_at)
    seen, new, expired = _is_seen(), _is_new(), _expires(at)
    renamed = ~F.col("c.name_zh").eqNullSafe(F.col("i.name_zh"))
    moved = _differs() | was_reactivated()

    def kept(name: str) -> Column:
        return F.col(f"c.{name}")

    lifecycle = {
        "name_zh_updated_at": F.when(new, F.when(F.col("i.name_zh").isNotNull(), at))
        .when(seen & renamed, at)
        .otherwise(kept("name_zh_updated_at")),
        "is_active": F.when(seen, True).when(expired, False).otherwise(kept("is_active")),
        "first_seen_at": F.when(new, at).otherwise(kept("first_seen_at")),
        "last_seen_at": F.when(seen, at).otherwise(kept("last_seen_at")),
        "deactivated_at": F.when(seen, F.lit(None).cast("timestamp"))
        .when(expired, at)
        .otherwise(kept("deactivated_at")),
        "updated_at": F.when(new | (seen & moved) | expired, at).otherwise(kept("updated_at")),
        "source_snapshot_at": F.when(seen, at).otherwise(kept("source_snapshot_at")),
    }
    columns = []
    for name in K.STATE_COLUMNS:
        if name == "id":
            value = F.col("id")
        elif name in lifecycle:
            value = lifecycle[name]
        else:
            value = F.when(seen, F.col(f"i.{name}")).otherwise(kept(name))
        columns.append(value.alias(name))
    return merge_join(current, incoming).select(
        *columns, change_label(at).alias("change"), was_reactivated().alias("reactivated")
    )


def merge_snapshot(current: DataFrame, incoming: DataFrame, snapshot_at: datetime) -> DataFrame:
    """Next state: upsert by id, stamp the lifecycle columns, switch off what is gone."""
    return merge_with_changes(current, incoming, snapshot_at).select(*K.STATE_COLUMNS)


def active(state: DataFrame) -> DataFrame:
    """Rows still in the source; a place of type closed may well be active."""
    return state.where("is_active")


def project_active(state: DataFrame) -> DataFrame:
    """The columns of the active view."""
    return active(state).select(*K.ACTIVE_VIEW_COLUMNS)


def status_stats(state: DataFrame, runs: DataFrame) -> DataFrame:
    """One row: nine counts over the state, last success time, last run and its status."""
    is_active, target = F.col("is_active"), F.col("type").isin(*K.TARGET_TYPES)
    has = {name: F.col(name).isNotNull() for name in ("name_zh", "municipality", "municipality_zh", "location_zh")}
    counts = state.agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.count_if(is_active).alias("rows_active"),
        F.count_if(~is_active).alias("rows_inactive"),
        F.count_if(is_active & target).alias("named_targets"),
        F.count_if(is_active & target & has["name_zh"]).alias("named_targets_with_zh"),
        F.count_if(has["name_zh"]).alias("rows_with_zh"),
        F.count_if(is_active & has["municipality"]).alias("rows_with_municipality"),
        F.count_if(is_active & has["municipality"] & has["municipality_zh"]).alias(
            "rows_with_municipality_zh"
        ),
        F.count_if(is_active & has["location_zh"]).alias("rows_with_location_zh"),
    )
    # Both sides are single aggregate rows, so the constant join key meets exactly one pair.
    one = F.lit(1).alias("_one")
    return counts.select("*", one).join(latest_run(runs).select("*", one), "_one", "left").drop("_one")


def latest_run(runs: DataFrame) -> DataFrame:
    """One row: time of the last success, number and status of the last run."""
    return runs.agg(
        F.max(F.when(F.col("status") == "succeeded", F.col("finished_at"))).alias("last_success_at"),
        F.max("run_id").alias("last_run_id"),
        F.max_by("status", "run_id").alias("last_run_status"),
    )
