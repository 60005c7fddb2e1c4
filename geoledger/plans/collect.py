"""The collection job: one snapshot in, one new version of the state out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.operators import merge as M
from geoledger.operators import quality as Q
from geoledger.operators.explore import coverage
from geoledger.session import written
from geoledger.sources.names import path_exists, read_names
from geoledger.sources.published import attach_names
from geoledger.sources.snapshot import read_snapshot, snapshot_meta, source_digest
from geoledger.sources.state import StateTable


@dataclass(frozen=True)
class CollectResult:
    run_id: int
    version: int
    rows_total: int
    rows_inserted: int
    rows_updated: int
    rows_unchanged: int
    rows_reactivated: int
    rows_deactivated: int
    rows_named_targets: int
    rows_missing_zh: int


def incoming_rows(good: DataFrame, names: DataFrame) -> DataFrame:
    """Snapshot rows with their names and row hash, as the merge takes them."""
    return attach_names(good, names).withColumn("row_hash", Q.row_hash()).select(*M.INCOMING_COLUMNS)


def collect_frames(
    current: DataFrame, raw: DataFrame, names: DataFrame, snapshot_at: datetime
) -> DataFrame:
    """The whole job as one plan: rows that pass the rules, named, hashed and merged."""
    good, _ = Q.validate_rows(raw)
    return M.merge_with_changes(current, incoming_rows(good, names), snapshot_at)


def load_names(spark: SparkSession, path: str | None, allow_missing: bool) -> DataFrame | None:
    """Name entries, or NULL when there are none and that is allowed."""
    if path is not None and path_exists(spark, path):
        names = read_names(spark, path)
        if allow_missing or not names.isEmpty():
            return names
        raise Q.DataRejected(f"{path} holds no names")
    if not allow_missing:
        raise Q.DataRejected(f"names file {path} does not exist")
    return None


def checked_snapshot(
    spark: SparkSession,
    path: str,
    multi_line: bool = False,
    keep: Callable[[DataFrame], DataFrame] = written,
) -> DataFrame:
    """Typed rows of a snapshot; raises when any row breaks a rule.

    The text is parsed once, into the table that `keep` writes; the checks and all later steps
    read that table.
    """
    raw = read_snapshot(spark, path, multi_line=multi_line)
    typed = Q.type_rows(raw, ragged=F.col("_bad").isNotNull())
    kept = keep(typed)
    broken = kept.where("reason is not null").select("raw_id", "ident", "reason")
    Q.enforce(broken, f"{path}: rows that break a rule")
    return kept.select(*K.SOURCE_COLUMNS)


def collect_job(
    spark: SparkSession,
    snapshot_path: str,
    state: StateTable,
    names_path: str | None = None,
    *,
    snapshot_at: datetime | None = None,
    run_id: int | None = None,
    snapshot_key: str = "",
    allow_missing_names: bool = False,
    min_rows: int = K.MIN_ROWS,
    min_large: int = K.MIN_LARGE,
    multi_line: bool = False,
) -> CollectResult | None:
    """Validate, name, merge and commit one snapshot.

    Input that breaks a rule stops the job before a run starts. A failure after that is logged and
    leaves the visible state as it was. A snapshot whose key was taken before, or a run that already
    succeeded, is not repeated (NULL result). When another writer commits first, the merge starts
    again from that writer's version.
    """
    if snapshot_key and state.took(snapshot_key) or run_id is not None and state.succeeded(run_id):
        return None
    names = load_names(spark, names_path, allow_missing_names)
    if names is None:
        empty = ", ".join(f"{name} string" for name in K.ATTACHED_NAME_COLUMNS)
        names = spark.createDataFrame([], f"id bigint, {empty}")
    run_id = state.next_run_id() if run_id is None else run_id
    at = snapshot_at or datetime.now(timezone.utc)

    staged = checked_snapshot(spark, snapshot_path, multi_line, lambda df: state.stage(run_id, df))
    Q.enforce(Q.require_unique(staged, "id", "ident"), f"{snapshot_path}: keys that occur twice")
    rows_total, _ = Q.enforce_gate(Q.sanity_gate(staged, min_rows, min_large))
    if rows_total == 0:
        raise Q.DataRejected(f"{snapshot_path} holds no rows")

    source = source_digest(snapshot_meta(spark, snapshot_path)).first()
    names_digest = None
    if names_path is not None and path_exists(spark, names_path):
        names_digest = source_digest(snapshot_meta(spark, names_path)).first()["source_sha256"]
    known = {"source_url": snapshot_path, "names_file_sha256": names_digest, "snapshot_key": snapshot_key or None}
    state.log(run_id, at, "running", **known)
    try:
        committed = False
        while not committed:
            version = (state.version() or 0) + 1
            folder = f"run={run_id}-v={version}"
            current = state.read(version - 1 or None)
            merged = M.merge_with_changes(current, incoming_rows(staged, names), at)
            state.write_folder(folder, merged, rows_total)
            committed = state.commit(version, folder, snapshot_key)
        counts = M.merge_counts(state.changes(version)).first()
        covered = coverage(state.seen(version)).first()
        numbers = {
            "rows_total": rows_total,
            **{
                f"rows_{name}": counts[name]
                for name in ("inserted", "updated", "unchanged", "reactivated", "deactivated")
            },
            "rows_named_targets": covered["targets"],
            "rows_missing_zh": covered["missing"],
        }
        state.log(
            run_id,
            datetime.now(timezone.utc),
            "succeeded",
            source_sha256=source["source_sha256"],
            source_bytes=source["source_bytes"],
            version=version,
            **known,
            **numbers,
        )
    except Exception as error:
        state.log(
            run_id,
            datetime.now(timezone.utc),
            "failed",
            **known,
            error_message=f"{type(error).__name__}: {error}",
        )
        raise
    return CollectResult(run_id=run_id, version=version, **numbers)


def state_status(state: StateTable) -> DataFrame:
    """The status row over the visible state and the run log."""
    return M.status_stats(state.read(), state.runs().select("run_id", "status", F.col("finished_at")))
