"""Scheduled collection: every new snapshot in a landing folder becomes one run."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StreamingQuery

from geoledger import constants as K
from geoledger.operators.quality import DataRejected
from geoledger.plans.collect import collect_job
from geoledger.sources.state import StateTable


def announce(
    spark: SparkSession, landing_dir: str, name: str, snapshot_path: str, snapshot_at: datetime
) -> None:
    """Put a one-line note about a snapshot folder of many files into the landing folder.

    The note is written under a hidden name and renamed, so the stream sees it whole or not at all.
    """
    paths = spark._jvm.org.apache.hadoop.fs
    hidden = paths.Path(f"{landing_dir}/.{name}.path")
    system = hidden.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(hidden, True)
    out.write(bytearray(f"{snapshot_path}\t{snapshot_at.isoformat()}\n".encode()))
    out.close()
    if not system.rename(hidden, paths.Path(f"{landing_dir}/{name}.path")):
        raise OSError(f"cannot announce {snapshot_path} in {landing_dir}")


def arrival(spark: SparkSession, row: Row) -> tuple[str, datetime]:
    """Snapshot path and time of a landed file: the file itself, or what its note says."""
    if not row["path"].endswith(".path"):
        return row["path"], row["modificationTime"].astimezone(timezone.utc)
    path, at = spark.read.text(row["path"]).first()["value"].split("\t")
    return path, datetime.fromisoformat(at)


def run_pending(
    spark: SparkSession,
    landing_dir: str,
    state: StateTable,
    checkpoint: str,
    names_path: str | None = None,
    *,
    allow_missing_names: bool = False,
    min_rows: int = K.MIN_ROWS,
    min_large: int = K.MIN_LARGE,
    multi_line: bool = False,
) -> StreamingQuery:
    """Take the waiting snapshots in the order of their file times, one per micro-batch.

    A landed file is a snapshot (`.csv`) or a note that names a snapshot folder (`.path`). The
    stream carries file names only; each one is handed to the collection job under a key of its own:
    the landed file, its time, the snapshot and its time. A batch that is retried finds the keys it
    has dealt with and goes on behind them, whatever other runs there were. A snapshot that breaks a
    rule is logged as refused and the next one is taken; any other failure stops the stream, and the
    next start tries that snapshot again.
    """
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", 1)
        .option("pathGlobFilter", "*.{csv,path}")
        .load(landing_dir)
        .select("path", "modificationTime")
    )

    def collect(batch: DataFrame, batch_id: int) -> None:
        # One file a batch, as the source is told; the loop does not depend on it.
        for row in batch.orderBy("modificationTime", "path").collect():
            path, at = arrival(spark, row)
            key = "|".join([row["path"], row["modificationTime"].isoformat(), path, at.isoformat()])
            try:
                collect_job(
                    spark,
                    path,
                    state,
                    names_path,
                    snapshot_at=at,
                    snapshot_key=key,
                    allow_missing_names=allow_missing_names,
                    min_rows=min_rows,
                    min_large=min_large,
                    multi_line=multi_line,
                )
            except DataRejected as error:
                state.log(
                    state.next_run_id(),
                    datetime.now(timezone.utc),
                    "refused",
                    source_url=path,
                    snapshot_key=key,
                    error_message=f"{type(error).__name__}: {error}",
                )

    return (
        arrivals.writeStream.foreachBatch(collect)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
