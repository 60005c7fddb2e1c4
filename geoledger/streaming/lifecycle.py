"""The change feed of a stream of snapshots, from state kept by id.

Rows of landed snapshots go by id to a state of three values: a digest of what is compared, the time of the last
snapshot that held the id, and whether it is active. The ids of a hash group keep theirs together, since each call
of a state or a timer from Python costs more than a row. A timer behind the time of a last snapshot fires once a newer
one was taken and switches off the ids that it lacks. No snapshot is joined with a table of all rows, and a restart
goes on from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from geoledger.operators.merge import COMPARED
from geoledger.session import ship
from geoledger.sources.names import path_exists

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
LANDED = "id bigint, digest string, snapshot_at timestamp"
HELD = "ids array<bigint>, digests array<string>, last_ms array<bigint>, active array<boolean>"
#: Hash groups of ids. A checkpoint holds its state by them, as it does by its shuffle partitions: another number needs
#: a new checkpoint. A task holds the ids of one group at a time, 12,000 of a hundred million.
GROUPS = 1 << 13
FEED = "id bigint, change string, reactivated boolean, snapshot_at timestamp"


class Lifecycle(StatefulProcessor):
    """Per id of a group: inserted, updated, unchanged or deactivated at a snapshot, and whether it came back."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", HELD)

    def read(self) -> dict[int, tuple[str, int, bool]]:
        ids, *values = self.held.get() or ([], [], [], [])
        return dict(zip(ids, zip(*values, strict=True), strict=True))

    def write(self, held: dict[int, tuple[str, int, bool]]) -> None:
        self.held.update(([*held], *(list(column) for column in zip(*held.values(), strict=True))))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.read()
        timed = {last for _, last, active in held.values() if active}
        for n, now, at, ms in sorted(
            ((r["id"], r["digest"], r["snapshot_at"], r["snapshot_ms"]) for r in rows), key=lambda r: r[3]
        ):
            digest, last, active = held.get(n, (None, None, False))
            change = "inserted" if last is None else "unchanged" if now == digest else "updated"
            yield Row(id=n, change=change, reactivated=last is not None and not active, snapshot_at=at)
            held[n] = now, ms, True
        self.write(held)
        times = {last for _, last, active in held.values() if active}
        for last in timed - times:
            self.handle.deleteTimer(last + 1)
        for last in times - timed:
            self.handle.registerTimer(last + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.read()
        expired = expiredTimerInfo.getExpiryTimeInMs()
        gone = {n: (digest, last, False) for n, (digest, last, active) in held.items() if active and last + 1 == expired}
        if gone:
            self.write(held | gone)
        at = datetime.fromtimestamp(timerValues.getCurrentWatermarkInMs() / 1000, timezone.utc)
        for n in gone:
            yield Row(id=n, change="deactivated", reactivated=False, snapshot_at=at)

    def close(self) -> None:
        pass


def land(incoming: DataFrame, landing: str, snapshot_at: datetime) -> None:
    """Put the rows of a snapshot, with the columns of a merge, into the landing folder: ids, digests and its time.

    Ids occur once; rows without one are left out. Spark's writers make files visible when the whole snapshot is
    written, so a stream sees it all or not at all.
    """
    digest = F.sha2(F.to_json(F.struct(*COMPARED), {"ignoreNullFields": "false"}), 256)
    rows = incoming.where("id IS NOT NULL").select(
        "id", digest.alias("digest"), F.lit(snapshot_at).cast("timestamp").alias("snapshot_at")
    )
    rows.write.mode("append").parquet(landing)


def start_feed(spark: SparkSession, landing: str, feed: str, checkpoint: str) -> StreamingQuery:
    """Take what has landed and append its change feed to a table of files; ends when all of it is taken.

    One snapshot at a time: start it after each landing, so that a snapshot is a batch and the timers of ids that it
    lacks fire behind it. Snapshots that are older than one taken before come too late and are left out. Ids that are
    absent from several snapshots are reported once.
    """
    ship(spark)
    spark.conf.set(PROVIDER, ROCKS)
    rows = spark.readStream.schema(LANDED).parquet(landing).withColumns(
        {"snapshot_ms": F.unix_millis("snapshot_at"), "id_group": F.pmod(F.xxhash64("id"), F.lit(GROUPS)).cast("int")}
    )
    changes = rows.withWatermark("snapshot_at", "0 seconds").groupBy("id_group").transformWithState(
        statefulProcessor=Lifecycle(), outputStructType=FEED, outputMode="Append", timeMode="EventTime"
    )
    return (
        changes.writeStream.format("parquet")
        .option("path", feed)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def take(spark: SparkSession, incoming: DataFrame, folder: str, snapshot_at: datetime) -> None:
    """Land a snapshot and bring the feed under `folder` up to date."""
    land(incoming, f"{folder}/landing", snapshot_at)
    start_feed(spark, f"{folder}/landing", f"{folder}/feed", f"{folder}/checkpoint").awaitTermination()


def read_feed(spark: SparkSession, folder: str) -> DataFrame:
    """(id, change, reactivated, snapshot_at) of all snapshots taken so far; ids that nothing happened to have no row."""
    if not path_exists(spark, f"{folder}/feed"):
        return spark.createDataFrame([], FEED)
    return spark.read.schema(FEED).parquet(f"{folder}/feed")
