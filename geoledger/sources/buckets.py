"""The current state in buckets by id, of which a merge touches those that changed.

Every version has a manifest with one row a bucket: the folder that holds its rows, a digest of the snapshot rows it was
merged from, when it was last confirmed, and the earliest time at which a row of it may still expire. A bucket whose
snapshot rows have the digest they had is linked into the next version as it is and only confirmed; rows that a snapshot
holds take their last-seen times from there when they are read. The other buckets are read, merged and written.

Buckets are Spark's own, by its hash of the id, so a merge shuffles the snapshot's rows to the buckets and the state's
rows not at all.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from geoledger import constants as K
from geoledger.operators import merge as M
from geoledger.operators.quality import DataRejected
from geoledger.sources.state import STATE_SCHEMA, StateTable

SEEN = ("inserted", "updated", "unchanged")
#: Columns that a confirmed row takes from its bucket.
CONFIRMED = ("last_seen_at", "source_snapshot_at")
MANIFEST = S.StructType(
    [
        S.StructField("bucket", S.IntegerType()),
        S.StructField("folder", S.StringType()),
        S.StructField("rows", S.LongType()),
        S.StructField("seen", S.LongType()),
        S.StructField("digest", S.StringType()),
        S.StructField("expires_from", S.TimestampType()),
        S.StructField("confirmed_at", S.TimestampType()),
        S.StructField("linked", S.BooleanType()),
    ]
)
STORED = S.StructType(
    [*STATE_SCHEMA.fields, S.StructField("change", S.StringType()), S.StructField("reactivated", S.BooleanType())]
)


@dataclass(frozen=True)
class BucketedState:
    """Versions of the state under `root`, in a number of buckets that stays as it was at first.

    Ids are there and occur once, in the state and in a snapshot, as the checks before a merge make sure.
    """

    spark: SparkSession
    root: str
    buckets: int = 64

    @property
    def _log(self) -> StateTable:
        return StateTable(self.spark, self.root)

    def version(self) -> int | None:
        return self._log.version()

    def bucket(self) -> F.Column:
        """Spark's bucket of an id."""
        return F.pmod(F.hash("id"), F.lit(self.buckets))

    # -- reading ----------------------------------------------------------------------------------------------------

    def manifest(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if version is None:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self._log._data(version)}/manifest")

    def stored(self, version: int, only: list[int] | None = None) -> DataFrame:
        """Rows as their files have them, read by bucket; `only` some buckets.

        The version is a table of the session's catalog whose partitions are the folders of the manifest.
        """
        marker = uuid.uuid5(uuid.NAMESPACE_URL, f"{self.root}#{version}#{self._log._data(version)}").hex
        name = f"geoledger_state_{marker}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in STORED.fields)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}, bucket INT) USING parquet PARTITIONED BY (bucket) "
                f"CLUSTERED BY (id) SORTED BY (id) INTO {self.buckets} BUCKETS LOCATION '{self.root}/none'"
            )
            held = self.manifest(version).where("rows > 0").select("bucket", "folder").collect()  # one row a bucket
            parts = [f"PARTITION (bucket={b}) LOCATION '{self.root}/data/{f}/bucket={b}'" for b, f in held]
            if parts:
                self.spark.sql(f"ALTER TABLE {name} ADD {' '.join(parts)}")
        rows = self.spark.table(name)
        return rows if only is None else rows.where(F.col("bucket").isin(only))

    def _confirmed(self, version: int, only: list[int] | None = None) -> DataFrame:
        """Stored rows with the times at which their buckets were last confirmed."""
        bucket = self.manifest(version).select("bucket", "confirmed_at", "linked")
        rows = self.stored(version, only).join(F.broadcast(bucket), "bucket", "left")  # one row a bucket
        seen = F.col("change").isin(*SEEN)
        return rows.withColumns(
            {
                **{c: F.when(seen, F.col("confirmed_at")).otherwise(F.col(c)) for c in CONFIRMED},
                "change": F.when(~F.col("linked"), F.col("change")).when(seen, "unchanged").otherwise("absent"),
                "reactivated": F.col("reactivated") & ~F.col("linked"),
            }
        )

    def read(self, version: int | None = None) -> DataFrame:
        """The state of a version."""
        version = self.version() if version is None else version
        if version is None:
            return self.spark.createDataFrame([], STATE_SCHEMA)
        return self._confirmed(version).select(*K.STATE_COLUMNS)

    def changes(self, version: int | None = None) -> DataFrame:
        """The change feed that produced a version."""
        version = self.version() if version is None else version
        if version is None:
            return self.spark.createDataFrame([], "id bigint, change string, reactivated boolean")
        return self._confirmed(version).select("id", *M.CHANGE_COLUMNS)

    def forget(self) -> None:
        """Drop the session's table names of this state; files stay."""
        for table in self.spark.catalog.listTables():
            if table.name.startswith("geoledger_state_"):
                self.spark.sql(f"DROP TABLE {table.name}")

    # -- writing ----------------------------------------------------------------------------------------------------

    def _write(self, folder: str, rows: DataFrame) -> None:
        """Rows to one file a bucket, in a folder each, in the layout of a bucketed table."""
        name = f"geoledger_write_{uuid.uuid4().hex}"
        columns = [*K.STATE_COLUMNS, *M.CHANGE_COLUMNS]
        typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in STORED.fields if f.name in columns])
        (
            typed.withColumn("bucket", self.bucket())
            .write.format("parquet")
            .partitionBy("bucket")
            .bucketBy(self.buckets, "id")
            .sortBy("id")
            .option("path", f"{self.root}/data/{folder}")
            .saveAsTable(name)
        )
        self.spark.sql(f"DROP TABLE {name}")  # the files stay

    def _describe(self, folder: str, at: datetime | None, digests: dict[int, str]) -> dict[int, tuple]:
        """Manifest rows of the buckets that were just written."""
        rows = self.spark.read.schema(S.StructType([*STORED.fields, S.StructField("bucket", S.IntegerType())])).parquet(
            f"{self.root}/data/{folder}"
        )
        seen, active = F.col("change").isin(*SEEN), F.coalesce(F.col("is_active"), F.lit(False))
        found = rows.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(seen).alias("seen"),
            F.min(F.when(active & ~seen, F.col("source_snapshot_at"))).alias("expires_from"),
        )
        return {
            r["bucket"]: (r["bucket"], folder, r["rows"], r["seen"], digests.get(r["bucket"]), r["expires_from"], at, False)
            for r in found.collect()  # one row a bucket
        }

    def _commit(self, version: int, folder: str, entries: dict[int, tuple]) -> None:
        table = self.spark.createDataFrame([entries[b] for b in sorted(entries)], MANIFEST)
        table.coalesce(1).write.parquet(f"{self.root}/data/{folder}/manifest")
        if not self._log.commit(version, folder):
            raise DataRejected(f"version {version} was made by another writer")

    def load(self, state: DataFrame) -> int:
        """A first version from a state without buckets."""
        version, folder = (self.version() or 0) + 1, f"load-{uuid.uuid4().hex}"
        rows = state.withColumns({"change": F.lit("absent"), "reactivated": F.lit(False)})
        self._write(folder, rows.repartition(self.buckets, "id"))
        self._commit(version, folder, self._describe(folder, None, {}))
        return version

    def digests(self, incoming: DataFrame) -> DataFrame:
        """(bucket, rows, digest): what a snapshot has for each bucket, whatever the order of its rows."""
        row = F.struct(*[F.col(c) for c in M.INCOMING_COLUMNS])
        wide = "decimal(38,0)"
        sums = [F.sum(F.xxhash64(F.lit(seed), row).cast(wide)).cast("string") for seed in (1, 2)]
        found = incoming.groupBy(self.bucket().alias("bucket"))
        return found.agg(F.count(F.lit(1)).alias("rows"), F.concat_ws(":", F.count(F.lit(1)), *sums).alias("digest"))

    def merge(self, incoming: DataFrame, snapshot_at: datetime) -> int:
        """Merge a full snapshot; the number of the version it makes.

        A bucket is linked if its snapshot rows are the same as at its last merge, this snapshot is not older, and no
        row that the snapshot lacks would expire now. `incoming` has the columns of a merge and is read twice.
        """
        before = self.version()
        version, folder = (before or 0) + 1, f"merge-{uuid.uuid4().hex}"
        old = {r["bucket"]: r for r in self.manifest(before).collect()} if before else {}  # one row a bucket
        new = {r["bucket"]: (r["rows"], r["digest"]) for r in self.digests(incoming).collect()}  # one row a bucket
        # A time of the session's zone, as the manifest's times are.
        at = self.spark.range(1).select(F.lit(snapshot_at).cast("timestamp")).first()[0]

        def stays(b: int) -> bool:
            r = old.get(b)
            return (
                r is not None
                and r["confirmed_at"] is not None
                and r["confirmed_at"] <= at
                and r["digest"] == new.get(b, (0, None))[1]
                and not (r["expires_from"] is not None and r["expires_from"] < at)
            )

        entries = {
            b: (b, r["folder"], r["rows"], r["seen"], r["digest"], r["expires_from"], at, True)
            for b, r in old.items()
            if stays(b)
        }
        touched = sorted(({*old} | {*new}) - {*entries})
        if touched:
            mine = incoming.where(self.bucket().isin(touched))
            if any(b in old for b in touched):
                current = self._confirmed(before, touched).select(*K.STATE_COLUMNS)
                merged = M.merge_with_changes(current, mine, snapshot_at)
            else:
                none = self.spark.createDataFrame([], STATE_SCHEMA)
                merged = M.merge_with_changes(none, mine, snapshot_at).repartition(self.buckets, "id")
            self._write(folder, merged)
            entries |= self._describe(folder, at, {b: d for b, (_, d) in new.items()})
        if (seen := sum(e[3] for e in entries.values())) != (sent := sum(n for n, _ in new.values())):
            raise DataRejected(f"version holds {seen} snapshot rows, expected {sent}")
        self._commit(version, folder, entries)
        return version
