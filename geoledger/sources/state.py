"""The current-state table: numbered versions that a run log makes visible."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from geoledger import constants as K
from geoledger.operators.merge import CHANGE_COLUMNS
from geoledger.operators.quality import DataRejected, enforce, require_unique
from geoledger.sources.names import path_exists

_NUMBERS = ("id", "elevation_ft", "latitude_deg", "longitude_deg")
_TIMES = (
    "name_zh_updated_at",
    "first_seen_at",
    "last_seen_at",
    "deactivated_at",
    "updated_at",
    "source_snapshot_at",
)


def _kind(name: str) -> S.DataType:
    if name == "id":
        return S.LongType()
    if name == "elevation_ft":
        return S.IntegerType()
    if name in _NUMBERS:
        return S.DoubleType()
    if name in _TIMES:
        return S.TimestampType()
    return S.BooleanType() if name == "is_active" else S.StringType()


STATE_SCHEMA = S.StructType([S.StructField(name, _kind(name)) for name in K.STATE_COLUMNS])
SNAPSHOT_SCHEMA = S.StructType([S.StructField(name, _kind(name)) for name in K.SOURCE_COLUMNS])

RUN_SCHEMA = S.StructType(
    [
        S.StructField("run_id", S.LongType()),
        S.StructField("event_at", S.TimestampType()),
        S.StructField("status", S.StringType()),
        S.StructField("source_url", S.StringType()),
        S.StructField("source_sha256", S.StringType()),
        S.StructField("source_bytes", S.LongType()),
        S.StructField("names_file_sha256", S.StringType()),
        S.StructField("version", S.LongType()),
        S.StructField("rows_total", S.LongType()),
        S.StructField("rows_inserted", S.LongType()),
        S.StructField("rows_updated", S.LongType()),
        S.StructField("rows_unchanged", S.LongType()),
        S.StructField("rows_reactivated", S.LongType()),
        S.StructField("rows_deactivated", S.LongType()),
        S.StructField("rows_named_targets", S.LongType()),
        S.StructField("rows_missing_zh", S.LongType()),
        S.StructField("error_message", S.StringType()),
        S.StructField("snapshot_key", S.StringType()),
    ]
)


def run_log(events: DataFrame) -> DataFrame:
    """The latest state of every run: its last status, start and finish time and all it reported."""
    final = F.struct(F.col("status") != "running", "event_at")
    reported = [name for name in events.columns if name not in ("run_id", "event_at", "status")]
    return events.groupBy("run_id").agg(
        F.max_by("status", final).alias("status"),
        F.min(F.when(F.col("status") == "running", F.col("event_at"))).alias("started_at"),
        F.max(F.when(F.col("status") != "running", F.col("event_at"))).alias("finished_at"),
        *[F.max(name).alias(name) for name in reported],
    )


@dataclass(frozen=True)
class StateTable:
    """Versions under `root/data`, staged snapshots under `root/staging`, run events under `root/runs`.

    A version is written to a folder of its own run. It becomes visible by its marker under `root/versions`, a small
    file that names the folder and the snapshot and is moved to a place that must be free. Of two writers that made
    the same version one gets the place; the other starts again from the version that won. A folder without a marker
    is never read.
    """

    spark: SparkSession
    root: str

    def _claim(self, kind: str, number: int, content: str) -> bool:
        """Put a file at a numbered place, unless the place is taken."""
        jvm = self.spark._jvm
        fs, options = jvm.org.apache.hadoop.fs, self.spark._jsc.hadoopConfiguration()
        place = fs.Path(f"{self.root}/{kind}/{number:012d}")
        draft = fs.Path(f"{self.root}/{kind}/.draft-{uuid.uuid4().hex}")
        system = place.getFileSystem(options)
        out = system.create(draft, True)
        out.write(bytearray(content.encode()))
        out.close()
        context = fs.FileContext.getFileContext(system.getUri(), options)
        never = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(system.makeQualified(draft), system.makeQualified(place), never)
        except Py4JJavaError as error:
            system.delete(draft, False)
            if "FileAlreadyExistsException" in str(error.java_exception):
                return False
            raise
        return True

    def _last(self, kind: str) -> int:
        """The highest number taken, 0 for none."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}")
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in system.listStatus(folder)] if system.exists(folder) else []
        return max((int(name) for name in names if name.isdigit()), default=0)

    def markers(self) -> DataFrame:
        """(folder, snapshot_key) of all versions."""
        schema = "folder string, snapshot_key string"
        if not self._last("versions"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("sep", "\t").csv(f"{self.root}/versions")

    def events(self) -> DataFrame:
        path = f"{self.root}/runs"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], RUN_SCHEMA)
        return self.spark.read.schema(RUN_SCHEMA).parquet(path)

    def runs(self) -> DataFrame:
        return run_log(self.events())

    def log(self, run_id: int, at: datetime, status: str, **values: object) -> None:
        """Append one event; error texts are cut to their limit."""
        message = values.get("error_message")
        if message is not None:
            values["error_message"] = str(message)[: K.ERROR_TEXT_LIMIT]
        row = {"run_id": run_id, "event_at": at, "status": status, **values}
        line = [tuple(row.get(name) for name in RUN_SCHEMA.names)]
        self.spark.createDataFrame(line, RUN_SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{self.root}/runs"
        )

    def next_run_id(self) -> int:
        """A run number that no other run has, also not one that starts at the same time."""
        number = max(self._last("numbers"), self.events().agg(F.max("run_id")).first()[0] or 0) + 1
        while not self._claim("numbers", number, ""):
            number += 1
        return number

    def version(self) -> int | None:
        """The last visible version."""
        return self._last("versions") or None

    def succeeded(self, run_id: int) -> bool:
        return not self.events().where(F.col("run_id") == run_id).where("status = 'succeeded'").isEmpty()

    def took(self, snapshot_key: str) -> bool:
        """Whether a version was made from this snapshot, or its rows were refused."""
        if not self.markers().where(F.col("snapshot_key") == snapshot_key).isEmpty():
            return True
        return not self.events().where((F.col("snapshot_key") == snapshot_key) & (F.col("status") == "refused")).isEmpty()

    def read(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if version is None:
            return self.spark.createDataFrame([], STATE_SCHEMA)
        return self.spark.read.schema(STATE_SCHEMA).parquet(self._data(version))

    def changes(self, version: int | None = None) -> DataFrame:
        """The change feed that produced a version."""
        version = self.version() if version is None else version
        schema = "id bigint, change string, reactivated boolean"
        if version is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._data(version))

    def seen(self, version: int) -> DataFrame:
        """Rows of a version that its snapshot held."""
        rows = self.spark.read.parquet(self._data(version))
        return rows.where(F.col("change").isin("inserted", "updated", "unchanged"))

    def stage(self, run_id: int, rows: DataFrame) -> DataFrame:
        """Write a parsed snapshot aside and read it back, so later steps never parse it again."""
        path = f"{self.root}/staging/run={run_id}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def clean(self, keep: int = 2) -> list[str]:
        """Delete staged snapshots, and folders of versions before the last `keep`; returns their names.

        Folders without a marker may belong to a run at work and stay. Nobody else should be reading old versions.
        """
        fs = self.spark._jvm.org.apache.hadoop.fs
        last, gone = self._last("versions"), []
        markers = {n: self._data(n) for n in range(1, last + 1)}
        old = [path for n, path in markers.items() if n <= last - keep]
        for path in [f"{self.root}/staging", *old]:
            target = fs.Path(path)
            system = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
            if system.exists(target) and system.delete(target, True):
                gone.append(target.getName())
        return gone

    def write_folder(self, folder: str, merged: DataFrame, expected_rows: int) -> None:
        """Write the rows of a version to a folder and check them before anyone may read them."""
        path = f"{self.root}/data/{folder}"
        merged.select(*K.STATE_COLUMNS, *CHANGE_COLUMNS).write.mode("overwrite").parquet(path)
        rows = self.spark.read.parquet(path)
        stage_check(rows.select(*K.STATE_COLUMNS), rows.select(*CHANGE_COLUMNS), expected_rows)

    def commit(self, version: int, folder: str, snapshot_key: str = "") -> bool:
        """Make a written folder the given version, unless another writer did so first."""
        return self._claim("versions", version, f"{folder}\t{snapshot_key}\n")

    def write_version(self, version: int, merged: DataFrame, expected_rows: int) -> None:
        """Write, check and commit a version."""
        folder = f"write-{uuid.uuid4().hex}"
        self.write_folder(folder, merged, expected_rows)
        if not self.commit(version, folder):
            raise DataRejected(f"version {version} was made by another writer")

    def _data(self, version: int) -> str:
        marker = self.spark.read.text(f"{self.root}/versions/{version:012d}").first()["value"]
        return f"{self.root}/data/{marker.split(chr(9))[0]}"


def stage_check(state: DataFrame, changes: DataFrame, expected_rows: int) -> None:
    """Raise unless a written version holds the whole snapshot once and idents stay unique."""
    seen = changes.where(F.col("change").isin("inserted", "updated", "unchanged")).count()
    if seen != expected_rows:
        raise DataRejected(f"version holds {seen} snapshot rows, expected {expected_rows}")
    enforce(require_unique(state.select("ident"), "ident"), "ident belongs to more than one id")
