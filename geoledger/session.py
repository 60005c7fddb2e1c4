"""Session set-up shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "geoledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for; `conf` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    A cluster names a shared folder in spark.checkpoint.dir. Only a local master may fall back to
    a folder of its own, since there the driver and the executors are one process.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = os.path.join(tempfile.mkdtemp(prefix="geoledger-"), "checkpoints")
    context.setCheckpointDir(configured)
    return configured


def written(df: DataFrame) -> DataFrame:
    """The rows of a DataFrame as a table in the shared checkpoint folder.

    Several branches can then read them without running the plan again, and a lost executor costs
    its own tasks only. It runs the plan once, where checkpoint() runs it twice.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()
#: Bytes of an Arrow batch on its way to Python, unless the session sets another number. Spark's default is 64 MB, of
#: which a task holds several on both sides.
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES, SPARK_BATCH_BYTES = 4 << 20, 64 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once a session, so that functions which run in Python find it there.

    Spark's file server hands it out; the driver's folders need not be visible to the executors. Arrow batches are
    limited by bytes, so that rows of long texts do not fill the workers.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH_CONF).rstrip("b") == str(SPARK_BATCH_BYTES):
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    folder = Path(tempfile.mkdtemp(prefix="geoledger-code-"))
    archive = folder / "geoledger_code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, str(path.relative_to(root.parent)))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
