"""Session defaults and the shared folder used for written tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app: str = "timbrel", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the library is tuned for.

    AQE coalesces small shuffles and splits skewed join partitions; Arrow
    batches are bounded in bytes so that rows carrying whole media files never
    build an oversized batch.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A folder of our own is set only where none is configured and the session
    runs in local mode.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="timbrel-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for one run of one job."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, whatever folder the driver started in."""
    sc = spark.sparkContext
    if getattr(sc, "_timbrel_shipped", False):
        return
    package = Path(__file__).parent
    folder = Path(tempfile.mkdtemp(prefix="timbrel-ship-"))
    archive = shutil.make_archive(str(folder / package.name), "zip", package.parent, package.name)
    sc.addPyFile(archive)
    sc._timbrel_shipped = True
