"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

# Settings that change results or plans and can be set on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Spark's default, INT96, has no statistics: filters on a time could not leave out a single row group.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Methods above 8,000 bytes of bytecode are never compiled by the JVM. The parse projection would be one when
    # fused; beyond this limit Spark runs such a stage operator by operator, about three times faster for that step.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings the package relies on (UTC clock, ANSI errors, adaptive plans)."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@lru_cache(maxsize=None)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="flowledger-")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    A temporary folder of this machine is used only when the master is local and the setting is absent.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh folder name below the shared folder; what is written there goes when the driver program ends."""
    folder = f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, folder)
    return folder


def _remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder if the JVM still answers; a cut-off job leaves its folders to the cluster's own clean-up."""
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    except Exception:  # the JVM has gone
        pass
