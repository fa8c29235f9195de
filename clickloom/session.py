"""Spark session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}

_LOCAL_FOLDERS: dict[str, str] = {}  # of local sessions without a shared folder


def build_session(app_name: str = "clickloom", master: str | None = None, **conf) -> SparkSession:
    """A session with AQE on.

    Settings that the cluster or spark-submit gives win over the defaults here;
    ``conf`` wins over both.
    """
    given = {key for key, _ in SparkConf().getAll()}
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {k: v for k, v in _DEFAULTS.items() if k not in given}
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a temporary folder of its own; on a
    cluster a machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="clickloom-")
    return _LOCAL_FOLDERS[application]


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, never used path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
