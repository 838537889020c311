"""Session settings that the library relies on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# RocksDB keeps the state of wide keys (paths, client addresses) off the heap;
# changelog checkpoints write only what a micro-batch changed.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


_shipped: dict[str, str] = {}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession, explicit: str | None = None) -> str:
    """Shared folder for streaming checkpoints: the caller's, else the cluster's."""
    root = explicit or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError(
            "no checkpoint folder: set spark.checkpoint.dir or Settings.checkpoint_root"
        )
    return root.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    """The file system that holds a path, as the session's Hadoop settings see it."""
    return hadoop_path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python workers may not find it on their path."""
    context = spark.sparkContext
    if _shipped.get("application") == context.applicationId:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="logloom-package-")) / "logloom.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped["application"] = context.applicationId
