"""Rows that one query parses and several follow: a folder a micro-batch, removed once all have read it."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from logloom.session import file_system, hadoop_path
from logloom.sources.commits import now_micros

OBSERVED = "staged"
_FOLDER = re.compile(r"batch=(\d+)")


def stage_batches(path: str):
    """A batch writer that shows a micro-batch's files all at once, and a replayed one not again.

    Files are written where followers do not look; renaming the folder shows them.
    """
    root = path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        system, shown = file_system(spark, root), hadoop_path(spark, f"{root}/batch={batch_id:012d}")
        hidden = f"{root}/_staging/batch={batch_id:012d}"
        # The rows are written first in a replay too: the counts of the batch are observed on them.
        batch.write.mode("overwrite").parquet(hidden)
        if system.exists(shown):
            system.delete(hadoop_path(spark, hidden), True)
        elif not system.rename(hadoop_path(spark, hidden), shown):
            raise OSError(f"{shown} could not be shown")

    return write


def follow(spark: SparkSession, path: str, schema, files_per_trigger: int) -> DataFrame:
    """Staged rows as they appear, in the order of their micro-batches; reports how far it has read."""
    root = path.rstrip("/")
    file_system(spark, root).mkdirs(hadoop_path(spark, root))
    rows = (
        spark.readStream.schema(schema.add("batch", "long")).option("maxFilesPerTrigger", files_per_trigger)
        .option("basePath", root).parquet(root)
    )
    return rows.observe(OBSERVED, F.max("batch").alias("batch")).drop("batch")


def passed(progress: dict) -> int | None:
    """The micro-batches below this number are read by the query of a progress report; None: no news.

    Files are read by age, and a folder may be read in part, so its own number is not passed.
    """
    found = ((progress.get("observedMetrics") or {}).get(OBSERVED) or {}).get("batch")
    return None if found is None else int(found)


def remove_read(spark: SparkSession, path: str, below: int, keep_micros: int = 0) -> list[int]:
    """Remove staged micro-batches below a number that are older than ``keep_micros``."""
    root, system = path.rstrip("/"), file_system(spark, path)
    folder, gone = hadoop_path(spark, root), []
    if not system.exists(folder):
        return gone
    before = now_micros() - keep_micros
    for status in system.listStatus(folder):
        match = _FOLDER.fullmatch(status.getPath().getName())
        if match and int(match[1]) < below and status.getModificationTime() * 1_000 <= before:
            system.delete(status.getPath(), True)
            gone.append(int(match[1]))
    return sorted(gone)


class StagedRows(StreamingQueryListener):
    """Removes staged micro-batches that every follower has read; a new driver waits for news of all."""

    def __init__(self, spark: SparkSession, path: str, followers: Sequence[str], keep_micros: int = 0) -> None:
        self.spark, self.path, self.keep_micros = spark, path, keep_micros
        self.read: dict[str, int | None] = dict.fromkeys(followers)
        self.done = -1

    def heard(self, progress: dict) -> list[int]:
        name, number = progress.get("name"), passed(progress)
        if name not in self.read or number is None:
            return []
        self.read[name] = max(number, self.read[name] or 0)
        if None in self.read.values() or (below := min(self.read.values())) <= self.done:
            return []
        gone = remove_read(self.spark, self.path, below, self.keep_micros)
        if not self.keep_micros:
            self.done = below
        return gone

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.heard(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
