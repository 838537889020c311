"""Metric tables on shared storage: one Parquet folder a measurement, by date."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.durations import micros_in
from logloom.operators.points import Measurement, latest_wins
from logloom.operators.timeseries import in_range
from logloom.session import file_system, hadoop_path
from logloom.sources.commits import (
    BACKFILL_BATCH,
    CommitLog,
    Replacement,
    now_micros,
    segments,
)


def table_path(root: str, m: Measurement) -> str:
    return f"{root.rstrip('/')}/{m.name}"


def schema_of(m: Measurement) -> str:
    """Columns of a table, for readers that start before its first point."""
    tags = [f"{t} {'int' if t == 'status' else 'string'}" for t in m.tags]
    whole = ("count", "window_s")
    kind = lambda f: "bigint" if f in whole else "binary" if f.endswith("_sketch") else "double"
    fields = [f"{f} {kind(f)}" for f in m.fields]
    return ", ".join(["time timestamp", *tags, *fields, "generation bigint", "batch_id bigint", "date date"])


def checkpoint_generation(spark: SparkSession, checkpoints: str, root: str, m: Measurement) -> int:
    """The number of a stream in a table's commit log, kept beside its checkpoint.

    A new checkpoint starts a new stream, so it gets a new number; a restart keeps the number.
    """
    path = f"{checkpoints.rstrip('/')}/generation/{m.name}"
    try:
        return int(spark.read.schema("generation bigint").parquet(path).first()[0])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    generation = CommitLog(spark, table_path(root, m)).start_stream()
    spark.range(1).select(F.lit(generation).alias("generation")).write.parquet(path)
    return generation


def dated(points: DataFrame, batch_id: int, generation: int = 0) -> DataFrame:
    return points.withColumns({
        "generation": F.lit(generation).cast("bigint"),
        "batch_id": F.lit(batch_id).cast("bigint"), "date": F.to_date("time"),
    })


def append_points(points: DataFrame, root: str, m: Measurement, batch_id: int = 0,
                  files: int = 4, generation: int = 0) -> None:
    """Write the points of a micro-batch. Of a point's rewrites the newest generation's wins,
    and in it the one with the highest ``batch_id``: batch numbers start again with a checkpoint.

    A date gets at most ``files`` files, whatever the number of state partitions; a
    micro-batch that catches up many dates still spreads over all of them.
    """
    part = F.pmod(F.hash(*m.tags), F.lit(files))
    rows = dated(points, batch_id, generation).repartition("date", part)
    rows.write.mode("append").partitionBy("date").parquet(table_path(root, m))


def append_history(points: DataFrame, root: str, m: Measurement, batch_id: int = 0,
                   generation: int = 0) -> None:
    """Write the points of a long range: few files a date, a large date by many writers.

    Without the hint every task would write a file for every date. Adaptive execution
    splits what the hint gathers, so a date that holds most points is not one task's work.
    """
    _write_history(dated(points, batch_id, generation), table_path(root, m))


def _write_history(rows: DataFrame, path: str) -> None:
    rows.hint("rebalance", "date").write.mode("append").partitionBy("date").parquet(path)


# ---------------------------------------------------------------------------------------
# Replacements


def _between(start: int, stop: int) -> Column:
    """A point's time in a range given in microseconds; the literals reach the scan."""
    moment = F.col("time").cast("timestamp")
    return (moment >= F.timestamp_micros(F.lit(start))) & (moment < F.timestamp_micros(F.lit(stop)))


def visible(versions: DataFrame, replacements: Sequence[Replacement]) -> DataFrame:
    """Versions (time, generation, batch_id, ...) that no published replacement hides.

    A replacement hides every older version in its range, also of points it does not have itself.
    Rows of replacements that are not published do not count.
    """
    hidden = [_between(start, stop) & (F.col("generation") < number) for start, stop, number in segments(list(replacements))]
    published = (F.col("batch_id") != BACKFILL_BATCH) | F.col("generation").isin([r.number for r in replacements])
    return versions.where(published & ~reduce(lambda a, b: a | b, hidden, F.lit(False)))


def replace_points(points: DataFrame, root: str, m: Measurement, start: int, stop: int,
                   open_for: str | None = None) -> int | None:
    """Replace all points with start <= time < stop (microseconds) by the given ones, at once.

    The points are written where no reader looks, then one entry of the commit log shows them
    and hides all older versions of the range, so a failed or running backfill is not seen and
    a rerun replaces an earlier run. Windows that a stream may still rewrite are left to
    it: with ``open_for`` (window and watermark together) the range ends that much before
    the stream's newest point. Returns the number of the replacement, or None if nothing is closed.
    """
    spark, table = points.sparkSession, table_path(root, m)
    log = CommitLog(spark, table)
    newest = log.newest_of_streams()
    if newest is not None and open_for is not None:
        stop = min(stop, newest - micros_of(spark, open_for))
    if stop <= start:
        return None
    number = log.take()
    rows = dated(points.where(_between(start, stop)), BACKFILL_BATCH, number)
    _write_history(rows, f"{table}/_base/commit={number}")
    log.publish(number, Replacement(number, start, stop, (), now_micros()))
    return number


def micros_of(spark: SparkSession, duration: str) -> int:
    """Microseconds of one or several durations joined by '+'."""
    parts = [micros_in(p.strip()) for p in duration.split("+")]
    return int(spark.range(1).select(reduce(lambda a, b: a + b, parts)).first()[0])


def read_versions(spark: SparkSession, root: str, m: Measurement) -> DataFrame:
    """Every written version of every point that counts; none where the table has no file yet."""
    table = table_path(root, m)
    replacements = CommitLog(spark, table).replacements()
    shown = sorted({number for _, _, number in segments(replacements)})
    parts = [_read(spark, [table], table), _read(spark, [f"{table}/_base/commit={n}" for n in shown], f"{table}/_base")]
    parts = [p.drop("commit") for p in parts if p is not None]
    rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema_of(m))
    if replacements:
        rows = visible(rows, replacements)
    return rows.withColumn("version", F.struct("generation", "batch_id"))


def _read(spark: SparkSession, folders: list[str], base: str) -> DataFrame | None:
    """The points of some folders; None where there is no file."""
    system = file_system(spark, base)
    found = [f for f in folders if system.exists(hadoop_path(spark, f))]
    if not found:
        return None
    try:
        return spark.read.option("basePath", base).parquet(*found)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def read_points(spark: SparkSession, root: str, m: Measurement, start: str, stop: str,
                unique: bool = False) -> DataFrame:
    """Current points with start <= time < stop; other dates are not opened.

    ``unique`` skips the merge of versions, for tables that hold one version a point
    (compacted, or written once in append mode): the read then needs no shuffle.
    """
    versions = in_range(read_versions(spark, root, m), start, stop)
    if unique:
        return versions.select(*m.key, *m.fields)
    return latest_wins(versions, m.key, m.fields, "version")


def stream_points(spark: SparkSession, root: str, m: Measurement,
                  files_per_trigger: int | None = None) -> DataFrame:
    """New versions of a table's points as streams write them, for the alert job.

    Replacements are no new points: backfills and compactions write where the stream does not look.
    The table may have no point yet: its folder is then made, and its declared columns are used.
    """
    schema = read_versions(spark, root, m).drop("version").schema
    spark.createDataFrame([], schema).write.mode("append").partitionBy("date").parquet(table_path(root, m))
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(table_path(root, m)).select(
        *m.key, *m.fields, F.struct("generation", "batch_id").alias("version"))


# ---------------------------------------------------------------------------------------
# Upkeep


def _dates(spark: SparkSession, folder: str) -> dict[str, object]:
    """The date folders of a table, with their paths."""
    path, system = hadoop_path(spark, folder), file_system(spark, folder)
    if not system.exists(path):
        return {}
    named = {s.getPath().getName(): s.getPath() for s in system.listStatus(path)}
    return {n[5:]: p for n, p in sorted(named.items()) if re.fullmatch(r"date=\d{4}-\d{2}-\d{2}", n)}


def _files(system, path) -> list[str]:
    return sorted(s.getPath().toString() for s in system.listStatus(path) if s.getPath().getName().endswith(".parquet"))


def _day_micros(day: str) -> int:
    return (date.fromisoformat(day) - date(1970, 1, 1)).days * 86_400_000_000


def compact(spark: SparkSession, root: str, target: str, m: Measurement) -> None:
    """Rewrite a table elsewhere with one version a point and few files a date."""
    append_history(latest_wins(read_versions(spark, root, m), m.key, m.fields, "version"), target, m)


def compact_dates(spark: SparkSession, root: str, m: Measurement, most_files: int = 8,
                  open_for: str = "1 hour") -> list[str]:
    """Give dates with more than ``most_files`` stream files one version a point and few files.

    Only such dates are read and written, and only if the stream has left them ``open_for``
    behind. Each is a replacement, so readers and writers go on meanwhile; the old files stay until
    ``clean`` removes them. Returns the dates.
    """
    table = table_path(root, m)
    log, system = CommitLog(spark, table), file_system(spark, table)
    newest = log.newest_of_streams()
    limit = None if newest is None else newest - micros_of(spark, open_for)
    settled = {f for r in log.replacements() for f in r.files}
    done = []
    for day, path in _dates(spark, table).items():
        files = [f for f in _files(system, path) if f not in settled]
        start, stop = _day_micros(day), _day_micros(day) + 86_400_000_000
        if len(files) <= most_files or (limit is not None and stop > limit):
            continue
        number = log.take()
        following = (date.fromisoformat(day) + timedelta(days=1)).isoformat()
        points = read_points(spark, root, m, f"{day} 00:00:00", f"{following} 00:00:00")
        _write_history(dated(points, BACKFILL_BATCH, number), f"{table}/_base/commit={number}")
        log.publish(number, Replacement(number, start, stop, tuple(files), now_micros()))
        done.append(day)
    return done


def clean(spark: SparkSession, root: str, m: Measurement, grace: str = "1 day") -> int:
    """Remove what nobody needs after ``grace``: compacted stream files, points of replacements
    that newer ones hide whole, and of backfills that were never published. Returns how many."""
    table = table_path(root, m)
    log, system = CommitLog(spark, table), file_system(spark, table)
    replacements, before = log.replacements(), now_micros() - micros_of(spark, grace)
    shown = {number for _, _, number in segments(replacements)}
    gone = [hadoop_path(spark, f) for r in replacements if r.made <= before for f in r.files]
    newest = max((r.number for r in replacements if r.made <= before), default=0)
    for number in [*log.abandoned(), *(r.number for r in replacements if r.number not in shown)]:
        if number < newest:
            gone.append(hadoop_path(spark, f"{table}/_base/commit={number}"))
    return sum(bool(system.exists(p) and system.delete(p, True)) for p in gone)


def measurements(tables: Sequence[tuple[Measurement, DataFrame]]) -> DataFrame:
    """Names of the measurements that hold a point; one row of a table is enough.

    Rows that are bound to give a point serve as well as the points themselves.
    """
    names = [t.select(F.lit(m.name).alias("measurement")).limit(1) for m, t in tables]
    return reduce(DataFrame.unionByName, names)


def expire(spark: SparkSession, root: str, m: Measurement, now: str, keep_days: int) -> list[str]:
    """Remove the dates that ended more than ``keep_days`` before ``now``; returns them.

    Whole folders go, no file is rewritten. Run it while no job reads those dates.
    """
    limit = date.fromisoformat(now[:10]) - timedelta(days=keep_days)
    table, system = table_path(root, m), file_system(spark, root)
    commits = [f"{table}/_base/commit={r.number}" for r in CommitLog(spark, table).replacements()]
    return sorted({day for folder in [table, *commits] for day in _remove_dates(spark, system, folder, limit)})


def expire_rows(spark: SparkSession, path: str, now: str, keep_days: int) -> list[str]:
    """Remove the dates of a table of rows written by date, such as staged rows, samples or alerts."""
    limit = date.fromisoformat(now[:10]) - timedelta(days=keep_days)
    return _remove_dates(spark, file_system(spark, path), path, limit)


def _remove_dates(spark: SparkSession, system, folder: str, limit: date) -> list[str]:
    gone = [(day, path) for day, path in _dates(spark, folder).items() if date.fromisoformat(day) < limit]
    for _, path in gone:
        system.delete(path, True)
    return [day for day, _ in gone]
