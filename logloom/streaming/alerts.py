"""Alert rules over a stream of metric points."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from logloom.functions.durations import micros_in
from logloom.operators.alerts import (
    FIRING,
    NO_DATA,
    NORMAL,
    PENDING,
    RULES,
    SINGLE_SERIES,
    Clock,
    Rule,
    evaluations,
    label,
    rule_structs,
    signals,
)
from logloom.operators.points import MEASUREMENTS, latest_wins

#: Kinds of rows that reach a series, and the state of a rule's empty series that has ended.
VALUE, BEAT, MARK, RETIRED = 0, 1, 2, -1
OUTPUT = "rule string, series string, at_millis bigint, value double, state string"


class HoldTracker(StatefulProcessor):
    """Follows one series of one rule from evaluation to evaluation.

    State is three numbers: when the running breach began, the last evaluation and how
    many evaluations in a row had no data. A timer notices an evaluation that brought no
    value. A silent series goes on reporting it; with ``patience`` it is forgotten after
    so many evaluations. A beat is an evaluation without a value of its own: it only counts where
    no value came. A mark tells a rule's empty series that the rule has real series now:
    it then reports no more.
    """

    def __init__(self, patience: int | None = None) -> None:
        self.patience = float("inf") if patience is None else patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.progress = handle.getValueState(
            "progress", "began bigint, last bigint, every bigint, missing int"
        )

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        began, last, missing, every = None, None, 0, None
        if self.progress.exists():
            began, last, every, missing = self.progress.get()
        if missing == RETIRED:
            return
        best, ends = {}, None
        for row in rows:
            if row.kind == MARK:
                ends = row.at_millis if ends is None else min(ends, row.at_millis)
            elif row.kind == VALUE or row.at_millis not in best:
                best[row.at_millis] = row
        for row in sorted(best.values(), key=lambda r: r.at_millis):
            if ends is not None and row.at_millis >= ends:
                break
            if last is not None and row.at_millis <= last:
                continue
            every = row.every_millis
            while last is not None and last + every < row.at_millis:
                began, last, missing = None, last + every, missing + 1
                if missing <= self.patience:
                    yield self._row(key, last, None, NO_DATA)
                else:
                    last = row.at_millis - every
            if row.value is None:
                state, began = NO_DATA, None
            elif row.value <= row.threshold:
                state, began = NORMAL, None
            else:
                began = row.at_millis if began is None else began
                state = FIRING if row.at_millis - began >= row.hold_millis else PENDING
            last, missing = row.at_millis, 0
            yield self._row(key, last, row.value, state)
        if ends is not None:
            self._forget_timers()
            self.progress.update((None, None, None, RETIRED))
        elif last is not None:
            self._remember(began, last, every, missing)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.progress.exists():
            return
        began, last, every, missing = self.progress.get()
        if missing == RETIRED:
            return
        now = timerValues.getCurrentWatermarkInMs()
        # One timer may stand for several evaluations that the watermark has passed.
        while missing < self.patience and last + every <= now:
            began, last, missing = None, last + every, missing + 1
            yield self._row(key, last, None, NO_DATA)
        if missing >= self.patience:
            self.progress.clear()
        else:
            self._remember(began, last, every, missing)

    def close(self) -> None:
        pass

    def _forget_timers(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    def _remember(self, began, last, every, missing) -> None:
        self._forget_timers()
        self.progress.update((began, last, every, missing))
        self.handle.registerTimer(last + every)

    @staticmethod
    def _row(key, at, value, state) -> Row:
        return Row(rule=key[0], series=key[1], at_millis=at, value=value, state=state)


def alert_stream(tables: Mapping[str, DataFrame], rules: Sequence[Rule] = RULES,
                 clock: Clock = Clock(), watermark: str = "2 minutes",
                 patience: int | None = None, beats: DataFrame | None = None) -> DataFrame:
    """Alert states as the evaluations close, for streams of finished points.

    A table with a ``version`` column may hold several versions of a point: each point then
    counts once, with the newest version that came before the watermark passed it.

    ``beats``, a stream with a ``time``, moves the clock where tables are silent and makes every
    rule report from its first evaluation on: a rule without any series so far reports
    ``NoData`` as the empty series. It needs the session's watermark policy ``max``
    (``follow_beats``), since a silent table's own watermark stands still.
    """
    shapes = {m.name: m for m in MEASUREMENTS}
    watched = {n: t.withWatermark("time", watermark) for n, t in tables.items()}
    watched = {
        n: latest_wins(t, shapes[n].key, shapes[n].fields, "version") if "version" in t.columns else t
        for n, t in watched.items()
    }

    def cells(rows: DataFrame, kind: Column) -> DataFrame:
        return rows.select(
            "rule", "series", F.unix_millis("evaluated").alias("at_millis"), "value", "threshold",
            (F.col("hold_micros") / 1000).cast("bigint").alias("hold_millis"),
            (micros_in(clock.every) / 1000).cast("bigint").alias("every_millis"),
            kind.alias("kind"),
        )

    seen = cells(signals(watched, rules, clock), F.lit(VALUE))
    if beats is not None:
        several = [r.name for r in rules if r.signal not in SINGLE_SERIES]
        mark = F.col("rule").isin(several)
        kinds = F.explode(F.when(mark, F.array(F.lit(VALUE), F.lit(MARK))).otherwise(F.array(F.lit(VALUE))))
        marked = seen.withColumn("kind", kinds).withColumn(
            "series", F.when(F.col("kind") == MARK, "").otherwise(F.col("series")))
        ticks = beats.withWatermark("time", watermark).groupBy(evaluations(clock)).agg(F.count(F.lit(1)).alias("n"))
        every_rule = ticks.select(
            F.lit("").alias("series"), F.col("w.end").alias("evaluated"), F.lit(None).cast("double").alias("value"),
            F.inline(rule_structs(rules)))
        seen = marked.unionByName(cells(every_rule, F.lit(BEAT)))
    states = seen.groupBy("rule", "series").transformWithState(
        HoldTracker(patience), OUTPUT, "append", "eventTime"
    )
    return states.select(
        "rule", *[label(rules, a).alias(a) for a in ("title", "severity", "component")],
        "series", F.timestamp_millis("at_millis").alias("evaluated"), "value", "state",
    )


def follow_beats(spark: SparkSession) -> None:
    """Let the newest stream of a query move its watermark; set before the query starts."""
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")


def beats_of_clock(spark: SparkSession) -> DataFrame:
    """One beat a second, from Spark's rate source."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(F.col("timestamp").alias("time"))
