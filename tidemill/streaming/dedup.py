"""De-duplication policies and late rows."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemill.operators.ordered import new_maxima


def dedup_exact(events: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Whole records once (or once per the given columns)."""
    return events.dropDuplicates(list(columns) if columns else None)


def dedup_bounded(events: DataFrame, columns: Sequence[str], event_time: str, within: str) -> DataFrame:
    """Records with equal ``columns`` once, as long as a copy comes within the given time of the one before it.

    On a stream the state is bounded by the watermark; on a batch the gap between copies is measured, after copies of one
    time are merged.
    """
    if events.isStreaming:
        return events.withWatermark(event_time, within).dropDuplicatesWithinWatermark(list(columns))
    times = list(dict.fromkeys([*columns, event_time]))
    before = F.lag(event_time).over(Window.partitionBy(*columns).orderBy(event_time))
    far = F.col("_before").isNull() | (F.col(event_time) > F.col("_before") + F.expr(f"interval {within}"))
    return events.dropDuplicates(times).withColumn("_before", before).where(far).drop("_before")


def dedup_newer_only(events: DataFrame, keys: Sequence[str], arrival: Sequence[str], ts: str = "ts_ms") -> DataFrame:
    """Records that are newer than everything before them of the same key, in order of arrival (batch)."""
    return new_maxima(events, keys, arrival, ts)


def late_rows(events: DataFrame, seconds: int, kind: str, event_time: str, batch: str) -> DataFrame:
    """Mark rows (``is_late``) whose time lies more than ``seconds`` before the newest time of earlier batches.

    The window below sees one row per kind and batch.
    """
    newest = events.groupBy(kind, batch).agg(F.max(event_time).alias("_top"))
    before = Window.partitionBy(kind).orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    limits = newest.select(kind, batch, F.max("_top").over(before).alias("_earlier"))
    return mark_late(events.join(limits, [kind, batch]), seconds, event_time, "_earlier").drop("_earlier")


def mark_late(events: DataFrame, seconds: int, event_time: str, newest: str) -> DataFrame:
    bound = F.col(newest) - F.expr(f"interval {seconds} seconds")
    return events.withColumn("is_late", F.coalesce(F.col(event_time) < bound, F.lit(False)))


class SnapshotWatch(StatefulProcessor):
    """Reports once per table that its snapshot is over: on the first change record, or after a quiet time."""

    def __init__(self, quiet_ms: int):
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.phase = handle.getValueState("phase", "in_snapshot boolean, completed boolean, timer long")

    def _state(self):
        return self.phase.get() if self.phase.exists() else (False, False, None)

    def handleInputRows(self, key, rows, timerValues):
        snapshot, change = False, None
        for piece in rows:
            snapshot |= bool((piece["snapshots"] > 0).any())
            firsts = piece["first_change"].dropna()
            if len(firsts):
                change = firsts.min() if change is None else min(change, firsts.min())
        _, completed, timer = self._state()
        if timer is not None:
            self.handle.deleteTimer(timer)
            timer = None
        if change is not None and not completed:
            yield pd.DataFrame({"table": [key[0]], "completed_at": [int(change)], "reason": ["change"]})
            completed = True
        if not completed:
            timer = timerValues.getCurrentProcessingTimeInMs() + self.quiet_ms
            self.handle.registerTimer(timer)
        self.phase.update((snapshot and change is None, completed, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        in_snapshot, completed, _ = self._state()
        if in_snapshot and not completed:
            self.phase.update((False, True, None))
            at = int(expiredTimerInfo.getExpiryTimeInMs())
            yield pd.DataFrame({"table": [key[0]], "completed_at": [at], "reason": ["quiet"]})

    def close(self) -> None:
        pass


def snapshot_completion_stream(envelopes: DataFrame, quiet_seconds: int = 15) -> DataFrame:
    """Tables whose snapshot phase has ended: table, completed_at (ms), reason.

    The quiet-time timer keeps the query alive, so run it with ``streams.run_until_idle`` and a ``linger`` beyond the quiet time.
    Records are first reduced to one row per Arrow batch and table, so a large table does not pass whole through
    the task that holds its state.
    """
    from tidemill.streaming.cdc import is_snapshot

    marks = envelopes.select(
        F.col("source")["table"].alias("table"), is_snapshot().cast("long").alias("snapshots"),
        F.when(~is_snapshot(), F.col("ts_ms")).alias("first_change"),
    )

    def reduce(pieces):
        for piece in pieces:
            yield piece.groupby("table", as_index=False).agg({"snapshots": "sum", "first_change": "min"})

    events_conf = marks.sparkSession.conf
    if "RocksDB" not in events_conf.get("spark.sql.streaming.stateStore.providerClass", ""):
        events_conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    slim = marks.mapInPandas(reduce, "table string, snapshots long, first_change double")
    return slim.groupBy("table").transformWithStateInPandas(
        SnapshotWatch(quiet_seconds * 1000), outputStructType="table string, completed_at long, reason string",
        outputMode="Append", timeMode="ProcessingTime",
    )
