"""Task leases: claims and results of workers in event time, one state a task, its end by a timer."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Fixed value: minutes that a lease lasts.
LEASE_MINUTES = 30
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "task string, event_id long, millis long, outcome string"


class _Leases(StatefulProcessor):
    """State: the end of a task's live lease, in milliseconds.

    Every use of the state or a timer is a message to the JVM and back, so a batch reads its task's lease once and writes the one it leaves.
    """

    def __init__(self, millis: int):
        self.millis = millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lease = handle.getValueState("lease", "until long")

    def _leave(self, before: int | None, until: int | None) -> None:
        if before == until:
            return
        if before is not None:
            self.handle.deleteTimer(before)
        if until is None:
            self.lease.clear()
        else:
            self.lease.update((until,))
            self.handle.registerTimer(until)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        events = sorted((r["millis"], r["event_id"], r["kind"]) for r in rows)
        held, out = self.lease.get(), []
        until = before = None if held is None else held[0]
        for at, event, kind in events:
            if until is not None and at >= until:
                out.append((None, until, "expired"))
                until = None
            if kind == "claim" and until is None:
                until = at + self.millis
                out.append((event, at, "granted"))
            elif kind == "claim":
                out.append((event, at, "busy"))
            elif until is not None:
                until = None
                out.append((event, at, "accepted"))
            else:
                out.append((event, at, "lease_lost"))
        self._leave(before, until)
        return (Row(task=key[0], event_id=e, millis=a, outcome=o) for e, a, o in out)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        until, held = expiredTimerInfo.getExpiryTimeInMs(), self.lease.get()
        if held is not None and held[0] == until:
            self.lease.clear()
            yield Row(task=key[0], event_id=None, millis=until, outcome="expired")

    def close(self) -> None:
        pass


def leases(requests: DataFrame, minutes: int = LEASE_MINUTES, delay: str = "1 hour") -> DataFrame:
    """(task, event_id, at, outcome) of a stream of requests (task, event_id, at, kind: claim or result).

    A claim is granted where the task has no live lease, else busy; a result is accepted within a lease, which it ends, else the lease is
    lost.  A lease that no result ends expires, by a later request of the task or when the watermark passes its end, and
    the task can be claimed again.  Requests of one task are taken in order of time, then id; those of a batch together.
    """
    timed = requests.select(F.col("task").cast("string").alias("task"), "event_id", F.col("at").cast("timestamp").alias("at"), "kind").withWatermark("at", delay)
    keyed = timed.withColumn("millis", F.unix_millis("at")).groupBy("task")
    told = keyed.transformWithState(statefulProcessor=_Leases(minutes * 60_000), outputStructType=OUT, outputMode="Append", timeMode="EventTime")
    return told.select("task", "event_id", F.timestamp_millis("millis").alias("at"), "outcome")


def with_rocks(spark: SparkSession, start):
    """What ``start()`` returns, with the state store that this operator needs while the query is started; the session's own stays."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, _ROCKS)
    try:
        return start()
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
