"""Hosts that fall silent: a row for every polling cycle without a sample, from timed state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from loamwork.streaming.samples import NO_DATA

#: Timed state needs this store.
STORE, ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Silence(StatefulProcessor):
    """State of one host: the last cycle that is settled, and the cycles behind it that have a sample.

    Both are one value, read and written once per call: every look at the state leaves Python, and one per cycle took
    most of the time.

    A timer stands at the end of the first open cycle. When the watermark passes it, all cycles that have ended are
    settled: each without a sample gives a row. The timer then stands at the end of the next cycle, so a host that never
    comes back goes on giving rows, and one that returns stops.
    """

    def __init__(self, cycle_ms: int, metrics: Sequence[str], error: str) -> None:
        self.cycle_ms, self.metrics, self.error = cycle_ms, metrics, error

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "settled bigint, seen array<bigint>")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        cycles, known = {int(r["_cycle"]) for r in rows}, self.state.get()
        if known is None:
            known = (min(cycles) - 1, [])
            self.handle.registerTimer((min(cycles) + 1) * self.cycle_ms)
        last, seen = known[0], set(known[1])
        fresh = {c for c in cycles if c > last} - seen  # a sample of a cycle that is settled already changes nothing
        if fresh:
            self.state.update((last, sorted(seen | fresh)))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        now, (last, open_cycles) = timerValues.getCurrentWatermarkInMs(), self.state.get()
        until = max(last, now // self.cycle_ms - 1)
        seen = set(open_cycles)
        silent = [
            Row(host=key[0], cycle=c, **dict.fromkeys(self.metrics, NO_DATA), error=self.error) for c in range(last + 1, until + 1) if c not in seen
        ]
        self.state.update((until, sorted(c for c in seen if c > until)))
        self.handle.registerTimer((until + 2) * self.cycle_ms)
        return iter(silent)

    def close(self) -> None:
        pass


def dead_rows(samples: DataFrame, host: str, time: str, cycle_seconds: int, metrics: Sequence[str], error: str = "unreachable", delay: str = "0 seconds") -> DataFrame:
    """(cycle, host, metrics..., error): stream of the cycles in which a known host has no sample, ``NO_DATA`` for its metrics.

    Cycles are ``cycle_seconds`` long, from midnight UTC of 1970 on. A host is known from its first sample on. A cycle is
    settled when the watermark, the newest time of any host less ``delay``, has passed its end; each gives one row at
    most, also over restarts. Samples of settled cycles are too late to matter, NULL hosts and times are left out.

    The state is one number per host and the open cycles; the session needs the RocksDB state store (see ``timed_session``).
    """
    if ROCKS.rpartition(".")[2] not in (samples.sparkSession.conf.get(STORE) or ""):
        raise ValueError(f"set {STORE} to {ROCKS}")
    kind = samples.schema[host].dataType
    out = T.StructType().add("host", kind).add("cycle", T.LongType())
    for m in metrics:
        out = out.add(m, T.StringType())
    out = out.add("error", T.StringType())
    number = F.floor(F.unix_micros(F.col(time).cast("timestamp")) / (cycle_seconds * 1_000_000)).cast("long")
    rows = samples.filter(F.col(host).isNotNull() & F.col(time).isNotNull()).select(F.col(host).alias("host"), F.col(time).cast("timestamp").alias("time"), number.alias("_cycle"))
    silent = rows.withWatermark("time", delay).groupBy("host").transformWithState(Silence(cycle_seconds * 1000, list(metrics), error), out, "Append", "EventTime")
    return silent.select(F.timestamp_seconds(F.col("cycle") * cycle_seconds).alias("cycle"), F.col("host").alias(host), *metrics, "error")


def timed_session(spark: SparkSession) -> SparkSession:
    """A session beside the given one, with the state store that timers need; the other keeps its settings."""
    own = spark.newSession()
    own.conf.set(STORE, ROCKS)
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return own
