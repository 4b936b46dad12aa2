"""Dormancy with one timer per customer: state that ends itself.

Each customer's open spells are kept with a single event-time timer at the earliest end; an event extends, joins
or opens spells and re-arms the timer, and when the watermark passes it the ended spells are emitted and their
state is dropped. Nothing is kept for a customer without an open spell. The watermark moves with the events of
all customers; ``with_clock`` adds a stream of clock ticks, so that a stream that falls silent altogether still
ends its spells.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.streaming.triggers import DORMANT_AFTER

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _micros(value: pd.Timestamp) -> int:
    return value.value // 1000


class DormancyTimer(StatefulProcessor):
    """Open spells of a customer: first and last event in microseconds, and the number of events."""

    def __init__(self, key: str, ts: str, gap_micros: int):
        self.key, self.ts, self.gap = key, ts, gap_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spells = handle.getListState("spells", "first bigint, last bigint, events bigint")

    def _arm(self, spells: list[tuple[int, int, int]]) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if spells:
            end = min(last for _, last, _ in spells) + self.gap
            self.handle.registerTimer(-(-end // 1000))  # timers count milliseconds: never before the end

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        spells = [tuple(s) for s in self.spells.get()] if self.spells.exists() else []
        for part in rows:
            spells += [(m, m, 1) for m in map(_micros, part[self.ts])]
        joined: list[tuple[int, int, int]] = []
        for first, last, events in sorted(spells):
            if joined and first < joined[-1][1] + self.gap:
                a, b, n = joined[-1]
                joined[-1] = (a, max(b, last), n + events)
            else:
                joined.append((first, last, events))
        if joined:
            self.spells.put(joined)
            self._arm(joined)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000  # all that ended by now, not only the one that was timed
        spells = [tuple(s) for s in self.spells.get()] if self.spells.exists() else []
        ended = [s for s in spells if s[1] + self.gap <= now]
        left = [s for s in spells if s[1] + self.gap > now]
        if left:
            self.spells.put(left)
        else:
            self.spells.clear()
        self._arm(left)
        if ended:
            at = lambda k, more=0: pd.to_datetime([s[k] + more for s in ended], unit="us")
            yield pd.DataFrame(
                {
                    self.key: [key[0]] * len(ended), "active_from": at(0), "last_event": at(1),
                    "dormant_at": at(1, self.gap), "events": [s[2] for s in ended],
                }
            )

    def close(self) -> None:
        pass


def with_clock(events: DataFrame, ticks: DataFrame, key: str = "customer_id", ts: str = "ts") -> DataFrame:
    """Events and clock ticks (one column, a time) as one stream; a tick has no customer and only moves the watermark."""
    nobody = F.lit(None).cast(events.schema[key].dataType).alias(key)
    return events.select(key, ts).unionByName(ticks.select(nobody, F.col(ticks.columns[0]).alias(ts)))


def timed_dormancy(
    events: DataFrame, key: str = "customer_id", ts: str = "ts", gap: dt.timedelta = DORMANT_AFTER, lateness: str = "1 day"
) -> DataFrame:
    """The rows of ``dormancy`` on a stream, by keyed timers.

    Events older than the watermark are dropped. Events without a customer move the watermark and are dropped then.
    Needs the state store that keeps timers (set here for the session).
    """
    spark: SparkSession = events.sparkSession
    spark.conf.set(PROVIDER, ROCKSDB)
    # one expression with the time in it, so that the filter stays above the watermark
    known = events.select(key, ts).withWatermark(ts, lateness).where(F.when(F.col(key).isNotNull(), F.col(ts)).isNotNull())
    out = T.StructType(
        [T.StructField(key, events.schema[key].dataType)]
        + [T.StructField(c, T.TimestampType()) for c in ("active_from", "last_event", "dormant_at")]
        + [T.StructField("events", T.LongType())]
    )
    return known.groupBy(key).transformWithStateInPandas(
        DormancyTimer(key, ts, int(gap.total_seconds() * 1_000_000)), outputStructType=out, outputMode="append", timeMode="eventTime"
    )
