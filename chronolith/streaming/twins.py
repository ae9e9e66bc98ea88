"""Structured Streaming twins of batch operators; on a closed input they give what the batch operator gives."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def deduplicated(messages: DataFrame, t: str, keys: list[str], delay: str) -> DataFrame:
    """Exact repeats within the watermark are dropped."""
    return messages.withWatermark(t, delay).dropDuplicatesWithinWatermark(keys)


def tick_counts(ticks: DataFrame, t: str, keys: list[str], valid: str, window: str, delay: str) -> DataFrame:
    """Samples and valid samples of each entity and window."""
    grouped = ticks.withWatermark(t, delay).groupBy(F.window(t, window), *keys)
    return grouped.agg(F.count("*").alias("samples"), F.count_if(F.col(valid)).alias("valid")).select("window.start", *keys, "samples", "valid")


class Ordered(StatefulProcessor):
    """Rows of a key in the order of ``t`` (seconds, the event time): a row waits until the watermark has passed it.

    So neither the order of chunks nor that of micro-batches matters, as far as rows are no later than the delay. Rows
    that wait are the only unbounded state, and the watermark bounds them.
    """

    PENDING = "t double"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", self.PENDING)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.pending.appendList([tuple(r) for part in rows for r in part[self.columns()].itertuples(index=False)])
        yield self.due(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield self.due(key, timerValues.getCurrentWatermarkInMs())

    def columns(self) -> list[str]:
        return [c.split()[0] for c in self.PENDING.split(", ")]

    def due(self, key, watermark: int) -> pd.DataFrame:
        """Work off the rows up to the watermark and ask to be called when it passes the next one."""
        rows = sorted(self.pending.get(), key=self.order) if self.pending.exists() else []
        ready = [tuple(r) for r in rows if r[0] * 1000 <= watermark]
        rest = [tuple(r) for r in rows[len(ready) :]]
        out = self.work(key, ready, watermark / 1000)
        if rest:
            self.pending.put(rest)
        else:
            self.pending.clear()
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        wake = [t for t in (rest[0][0] if rest else None, self.next_end()) if t is not None]
        if wake:
            self.handle.registerTimer(max(int(min(wake) * 1000) + 1, watermark + 1))
        return out

    def next_end(self) -> float | None:
        """When the state itself runs out."""
        return None

    def close(self) -> None:
        pass


class OpenIntervals(Ordered):
    """start opens an interval if none is open, end closes it; one that is open for more than ``longest`` seconds is unclosed."""

    PENDING = "t double, edge string"

    def __init__(self, longest: float):
        self.longest = longest

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.start = handle.getValueState("start", "t double")

    @staticmethod
    def order(row) -> tuple:
        return row[0], row[1] != "start"

    def next_end(self) -> float | None:
        return self.start.get()[0] + self.longest if self.start.exists() else None

    def work(self, key, rows: list[tuple], now: float) -> pd.DataFrame:
        out, open_ = [], self.start.get()[0] if self.start.exists() else None
        for t, edge in [*rows, (now, None)]:
            if open_ is not None and t > open_ + self.longest:
                out.append((key[0], open_, None))
                open_ = None
            if edge == "start" and open_ is None:
                open_ = t
            elif edge == "end" and open_ is not None:
                if t > open_:
                    out.append((key[0], open_, t))
                open_ = None
        if open_ is None:
            self.start.clear()
        else:
            self.start.update((float(open_),))
        return pd.DataFrame(out, columns=["key", "start", "end"]).astype({"start": "float64", "end": "float64"})


def intervals(markers: DataFrame, key: str, delay: str, longest: float) -> DataFrame:
    """``evidence.marker_intervals`` of a stream of markers (ts timestamp, edge string), by key; ``end`` is null for an unclosed one.

    An interval is out when the watermark has passed its end, an unclosed one when the watermark is ``longest`` seconds
    past its start; intervals are taken to be no longer than that. Times are seconds since 1970.
    """
    rows = markers.withWatermark("ts", delay).where(F.col("edge").isin("start", "end"))
    rows = rows.select(F.col(key).cast("long").alias("key"), "ts", _seconds("ts").alias("t"), "edge")
    return rows.groupBy("key").transformWithStateInPandas(OpenIntervals(longest), "key long, start double, end double", "Append", "EventTime")


class Hold(Ordered):
    """Holds the last value with its time; a tick takes it while it is at most ``age`` old."""

    PENDING = "t double, v double"

    def __init__(self, age: float):
        self.age = age

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "t double, v double")

    @staticmethod
    def order(row) -> tuple:
        return row[0], row[1] is None or row[1] != row[1]

    def next_end(self) -> float | None:
        return self.last.get()[0] + self.age if self.last.exists() else None

    def work(self, key, rows: list[tuple], now: float) -> pd.DataFrame:
        last, out = tuple(self.last.get()) if self.last.exists() else None, []
        for t, v in rows:
            if v is not None and v == v:
                last = (float(t), float(v))
            else:
                out.append((key[0], t, last[1] if last and t - last[0] <= self.age else None))
        if last and now - last[0] <= self.age:
            self.last.update(last)
        else:
            self.last.clear()
        return pd.DataFrame(out, columns=["key", "t", "held"]).astype({"t": "float64", "held": "float64"})


def held(stream: DataFrame, key: str, delay: str, age: float) -> DataFrame:
    """``joins.asof`` with ``max_age`` on a stream: rows (ts timestamp, v double) with v are updates, rows without are ticks.

    A tick is out, with the value held at its time, when the watermark has passed it; of an update and a tick at one time
    the update comes first.
    """
    rows = stream.withWatermark("ts", delay).select(F.col(key).cast("long").alias("key"), "ts", _seconds("ts").alias("t"), F.col("v").cast("double").alias("v"))
    return rows.groupBy("key").transformWithStateInPandas(Hold(age), "key long, t double, held double", "Append", "EventTime")


def _seconds(ts: str) -> Column:
    return F.unix_micros(ts) / 1_000_000
