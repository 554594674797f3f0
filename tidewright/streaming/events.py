"""Windowed counts, deduplication and stateful per-key sequences on event streams.

The per-key operators hold events in a list state until the watermark has passed them, so late rows within the delay fall
into place, and event-time timers bring out what no later event does. A timer at the end of time fires when the
stream is closed (``closing.run_to_end``), so that a finished stream gives the rows of the batch operator. They need the
RocksDB state store.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewright.functions.vectors import status_code
from tidewright.operators.order import _as_list
from tidewright.operators.sequence import LAST_EVENT_SENTINEL
from tidewright.streaming.closing import END_MS, watermarked


def stream_counts(sdf: DataFrame, cols, ts: str, window: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """Rows per key and tumbling window; a window comes out once the watermark has passed it."""
    counted = watermarked(sdf, ts, delay).groupBy(*_as_list(cols), F.window(ts, window)).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*_as_list(cols), F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n")


def stream_dedupe(sdf: DataFrame, key, ts: str, delay: str = "1 day") -> DataFrame:
    """The first row of each key; copies within ``delay`` are dropped."""
    return sdf.withWatermark(ts, delay).dropDuplicatesWithinWatermark(_as_list(key))


def stream_distinct(sdf: DataFrame, key, ts: str, delay: str = "1 day") -> DataFrame:
    """The first row of each key, however far apart its copies lie; the state holds every key."""
    return watermarked(sdf, ts, delay).dropDuplicates(_as_list(key))


def _micros(times: pd.Series) -> pd.Series:
    return times.astype("datetime64[us]").astype("int64")


class _Waiting(StatefulProcessor):
    """Events (micros, value) of a key wait in order of time until the watermark has passed them."""

    def __init__(self, ts: str, value: str, value_type: str, idle_seconds: int | None):
        self.ts, self.value, self.value_type, self.idle = ts, value, value_type, None if idle_seconds is None else idle_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", f"t bigint, v {self.value_type}")

    def take(self, rows: Iterator[pd.DataFrame]) -> bool:
        """Put new events into the state."""
        new = []
        for frame in rows:
            values = frame[self.value]
            new += zip(_micros(frame[self.ts]).tolist(), [None if pd.isna(v) else int(v) for v in values])
        if new:
            self.waiting.appendList(new)
        return bool(new)

    def ordered(self) -> list[tuple]:
        return sorted(self.waiting.get(), key=lambda e: (e[0], e[1] is not None, e[1]))

    def keep(self, events: list[tuple]) -> None:
        if events:
            self.waiting.put(events)
        else:
            self.waiting.clear()

    def wake(self, at_ms: int, mark_ms: int) -> None:
        """Timers of this key: one, at the given time."""
        for timer in list(self.handle.listTimers()):
            if timer != at_ms:
                self.handle.deleteTimer(timer)
        self.handle.registerTimer(max(at_ms, mark_ms + 1))

    def end_after(self, micros: int) -> int:
        """When a key whose last event is this old is over."""
        return END_MS if self.idle is None else -(-micros // 1000) + self.idle

    def close(self) -> None:
        pass


class _Gaps(_Waiting):
    def __init__(self, keys, id, sentinel, **rest):
        super().__init__(value=id, **rest)
        self.names, self.sentinel = [*keys, id, "next_gap"], sentinel

    def handleInputRows(self, key, rows, timerValues):
        self.take(rows)
        return self.settle(key, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return self.settle(key, timerValues)

    def settle(self, key, timer_values):
        mark_ms = timer_values.getCurrentWatermarkInMs()
        events = self.ordered()
        # Pairs whose later event the watermark has passed are final.
        done = 0
        while done + 1 < len(events) and events[done + 1][0] <= mark_ms * 1000:
            done += 1
        out = [(*key, i, after // 1_000_000 - t // 1_000_000) for (t, i), (after, _) in zip(events[:done], events[1: done + 1])]
        left = events[done:]
        if len(left) == 1 and self.end_after(left[0][0]) <= mark_ms:
            out.append((*key, left[0][1], self.sentinel - left[0][0] // 1_000_000))
            left = []
        if done or not left:
            self.keep(left)
        if left:
            self.wake(-(-left[1][0] // 1000) if len(left) > 1 else self.end_after(left[0][0]), mark_ms)
        if out:
            yield pd.DataFrame(out, columns=self.names)


def stream_next_gap(sdf: DataFrame, key, ts: str, id: str, delay: str = "10 minutes", idle_seconds: int | None = None,
                    sentinel: int = LAST_EVENT_SENTINEL) -> DataFrame:
    """Seconds to the next event of a key, as a stream.

    The last event of a key comes out with ``sentinel - t`` when the stream is closed, or ``idle_seconds`` after it, if that is
    given. The state of a key holds the events of about one ``delay``.
    """
    keys = _as_list(key)
    types = dict(sdf.dtypes)
    fields = ", ".join(f"{k} {types[k]}" for k in keys)
    return watermarked(sdf, ts, delay).select(*keys, ts, id).groupBy(*keys).transformWithStateInPandas(
        _Gaps(keys, id, sentinel, ts=ts, value_type="bigint", idle_seconds=idle_seconds),
        f"{fields}, {id} bigint, next_gap bigint", "append", "eventTime",
    )


class _Arrival(_Waiting):
    def __init__(self, series, **rest):
        super().__init__(value="status_code", **rest)
        self.series = series

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.seen = handle.getValueState("seen", "before int, first int, clear_n bigint, answered boolean, latest bigint")

    def handleInputRows(self, key, rows, timerValues):
        self.take(rows)
        return self.settle(key, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return self.settle(key, timerValues)

    def settle(self, key, timer_values):
        mark_ms = timer_values.getCurrentWatermarkInMs()
        before, first, clear_n, answered, latest = self.seen.get() if self.seen.exists() else (0, None, 0, False, 0)
        events = self.ordered()
        latest = max([latest, *[t for t, _ in events[-1:]]])
        done = 0
        answer = None
        while done < len(events) and events[done][0] <= mark_ms * 1000 and not (answered or answer):
            t, code = events[done]
            done += 1
            if code is not None and code < 10:
                first, clear_n = code if first is None else first, clear_n + 1
                if first == 1:
                    answer = (-1, None)
                elif before is not None and code - before == 1:
                    answer = (0, pd.Timestamp(t, unit="us"))
            before = code
        left = [] if answered or answer else events[done:]
        over = not left and self.end_after(latest) <= mark_ms
        if over and not (answered or answer):
            answer = (None if clear_n == 0 else -1 if clear_n == 1 else 0, None)
        if over:
            self.waiting.clear()
            self.seen.clear()
        else:
            if len(left) < len(events):
                self.keep(left)
            self.seen.update((before, first, clear_n, bool(answered or answer), latest))
            self.wake(-(-left[0][0] // 1000) if left else self.end_after(latest), mark_ms)
        if answer:
            status, found = answer
            yield pd.DataFrame({
                self.series: [key[0]], "status": pd.array([status], dtype="Int32"), "found_at": pd.Series([found], dtype="datetime64[us]"),
            })


def stream_first_arrival(sdf: DataFrame, series: str, ts: str, cloud: str, water: str, delay: str = "10 minutes",
                         idle_seconds: int | None = None) -> DataFrame:
    """status and found_at of each series as ``operators.sequence.first_arrival`` gives them, once, as soon as they are known.

    A step from clear-and-dry to clear-and-wet, or a first clear observation that is already wet, answers at once; any other
    series answers when the stream is closed, or ``idle_seconds`` after its last event, if that is given, and then leaves the state. Until
    then an answered series keeps one short row, so that it does not answer twice.
    """
    coded = watermarked(sdf.withColumn("status_code", status_code(cloud, water)), ts, delay).select(series, ts, "status_code")
    kind = dict(sdf.dtypes)[series]
    return coded.groupBy(series).transformWithStateInPandas(
        _Arrival(series, ts=ts, value_type="int", idle_seconds=idle_seconds),
        f"{series} {kind}, status int, found_at timestamp", "append", "eventTime",
    )
