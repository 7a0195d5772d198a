"""Stateful processors (``transformWithStateInPandas``) for the reference's
low-level processors: a punctuating max and a punctuating word count.

Scope difference, by design: the reference's punctuators belong to a task and
flush every key of its store; here state and timers are per key, so each key
flushes itself. Keeping every key of a partition in one group would put an
unbounded group into one task.

Stream-time punctuation follows a key's own records in arrival (``seq``) order:
the first record fires, and then each record that takes the key's stream time
over one or more ticks fires once, whether records come in one micro-batch or in
many. A key without records fires nothing by that rule; with ``idle_flush`` an
event-time timer at the key's next tick fires it when the watermark passes.

A key's rows of one micro-batch are folded with vectorised running maxima and
O(1) state calls.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

LONG_STATE = "value long"
MAX_STATE = "max long, stream_time long, first long"
COUNT_STATE = "count long, stream_time long, first long"

STREAM_TIME = "stream-time"
WALL_CLOCK = "wall-clock"
IDLE = "idle"


def crossed_ticks(ms: np.ndarray, stream_time: int | None, first: int | None, tick: int):
    """Rows (in arrival order) that fire -> (which, stream time at each row, time of the first record).

    Ticks lie at multiples of ``tick`` from the first record's time; a late or
    equal time crosses none.
    """
    at = np.maximum.accumulate(ms if stream_time is None else np.maximum(ms, stream_time))
    start = int(at[0]) if first is None else first
    steps = (at - start) // tick
    before = np.concatenate([[-1 if stream_time is None else (stream_time - start) // tick], steps[:-1]])
    return steps > before, at, start


def _in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    batch = pd.concat(list(rows), ignore_index=True)
    return batch[batch["ms"].notna()].sort_values("seq", kind="stable")


def _numbers(row) -> tuple:
    return (None, None, None) if row is None else tuple(None if v is None or pd.isna(v) else int(v) for v in row)


class MaxProcessor(StatefulProcessor):
    """Running max per key; flushes ``(key, max)`` on stream-time ticks and,
    optionally, every ``wall_clock_ms`` of processing time (re-armed after
    each firing, independent of input) or, in event-time mode with
    ``idle_flush``, when the watermark passes the key's next tick.

    Update rule (reference): keep the new value when there is no old value
    or it is larger. Seeds come through ``initialState`` (column ``value``).
    """

    def __init__(self, tick_ms: int, wall_clock_ms: int | None = None, idle_flush: bool = False):
        self.tick_ms = int(tick_ms)
        self.wall_clock_ms = wall_clock_ms
        self.idle_flush = idle_flush

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # one state row per key: a single get and a single update per batch
        self.state = handle.getValueState("max", MAX_STATE)
        self.armed = handle.getValueState("armed", LONG_STATE)

    def _arm(self, timerValues) -> None:
        if self.wall_clock_ms and not self.armed.exists():
            at = timerValues.getCurrentProcessingTimeInMs() + int(self.wall_clock_ms)
            self.handle.registerTimer(at)
            self.armed.update((at,))

    def _arm_tick(self, after: int, first: int) -> None:
        """One pending timer, at the first tick after a time."""
        at = first + ((after - first) // self.tick_ms + 1) * self.tick_ms
        old = self.armed.get()
        if old is None or old[0] != at:
            if old is not None:
                self.handle.deleteTimer(old[0])
            self.handle.registerTimer(at)
            self.armed.update((at,))

    def _out(self, key, values, times, kind):
        return pd.DataFrame({"key": [key[0]] * len(values), "value": values, "stream_time": times, "kind": kind})

    def handleInitialState(self, key, initialState, timerValues) -> None:
        seed = initialState["value"].max()
        cur, st, first = _numbers(self.state.get())
        if pd.notna(seed):
            cur = int(seed) if cur is None else max(cur, int(seed))
            self.state.update((cur, st, first))
        self._arm(timerValues)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        cur, st, first = _numbers(self.state.get())
        batch = _in_order(rows)
        self._arm(timerValues)
        if key[0] is None or batch.empty:
            return
        lowest = np.iinfo(np.int64).min
        values = batch["value"]
        known = values.notna().to_numpy()
        given = np.where(known, values.where(known, lowest).to_numpy(np.int64), lowest)
        top = np.maximum.accumulate(given if cur is None else np.maximum(given, cur))
        fires, at, first = crossed_ticks(batch["ms"].to_numpy(np.int64), st, first, self.tick_ms)
        cur = None if top[-1] == lowest else int(top[-1])
        self.state.update((cur, int(at[-1]), first))
        if self.idle_flush:
            self._arm_tick(int(at[-1]), first)
        fires &= top > lowest
        if fires.any():
            yield self._out(key, top[fires], at[fires], STREAM_TIME)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.armed.clear()
        cur, st, first = _numbers(self.state.get())
        if self.idle_flush:
            st = expiredTimerInfo.getExpiryTimeInMs()
            self._arm_tick(max(st, timerValues.getCurrentWatermarkInMs()), first)
            self.state.update((cur, st, first))  # the key's own records do not fire this tick again
        else:
            self._arm(timerValues)
        if cur is not None:
            yield self._out(key, [cur], [st], IDLE if self.idle_flush else WALL_CLOCK)

    def close(self) -> None:
        pass


class WordCountProcessor(StatefulProcessor):
    """Per-word running count; on each stream-time tick emits
    ``(word, count as text, stream time)``."""

    def __init__(self, tick_ms: int):
        self.tick_ms = int(tick_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("count", COUNT_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, st, first = _numbers(self.state.get())
        batch = _in_order(rows)
        if key[0] is None or batch.empty:
            return
        counts = np.arange(1, len(batch) + 1, dtype=np.int64) + (n or 0)
        fires, at, first = crossed_ticks(batch["ms"].to_numpy(np.int64), st, first, self.tick_ms)
        self.state.update((int(counts[-1]), int(at[-1]), first))
        if fires.any():
            yield pd.DataFrame({"word": [key[0]] * int(fires.sum()), "count": [str(c) for c in counts[fires]],
                                "stream_time": at[fires]})

    def close(self) -> None:
        pass


def max_output_schema(key_type: str = "string") -> str:
    return f"key {key_type}, value long, stream_time long, kind string"


WORD_COUNT_OUTPUT = "word string, count string, stream_time long"


def pre_aggregate_max(df):
    """Map-side thinning before the per-key max processor (stateless, per
    partition and Arrow batch): of each key the rows, in arrival order, that
    raise its largest value or its stream time so far. A row that raises
    neither within its batch cannot do so in the key's whole stream, so the
    processor's state and emissions stay the same. Null values are below all
    others, and rows without a time, which the processor leaves out, count for
    neither."""
    schema = df.schema

    def raises(column, keys):
        top = column.groupby(keys, sort=False).cummax().groupby(keys, sort=False).ffill()
        before = top.groupby(keys, sort=False).shift()
        return (column > before) | (column.notna() & before.isna())

    def thin(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            pdf = pdf.sort_values("seq", kind="stable")
            value = pdf["value"].where(pdf["ms"].notna())
            up = raises(value, pdf["key"]) | raises(pdf["ms"], pdf["key"])
            first = pdf.groupby("key", sort=False).cumcount() == 0
            yield pdf[(up | first) & pdf["key"].notna()][[f.name for f in schema.fields]]

    return df.mapInPandas(thin, schema)
